"""Probabilities and thresholds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textprep.config import SWEEP_COUNT, SWEEP_START, SWEEP_STEP

# The distance between neighbours as floating point sees it, so that threshold
# i is exactly SWEEP_START + i * STEP.
STEP = (SWEEP_START + SWEEP_STEP) - SWEEP_START


def apply_threshold(prob: Column, threshold: float) -> Column:
    return (prob >= F.lit(float(threshold))).cast("int")


def softmax_prob(logits: Column) -> Column:
    """Probability of class 1 under a softmax that cannot overflow."""
    top = F.array_max(logits)
    parts = F.transform(logits, lambda x: F.exp(x.cast("double") - top))
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return F.element_at(parts, 2) / total


def sweep_threshold(index: Column) -> Column:
    return F.lit(SWEEP_START) + index * F.lit(STEP)


def thresholds_passed(prob: Column) -> Column:
    """How many thresholds of the sweep are <= ``prob``.

    The division only guesses; the two comparisons against the thresholds
    themselves make the count exact.
    """
    guess = F.floor((prob - F.lit(SWEEP_START)) / F.lit(STEP)).cast("int")
    guess = F.least(F.greatest(guess, F.lit(-1)), F.lit(SWEEP_COUNT))
    above = (prob >= sweep_threshold(guess + 1)).cast("int")
    below = (prob < sweep_threshold(guess)).cast("int")
    return F.least(F.greatest(guess + 1 + above - below, F.lit(0)), F.lit(SWEEP_COUNT))
