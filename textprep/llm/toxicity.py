"""Toxicity by compression distance.

Zstandard dictionaries hold what sets toxic and ordinary text apart, one pair of
them short strings found nearly nowhere else, a second pair longer and merely
typical ones. Each window of a text is compressed with both dictionaries of a
pair; where the toxic one saves bytes, the window resembles toxic text.
Calibrated on the training sample, the savings of all windows give the score of
the document.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from textprep.llm.compression import Coder, contrast_segments, fit_logistic, probability, windows
from textprep.llm.labelled import labelled_sample, scored

WINDOW = 128
# The run of one byte makes every window compressible, so that zstandard never
# stores it as it is and each saved byte shows.
FILLER = b"\n" * 40
# Per pair: bytes of a string and of the shortest match, how typical a string has
# to be, and the saving from which a window counts.
PAIRS = ((5, 4.0, 2), (7, 2.0, 3))
# With these two values zstandard never entropy-codes literals, so what a window
# saves is what the dictionary matched.
CODER = {"strategy": 1, "target_length": 1}
TRAIN = {1: 1500, 0: 3000}
MAX_CHARS = 20_000
FOLDS, HELD = 5, 0


class Savings:
    """What the toxic dictionary of each pair saves on the windows of a text."""

    def __init__(self, pairs: list[tuple[bytes, bytes]]):
        self.coders = [
            (*(Coder(content, min_match=gram, **CODER) for content in pair), clear)
            for pair, (gram, _, clear) in zip(pairs, PAIRS)
        ]

    def __call__(self, texts: list[str]) -> np.ndarray:
        rows = np.zeros((len(texts), 6 * len(self.coders) + 1))
        for i, text in enumerate(texts):
            parts = [w + FILLER for w in windows(text.lower().encode(), WINDOW)]
            if parts:
                measures = [m for coders in self.coders for m in self._measures(parts, *coders)]
                rows[i] = *measures, np.log1p(len(parts))
        return rows

    @staticmethod
    def _measures(parts: list[bytes], toxic: Coder, ordinary: Coder, clear: int) -> tuple:
        saved = np.sort(np.maximum(ordinary.lengths(parts) - toxic.lengths(parts), 0))[::-1]
        total = saved[saved >= clear].sum()
        second = saved[1] if len(saved) > 1 else 0
        return (
            np.log1p(total), total / len(saved), (saved >= 1).mean(), (saved >= clear).mean(),
            np.sqrt(saved[0]), np.sqrt(second),
        )


def fit(sample: list[tuple[str, int]]) -> tuple[list[tuple[bytes, bytes]], np.ndarray]:
    """The contents of the toxic and the ordinary dictionary of each pair, and the calibration weights."""
    toxic = [t.lower().encode() for t, y in sample if y == 1]
    ordinary = [t.lower().encode() for t, y in sample if y == 0]
    pairs = [
        (
            contrast_segments(toxic, ordinary, lift=lift, words_only=True, gram=gram),
            contrast_segments(ordinary, toxic, lift=1.0, words_only=True, gram=gram),
        )
        for gram, lift, _ in PAIRS
    ]
    x = Savings(pairs)([t for t, _ in sample])
    return pairs, fit_logistic(x, np.array([y for _, y in sample], float))


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = FOLDS,
    held: int = HELD,
    train: dict = TRAIN,
    max_chars: int = MAX_CHARS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (score >= 0.5).

    The model learns from at most ``train[label]`` documents of each class, none of
    them in the held-out fold, and of longer texts from a window of ``max_chars``
    characters; scoring takes whole texts. Null and empty texts have no window and get the score of
    a text without any saving. Without labels every score is near 0. Repeated
    rows score alike; extra columns are ignored; an empty table gives an empty
    result.
    """
    sample, _ = labelled_sample(docs, labels, "toxic", folds, held, train, max_chars)
    pairs, weights = fit(sample)

    def start():
        savings = Savings(pairs)
        return lambda texts: probability(savings(texts), weights)

    return scored(docs, folds, held, start, 0.5)
