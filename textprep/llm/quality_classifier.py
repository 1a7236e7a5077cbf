"""Quality by compression: which class's dictionary codes a text shorter.

Both dictionaries start from one base trained on all texts and end with the
segments that set good and bad text apart. The difference of the compressed
sizes, as a share of the text, and the compressed share itself are calibrated
to a score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from textprep.llm.compression import Coder, contrast_segments, fit_logistic, probability, trained_base, windows
from textprep.llm.labelled import labelled_sample, scored

WINDOW = 1 << 10
LONG_WINDOW = 64 << 10
CODER = {"strategy": 3, "min_match": 4, "search_log": 3, "window_log": 17}
TRAIN = {1: 2500, 0: 2500}
MAX_CHARS = 20_000
FOLDS, HELD = 4, 2


def _features(texts: list[str], good: Coder, bad: Coder) -> np.ndarray:
    rows = np.zeros((len(texts), 6))
    for i, text in enumerate(texts):
        data = text.encode()
        if not data:
            continue
        # Short windows meet little of their own text, so the dictionaries tell;
        # long ones show how much a text repeats itself.
        parts = windows(data, WINDOW)
        under_good, under_bad = good.lengths(parts), bad.lengths(parts)
        difference = (under_bad.sum() - under_good.sum()) / max(under_bad.sum(), under_good.sum())
        worst = ((under_bad - under_good) / np.maximum(under_bad, under_good)).min()
        share = good.lengths(windows(data, LONG_WINDOW)).sum() / len(data)
        rows[i] = 10 * difference, np.tanh(20 * difference), np.tanh(20 * worst), share, min(share, 0.3), np.log1p(len(data)) / 10
    return rows


def fit(sample: list[tuple[str, int]], sizes: dict[int, int]) -> tuple[bytes, bytes, np.ndarray]:
    """The contents of both dictionaries and the calibration weights.

    ``sizes`` are the documents of each class in all: the sample holds as many
    of either class as it can, and the intercept makes up for that.
    """
    good = [t.encode() for t, y in sample if y == 1]
    bad = [t.encode() for t, y in sample if y == 0]
    base = trained_base(good + bad)
    first = base + contrast_segments(good, bad, lift=1.0, words_only=False)
    second = base + contrast_segments(bad, good, lift=1.0, words_only=False)
    x = _features([t for t, _ in sample], Coder(first, **CODER), Coder(second, **CODER))
    weights = fit_logistic(x, np.array([y for _, y in sample], float))
    if good and bad:
        weights[-1] += np.log(sizes[1] / len(good)) - np.log(sizes[0] / len(bad))
    return first, second, weights


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = FOLDS,
    held: int = HELD,
    train: dict = TRAIN,
    max_chars: int = MAX_CHARS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (score >= 0.7).

    The model learns from at most ``train[label]`` documents of each class, none of
    them in the held-out fold, and of longer texts from a window of ``max_chars``
    characters; scoring takes whole texts. Null and empty texts have neither difference nor size and
    get the score those measures give. Without labels every score is near 0.
    Repeated rows score alike; extra columns are ignored; an empty table gives
    an empty result.
    """
    first, second, weights = fit(*labelled_sample(docs, labels, "quality", folds, held, train, max_chars))

    def start():
        good, bad = Coder(first, **CODER), Coder(second, **CODER)
        return lambda texts: probability(_features(texts, good, bad), weights)

    return scored(docs, folds, held, start, 0.7)
