"""Classifying text by how well zstandard dictionaries of two classes code it.

A dictionary holds the segments that set its class apart from the other, with or
without a base trained on both, so text that is typical of neither class costs
nearly the same under both. Everything here works on a bounded training sample on the driver or
inside tasks on one text at a time.
"""

from __future__ import annotations

import numpy as np
import zstandard

GRAM = 5
BASE_BYTES = 8 << 10
SEGMENTS = 400


def windows(text: bytes, size: int) -> list[bytes]:
    """The whole text in windows of ``size`` bytes; an empty text has none."""
    return [text[i : i + size] for i in range(0, len(text), size)]


def _grams(text: bytes, n: int) -> np.ndarray:
    """The distinct n-byte strings of a text as integers."""
    data = np.frombuffer(text, np.uint8).astype(np.int64)
    if len(data) < n:
        return np.empty(0, np.int64)
    code = np.zeros(len(data) - n + 1, np.int64)
    for i in range(n):
        code = (code << 8) | data[i : len(data) - n + 1 + i]
    return np.unique(code)


def _document_counts(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-byte strings of the texts, sorted, and in how many texts each occurs."""
    found = [_grams(t, n) for t in texts]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.unique(np.concatenate(found), return_counts=True)


def _joined(grams: list[bytes]) -> list[bytes]:
    """Strings that overlap by all but one byte, joined into longer segments."""
    unused = dict.fromkeys(grams)
    starts: dict[bytes, list[bytes]] = {}
    ends: dict[bytes, list[bytes]] = {}
    for g in grams:
        starts.setdefault(g[:-1], []).append(g)
        ends.setdefault(g[1:], []).append(g)
    segments = []
    for g in grams:
        if g not in unused:
            continue
        del unused[g]
        segment = g
        while len(segment) < 32 and (after := next((x for x in starts.get(segment[1 - len(g) :], ()) if x in unused), None)):
            del unused[after]
            segment += after[-1:]
        while len(segment) < 32 and (before := next((x for x in ends.get(segment[: len(g) - 1], ()) if x in unused), None)):
            del unused[before]
            segment = before[:1] + segment
        segments.append(segment)
    return segments


def _inside_words(grams: np.ndarray, n: int) -> np.ndarray:
    """Whether all bytes but the first and the last belong to letters or digits."""
    fits = np.ones(len(grams), bool)
    for i in range(1, n - 1):
        b = (grams >> (8 * i)) & 255
        fits &= ((b | 32) >= 97) & ((b | 32) <= 122) | (b >= 128) | (b >= 48) & (b <= 57)
    return fits


def contrast_segments(
    of: list[bytes], against: list[bytes], lift: float, words_only: bool, most: int = SEGMENTS, gram: int = GRAM
) -> bytes:
    """Segments of ``gram`` bytes (at most 7) or more that occur in many texts of ``of`` and rarely in ``against``.

    Only strings whose share of texts is over e^lift times that of the other
    class count. The most telling come last, where the coder reaches them at the
    least cost.
    """
    grams, counts = _document_counts(of, gram)
    others, other_counts = _document_counts(against, gram)
    if not len(grams):
        return b""
    place = np.searchsorted(others, grams)
    place[place == len(others)] = 0
    elsewhere = np.where(others[place] == grams, other_counts[place], 0) if len(others) else np.zeros(len(grams))
    rate, other_rate = counts / len(of), (elsewhere + 0.5) / (len(against) + 1)
    gain = np.log(rate / other_rate)
    fits = _inside_words(grams, gram) if words_only else np.ones(len(grams), bool)
    weight = np.where(fits & (counts >= max(3, 0.01 * len(of))) & (gain > lift), rate * gain, 0.0)
    order = np.argsort(-weight, kind="stable")[:most]
    chosen = [int(grams[i]).to_bytes(gram, "big") for i in order if weight[i] > 0]
    return b"\n".join(reversed(_joined(chosen)))


def trained_base(texts: list[bytes], size: int = BASE_BYTES) -> bytes:
    """A dictionary trained on the texts, as plain content.

    The trainer needs far more text than the size asked for; with less, the
    last texts themselves serve.
    """
    samples = [w for t in texts for w in windows(t, 512) if len(w) >= 8]
    total = sum(map(len, samples))
    if total < 100 * size:
        return b"".join(samples)[-size:]
    step = max(1, total // (400 * size))
    return zstandard.train_dictionary(size, samples[::step], k=256, d=8).as_bytes()[-size * 3 // 4 :]


class Coder:
    """Compressed lengths under one dictionary."""

    def __init__(self, content: bytes, window_log: int = 14, **parameters: int):
        code = zstandard.ZstdCompressionParameters(
            window_log=window_log,
            hash_log=12,
            chain_log=12,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
            **parameters,
        )
        # A dictionary needs eight bytes; one that no text matches stands for none.
        words = zstandard.ZstdCompressionDict(content.ljust(8, b"\0"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._compress = zstandard.ZstdCompressor(dict_data=words, compression_params=code).compress

    def lengths(self, parts: list[bytes]) -> np.ndarray:
        compress = self._compress
        return np.fromiter((len(compress(p)) for p in parts), np.int64, len(parts))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Newton's method; the last weight is the intercept. One class gives a constant, no rows zero."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    if len(y) == 0:
        w[-1] = -30.0
        return w
    share = np.clip(y.mean(), 0.5 / (len(y) + 1), 1 - 0.5 / (len(y) + 1))
    w[-1] = np.log(share / (1 - share))
    ridge = penalty * len(y) * np.eye(len(w))
    ridge[-1, -1] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge @ w - ridge[-1] * w[-1]
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
