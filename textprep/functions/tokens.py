"""Tokens, n-grams and fixed-length sequences as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textprep.config import PADDING_ID, SEQUENCE_SEPARATORS

WORD_RUN = r"[\p{L}\p{N}_]{2,}"


def word_tokens(text: Column) -> Column:
    """Runs of two or more word characters; the caller lowercases."""
    return F.regexp_extract_all(text, F.lit(WORD_RUN), F.lit(0))


def word_ngrams(tokens: Column, low: int, high: int) -> Column:
    """All n-grams with low <= n <= high, joined by one space."""
    grams, wanted = tokens, []
    for n in range(1, high + 1):
        if n > 1:
            # Each gram takes the token after it: two lists are paired instead
            # of cutting a slice per position.
            count = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
            grams = F.zip_with(
                F.slice(grams, 1, count),
                F.slice(tokens, n, count),
                lambda gram, token: F.concat(gram, F.lit(" "), token),
            )
        if n >= low:
            wanted.append(grams)
    return F.concat(*wanted)


def sequence_tokens(text: Column) -> Column:
    """Lower-cased words between separators, in order."""
    blanks = " " * len(SEQUENCE_SEPARATORS)
    spaced = F.translate(F.lower(text), SEQUENCE_SEPARATORS, blanks)
    return F.array_remove(F.split(spaced, " "), "")


def _require_room(max_len: int) -> None:
    if max_len < 1:
        raise ValueError(f"a sequence cannot be cut to {max_len} items")


def truncate_post(seq: Column, max_len: int) -> Column:
    """The first ``max_len`` items."""
    _require_room(max_len)
    return F.slice(seq, 1, max_len)


def truncate_head_tail(seq: Column, max_len: int) -> Column:
    """The items at the head or the tail; both together are ``max_len`` places.

    In a sequence that fits, every item belongs to one of them.
    """
    _require_room(max_len)
    head = max(1, max_len // 2)
    tail_from = F.size(seq) - (max_len - head)
    return F.filter(seq, lambda _, i: (i < head) | (i >= tail_from))


def truncate(seq: Column, max_len: int, strategy: str) -> Column:
    if strategy == "head_tail":
        return truncate_head_tail(seq, max_len)
    if strategy == "post":
        return truncate_post(seq, max_len)
    raise ValueError(f"unknown truncate strategy: {strategy}")


def pad_post(seq: Column, max_len: int) -> Column:
    """Fill up with the padding id to exactly ``max_len`` items."""
    missing = F.greatest(F.lit(max_len) - F.size(seq), F.lit(0))
    return F.concat(seq, F.array_repeat(F.lit(PADDING_ID), missing))


def attention_mask(padded: Column) -> Column:
    """1 for a real item, 0 for padding (no word has the padding id)."""
    return F.transform(padded, lambda v: (v != PADDING_ID).cast("int"))
