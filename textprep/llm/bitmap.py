"""A filter of fixed size for keys that a later join decides exactly."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textprep.session import stage

# 8 MiB travel to every task, whatever the number of keys. With more keys the
# filter lets more rows through that the join then drops; it never loses a key.
BITS = 1 << 26


def slot(key: Column, bits: int = BITS) -> Column:
    """The place of a 64-bit key: its bits folded, without arithmetic that can overflow."""
    folded = key.bitwiseXOR(F.shiftrightunsigned(key, 29)).bitwiseXOR(F.shiftrightunsigned(key, 43))
    return folded.bitwiseAND(F.lit(bits - 1))


def slots(keys: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The same for an array of 64-bit integers."""
    x = keys.view(np.uint64)
    return ((x ^ (x >> np.uint64(29)) ^ (x >> np.uint64(43))) & np.uint64(bits - 1)).astype(np.int64)


def marked(keys: DataFrame, key: str, bits: int = BITS) -> np.ndarray:
    """The bytes of the filter that holds all keys of a table.

    Spark ors them together in pieces of 4 KiB; the driver gets each piece once.
    """
    place = slot(F.col(key), bits) + 1  # Spark numbers values and pieces from one
    pieces = keys.groupBy(F.bitmap_bucket_number(place).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    found = np.zeros(-(-bits // 32768) * 4096, np.uint8)
    for row in stage(pieces, "bitmap").toLocalIterator():
        start = (row["piece"] - 1) * 4096
        found[start : start + 4096] = np.frombuffer(row["bits"], np.uint8)
    return found


def held(found: np.ndarray, keys: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Which keys may be in the table; false only for keys that are not."""
    at = slots(keys, bits)
    return (found[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
