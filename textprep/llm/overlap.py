"""Exact overlap of candidate pairs as a blocked sparse product.

Documents are dealt to blocks, near each other if they are paired. Every cell of
the block matrix that holds a pair gets what the two blocks bring once, not once
per pair, and lies in one task of bounded size. For sets of n-grams a cell is a
sparse matrix of documents by n-grams: each row, spread out over the n-grams, is
multiplied with the rows of all its partners at once, which accumulates their
overlaps, and entries below the bound of the set sizes are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textprep.llm.bitmap import held as may_hold
from textprep.llm.bitmap import marked
from textprep.llm.shingles import shingle_sets
from textprep.operators.skew import lookup
from textprep.session import stage

PAIR = "a bigint, n_a bigint, b bigint, n_b bigint"
# N-grams of the documents of one block; a longer document is a block of its own.
BLOCK_SHINGLES = 500_000
_PIECE = 1 << 20


def needed(percent: int, n):
    """The smallest overlap with which sets of n and n elements are similar."""
    return -(-percent * n // 100)


def overlap_needed(percent: int, n, m):
    """The smallest o with 100 o >= percent (n + m - o)."""
    return -(-percent * (n + m) // (100 + percent))


def in_cells(pairs: DataFrame, things: DataFrame, compare: Callable, capacity: int, weight: str, found_in: str) -> DataFrame:
    """The pairs (a, n_a, b, n_b) that ``compare`` lets pass, staged as ``found_in``.

    ``things`` holds (doc_id, n, thing) of at least all ids in ``pairs``, which are
    staged. ``weight`` is an expression over n; the documents of one block weigh
    ``capacity`` or little more, or are a single one. Documents are put into blocks
    by their smallest partner, many small groups to a block, a large group in
    several. ``compare`` gets the two columns of ids, and the things by id.
    """
    ends = pairs.select(F.col("a").alias("doc_id"), F.col("n_a").alias("n"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("doc_id"), F.col("n_b").alias("n"), F.col("a").alias("other"))
    )
    heads = stage(
        ends.groupBy("doc_id").agg(
            F.max(F.expr(weight)).cast("bigint").alias("weight"),
            F.least(F.min("other"), F.first("doc_id")).alias("head"),
            F.count(F.lit(1)).alias("degree"),
        ),
        f"{found_in}-heads",
    )
    blocks = max(1, -(-(heads.agg(F.sum("weight").alias("w")).first()["w"] or 0) // capacity))
    crowds = stage(heads.groupBy("head").agg(F.sum("weight").alias("crowd"), F.count(F.lit(1)).alias("members")), f"{found_in}-crowds")
    parts = F.ceil(F.col("crowd") / capacity)
    block = F.when(F.col("crowd") > capacity, F.xxhash64("head", F.pmod(F.xxhash64("doc_id"), parts)))
    placed = lookup(heads, crowds, "head", ["crowd"], "doc_id", "members").select(
        "doc_id", "degree", block.otherwise(F.pmod(F.xxhash64("head"), F.lit(blocks))).alias("block")
    )
    placed = stage(placed, f"{found_in}-blocks")
    celled = pairs.select("a", "b")
    for end, other in (("a", "b"), ("b", "a")):
        mine = placed.select(F.col("doc_id").alias(end), F.col("block").alias(f"block_{end}"), "degree")
        celled = lookup(celled, mine, end, [f"block_{end}"], other, "degree")
    cell = F.xxhash64(F.least("block_a", "block_b"), F.greatest("block_a", "block_b"))
    celled = stage(celled.select(cell.alias("cell"), "a", "b"), f"{found_in}-cells")
    wanted = celled.select("cell", F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    # The same join at every size: what is small now would be broadcast otherwise.
    brought = things.join(wanted.hint("merge"), "doc_id").select(F.col("cell").alias("place"), "doc_id", "n", "thing")

    def run(key: tuple, some: pa.Table, held: pa.Table) -> pa.Table:
        a, b = (some.column(c).to_numpy() for c in "ab")
        ids, n = (held.column(c).to_numpy() for c in ("doc_id", "n"))
        order = np.argsort(ids, kind="stable")
        ids, n = ids[order], n[order]
        # Rows that repeat an id stand side by side: a pair of ids is a pair of runs.
        low = [np.searchsorted(ids, x, side="left") for x in (a, b)]
        high = [np.searchsorted(ids, x, side="right") for x in (a, b)]
        runs = [h - s for h, s in zip(high, low)]
        each = runs[0] * runs[1]
        pair = np.repeat(np.arange(len(a)), each)
        turn = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
        x, y = low[0][pair] + turn // np.maximum(runs[1][pair], 1), low[1][pair] + turn % np.maximum(runs[1][pair], 1)
        stay = compare(x, y, n, held.column("thing").take(pa.array(order)))
        kept, once = np.unique(pair[stay], return_index=True)
        x, y = x[stay][once], y[stay][once]
        return pa.table({"a": a[kept], "n_a": n[x], "b": b[kept], "n_b": n[y]})

    return stage(celled.groupBy("cell").cogroup(brought.groupBy("place")).applyInArrow(run, PAIR), found_in)


def _packed(found: np.ndarray):
    """Compressed texts of the documents that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            known &= may_hold(found, ids.fill_null(0).to_numpy(zero_copy_only=False))
            if known.any():
                some = batch.filter(pa.array(known))
                texts = some.column("text").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array([coder.compress((t or "").encode()) for t in texts], pa.binary())],
                    names=["doc_id", "thing"],
                )

    return run


def sets_of(things: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sets of shingles of compressed texts, a bounded number of bytes at a time."""
    coder, some, held = zstandard.ZstdDecompressor(), [], 0
    for thing in things:
        some.append(coder.decompress(thing.as_buffer()))
        held += len(some[-1])
        if held >= _PIECE:
            yield from shingle_sets(pa.array(some, pa.binary()), size)
            some, held = [], 0
    if some:
        yield from shingle_sets(pa.array(some, pa.binary()), size)


class Incidence:
    """Sets as the rows of a sparse matrix over the n-grams of a cell."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        grams, self.column = np.unique(np.concatenate(sets) if sets else np.empty(0, np.uint64), return_inverse=True)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.row = np.zeros(len(grams), np.int64)

    def _columns(self, i: int) -> np.ndarray:
        return self.column[self.first[i] : self.first[i + 1]]

    def overlaps(self, i: int, partners: np.ndarray) -> np.ndarray:
        """Row ``i``, spread out over the n-grams, times the rows of its partners (not empty)."""
        out = np.empty(len(partners), np.int64)
        self.row[self._columns(i)] = 1
        start = 0
        while start < len(partners):  # the rows that are multiplied at once
            ends = np.cumsum(self.sizes[partners[start:]])
            some = partners[start : start + max(1, int(np.searchsorted(ends, BLOCK_SHINGLES, side="right")))]
            at = np.concatenate([[0], ends[: len(some) - 1]])
            out[start : start + len(some)] = np.add.reduceat(self.row[np.concatenate([self._columns(j) for j in some])], at)
            start += len(some)
        self.row[self._columns(i)] = 0
        return out


def product(x: np.ndarray, y: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether the overlap of the pairs of sets (x, y) reaches the bound."""
    rows = Incidence(sets)
    bound = overlap_needed(percent, rows.sizes[x], rows.sizes[y])
    can = np.flatnonzero((np.minimum(rows.sizes[x], rows.sizes[y]) >= bound) & (bound > 0))
    order = can[np.argsort(x[can], kind="stable")]
    similar = np.zeros(len(x), bool)
    for part in np.split(order, np.flatnonzero(np.diff(x[order])) + 1):
        if len(part):
            similar[part] = rows.overlaps(int(x[part[0]]), y[part]) >= bound[part]
    return similar


def may_need(things: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``things`` with at least these ids, told by a filter of fixed size."""
    found = things.sparkSession.sparkContext.broadcast(marked(ids, "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(may_hold(found.value, ids)))

    return things.mapInArrow(run, things.schema)


def packed_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and compressed text (``thing``) of at least the documents with these ids."""
    found = docs.sparkSession.sparkContext.broadcast(marked(ids, "doc_id"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _packed(found.value)(batches)

    return docs.select("doc_id", "text").mapInArrow(pack, "doc_id bigint, thing binary")


def similar_pairs(docs: DataFrame, pairs: DataFrame, size: int, percent: int, found_in: str = "similar") -> DataFrame:
    """The pairs whose sets A and B of shingles hold 100 |A and B| >= percent |A or B|.

    ``docs`` has doc_id and text, ``pairs`` is staged and has (a, n_a, b, n_b).
    Of all texts only those that a pair may need leave their task, compressed. Of
    rows that repeat an id, one that is similar is enough.
    """
    packed = packed_texts(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))

    def compare(x: np.ndarray, y: np.ndarray, n: np.ndarray, things: pa.Array) -> np.ndarray:
        return product(x, y, list(sets_of(things, size)), percent)

    things = packed.withColumn("n", F.lit(0).cast("bigint"))
    return in_cells(pairs, things, compare, BLOCK_SHINGLES, "n", found_in)
