"""Hard negatives of anchor vectors, by a shuffle with a secondary sort.

Every row is scored against the anchors, a stated query set (ids divisible by
``every``) that travels in blocks of bounded size; rows stay where they are.

1. Each task keeps, per anchor, the rows of its own label that can still be among
   the anchor's first positives: never more than that many. These pairs are keyed
   by (anchor, descending score, id), dealt out by anchor and sorted within
   partitions; an iterator passes the first ones of each anchor on.
2. With the positives known, each task keeps per positive the rows of other labels
   whose score lies in its window, again at most as many as are wanted.
3. Positives and these rows are keyed by (anchor, descending score, kind, id), dealt
   out by anchor and sorted. One iterator reads that stream: a positive opens a
   window, a negative is given to every open window that reaches down to its score,
   and a window that is full or passed closes. It holds open windows only, never
   the rows of an anchor.

``repartition`` with ``sortWithinPartitions`` is the DataFrame form of
``repartitionAndSortWithinPartitions``: one exchange and a sort inside it, which
may spill. Memory of a task: a block of anchors with their best rows, and the
scores of SCORES (anchor, row) pairs at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textprep.session import stage

EVERY = 100
POSITIVES = 5
NEGATIVES = 5
# The window below a positive score p: LOW * p <= 100 * score <= 100 * p.
LOW = 80
# Bytes of anchor components that travel to a task at once, and scores held at once.
BLOCK_BYTES = 32 << 20
SCORES = 4_000_000
_EXACT = 1 << 53

PAIR = "anchor bigint, down bigint, kind int, id bigint"
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label and the integer components of the rows that take part.

    Without a label, a vector, an id, or with a component that is null or not
    finite, a row takes no part. Where the id is divisible by 7, the label moves
    on by one modulo 10.
    """
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf")))
    )
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label").cast("bigint"))
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    rows = vectors.select("vec_id", "label", "embedding").filter(known & finite)
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), moved.alias("label"), scaled.alias("vec"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width)


def _inner(rows: np.ndarray, anchors: np.ndarray, needed: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all anchors (down) with all rows (across)."""
    top = [int(max(x.max(initial=0), -int(x.min(initial=0)))) for x in (rows, anchors)]
    bound = rows.shape[1] * top[0] * top[1]
    if bound < _EXACT:
        return (anchors.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    if bound < 1 << 63:
        return anchors @ rows.T
    exact = anchors.astype(object) @ rows.T.astype(object)
    # The largest components stand for anything beyond them.
    if max(top) >= 1 << 62 or any(not -(1 << 63) <= x < 1 << 63 for x in exact[needed]):
        raise OverflowError("an inner product does not fit 64 bits")
    return np.where(needed, exact, 0).astype(np.int64)


class _Best:
    """Per anchor (and window) the first ``most`` of all offered (score, id)."""

    def __init__(self, anchors: int, most: int):
        self.most = most
        self.score = np.full((anchors, most), np.iinfo(np.int64).min)
        self.id = np.full((anchors, most), np.iinfo(np.int64).max)
        self.row = np.full((anchors, most), -1, np.int64)

    def offer(self, first: int, score: np.ndarray, allowed: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Scores of some anchors from number ``first`` on with rows sorted by id."""
        if not self.most:
            return
        held = slice(first, first + len(score))
        # What is below the last one held cannot enter.
        allowed = allowed & ((score >= self.score[held, -1:]) | (self.row[held, -1:] < 0))
        at, col = np.nonzero(allowed)
        if not len(at):
            return
        changed, place = np.unique(at, return_inverse=True)
        old = np.arange(self.most)[None, :].repeat(len(changed), 0).ravel()
        mine = changed.repeat(self.most)
        real = self.row[first + mine, old] >= 0
        mine, old = mine[real], old[real]
        a = np.concatenate([mine, at])
        s = np.concatenate([self.score[first + mine, old], score[at, col]])
        i = np.concatenate([self.id[first + mine, old], ids[col]])
        r = np.concatenate([self.row[first + mine, old], rows[col]])
        # Descending without overflow: the bitwise complement reverses the order.
        order = np.lexsort((r, i, ~s, a))
        a, s, i, r = a[order], s[order], i[order], r[order]
        starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        turn = np.arange(len(a)) - np.repeat(starts, np.diff(np.append(starts, len(a))))
        stay = turn < self.most
        self.score[first + a[stay], turn[stay]] = s[stay]
        self.id[first + a[stay], turn[stay]] = i[stay]
        self.row[first + a[stay], turn[stay]] = r[stay]


def _pairs(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor), pa.array(~score), pa.array(np.full(len(ids), kind, np.int32)), pa.array(ids)],
        names=["anchor", "down", "kind", "id"],
    )


def _scan(block: dict, keep: int, windows: bool):
    """Over all rows: the pairs with the anchors of a block that can still count.

    Without ``windows`` pairs of one label, the best ``keep`` of each anchor; with
    them pairs of two labels, the best ``keep`` of each window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {}  # by vector length: the anchors of that length and their best rows
        for width in np.unique(block["width"]).tolist():
            mine = np.flatnonzero(block["width"] == width)
            vec = np.stack([np.frombuffer(block["vec"][i], np.int64) for i in mine])
            n_windows = block["high"].shape[1] if windows else 1
            tables[width] = mine, vec, [_Best(len(mine), keep) for _ in range(n_windows)]
        seen = 0
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            widths = batch.column("vec").value_lengths().to_numpy(zero_copy_only=False)
            for width in np.unique(widths).tolist():
                if width not in tables:
                    continue
                mine, vec, best = tables[width]
                here = np.flatnonzero(widths == width)
                here = here[np.argsort(ids[here], kind="stable")]
                matrix = _matrix(batch.column("vec").take(pa.array(here)), width)
                step = max(1, SCORES // len(here))
                for first in range(0, len(mine), step):
                    some = mine[first : first + step]
                    same = block["label"][some][:, None] == labels[here][None, :]
                    other = block["anchor_id"][some][:, None] != ids[here][None, :]
                    score = _inner(matrix, vec[first : first + step], other)
                    for k, b in enumerate(best):
                        allowed = same & other
                        if windows:
                            allowed = other & ~same & (score <= block["high"][some, k][:, None]) & (score >= block["low"][some, k][:, None])
                        b.offer(first, score, allowed, ids[here], seen + here)
            seen += batch.num_rows
        for mine, _, best in tables.values():
            a = np.concatenate([np.repeat(mine, keep) for _ in best])
            s, i, r = (np.concatenate([getattr(b, f).ravel() for b in best]) for f in ("score", "id", "row"))
            a, s, i, r = (x[r >= 0] for x in (a, s, i, r))
            # A row in several windows goes out once.
            _, once = np.unique(np.stack([a, r]), axis=1, return_index=True)
            if len(once):
                yield _pairs(block["anchor"][a[once]], s[once], int(windows), i[once])

    return run


def _first_of_each(most: int):
    """Of a stream sorted by anchor, the first rows of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, taken = None, 0
        for batch in batches:
            keep = []
            for anchor in batch.column("anchor").to_pylist():
                last, taken = (last, taken + 1) if anchor == last else (anchor, 1)
                keep.append(taken <= most)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def _open_windows(most: int, low: int):
    """Of a stream sorted by (anchor, score down, kind, id): each positive's negatives.

    At one score positives come first, so a window is open before the negatives
    that tie with its positive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, windows = None, []  # open windows: positive id, score, negatives found
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("anchor", "down", "kind", "id"))
            for anchor, down, kind, row in zip(*columns):
                if anchor != last:
                    last, windows = anchor, []
                score = ~down
                if kind == 0:
                    windows.append([row, score, 0])
                    continue
                windows = [w for w in windows if w[2] < most and low * w[1] <= 100 * score]
                for window in windows:
                    window[2] += 1
                    out.append((anchor, window[0], window[2], row, window[1], score))
            columns = list(zip(*out)) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["anchor", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def _sorted_by_anchor(pairs: DataFrame) -> DataFrame:
    return pairs.repartition("anchor").sortWithinPartitions("anchor", "down", "kind", "id")


def hard_negatives(
    vectors: DataFrame,
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding. Scores are exact integer inner
    products of floor(256 x); equal scores go by the smaller id. An anchor's
    positives are its first rows of the same label, and each has the first rows
    of other labels with low * positive_score <= 100 * negative_score <= 100 *
    positive_score.

    Rows without label, id or vector, or with a component that is null or not
    finite, take no part. Vectors of different lengths are not compared; those of
    length 0 score 0. Rows that repeat an id all take part, but never pair with an
    anchor of that id, and an anchor that is repeated as a whole
    counts once. A positive without negatives has no row. Inner products beyond
    64 bits fail the job. Other columns are ignored; an empty table gives an
    empty result.
    """
    rows = stage(valid_vectors(vectors), "vectors")
    chosen = rows.filter(F.col("vec_id") % every == 0).distinct()
    anchors = stage(chosen.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    found = anchors.agg(F.sum(8 * F.size("vec") + 8 * (2 + positives)).alias("bytes")).first()["bytes"] or 0
    blocks = -(-found // block_bytes)
    numbered = anchors.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(max(1, blocks))))

    def block_of(table: DataFrame, k: int) -> dict:
        """One block on the driver: about ``block_bytes``, whatever the number of anchors."""
        part = table.filter(F.col("block") == k).drop("block").toArrow()
        column = lambda c: part.column(c).to_numpy(zero_copy_only=False)
        vec = [np.asarray(v, np.int64).tobytes() for v in column("vec")]
        block = {
            "anchor": column("anchor"), "anchor_id": column("vec_id"), "label": column("label"),
            "vec": vec, "width": np.array([len(v) // 8 for v in vec], np.int64),
        }
        if "high" in part.column_names:
            scores = [[int(s) for s in x] for x in part.column("high").to_pylist()]
            # Without a positive the window is empty: its floor lies above its top.
            block["high"] = np.array([x + [0] * (positives - len(x)) for x in scores], np.int64).reshape(-1, positives)
            floors = [[-(-low * s // 100) for s in x] + [1] * (positives - len(x)) for x in scores]
            block["low"] = np.array(floors, np.int64).reshape(-1, positives)
        return block

    def scan(table: DataFrame, keep: int, windows: bool) -> DataFrame:
        pairs = rows.sparkSession.createDataFrame([], PAIR)
        for k in range(blocks):
            pairs = pairs.unionByName(rows.mapInArrow(_scan(block_of(table, k), keep, windows), PAIR))
        return pairs

    near = _sorted_by_anchor(scan(numbered, positives, False)).mapInArrow(_first_of_each(positives), PAIR)
    opened = stage(near, "positives")
    tops = opened.groupBy("anchor").agg(F.collect_list(F.expr("~down")).alias("high"))  # at most ``positives`` each
    windowed = stage(numbered.join(tops, "anchor"), "windows")
    hard = scan(windowed, negatives, True)
    mined = _sorted_by_anchor(opened.unionByName(hard)).mapInArrow(
        _open_windows(negatives, low), RESULT.replace("anchor_id", "anchor")
    )
    return mined.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor").select(
        *[c.split()[0] for c in RESULT.split(", ")]
    )
