"""Best-fit packing of tokenised documents into sequences.

The plan depends on nothing but how many pieces there are of each length, at
most ``capacity`` numbers. It is made from that histogram on the driver and
states, per length, which ranks go to which sequences; the pieces, ranked within
their length by Spark, look up their place.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textprep.session import stage

CAPACITY = 1024
END_ID = 2
BUCKETS = 64
VOCABULARY = "byte_bpe_50k"
# Up to here both tokenizer libraries are tested to split texts alike.
_FAR = re.compile("[^\x00-ɏ]")

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class Ids:
    """Token ids of a text by the vocabulary's JSON file.

    Texts of Latin script take a faster library with the same vocabulary and
    rules; all others go through the reference tokenizer, and so do those with
    runs of white space too long for the faster one.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        self.slow = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        special = {t.content: i for i, t in self.slow.get_added_tokens_decoder().items()}
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )

    def __call__(self, text: str) -> np.ndarray:
        if not _FAR.search(text):
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
            except ValueError:  # a run of white space beyond its stack
                pass
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")


def tokenised_pieces(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Per row of ``docs`` its pieces: doc_id, piece, start, length, ids_crc32.

    A document longer than ``capacity`` is cut into full pieces; the remainder
    comes first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = Ids()
        for batch in batches:
            rows = []
            for key, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(ids_of(content or ""), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((key, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int32()),
                    *[pa.array(c, pa.int64()) for c in columns[2:]],
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECES)


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, number of such sequences) for a histogram of lengths.

    Pieces above a third of the capacity are matched greedily: the longest takes
    the longest partner that fits, and no sequence holds more than two. Shorter
    ones, longest first, go where they leave the smallest gap.
    """
    left = {n: c for n, c in counts.items() if c > 0 and n < capacity}
    open_by_gap: dict[int, list[list]] = defaultdict(list)

    def put(lengths: tuple[int, ...], n: int) -> None:
        if n:
            open_by_gap[capacity - sum(lengths)].append([lengths, n])

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left[n]:
            partner = next((m for m in large if m <= capacity - n and left[m] - (m == n) > 0), None)
            if partner is None:
                put((n,), left[n])
                left[n] = 0
            elif partner == n:
                put((n, n), left[n] // 2)
                left[n] %= 2
            else:
                k = min(left[n], left[partner])
                put((n, partner), k)
                left[n] -= k
                left[partner] -= k
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            gap = next((g for g in range(n, capacity + 1) if open_by_gap.get(g)), None)
            if gap is None:
                lengths, bins, room = (), left[n], capacity // n
            else:
                lengths, bins = open_by_gap[gap].pop()
                room = gap // n
            full = min(bins, left[n] // room)
            put(lengths + (n,) * room, full)
            left[n] -= full * room
            bins -= full
            if bins and left[n]:  # fewer than fill one more sequence
                put(lengths + (n,) * left[n], 1)
                left[n] = 0
                bins -= 1
            if gap is not None:
                put(lengths, bins)
    if counts.get(capacity):
        put((capacity,), counts[capacity])
    return [(lengths, n) for group in open_by_gap.values() for lengths, n in group]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, offset) in the order of ranks."""
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    first = 0
    for lengths, n in patterns:
        offset = 0
        for size in lengths:
            rows[size].append((used[size], first, offset))
            used[size] += n
            offset += size
        first += n
    return {size: np.array(found, np.int64) for size, found in rows.items()}


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are documents of one token, the end. Repeated rows are
    documents of their own. Full pieces fill a sequence alone. Other columns
    are ignored; an empty table gives an empty result.

    Ranks within a length come from ``buckets`` groups per length, so no length
    is ranked in one task; the offsets of the groups, at most ``buckets`` times
    ``capacity`` rows, are broadcast.
    """
    pieces = stage(
        tokenised_pieces(docs, doc_id, text, capacity, end_id).withColumn(
            "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int")
        ),
        "pieces",
    )
    full = pieces.filter(F.col("length") == capacity)
    partial = pieces.filter(F.col("length") < capacity)
    groups = stage(partial.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "piece-groups")
    histogram = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(plan_sequences(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        partial.withColumn("at", F.row_number().over(order))
        .join(F.broadcast(offsets), ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.col("at") - 1)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            ranks = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for size in np.unique(lengths):
                mine = np.flatnonzero(lengths == size)
                rows = table[int(size)]
                at = np.searchsorted(rows[:, 0], ranks[mine], side="right") - 1
                sequence[mine] = rows[at, 1] + ranks[mine] - rows[at, 0]
                offset[mine] = rows[at, 2]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    placed = ranked.select(*names, "rank").mapInArrow(run, f"{PIECES}, sequence_id bigint, offset bigint")
    # A full piece needs no partner; negative numbers keep it apart from the plan's.
    alone = full.select(*names, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return placed.unionByName(alone)
