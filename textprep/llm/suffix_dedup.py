"""Remove byte strings that repeat anywhere in the corpus, by sorting suffixes.

Sorting the suffixes at every byte would multiply the corpus. Instead each string
of ``length`` bytes is sorted at its anchor, the place of the smallest hash among
its short substrings. Equal strings have equal anchors at equal offsets, so they
meet in one cell, keyed by the substring at the anchor. In a cell the text after
the anchor (suffixes) and, reversed, before it are sorted deep-shallow; common
prefixes on both sides tell exactly, for every offset, which strings are equal.

A cell of more than CROWD anchors is split by content: its strings are dealt to
levels by their offset, and a level's cells are keyed by all the bytes its
strings have in common. Equal contexts of such anchors are combined in each
task before the shuffle.

Levels do not split the contexts of a passage shared by very many texts, as those
differ only outside of what their strings have in common. Cells of more than
about HOT rows are found from one row in SAMPLE, which decides only the way. Each
string of such a cell goes alone, as a 128-bit hash: equal hashes are combined in
each task before the shuffle and then counted, without any sorting.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textprep.llm import shingles
from textprep.llm.bitmap import held as may_hold
from textprep.llm.bitmap import marked as marked_keys
from textprep.llm.suffix_sort import sort_strings
from textprep.session import stage

LENGTH = 200
ANCHOR = 50
SEGMENT = 1 << 20
CROWD = 1_000
HOT = 20_000
SAMPLE = 16
HELD_STRINGS = 100_000
BATCH_ROWS = 20_000
CHUNK_ROWS = 4_000
UNPACKED_ROWS = 5_000
PART_ROWS = 2_000
BROADCAST_ANCHORS = 2_000_000

CONTEXT = "kind tinyint, cell bigint, low int, high int, doc_id bigint, mark bigint, at bigint, stop bigint, before int, context binary"


def _parts(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces, so that what a task holds depends on no session's setting."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _slide(values: np.ndarray, width: int, best: np.ufunc, fill) -> np.ndarray:
    """The best of each ``width`` neighbours, by running bests from both ends of blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, fill, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, length: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all strings of ``length`` bytes, ties included."""
    width = length - size + 1
    places, hashes = [], []
    for start in range(0, len(data) - length + 1, SEGMENT):
        part = data[start : start + SEGMENT + length - 1]
        powers, inverses = shingles._tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers[: len(part)], out=sums[1:])
        own = shingles.mix((sums[size:] - sums[:-size]) * inverses[: len(part) - size + 1])
        least = _slide(own, width, np.minimum, np.uint64(0xFFFFFFFFFFFFFFFF))
        edge = np.zeros(width - 1, np.uint64)
        most = _slide(np.concatenate([edge, least, edge]), width, np.maximum, np.uint64(0))
        found = np.flatnonzero(most == own)
        places.append(found + start)
        hashes.append(own[found])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[first]


def levels(reach: int) -> list[tuple[int, int]]:
    """Ranges of offsets, 0 to ``reach``, narrow at both ends."""
    cuts = sorted({0, 1, 4, 16, 48, reach - 47, reach - 15, reach - 3, reach, reach + 1} & set(range(reach + 2)))
    return [(a, b - 1) for a, b in zip(cuts, cuts[1:])]


def _anchor_rows(length: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, PART_ROWS):
            ids, marks = batch.column("doc_id"), batch.column("mark")
            rows, places, hashes = [], [], []
            for i, text in enumerate(batch.column("text").cast(pa.large_binary()).to_pylist()):
                if text is not None and len(text) >= length:
                    place, own = anchors(np.frombuffer(text, np.uint8), length, size)
                    rows.append(np.full(len(place), i))
                    places.append(place)
                    hashes.append(own)
            if rows:
                row = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hashes).view(np.int64)), ids.take(row), marks.take(row), pa.array(np.concatenate(places))],
                    names=["hash", "doc_id", "mark", "at"],
                )

    return run


def _cell(text: bytes, at: int, low: int, high: int, length: int) -> int:
    """The cell of a level: what all its strings have in common."""
    key = hashlib.blake2b(text[at - low : at + length - high] + b"%d" % low, digest_size=8).digest()
    return int.from_bytes(key, "big", signed=True)


def _cell_rows(length: int, size: int, hashes: np.ndarray):
    """The cells of all levels at the anchors with the given hashes."""
    split = levels(length - size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for text in batch.column("text").cast(pa.large_binary()).to_pylist():
                if text is not None and len(text) >= length:
                    place, own = anchors(np.frombuffer(text, np.uint8), length, size)
                    for at in place[np.isin(own.view(np.int64), hashes)].tolist():
                        cells += [_cell(text, at, a, b, length) for a, b in split if max(a, length + at - len(text)) <= min(b, at)]
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64())], names=["cell"])

    return run


def _hot_cells(rows: DataFrame, hashes: list[int], length: int, size: int) -> frozenset[int]:
    """Cells with more than about HOT rows; their number is bounded by that of all rows / HOT."""
    if not hashes:
        return frozenset()
    part = rows.filter(F.pmod(F.xxhash64("doc_id", "mark"), F.lit(SAMPLE)) == 0).select("text")
    cells = part.mapInArrow(_cell_rows(length, size, np.array(hashes, np.int64)), "cell bigint")
    return frozenset(r[0] for r in cells.groupBy("cell").count().filter(F.col("count") * SAMPLE > HOT).select("cell").collect())


def _context_rows(length: int, size: int, hot: frozenset[int] = frozenset()):
    reach = length - size
    split = levels(reach)

    def _whole(at: int, n: int) -> tuple[int, int]:
        """What all strings anchored at a place cover in a text of n bytes."""
        return max(0, at - reach), min(n, at + length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [[] for _ in range(10)]

        def put(*row) -> None:
            for column, value in zip(columns, row):
                column.append(value)

        def settle(doc, mark, start: int, stop: int) -> None:
            # Any cell will do, so settled rows are spread.
            put(1, hash((doc, mark, start)), 0, 0, doc, mark, start, stop, 0, b"")

        def drain() -> Iterator[pa.RecordBatch]:
            kinds = [pa.int8(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            whole = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["kind", "cell", "low", "high", "doc_id", "mark", "at", "stop", "before", "context"],
            )
            for column in columns:
                column.clear()
            for start in range(0, whole.num_rows, BATCH_ROWS):
                yield whole.slice(start, BATCH_ROWS)

        def release(strings: dict[bytes, list]) -> None:
            """One row per string goes on; places of strings seen twice are settled here."""
            done: dict[int, list] = {}
            for key, found in strings.items():
                _, doc, mark, at, offset = found[0]
                put(2, int.from_bytes(key[:8], "big", signed=True), offset, offset, doc, mark, at, 0, offset, key[8:])
                if len(found) > 1:
                    for row, doc, mark, at, offset in found:
                        done.setdefault(row, [doc, mark, []])[2].append((at - offset, at - offset + length))
            for doc, mark, spans in done.values():
                for start, stop in _union(spans):
                    settle(doc, mark, start, stop)
            strings.clear()

        for batch in batches:
            held: dict[tuple, tuple] = {}
            firsts, paid = set(), set()
            strings: dict[bytes, list] = {}
            n_strings = 0

            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            for row, (doc, mark, text, spots) in enumerate(
                zip(batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist(), texts, batch.column("spots").to_pylist())
            ):
                n, done = len(text), []
                for spot in spots:
                    at = spot["at"]
                    if spot["crowded"]:
                        # Equal whole contexts of this batch: the first goes on for all.
                        around = text[max(0, at - reach) : at + length]
                        other = held.setdefault((min(at, reach), around), (doc, mark, at, n))
                        if other != (doc, mark, at, n) or (doc, mark, at, n) in firsts:
                            done.append(_whole(at, n))
                            if other not in paid:
                                paid.add(other)
                                start, stop = _whole(*other[2:])
                                settle(other[0], other[1], start, stop)
                            continue
                        firsts.add(other)
                    for low, high in split if spot["crowded"] else ((0, reach),):
                        # Offsets at which a whole string fits into the text.
                        least, most = max(low, length + at - n), min(high, at)
                        if least > most:
                            continue
                        cell = _cell(text, at, low, high, length)
                        if spot["crowded"] and cell in hot:
                            for offset in range(least, most + 1):
                                key = hashlib.blake2b(text[at - offset : at - offset + length] + b"%d" % offset, digest_size=16).digest()
                                strings.setdefault(key, []).append((row, doc, mark, at, offset))
                                n_strings += 1
                            continue
                        put(0, cell, least, most, doc, mark, at, 0, most, text[at - most : at + length - least])
                    full = n_strings >= HELD_STRINGS
                    if full:
                        release(strings)
                        n_strings = 0
                    if full or len(columns[0]) >= BATCH_ROWS:
                        yield from drain()
                for start, stop in _union(done):
                    settle(doc, mark, start, stop)
            release(strings)
            if columns[0]:
                yield from drain()

    return run


def repeated_offsets(cells: np.ndarray, low: np.ndarray, high: np.ndarray, contexts: list[bytes], before: np.ndarray, length: int) -> np.ndarray:
    """Per row and offset, whether the string that begins so far before the anchor stands in another row."""
    before_list = before.tolist()
    right = [c[b:] for c, b in zip(contexts, before_list)]
    left = [c[:b][::-1] for c, b in zip(contexts, before_list)]
    right_order, right_common = sort_strings(cells, right, ANCHOR)
    left_order, left_common = sort_strings(cells, left)
    offsets = np.arange(int(high.max()) + 1)

    def blocks(order: np.ndarray, common: np.ndarray, depth: np.ndarray) -> np.ndarray:
        found = np.empty((len(order), len(depth)), np.int64)
        found[order] = np.cumsum(common[:, None] < depth[None, :], axis=0)
        return found

    code = blocks(right_order, right_common, length - offsets) * (len(cells) + 1) + blocks(left_order, left_common, offsets)
    inside = (offsets >= low[:, None]) & (offsets <= high[:, None])
    code = np.where(inside, code, -1 - np.arange(len(cells))[:, None])
    order = np.argsort(code, axis=0, kind="stable")
    sorted_code = np.take_along_axis(code, order, axis=0)
    equal = sorted_code[1:] == sorted_code[:-1]
    twice = np.zeros(code.shape, bool)
    twice[1:] |= equal
    twice[:-1] |= equal
    found = np.empty(code.shape, bool)
    np.put_along_axis(found, order, twice, axis=0)
    return found & inside


def _spans_of_cells(length: int):
    names = ("cell", "low", "high", "doc_id", "mark", "at", "before", "context")

    def spans(table: pa.Table) -> Iterator[pa.RecordBatch]:
        cells, low, high, at, before = (table.column(c).to_numpy() for c in ("cell", "low", "high", "at", "before"))
        contexts = table.column("context").to_pylist()
        # Rows with the same context repeat at every offset; one stands for them.
        held: dict[tuple, int] = {}
        group = np.fromiter((held.setdefault((c, b, x), i) for i, (c, b, x) in enumerate(zip(cells.tolist(), before.tolist(), contexts))), np.int64, len(cells))
        count = np.bincount(group, minlength=len(cells))
        whole = count[group] > 1
        heads = np.flatnonzero(group == np.arange(len(cells)))
        per_cell = dict(zip(*np.unique(cells[heads], return_counts=True)))
        heads = heads[np.fromiter((per_cell[c] > 1 for c in cells[heads].tolist()), bool, len(heads))]
        rows, starts, stops = [np.flatnonzero(whole)], [at[whole] - high[whole]], [at[whole] - low[whole] + length]
        if len(heads):
            found = repeated_offsets(cells[heads], low[heads], high[heads], [contexts[i] for i in heads], before[heads], length)
            found &= ~whole[heads][:, None]
            edge = np.zeros((len(heads), 1), np.int8)
            step = np.diff(np.concatenate([edge, found.astype(np.int8), edge], axis=1), axis=1)
            row, first = np.nonzero(step == 1)
            _, last = np.nonzero(step == -1)
            rows.append(heads[row])
            starts.append(at[heads[row]] - (last - 1))
            stops.append(at[heads[row]] - first + length)
        rows = pa.array(np.concatenate(rows))
        if len(rows):
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("doc_id").combine_chunks().take(rows),
                    table.column("mark").combine_chunks().take(rows),
                    pa.array(np.concatenate(starts)),
                    pa.array(np.concatenate(stops)),
                ],
                names=["doc_id", "mark", "start", "stop"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in _parts(batches, CHUNK_ROWS):
            now = pa.Table.from_batches([batch]).select(list(names))
            rest = now if rest is None else pa.concat_tables([rest, now])
            if rest.num_rows < CHUNK_ROWS:
                continue
            cells = rest.column("cell").to_numpy()
            cut = int(np.searchsorted(cells, cells[-1], side="left"))
            if cut:
                yield from spans(rest.slice(0, cut))
                rest = rest.slice(cut)
        if rest is not None and rest.num_rows:
            yield from spans(rest)

    return run


def _union(spans: list[tuple[int, int]]) -> list[list[int]]:
    """The spans, sorted, with those that overlap or touch made one."""
    union: list[list[int]] = []
    for start, stop in sorted(spans):
        if union and start <= union[-1][1]:
            union[-1][1] = max(union[-1][1], stop)
        else:
            union.append([start, stop])
    return union


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("spans")
        starts, stops = (column.flatten().field(k).to_pylist() for k in (0, 1))
        cuts = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).tolist()
        merged = [_union(list(zip(starts[a:b], stops[a:b]))) for a, b in zip(cuts, cuts[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array(merged, pa.list_(pa.list_(pa.int64())))],
            names=["doc_id", "mark", "spans"],
        )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches, PART_ROWS):
        sizes, removed, counts, digests = [], [], [], []
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        for text, spans in zip(texts, batch.column("spans").to_pylist()):
            text, at, kept = text or b"", 0, hashlib.sha256()
            for start, stop in spans or ():
                kept.update(text[at:start])
                at = stop
            kept.update(text[at:])
            sizes.append(len(text))
            removed.append(sum(stop - start for start, stop in spans or ()))
            counts.append(len(spans or ()))
            digests.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *[pa.array(c, pa.int64()) for c in (sizes, removed, counts)],
                pa.array(digests, pa.string()),
                batch.column("spans").cast(pa.list_(pa.list_(pa.int64()))),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def repeated_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, size: int = ANCHOR
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    ``spans`` are the maximal runs [start, stop) of bytes covered by a string of
    ``length`` bytes that also starts anywhere else. Null texts are empty; texts
    of fewer than ``length`` bytes keep all. Repeated rows are documents of their
    own, so each repeats the other. Rows are told apart by id and a hash of
    their text; null ids are allowed. Other columns are ignored; an empty table
    gives an empty result.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("mark"))
    marked = stage(rows.mapInArrow(_anchor_rows(length, size), "hash bigint, doc_id bigint, mark bigint, at bigint"), "anchors")
    shared = stage(
        marked.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
            "hash", (F.col("n") > min(CROWD, HOT)).alias("crowded"), (F.col("n") > HOT).alias("hot")
        ),
        "shared-anchors",
    )
    hot = _hot_cells(rows, [r[0] for r in shared.filter("hot").select("hash").collect()], length, size)
    few = shared.count() <= BROADCAST_ANCHORS
    spots = (
        marked.join(F.broadcast(shared) if few else shared, "hash")
        .groupBy("doc_id", "mark")
        .agg(F.collect_set(F.struct("at", "crowded")).alias("spots"))
    )
    spots = stage(spots, "spots").withColumnsRenamed({"doc_id": "_id", "mark": "_mark"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    placed = _moved(rows, spots).join(spots.hint("merge"), same)
    contexts = placed.select("doc_id", "mark", "thing", "spots").mapInArrow(_unpacked(_context_rows(length, size, hot)), CONTEXT)
    # Rows that a task has settled go the same way as the others, past the sorting.
    cells = contexts.repartition("cell").sortWithinPartitions("cell")
    spans = cells.mapInArrow(_settled_or_sorted(length), "doc_id bigint, mark bigint, start bigint, stop bigint")
    grouped = spans.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    merged = stage(
        grouped.mapInArrow(_merged, "doc_id bigint, mark bigint, spans array<array<bigint>>"), "spans"
    ).withColumnsRenamed({"doc_id": "_id", "mark": "_mark"})
    # Texts without a span are finished where they are; the others move once more.
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<array<bigint>>"
    whole = _finished(rows, merged, _kept, schema)
    cut = _moved(rows, merged).join(merged.hint("merge"), same, "left").select("doc_id", "thing", "spans")
    return whole.unionByName(cut.mapInArrow(_unpacked(_kept), schema))


def _picked(rows: DataFrame, wanted: DataFrame, named: bool):
    """The rows with the key they are picked by, and a function that picks from batches.

    It picks at least the rows that ``wanted`` names, or with ``named`` off all others: a
    filter of fixed size tells which is which, in the same way both times.
    """
    spark = rows.sparkSession
    found = spark.sparkContext.broadcast(marked_keys(wanted.select(F.xxhash64("_id", "_mark").alias("key")), "key"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, PART_ROWS):
            held = may_hold(found.value, batch.column("key").to_numpy(zero_copy_only=False))
            some = batch.filter(pa.array(held if named else ~held))
            if some.num_rows:
                yield some

    return rows.select("doc_id", "mark", "text", F.xxhash64("doc_id", "mark").alias("key")), pick


def _moved(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, mark and compressed text (``thing``) of at least the rows that ``wanted`` names."""
    keyed, pick = _picked(rows, wanted, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=1)
        for some in pick(batches):
            texts = some.column("text").cast(pa.binary())
            texts = pa.array([coder.compress(t or b"") for t in texts.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("mark"), texts], names=["doc_id", "mark", "thing"])

    return keyed.mapInArrow(run, "doc_id bigint, mark bigint, thing binary")


def _finished(rows: DataFrame, wanted: DataFrame, inner, schema: str) -> DataFrame:
    """``inner`` over all rows that ``_moved`` leaves, with null ``spans``.

    Both steps share one worker: two in a row would hold two of them per core, and each
    keeps its memory until the executor ends it.
    """
    keyed, pick = _picked(rows, wanted, False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from inner(pick(batches))

    return keyed.withColumn("spans", F.lit(None).cast("array<array<bigint>>")).mapInArrow(run, schema)


def _unpacked(inner):
    """``inner`` over batches whose texts came compressed, UNPACKED_ROWS at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdDecompressor()

        def plain() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, UNPACKED_ROWS):
                    part = batch.slice(start, UNPACKED_ROWS)
                    texts = pa.array([coder.decompress(t) for t in part.column("thing").to_pylist()], pa.large_binary())
                    others = [c for c in part.schema.names if c != "thing"]
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), texts], names=[*others, "text"])

        yield from inner(plain())

    return run


def _counted(rows: list[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The places of strings that have several rows; all rows of a string are at hand."""
    if not rows:
        return
    table = pa.Table.from_batches(rows).combine_chunks()
    keys = np.stack([table.column("cell").to_numpy(), np.frombuffer(b"".join(table.column("context").to_pylist()), ">i8").astype(np.int64)], axis=1)
    _, group, count = np.unique(keys, axis=0, return_inverse=True, return_counts=True)
    twice = table.filter(pa.array(count[group.ravel()] > 1))
    if twice.num_rows:
        starts = twice.column("at").to_numpy() - twice.column("low").to_numpy()
        ids = (twice.column(c).combine_chunks() for c in ("doc_id", "mark"))
        yield pa.RecordBatch.from_arrays([*ids, pa.array(starts), pa.array(starts + length)], names=["doc_id", "mark", "start", "stop"])


def _settled_or_sorted(length: int):
    of_cells = _spans_of_cells(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settled, single = [], []

        def count(rows: pa.RecordBatch) -> None:
            # Rows come by cell, so only those of the last cell may have others to come.
            single.append(rows)
            if sum(b.num_rows for b in single) >= CHUNK_ROWS:
                last = single[-1].column("cell").to_numpy()
                cut = int(np.searchsorted(last, last[-1], side="left"))
                if cut:
                    settled.extend(_counted([*single[:-1], rows.slice(0, cut)], length))
                    single[:] = [rows.slice(cut)]

        def open_rows() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kind = batch.column("kind").to_numpy(zero_copy_only=False)
                done = batch.filter(pa.array(kind == 1))
                if done.num_rows:
                    settled.append(
                        pa.RecordBatch.from_arrays([done.column(c) for c in ("doc_id", "mark", "at", "stop")], names=["doc_id", "mark", "start", "stop"])
                    )
                alone = batch.filter(pa.array(kind == 2))
                if alone.num_rows:
                    count(alone)
                rest = batch.filter(pa.array(kind == 0))
                if rest.num_rows:
                    yield rest

        for out in of_cells(open_rows()):
            yield from settled
            settled.clear()
            yield out
        settled.extend(_counted(single, length))
        yield from settled

    return run
