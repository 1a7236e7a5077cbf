"""Phrases of two and three words that stand together more often than their parts.

Counting goes by direct addressing. Words are ranked by frequency over the whole
corpus; the rank of each of the WORDS most frequent is its number. Pairs of numbers
fall into square tiles of the rank-by-rank table: a tile with many occurrences is
counted with a dense ``bincount``, the others as a sorted list of coordinates. The
same is done again one level up: frequent pairs are ranked anew, and (pair, next word)
are the coordinates of the three-word phrases.

The tables of ranks that travel to the tasks have fixed bounds. Everything beyond
them is counted as well, as coordinates that spell the words out by 63-bit hash, if a
filter of fixed size says that it may be frequent; so the bounds decide how much work
there is, never the result. Each task sends one row per phrase and buffer, and partial
aggregation merges these. A word that occurs less often than a phrase has to is in no
phrase, and a phrase of three words is counted only where both its pairs are frequent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textprep.llm.bitmap import held as may_hold
from textprep.llm.bitmap import marked
from textprep.llm.shingles import _BASE, _tables, mix
from textprep.session import stage

LEAST = 10
KEPT = 2000
# A phrase inside a longer candidate goes if the longer one has this share of it.
SHARE = 50
# Ranked words and pairs that travel to every task, and the edge of a tile.
WORDS = 1 << 16
PAIRS = 1 << 18
TILE = 1 << 10
# A tile with so many occurrences in a buffer is counted densely.
DENSE_FROM = TILE * TILE // 32
BUFFER = 2_000_000
# Rows that are sent at once, and distinct words a task holds before it sends them.
SENT_ROWS = 100_000
HELD_WORDS = 100_000
# Groups that share the work of a language's ranking.
SALTS = 64
_CHUNK = 1 << 19
_STEP = np.uint64(0xD6E8FEB86659FD93)
UNKNOWN = "und"


class _Words:
    """The words of some texts that lie one after the other: hashes, spans, pieces."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, langs: np.ndarray, seed: int):
        cut = (data >= 10) & (data <= 13)
        for mark in b".,;:!?":
            cut |= data == mark
        blank = cut | (data == 32) | (data == 9)
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        word = ~blank
        begins, ends = word.copy(), word.copy()
        begins[1:] &= blank[:-1] | edge[1:-1]
        ends[:-1] &= blank[1:] | edge[1:-1]
        self.data, self.starts, self.ends = data, np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.owner = np.searchsorted(bounds, self.starts, side="right") - 1
        # A new text begins a new piece, like a mark does.
        pieces = np.cumsum(cut | edge[:-1])
        self.piece = pieces[self.starts]
        low = data.astype(np.uint64)
        low[(data >= 65) & (data <= 90)] += np.uint64(32)
        low += np.uint64(1)
        powers, inverses = _tables(len(data))
        low *= powers[: len(data)]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(low, out=sums[1:])
        raw = (sums[self.ends] - sums[self.starts]) * inverses[self.starts]
        raw = mix(raw ^ ((self.ends - self.starts).astype(np.uint64) * np.uint64(_BASE)))
        salted = mix(raw + langs[self.owner] + np.uint64(seed) * np.uint64(_BASE))
        self.hash = (salted >> np.uint64(1)).astype(np.int64)

    def spelled(self, at: int) -> str:
        return bytes(self.data[self.starts[at] : self.ends[at]]).decode().translate(_LOWER)


_LOWER = {c: c + 32 for c in range(65, 91)}


def _chunks(batch: pa.RecordBatch, seed: int) -> Iterator[tuple[_Words, list[str]]]:
    """The words of a batch, about half a megabyte of text at a time, with the languages."""
    langs = [x if x is not None else UNKNOWN for x in batch.column("lang").to_pylist()]
    codes = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
    salts = np.array([codes[x] for x in langs], np.uint64)
    column = batch.column("text").fill_null("").cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + _CHUNK, side="right")) - 1)
        own = np.diff(bounds[start : stop + 1])
        filled = start + np.flatnonzero(own)
        if len(filled):
            text = data[bounds[start] : bounds[stop]]
            yield _Words(text, bounds[filled] - bounds[start], salts[filled], seed), [langs[i] for i in filled]
        start = stop


def _word_counts(seed: int):
    """Occurrences per word and language, combined within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        names: dict[int, tuple[str, str]] = {}

        def sent() -> pa.RecordBatch:
            keys = list(counts)
            columns = [keys, [names[k][0] for k in keys], [names[k][1] for k in keys], [counts[k] for k in keys]]
            types = [pa.int64(), pa.string(), pa.string(), pa.int64()]
            counts.clear()
            names.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["h", "lang", "word", "n"])

        for batch in batches:
            for words, langs in _chunks(batch, seed):
                hashes, at, n = np.unique(words.hash, return_index=True, return_counts=True)
                for h, i, c in zip(hashes.tolist(), at.tolist(), n.tolist()):
                    if h not in names:
                        names[h] = langs[words.owner[i]], words.spelled(i)
                        counts[h] = 0
                    counts[h] += c
                if len(counts) >= HELD_WORDS:
                    yield sent()
        if counts:
            yield sent()

    return run


class _Ranks:
    """Numbers of ranked keys: the place in the ranking, or -1."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys, kind="stable")
        self.sorted = keys[self.order]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.sorted):
            return np.full(len(keys), -1, np.int64)
        at = np.searchsorted(self.sorted, keys)
        at[at == len(self.sorted)] = 0
        return np.where(self.sorted[at] == keys, self.order[at], -1)


def _runs(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of sorted coordinates with their counts."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.diff(np.append(first, len(order)))


def counted(left: np.ndarray, right: np.ndarray, width: int, tile: int = TILE, dense_from: int = DENSE_FROM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of ranks (left, right) with their counts, tile by tile."""
    across = -(-width // tile)
    place = left // left.dtype.type(tile) * left.dtype.type(across) + right // right.dtype.type(tile)
    # Few tiles are told apart by 16 bits, which are sorted in one sweep each.
    order = np.argsort(place.astype(np.uint16) if place.max(initial=0) < 1 << 16 else place, kind="stable")
    del place
    left, right = left[order], right[order]
    del order
    rows, columns = left // tile, right // tile
    new = np.ones(len(left), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1])
    edges = np.append(np.flatnonzero(new), len(left))
    del rows, columns, new
    found, thin = [], np.ones(len(left), bool)
    for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if stop - start < dense_from:
            continue
        thin[start:stop] = False
        base = (int(left[start]) // tile * tile, int(right[start]) // tile * tile)
        inside = (left[start:stop] - left.dtype.type(base[0])) * left.dtype.type(tile) + (right[start:stop] - right.dtype.type(base[1]))
        table = np.bincount(inside)
        at = np.flatnonzero(table)
        found.append((base[0] + at // tile, base[1] + at % tile, table[at]))
    code, n = np.unique(left[thin].astype(np.uint64) * np.uint64(width) + right[thin], return_counts=True)
    code = code.astype(np.int64)
    found.append((code // width, code % width, n))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found))


class _Tally:
    """Buffered occurrences of (left, right): by rank where both have one, else spelled out.

    A buffered pair of ranks takes eight bytes.
    """

    def __init__(self, spell: Callable, width: int, names: list[str]):
        self.spell, self.width, self.names = spell, width, names
        self.ranked: list[tuple[np.ndarray, np.ndarray]] = []
        self.loose: list[list[np.ndarray]] = []
        self.held = 0

    def add(self, left: np.ndarray, right: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        dense = (left >= 0) & (right >= 0)
        self.ranked.append((left[dense].astype(np.uint32), right[dense].astype(np.uint32)))
        self.loose.append([c[~dense] for c in columns])
        self.held += len(left)
        if self.held >= BUFFER:
            yield from self.sent()

    def sent(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        ranked, loose = ([np.concatenate(x) for x in zip(*rows)] for rows in (self.ranked, self.loose))
        self.ranked, self.loose, self.held = [], [], 0
        left, right, n = counted(*ranked, self.width)
        yield from self._batches([*self.spell(left), right], n)
        yield from self._batches(*_runs(loose))

    def _batches(self, columns: list[np.ndarray], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(n), SENT_ROWS):
            part = [pa.array(c[start : start + SENT_ROWS]) for c in (*columns, n)]
            yield pa.RecordBatch.from_arrays(part, names=[*self.names, "n"])


def _numbers(words: _Words, ranks: _Ranks, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word its number (rank, or ~hash) and whether it may be frequent."""
    rank = ranks(words.hash)
    return np.where(rank >= 0, rank, ~words.hash), (rank >= 0) | may_hold(found, words.hash)


def _pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (mix(a.view(np.uint64) * _STEP + b.view(np.uint64)) >> np.uint64(1)).astype(np.int64)


def _adjacent(words: _Words, number: np.ndarray, may: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of neighbours in a piece: where the first stands, and both numbers."""
    at = np.flatnonzero((words.piece[1:] == words.piece[:-1]) & may[1:] & may[:-1])
    return at, number[at], number[at + 1]


def _pair_counts(shared, width: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, found = _Ranks(shared.value[0]), shared.value[1]
        tally = _Tally(lambda left: [left], width, ["a", "b"])
        for batch in batches:
            for words, _ in _chunks(batch, seed):
                _, a, b = _adjacent(words, *_numbers(words, ranks, found))
                yield from tally.add(a, b, [a, b])
        yield from tally.sent()

    return run


def _triple_counts(shared, pairs, width: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, found = _Ranks(shared.value[0]), shared.value[1]
        first, second, known = pairs.value
        pair_ranks = _Ranks(_pair_key(first, second))
        tally = _Tally(lambda left: [first[left], second[left]], width, ["a", "b", "c"])
        for batch in batches:
            for words, _ in _chunks(batch, seed):
                at, a, b = _adjacent(words, *_numbers(words, ranks, found))
                key = _pair_key(a, b)
                rank = pair_ranks(key)
                # The key only finds the row: the pair itself has to be the same.
                same = rank >= 0
                same[same] = (first[rank[same]] == a[same]) & (second[rank[same]] == b[same])
                rank = np.where(same, rank, -1)
                may = same | may_hold(known, key)
                # Two neighbouring pairs that share their middle word, both frequent.
                i = np.flatnonzero((at[1:] == at[:-1] + 1) & may[1:] & may[:-1])
                c = b[i + 1]
                yield from tally.add(rank[i], np.where(c >= 0, c, -1), [a[i], b[i], c])
        yield from tally.sent()

    return run


def _ranked(table: DataFrame, most: int, *columns: str) -> list[np.ndarray]:
    """The given columns of the ``most`` most frequent rows, a fixed bound."""
    top = table.orderBy(F.desc("f"), *columns).limit(most).select(*columns).toArrow()
    return [top.column(c).to_numpy().astype(np.int64) for c in columns]


def _vocabulary(texts: DataFrame) -> tuple[DataFrame, int]:
    """h, lang, word, f of all words, and a seed under which no two words share h."""
    for seed in range(8):
        schema = "h bigint, lang string, word string, n bigint"
        counts = texts.mapInArrow(_word_counts(seed), schema).groupBy("h", "lang", "word").agg(F.sum("n").alias("f"))
        words = stage(counts, "phrase-words")
        if words.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            return words, seed
    raise RuntimeError("word hashes collide under every seed")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    kept: int = KEPT,
    share: int = SHARE,
    words: int = WORDS,
    pairs: int = PAIRS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``kept`` phrases.

    Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at
    blanks and tabs into words. a counts the phrase within pieces, l and r the parts
    of its lowest-scoring cut, n all words of the language; score is
    floor(1000000 a a / (l r)), exact in decimal arithmetic. Phrases come ``least``
    times or more. One inside a longer candidate that has ``share`` per cent of its
    occurrences or more is dropped. Order: score, a, then phrase by its bytes.

    Null texts are empty; a null language is ``und`` and one with rows of that name.
    Repeated rows count each time, ids play no part, other columns are ignored; texts
    without words add nothing, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    vocabulary, seed = _vocabulary(texts)
    frequent = vocabulary.filter(F.col("f") >= least)
    (top,) = _ranked(frequent, words, "h")
    shared = spark.sparkContext.broadcast((top, marked(frequent, "h")))
    width = max(words, 1)
    # The number of a word: its rank, or else the complement of its hash.
    ranks = spark.createDataFrame(list(zip(top.tolist(), range(len(top)))), "h bigint, rank bigint")
    named = stage(
        frequent.join(F.broadcast(ranks), "h", "left").select(
            F.coalesce("rank", F.bitwise_not("h")).alias("id"), "lang", "word", "f"
        ),
        "phrase-ids",
    )

    def summed(table: DataFrame, name: str, *columns: str) -> DataFrame:
        sums = table.groupBy(*columns).agg(F.sum("n").alias("f"))
        return stage(sums.filter(F.col("f") >= least), name)

    two = summed(texts.mapInArrow(_pair_counts(shared, width, seed), "a bigint, b bigint, n bigint"), "phrase-pairs", "a", "b")
    first, second = _ranked(two, pairs, "a", "b")
    keyed = two.mapInArrow(_with_key, "key bigint")
    pairs_shared = spark.sparkContext.broadcast((first, second, marked(keyed, "key")))
    counts = texts.mapInArrow(_triple_counts(shared, pairs_shared, width, seed), "a bigint, b bigint, c bigint, n bigint")
    three = summed(counts, "phrase-triples", "a", "b", "c")

    def word(column: str) -> DataFrame:
        return named.select(
            F.col("id").alias(column), F.col("lang").alias("lang"), F.col("word").alias(f"word_{column}"), F.col("f").alias(f"f_{column}")
        )

    cover = F.max("f").alias("cover")
    longer = three.groupBy("a", "b").agg(cover).unionByName(
        three.groupBy(F.col("b").alias("a"), F.col("c").alias("b")).agg(cover)
    )
    longer = longer.groupBy("a", "b").agg(F.max("cover").alias("cover"))
    bare = two.join(longer, ["a", "b"], "left").filter(
        F.col("cover").isNull() | (F.lit(100).cast("decimal(20,0)") * F.col("cover") < F.lit(share).cast("decimal(20,0)") * F.col("f"))
    )
    of_two = bare.join(word("a"), "a").join(word("b").drop("lang"), "b").select(
        "lang",
        F.concat_ws(" ", "word_a", "word_b").alias("phrase"),
        F.col("f").alias("a"),
        F.col("f_a").alias("l"),
        F.col("f_b").alias("r"),
        _score("f", "f_a", "f_b").alias("score"),
    )
    head = two.select("a", "b", F.col("f").alias("f_ab"))
    tail = two.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("f").alias("f_bc"))
    parts = three.join(head, ["a", "b"]).join(tail, ["b", "c"])
    parts = parts.join(word("a"), "a").join(word("b").drop("lang"), "b").join(word("c").drop("lang"), "c")
    cuts = parts.withColumn("one", _score("f", "f_a", "f_bc")).withColumn("two", _score("f", "f_ab", "f_c"))
    early = F.col("one") <= F.col("two")
    of_three = cuts.select(
        "lang",
        F.concat_ws(" ", "word_a", "word_b", "word_c").alias("phrase"),
        F.col("f").alias("a"),
        F.when(early, F.col("f_a")).otherwise(F.col("f_ab")).alias("l"),
        F.when(early, F.col("f_bc")).otherwise(F.col("f_c")).alias("r"),
        F.least("one", "two").alias("score"),
    )
    # A language may hold most phrases: each of its groups ranks its own first.
    found = of_two.unionByName(of_three).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    near = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).filter(F.col("rank") <= kept)
    last = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("rank") <= kept)
    totals = vocabulary.groupBy("lang").agg(F.sum("f").alias("n"))
    return last.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _score(a: str, left: str, right: str):
    """floor(1000000 a a / (left right)); the products have up to 38 digits."""
    wide = [f"cast({c} as decimal(20,0))" for c in (a, left, right)]
    return F.expr(f"(1000000 * {wide[0]} * {wide[0]}) div ({wide[1]} * {wide[2]})")


def _with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in "ab")
        yield pa.RecordBatch.from_arrays([pa.array(_pair_key(a, b))], names=["key"])
