"""N-gram statistics, TF-IDF vocabulary and vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textprep.config import TfidfConfig
from textprep.functions.clean import as_text, strip_accents
from textprep.functions.tokens import word_ngrams, word_tokens
from textprep.operators.memory import give_back
from textprep.operators.rows import numbered
from textprep.operators.skew import lookup
from textprep.session import stage

# A vocabulary up to this many terms and bytes may travel to every task.
LOCAL_VOCABULARY = 2_000_000
LOCAL_BYTES = 256 << 20
# Rows that one task may sort to pick the top ones.
SORT_ROWS = 1_000_000
# Candidates per wanted term that one final sort may take.
SORT_FACTOR = 50
# Counters a task holds per wanted term, and at least.
SUMMARY_FACTOR, SUMMARY_LEAST = 10, 1 << 20
# New counters a task gathers before it merges them, about 64 MB, and ranges of hashes
# that it merges one after the other.
SUMMARY_NEW, SUMMARY_RANGES = 1 << 22, 16
# Tokens a task works on at once, whatever the size of a batch; a longer row goes alone.
SLICE_TOKENS = 1 << 19
# The same where vectors are made, which several steps of a row's weights precede.
VECTOR_TOKENS = 1 << 17
# Candidates that may travel to every task by their hashes, 64 MB.
MAX_CANDIDATES = 8_000_000


def with_tokens(df: DataFrame, text: str = "clean_text", target: str = "tokens") -> DataFrame:
    """Add the word tokens of the lower-cased, accent-free text."""
    lowered = df.withColumn("_lower", F.lower(as_text(F.col(text))))
    plain = lowered.withColumn("_lower", strip_accents(F.col("_lower")))
    return plain.withColumn(target, word_tokens(F.col("_lower"))).drop("_lower")


def term_stats(df: DataFrame, cfg: TfidfConfig = TfidfConfig(), text: str = "clean_text") -> DataFrame:
    """Per n-gram its occurrences ``tf`` and the rows it occurs in ``df``.

    Each row's n-grams are sorted, so that the first of equal ones marks the row
    and both counts come from one shuffle with partial aggregation, instead of
    one per (row, term) and one per term.
    """
    grams = with_tokens(df.select(text), text).select(
        F.sort_array(word_ngrams(F.col("tokens"), cfg.ngram_min, cfg.ngram_max)).alias("g")
    )
    # One pair more than n-grams: the last one has no term and is dropped.
    shifted = F.concat(F.array(F.lit(None).cast("string")), F.col("g"))
    pairs = F.zip_with(
        "g", shifted, lambda a, b: F.struct(a.alias("term"), (~a.eqNullSafe(b)).alias("first"))
    )
    terms = grams.select(F.explode(pairs).alias("t")).select("t.term", "t.first")
    return terms.filter(F.col("term").isNotNull()).groupBy("term").agg(
        F.count(F.lit(1)).alias("tf"), F.count_if("first").alias("df")
    )


def _bound(value: int | float, n_docs: int) -> float:
    """A document frequency limit: a count, or a share of the rows if a float."""
    return value * n_docs if isinstance(value, float) else value


def eligible_terms(stats: DataFrame, n_docs: int, cfg: TfidfConfig = TfidfConfig()) -> DataFrame:
    low, high = _bound(cfg.min_df, n_docs), _bound(cfg.max_df, n_docs)
    if high < low:
        raise ValueError("max_df corresponds to fewer documents than min_df")
    return stats.filter((F.col("df") >= F.lit(low)) & (F.col("df") <= F.lit(high)))


def smooth_idf(n_docs: int, df: Column) -> Column:
    return F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + df)) + 1.0


def top_rows(rows: DataFrame, limit: int, weight: str, *ties: str) -> DataFrame:
    """The ``limit`` rows of largest ``weight`` (a positive count), ties in order.

    Every task would hand its own top list to the final sort, so with far more
    rows than wanted those below the needed magnitude are cut off first.
    """
    if rows.count() > SORT_FACTOR * limit:
        # Eight steps per doubling of the weight: a few hundred magnitudes at most.
        magnitude = F.floor(F.log2(F.col(weight).cast("double")) * 8)
        sizes = rows.groupBy(magnitude.alias("m")).count().orderBy(F.col("m").desc()).collect()
        seen, lowest = 0, None
        for row in sizes:
            seen, lowest = seen + row["count"], row["m"]
            if seen >= limit:
                break
        rows = rows.filter(magnitude >= F.lit(lowest))
    if limit > SORT_ROWS:
        placed = numbered(rows, "_place", F.col(weight).desc(), *ties, in_one_task=SORT_ROWS)
        return placed.filter(F.col("_place") <= limit).drop("_place")
    return rows.orderBy(F.col(weight).desc(), *ties).limit(limit)


def fits_locally(terms: DataFrame, limit: int | None = None) -> bool:
    """Whether a term list is small enough, in rows and bytes, to go to every task."""
    size = terms.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("bytes")
    ).first()
    return size["n"] <= (LOCAL_VOCABULARY if limit is None else limit) and size["bytes"] <= LOCAL_BYTES


def _slices(tokens: pa.Array, *others: pa.Array, most: int | None = None) -> Iterator[tuple[pa.Array, ...]]:
    """A batch's token lists, and columns beside them, in runs of ``most`` (SLICE_TOKENS) tokens or one row."""
    most = SLICE_TOKENS if most is None else most
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < len(ends):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield tuple(column.slice(start, stop - start) for column in (tokens, *others))
        start = stop


def _token_keys(flat: pa.Array) -> np.ndarray:
    """Two independent 64-bit hashes per token, side by side."""
    coded = flat.dictionary_encode()
    words = [hashlib.blake2b(w.encode(), digest_size=16).digest() for w in coded.dictionary.to_pylist()]
    keys = np.frombuffer(b"".join(words), np.uint64).reshape(-1, 2)
    return keys[coded.indices.to_numpy(zero_copy_only=False)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(32))


def _gram_keys(keys: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of all n-grams that stay inside one row, and where each begins."""
    count = len(rows) - n + 1
    if count <= 0:
        return keys[:0], rows[:0]
    combined = keys[:count].copy()
    for i in range(1, n):
        combined = _mixed(combined * np.uint64(0x9E3779B97F4A7C15) + keys[i : i + count])
    at = np.flatnonzero(rows[:count] == rows[n - 1 :])
    return combined[at], at


class _Members:
    """Which hashes are in a sorted array, and where; most others are told by one bit."""

    def __init__(self, hashes: np.ndarray, bits: int = 1 << 24):
        self.sorted, self.low = hashes, np.uint64(bits - 1)
        self.seen = np.zeros(bits, bool)
        self.seen[hashes & self.low] = True

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of the keys that are members, and of each in the sorted array."""
        may = np.flatnonzero(self.seen[keys & self.low])
        if not len(may) or not len(self.sorted):
            return may[:0], may[:0]
        at = np.minimum(np.searchsorted(self.sorted, keys[may]), len(self.sorted) - 1)
        hit = self.sorted[at] == keys[may]
        return may[hit], at[hit]


def _per_hash(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, their occurrences, rows they occur in, and a place of each."""
    order = np.argsort(keys, kind="stable")
    keys, rows = keys[order], rows[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    fresh = first.copy()
    fresh[1:] |= rows[1:] != rows[:-1]  # rows ascend among equal hashes
    starts = np.flatnonzero(first)
    tf = np.diff(np.append(starts, len(keys)))
    df = np.add.reduceat(fresh.astype(np.int64), starts) if len(starts) else starts
    return keys[starts], tf, df, order[starts]


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Counters (hash, tf, df) of several lists sorted by hash as one such list."""
    hashes = np.concatenate([p[0] for p in parts])
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    first = np.ones(len(hashes), bool)
    first[1:] = hashes[1:] != hashes[:-1]
    starts = np.flatnonzero(first)
    sums = []
    for i in (1, 2):
        counts = np.concatenate([p[i] for p in parts])[order]
        sums.append(np.add.reduceat(counts, starts, dtype=np.int64) if len(starts) else counts.astype(np.int64))
    return hashes[starts], *sums


def _ranges(counters: tuple[np.ndarray, ...], count: int) -> list[tuple[np.ndarray, ...]]:
    """Counters sorted by hash in equal ranges of the hash, without copying them."""
    cuts = np.array([(i << 64) // count for i in range(1, count)], np.uint64)
    ends = [0, *np.searchsorted(counters[0], cuts).tolist(), len(counters[0])]
    return [tuple(x[a:b] for x in counters) for a, b in zip(ends, ends[1:])]


def _most_frequent(counters: tuple[np.ndarray, ...], capacity: int) -> tuple[tuple[np.ndarray, ...], int]:
    """At most ``capacity`` counters, and the largest of those given up."""
    over = len(counters[0]) - capacity
    if over <= 0:
        return counters, 0
    cut = int(np.partition(counters[1], over - 1)[over - 1])
    stay = counters[1] > cut
    return tuple(x[stay] for x in counters), cut


def _summaries(cfg: TfidfConfig, capacity: int):
    """Counters of a task's most frequent n-grams, and by how much they may be too low.

    New counters are gathered and merged SUMMARY_NEW at a time, a range of hashes after
    the other, so that merging needs little beside them. Beyond its share of the capacity
    a range gives up its smallest; the largest of any range adds to the bound on what any
    n-gram may have lost.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = -(-capacity // SUMMARY_RANGES)
        held = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))] * SUMMARY_RANGES
        fresh: list[tuple[np.ndarray, ...]] = []
        lost = 0

        def settle() -> None:
            nonlocal lost
            parts = [_ranges(f, SUMMARY_RANGES) for f in fresh]
            most = 0
            for i in range(SUMMARY_RANGES):
                held[i], cut = _most_frequent(_merged([held[i], *(p[i] for p in parts)]), share)
                most = max(most, cut)
            lost += most
            fresh.clear()

        for batch in batches:
            for (part,) in _slices(batch.column("tokens")):
                flat, rows = _flat(part)
                keys = _token_keys(flat)
                for n in range(cfg.ngram_min, cfg.ngram_max + 1):
                    grams, at = _gram_keys(keys, rows, n)
                    hashes, tf, df, _ = _per_hash(grams[:, 0], rows[at])
                    # Counts inside a slice, which Arrow bounds, fit into 32 bits.
                    fresh.append((hashes, tf.astype(np.int32), df.astype(np.int32)))
                if sum(len(f[0]) for f in fresh) >= SUMMARY_NEW:
                    settle()
        settle()
        whole = [np.append(np.concatenate([h[i] for h in held]), np.zeros(1, held[0][i].dtype)) for i in range(3)]
        bound = np.zeros(len(whole[0]), np.int64)
        bound[-1] = lost
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (whole[0].view(np.int64), *whole[1:], bound)], names=["h", "tf", "df", "lost"]
        )
        del held, fresh, whole, bound
        give_back()

    return run


def _admitted(tokens: DataFrame, n_docs: int, cfg: TfidfConfig) -> np.ndarray | None:
    """Sorted hashes of all n-grams that can be in the vocabulary, or None for any.

    Every n-gram's true count lies between its counter and that plus the sum of what
    tasks gave up. The counters that surely are within the document frequency limits
    say which count the last vocabulary term has at least; who cannot reach it is out.
    """
    capacity = max(SUMMARY_LEAST, SUMMARY_FACTOR * cfg.max_features)
    counters = tokens.mapInArrow(_summaries(cfg, capacity), "h bigint, tf bigint, df bigint, lost bigint")
    merged = counters.groupBy("h").agg(*[F.sum(c).alias(c) for c in ("tf", "df", "lost")])
    # Counters of 1, nearly all of them, are given up here.
    summary = stage(merged.filter("tf > 1 or lost > 0"), "gram-counters")
    low, high = _bound(cfg.min_df, n_docs), _bound(cfg.max_df, n_docs)
    lost = summary.agg(F.sum("lost").alias("lost")).first()["lost"] or 0
    if lost or low < 2:
        lost += 1
    sure = summary.filter((F.col("df") >= low) & (F.col("df") + lost <= high))
    # Eight steps per doubling of the count: a few hundred lines at most.
    magnitude = F.floor(F.log2(F.col("tf").cast("double")) * 8)
    steps = sure.groupBy(magnitude.alias("m")).agg(F.count(F.lit(1)).alias("n"), F.min("tf").alias("least"))
    seen, least = 0, 0
    for row in steps.orderBy(F.desc("m")).collect():
        seen += row["n"]
        if seen >= cfg.max_features:
            least = row["least"]
            break
    if lost >= least > 0 or (lost and not least):
        return None
    can = summary.filter((F.col("tf") + lost >= least) & (F.col("df") + lost >= low)).select("h")
    if can.count() > MAX_CANDIDATES:
        return None
    return np.sort(can.toArrow().column("h").to_numpy().view(np.uint64))


def _exact_counts(cfg: TfidfConfig, shared):
    """Per slice the distinct admitted n-grams, spelled out, with tf and df."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = None if shared is None else _Members(shared.value)
        for batch in batches:
            for (part,) in _slices(batch.column("tokens")):
                flat, rows = _flat(part)
                keys = _token_keys(flat)
                for n in range(cfg.ngram_min, cfg.ngram_max + 1):
                    grams, at = _gram_keys(keys, rows, n)
                    if members is not None:
                        hit = members(grams[:, 0])[0]
                        grams, at = grams[hit], at[hit]
                    _, tf, df, place = _per_hash(grams[:, 0], rows[at])
                    terms = _joined([flat.take(pa.array(at[place] + i)) for i in range(n)])
                    yield pa.RecordBatch.from_arrays([terms, pa.array(tf), pa.array(df)], names=["term", "tf", "df"])
        members = None
        give_back()

    return run


def vocabulary_candidates(tokens: DataFrame, n_docs: int, cfg: TfidfConfig) -> DataFrame:
    """tf and df of all n-grams that can be in the vocabulary, out of staged tokens.

    One pass keeps mergeable counters of the frequent n-grams of all lengths; their
    bounds admit candidates, and a second pass counts exactly these. Rare n-grams,
    nearly all of a large corpus, are spelled out nowhere. If the bounds cannot tell
    (all counts tie, or the candidates are too many), every n-gram is a candidate.
    N-grams are told apart by 64-bit hash.
    """
    admitted = _admitted(tokens, n_docs, cfg)
    shared = None if admitted is None else tokens.sparkSession.sparkContext.broadcast(admitted)
    counted = tokens.mapInArrow(_exact_counts(cfg, shared), "term string, tf bigint, df bigint")
    exact = counted.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    return stage(eligible_terms(exact, n_docs, cfg), "terms")


def tfidf_vocab(df: DataFrame, cfg: TfidfConfig = TfidfConfig(), text: str = "clean_text") -> DataFrame:
    """The vocabulary of ``df``: term, id (in term order), tf, df and idf."""
    tokens = stage(with_tokens(df.select(text), text).select("tokens"), "tokens")
    n_docs = tokens.count()
    terms = vocabulary_candidates(tokens, n_docs, cfg)
    chosen = stage(top_rows(terms, cfg.max_features, "tf", "term"), "chosen-terms")
    return numbered(chosen, "_place", "term", in_one_task=SORT_ROWS).select(
        "term",
        (F.col("_place") - 1).cast("int").alias("id"),
        "tf",
        "df",
        smooth_idf(n_docs, F.col("df")).alias("idf"),
    )


def _flat(tokens: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of a batch one after the other, and the row of each."""
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    return tokens.flatten(), np.repeat(np.arange(len(tokens), dtype=np.int64), lengths)


def _joined(parts: list[pa.Array]) -> pa.Array:
    return parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, " ")


def _grams(flat: pa.Array, rows: np.ndarray, n: int) -> tuple[pa.Array, np.ndarray]:
    """All n-grams that stay inside one row, with their rows."""
    count = len(flat) - n + 1
    if count <= 0:
        return flat.slice(0, 0), rows[:0]
    inside = rows[:count] == rows[n - 1 :]
    mask = pa.array(inside)
    return _joined([flat.slice(i, count).filter(mask) for i in range(n)]), rows[:count][inside]


def _gram_counter(low: int, high: int):
    """A function from token lists to each row's distinct n-grams with their counts."""

    kind = pa.list_(pa.struct([("term", pa.string()), ("n", pa.int64())]))

    def of_slice(tokens: pa.Array) -> pa.Array:
        flat, rows = _flat(tokens)
        found = [_grams(flat, rows, n) for n in range(low, high + 1)]
        coded = pa.concat_arrays([g for g, _ in found]).dictionary_encode()
        owner = np.concatenate([r for _, r in found])
        width = np.int64(max(len(coded.dictionary), 1))
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        cell, n = np.unique(owner * width + codes, return_counts=True)
        owner, code = np.divmod(cell, width)
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(tokens)))])
        terms = coded.dictionary.take(pa.array(code))
        items = pa.StructArray.from_arrays([terms, pa.array(n.astype(np.int64))], names=["term", "n"])
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), items)

    @F.arrow_udf("array<struct<term:string,n:bigint>>")
    def counts(tokens: pa.Array) -> pa.Array:
        parts = [of_slice(part) for (part,) in _slices(tokens)]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return counts


def _term_keys(terms: pa.Array) -> np.ndarray:
    """Both hashes of whole n-grams, as ``_gram_keys`` computes them from tokens."""
    words = pc.split_pattern(terms, " ")
    flat, rows = _flat(words)
    keys, lengths = _token_keys(flat), np.bincount(rows, minlength=len(terms))
    out = np.zeros((len(terms), 2), np.uint64)
    for n in np.unique(lengths).tolist():
        grams, at = _gram_keys(keys, rows, n)
        whole = lengths[rows[at]] == n
        out[rows[at][whole]] = grams[whole]
    return out


def _weigh(tokens: pa.Array, members: _Members, check: np.ndarray, ids: np.ndarray, idf: np.ndarray, cfg: TfidfConfig):
    """Row offsets, term ids and unit-length weights of a batch of token lists.

    Terms are found by one hash and have to agree in the other one as well.
    """
    flat, rows = _flat(tokens)
    keys, width = _token_keys(flat), np.int64(max(len(ids), 1))
    cells = []
    for n in range(cfg.ngram_min, cfg.ngram_max + 1):
        grams, at = _gram_keys(keys, rows, n)
        hit, place = members(grams[:, 0])
        same = check[place] == grams[hit, 1]
        cells.append(rows[at[hit[same]]] * width + ids[place[same]])
    cell, tf = np.unique(np.concatenate(cells), return_counts=True)
    owner, term = np.divmod(cell, width)
    weight = (1.0 + np.log(tf)) * idf[term]
    norm = np.sqrt(np.bincount(owner, weights=weight * weight, minlength=len(tokens)))
    weight = weight / norm[owner]
    sizes = np.bincount(owner, minlength=len(tokens))
    return np.concatenate([[0], np.cumsum(sizes)]), term, weight


def _with_bias(offsets, term, weight, bias_id: int):
    """Append a feature of value 1 to every row."""
    ends = offsets[1:]
    return (
        offsets + np.arange(len(offsets)),
        np.insert(term, ends, bias_id),
        np.insert(weight, ends, 1.0),
    )


def _sparse_vectors(offsets, term, weight, size: int) -> pa.Array:
    """The batch in the storage form of the ML vector type."""
    n = len(offsets) - 1
    ends = pa.array(offsets.astype(np.int32))
    return pa.StructArray.from_arrays(
        [
            pa.array(np.zeros(n, np.int8)),
            pa.array(np.full(n, size, np.int32)),
            pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))),
            pa.ListArray.from_arrays(ends, pa.array(weight)),
        ],
        names=["type", "size", "indices", "values"],
    )


def weigher(vocab: DataFrame, cfg: TfidfConfig = TfidfConfig(), bias: bool = False):
    """A function from token lists, and columns beside them, to what tasks need of their rows.

    It gives slices of the rows: row offsets, term ids, weights and the columns. The
    vocabulary is bounded by ``max_features`` and shipped to the tasks as sorted hashes,
    so a row's weights are found where the row is: no explode, no join, no shuffle. With
    ``bias`` a last feature of value 1 is appended. Also returns the number of terms.
    """
    table = vocab.select("id", "term", "idf").toArrow().combine_chunks()
    size = table.num_rows
    ids = table.column("id").to_numpy().astype(np.int64)
    idf = np.zeros(size)
    idf[ids] = table.column("idf").to_numpy()
    terms = table.column("term").combine_chunks()
    keys = _term_keys(terms if isinstance(terms, pa.Array) else pa.concat_arrays(terms.chunks))
    order = np.argsort(keys[:, 0], kind="stable")
    shared = vocab.sparkSession.sparkContext.broadcast((keys[order, 0], keys[order, 1], ids[order], idf))
    cache: dict[str, _Members] = {}

    def weigh(tokens: pa.Array, *others: pa.Array) -> Iterator[tuple]:
        hashes, check, ids, idf = shared.value
        if "members" not in cache:
            cache["members"] = _Members(hashes)
        for some, *rest in _slices(tokens, *others, most=VECTOR_TOKENS):
            offsets, term, weight = _weigh(some, cache["members"], check, ids, idf, cfg)
            if bias:
                offsets, term, weight = _with_bias(offsets, term, weight, size)
            yield offsets, term, weight, *rest

    return weigh, size


def vectorizer(vocab: DataFrame, cfg: TfidfConfig = TfidfConfig(), bias: bool = False):
    """A function from a token column and a sign column to ML vectors."""
    weigh, size = weigher(vocab, cfg, bias)

    @F.arrow_udf(VectorUDT())
    def vectorize(tokens: pa.Array, sign: pa.Array) -> pa.Array:
        parts = []
        for offsets, term, weight, signs in weigh(tokens, sign):
            weight = weight * np.repeat(signs.to_numpy(zero_copy_only=False), np.diff(offsets))
            parts.append(_sparse_vectors(offsets, term, weight, size + int(bias)))
        return pa.concat_arrays(parts) if parts else _sparse_vectors(np.zeros(1, np.int64), *np.zeros((2, 0)), size + int(bias))

    return vectorize


def tfidf_vectors(
    df: DataFrame,
    vocab: DataFrame,
    cfg: TfidfConfig = TfidfConfig(),
    text: str = "clean_text",
    bias: bool = False,
    sign: Column | None = None,
) -> DataFrame:
    """Add ``features``; unknown terms are ignored, rows have unit length.

    ``bias`` appends a constant feature and ``sign`` (1.0 or -1.0) multiplies
    the whole row; both serve the classifier. A vocabulary too large to ship is
    joined instead, which needs a unique ``row_id``.
    """
    signs = F.lit(1.0) if sign is None else sign
    if not fits_locally(vocab):
        return _vectors_by_join(df, vocab, cfg, text, bias, signs)
    vectorize = vectorizer(vocab, cfg, bias)
    tokens = with_tokens(df, text, "_tokens")
    return tokens.withColumn("features", vectorize(F.col("_tokens"), signs)).drop("_tokens")


def tfidf_weights(
    df: DataFrame,
    vocab: DataFrame,
    cfg: TfidfConfig = TfidfConfig(),
    text: str = "clean_text",
) -> DataFrame:
    """Long form: one row per row_id and known term with its normalised weight.

    A vocabulary that fits is shipped, and the cells are taken from the rows'
    vectors without a shuffle. A larger one is joined with the distinct terms of
    each row, which are counted where the row is.
    """
    if fits_locally(vocab):
        v = F.unwrap_udt("features")
        vectors = tfidf_vectors(df.select("row_id", text), vocab, cfg, text).select("row_id", v.alias("v"))
        cells = vectors.select(
            "row_id", F.inline(F.arrays_zip(F.col("v.indices").alias("id"), F.col("v.values").alias("value")))
        )
        named = cells.join(F.broadcast(vocab.select("id", "term")), "id")
        return named.select("row_id", "id", "term", "value")
    return _weights_by_join(df, vocab, cfg, text)


def _weights_by_join(df: DataFrame, vocab: DataFrame, cfg: TfidfConfig, text: str) -> DataFrame:
    counts = _gram_counter(cfg.ngram_min, cfg.ngram_max)
    tokens = with_tokens(df.select("row_id", text), text)
    tf = tokens.select("row_id", F.inline(counts(F.col("tokens"))))
    # Every term of the rows with its count: one outside the vocabulary can be hot too.
    rows_of = tf.groupBy("term").agg(F.count(F.lit(1)).alias("_rows"))
    listed = stage(rows_of.join(vocab.select("term", "id", "idf"), "term", "left"), "listed-terms")
    found = lookup(tf, listed, "term", ["id", "idf"], scatter="row_id", weight="_rows")
    known = found.filter(F.col("id").isNotNull())
    raw = (F.lit(1.0) + F.log("n")) * F.col("idf")
    row = Window.partitionBy("row_id")
    return known.withColumn("raw", raw).select(
        "row_id",
        "id",
        "term",
        (F.col("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(row))).alias("value"),
    )


def _vectors_by_join(
    df: DataFrame, vocab: DataFrame, cfg: TfidfConfig, text: str, bias: bool, sign: Column
) -> DataFrame:
    size = vocab.count()
    cell = F.struct("id", "value")
    cells = _weights_by_join(df, vocab, cfg, text).groupBy("row_id").agg(F.array_sort(F.collect_list(cell)).alias("_cells"))

    @F.arrow_udf(VectorUDT())
    def pack(ids: pa.Array, values: pa.Array, signs: pa.Array) -> pa.Array:
        flat, owner = _flat(ids)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(ids)))])
        term = flat.to_numpy(zero_copy_only=False).astype(np.int64)
        weight = values.flatten().to_numpy(zero_copy_only=False)
        if bias:
            offsets, term, weight = _with_bias(offsets, term, weight, size)
        weight = weight * np.repeat(signs.to_numpy(zero_copy_only=False), np.diff(offsets))
        return _sparse_vectors(offsets, term, weight, size + int(bias))

    joined = df.join(cells, "row_id", "left")
    ids = F.coalesce(F.col("_cells.id"), F.array().cast("array<int>"))
    values = F.coalesce(F.col("_cells.value"), F.array().cast("array<double>"))
    return joined.withColumn("features", pack(ids, values, sign)).select(*df.columns, "features")
