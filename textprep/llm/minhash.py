"""Near duplicates by MinHash, with sequential Bayesian verification.

1. Each text's set of word shingles becomes a signature of BANDS x ROWS minima.
   Documents that agree in a whole band are candidates. Two sets of similarity s
   share no band with probability (1 - s^ROWS)^BANDS: 7e-9 at 0.85, 1e-6 at 0.8.
2. The signatures of each candidate pair are compared BATCH minima at a time. With a
   uniform prior, m agreements of n leave a similarity of at least t with probability
   P(Binomial(n + 1, t) <= m). Once that is below MISS, the pair is dropped and its
   other minima are not looked at.
3. Survivors are verified exactly on their full sets (``overlap``).

Equal sets are combined first and linked through their smallest id. Of two documents
in a band both are a pair. Larger groups are first paired with their most central
member, whose groups hold most documents: an original is more central than its copies.
Once components are known, members of such groups that are in different ones go through
steps 2 and 3 as well, until nothing more can connect (``groups``). So a group of
thousands of near copies costs its size, and no candidate link between different
components is left out.

Groups are found by counting band keys with partial aggregation, so a hot key costs
a row per task; only members of groups of three and more travel themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textprep.llm.bitmap import held as may_hold
from textprep.llm.bitmap import marked
from textprep.llm.components import connected_components
from textprep.llm.groups import cross_links, equal_sets, families, possible, starred
from textprep.llm.overlap import in_cells, may_need, similar_pairs
from textprep.llm.shingles import mix, shingle_sets
from textprep.operators.skew import lookup
from textprep.session import discard, stage

BANDS = 32
ROWS = 5
BATCH = 16
MISS = 1e-9
# Signatures in a block of compared pairs.
BLOCK_SIGNATURES = 1024
_CHUNK = 1 << 16
_PAIRS = 1 << 17
# Texts whose sets a task holds at once.
_ROWS = 500


def _constants(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Per minimum a mask and an odd multiplier, which permute 32-bit numbers."""
    drawn = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    half = (drawn >> np.uint64(32)).astype(np.uint32)
    return half[:count], half[count:] | np.uint32(1)


def signatures(sets: list[np.ndarray], count: int = BANDS * ROWS) -> np.ndarray:
    """One row of ``count`` minima per set; zeros for an empty one."""
    masks, factors = _constants(count)
    out = np.zeros((len(sets), count), np.uint32)
    filled = [i for i, s in enumerate(sets) if len(s)]
    start = 0
    while start < len(filled):
        stop, held = start, 0
        while stop < len(filled) and (stop == start or held + len(sets[filled[stop]]) <= _CHUNK):
            held += len(sets[filled[stop]])
            stop += 1
        some = filled[start:stop]
        x = (np.concatenate([sets[i] for i in some]) >> np.uint64(32)).astype(np.uint32)
        at = np.cumsum([0] + [len(sets[i]) for i in some[:-1]])
        for j in range(count):
            out[some, j] = np.minimum.reduceat((x ^ masks[j]) * factors[j], at)
        start = stop
    return out


def band_keys(minima: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """The 64-bit key of every band of every signature."""
    parts = minima.reshape(len(minima), bands, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(rows):
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, j])
    return keys.view(np.int64)


def least_agreements(percent: int, count: int = BANDS * ROWS, batch: int = BATCH, miss: float = MISS) -> dict[int, int]:
    """Per number n of compared minima the fewest agreements that keep a pair."""
    t, found = percent / 100, {}
    for n in sorted({*range(batch, count, batch), count}):
        chance = total = (1 - t) ** (n + 1) if t < 1 else 0.0
        m = 0
        while total < miss and m < n:
            chance = chance * (n + 1 - m) / (m + 1) * (t / (1 - t)) if t < 1 else 0.0
            total, m = total + chance, m + 1
        found[n] = m
    return found


def _signed_sets(size: int, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, _ROWS) for b in batches for i in range(0, b.num_rows, _ROWS)):
            sets = list(shingle_sets(batch.column("text"), size))
            one = [s.sum(dtype=np.uint64) for s in sets]
            two = [np.bitwise_xor.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D))) if len(s) else np.uint64(0) for s in sets]
            minima = signatures(sets, count)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array(one, np.uint64).view(np.int64)),
                    pa.array(np.array(two, np.uint64).view(np.int64)),
                    pa.array([row.tobytes() for row in minima], pa.binary()),
                ],
                names=["doc_id", "n", "k1", "k2", "thing"],
            )

    return run


def _minima(things: pa.Array, count: int) -> np.ndarray:
    return np.frombuffer(b"".join(t.as_py() for t in things), np.uint32).reshape(len(things), count)


def _banded(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(_minima(batch.column("thing"), bands * rows), bands, rows)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(ids, bands))], names=["key", "doc_id"])

    return run


def _in_groups(bands: int, rows: int, found):
    """The bands that may be in a larger group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(_minima(batch.column("thing"), bands * rows), bands, rows)
            hit = may_hold(found.value, keys.ravel()).reshape(keys.shape)
            own = np.nonzero(hit)[0]
            columns = [batch.column(c).to_numpy(zero_copy_only=False)[own] for c in ("doc_id", "n")]
            yield pa.RecordBatch.from_arrays([pa.array(keys[hit]), *(pa.array(c) for c in columns)], names=["key", "doc_id", "n"])

    return run


def likely(minima: np.ndarray, x: np.ndarray, y: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Which pairs (x, y) of signatures stay likely enough in every batch."""
    stay = np.zeros(len(x), bool)
    for start in range(0, len(x), _PAIRS):
        at = np.arange(start, min(start + _PAIRS, len(x)))
        agree, done = np.zeros(len(at), np.int64), 0
        for n, most in least.items():
            agree += (minima[x[at], done:n] == minima[y[at], done:n]).sum(axis=1)
            alive = agree >= most
            at, agree, done = at[alive], agree[alive], n
            if not len(at):
                break
        stay[at] = True
    return stay


def _pruning(percent: int, count: int):
    """For the sets of a cell: the likely partners of one of them, the likeliest first."""

    def prune(sets: list[np.ndarray]):
        minima, least = signatures(sets, count), least_agreements(percent, count)

        def rank(one: int, partners: np.ndarray) -> np.ndarray:
            partners = partners[likely(minima, np.full(len(partners), one), partners, least)]
            agree = (minima[partners] == minima[one]).sum(axis=1)
            return partners[np.argsort(-agree, kind="stable")]

        return rank

    return prune


def _verified(docs: DataFrame, signed: DataFrame, pairs: DataFrame, size: int, percent: int, count: int, name: str) -> DataFrame:
    """Of staged pairs (a, b) those that pass steps 2 and 3."""
    least = least_agreements(percent, count)

    def compare(x: np.ndarray, y: np.ndarray, n: np.ndarray, things: pa.Array) -> np.ndarray:
        stay = possible(percent, n[x], 0, n[y], 0)
        stay[stay] = likely(_minima(things, count), x[stay], y[stay], least)
        return stay

    one = F.lit(1).cast("bigint")
    weighed = pairs.select("a", one.alias("n_a"), "b", one.alias("n_b"))
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    things = may_need(signed.select("doc_id", "n", "thing"), ids)
    survivors = in_cells(weighed, things, compare, BLOCK_SIGNATURES, "n", f"{name}-likely")
    return similar_pairs(docs, survivors, size, percent, f"{name}-similar").select("a", "b")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents link when 100 |A and B| >= percent |A or B| for their sets of
    shingles of ``size`` words, and share a band; links are confirmed on the full
    sets. component_id is the smallest id reachable, and that document is kept.
    Null and empty texts, and those without words, have no shingle and are alone.
    A row with a null id takes no part: its component is null and it is kept. Rows
    that repeat an id are one document: linked if one of their texts is, and kept
    or dropped together. Shingles stand for themselves by 64-bit hash. Other
    columns are ignored; an empty table gives an empty result.
    """
    count = bands * rows
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id bigint, n bigint, k1 bigint, k2 bigint, thing binary"
    sets = stage(texts.mapInArrow(_signed_sets(size, count), schema), "minhash-sets")
    held = sets.filter("n > 0 and doc_id is not null")
    copies, own = equal_sets(held, ["k1", "k2", "n"], "minhash")
    signed = held.join(own, ["doc_id", "k1", "k2", "n"]).select("doc_id", "n", "thing").dropDuplicates(["doc_id", "n", "thing"])
    signed = stage(signed, "minhash-signed")

    keyed = signed.mapInArrow(_banded(bands, rows), "key bigint, doc_id bigint")
    groups = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    groups = stage(groups.filter("m > 1"), "minhash-bands")
    large = groups.filter("m > 2")
    found = docs.sparkSession.sparkContext.broadcast(marked(large, "key"))
    crowd = signed.mapInArrow(_in_groups(bands, rows, found), "key bigint, doc_id bigint, n bigint")
    # The members of larger groups, and how many documents each group has.
    met = lookup(crowd, large.select("key", "m"), "key", ["m"], "doc_id", "m").filter("m is not null")
    met = stage(met, "minhash-members")
    central = met.groupBy("doc_id").agg(F.sum("m").alias("central"))
    crowd = stage(met.drop("m").join(central, "doc_id"), "minhash-crowd")
    family = families(crowd, "minhash")
    two = groups.filter("m = 2 and a <> b").select("a", "b")
    pairs = stage(two.unionByName(starred(family).select("a", "b")).distinct(), "minhash-pairs")
    discard(met, crowd)
    similar = _verified(texts, signed, pairs, size, percent, count, "minhash")
    roots = stage(connected_components(similar.unionByName(copies)), "minhash-roots")
    more = cross_links(texts, family, roots, size, percent, "minhash", _pruning(percent, count))
    if not more.isEmpty():
        known = roots.select(F.col("node").alias("a"), F.col("component").alias("b"))
        roots = stage(connected_components(known.unionByName(more)), "minhash-roots")
    component = F.coalesce("component", "doc_id")
    return (
        sets.select("doc_id", F.col("n").alias("n_shingles"))
        .join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))
    )
