"""Mix sources to target weights by repeating and sampling whole documents.

Tokens are words. Sizes are computed once and staged; everything after that
reads the narrow table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textprep.llm.columns import WORD, whole
from textprep.session import stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
SEEDS = 32
BROADCAST_SOURCES = 100_000
SOURCE_SALTS = 64


def n_words(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """One row per source: source, source_size, target.

    Sources sorted by code point, null last, take the weights in turn. Together
    they get ``share`` of all sizes, but none more than ``most`` times its own
    size. The level at which the rest is shared follows from one sorted pass:
    sources are capped in the order of cap / weight. The windows hold one narrow
    row per source, not per document.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = per.withColumn("_bytes", F.hex(F.encode("source", "UTF-8")))
    order = Window.orderBy(F.col("_bytes").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    whole_table = Window.partitionBy()
    ranked = named.withColumn("_w", weight).withColumn("_cap", most * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_bytes").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    summed = ranked.select(
        "*",
        (share * F.sum("source_size").over(whole_table)).alias("_all"),
        F.sum("_w").over(whole_table).alias("_w_all"),
        F.coalesce(F.sum("_cap").over(before), F.lit(0.0)).alias("_cap_before"),
        F.coalesce(F.sum("_w").over(before), F.lit(0.0)).alias("_w_before"),
    )
    level = (F.col("_all") - F.col("_cap_before")) / (F.col("_w_all") - F.col("_w_before"))
    capped = summed.withColumn("_level", level).withColumn("_is_capped", level * F.col("_w") >= F.col("_cap"))
    # The first source below its cap sets the level for itself and all after it.
    final = F.min(F.when(~F.col("_is_capped"), F.struct(F.col("_cap") / F.col("_w"), "_level"))).over(whole_table)
    return capped.select(
        "source",
        "source_size",
        F.when(F.col("_is_capped"), F.col("_cap")).otherwise(final["_level"] * F.col("_w")).alias("target"),
    )


def _draws(doc_id: Column, seeds: int) -> list[Column]:
    """Uniform draws in [0, 1), four from each MD5 of seed number and id."""
    key = F.coalesce(doc_id.cast("string"), F.lit("null"))
    digests = [F.md5(F.concat_ws(":", F.lit(str(i)), key)) for i in range(-(-seeds // 4))]
    return [
        F.conv(F.substring(digests[k // 4], 8 * (k % 4) + 1, 8), 16, 10).cast("double") / 2.0**32
        for k in range(seeds)
    ]


def _with_source(rows: DataFrame, per_source: DataFrame, few: bool) -> DataFrame:
    """``rows`` with the columns of their source; a hot source is no hot key."""
    columns = [c for c in per_source.columns if c != "source"]
    if few:
        right = F.broadcast(per_source.withColumnRenamed("source", "_source"))
        return rows.join(right, F.col("source").eqNullSafe(F.col("_source")), "left").select(*rows.columns, *columns)
    salts = F.explode(F.array(*[F.lit(i) for i in range(SOURCE_SALTS)]))
    right = per_source.withColumnRenamed("source", "_source").withColumn("_salt", salts)
    left = rows.withColumn("_spot", F.pmod(F.xxhash64("doc_id"), F.lit(SOURCE_SALTS)).cast("int"))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_spot") == F.col("_salt"))
    return left.join(right, same, "left").select(*rows.columns, *columns)


def _sizes(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return stage(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            n_words(F.col(text)).alias("size"),
        ),
        "mix-sizes",
    )


def _rate() -> Column:
    return F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))


def source_plan(sizes: DataFrame, weights: tuple, share: float, most: float, seeds: int, broadcast_sources: int) -> tuple[DataFrame, bool]:
    """source, source_size, target and seed per source, and whether these rows are few."""
    targets = stage(source_targets(sizes, weights, share, most), "mix-targets")
    few = targets.count() <= broadcast_sources
    rated = _with_source(sizes, targets, few).withColumn("rate", _rate())
    fraction = F.col("rate") - F.floor("rate")
    totals = rated.groupBy("source").agg(
        F.first("source_size").alias("source_size"),
        F.first("target").alias("target"),
        F.sum(F.floor("rate") * F.col("size")).alias("whole"),
        *[
            F.sum(F.when(d < fraction, F.col("size")).otherwise(F.lit(0))).alias(f"s{k}")
            for k, d in enumerate(_draws(F.col("doc_id"), seeds))
        ],
    )
    misses = [
        F.struct(F.abs(F.col("whole") + F.col(f"s{k}") - F.col("target")).alias("miss"), F.lit(k).alias("seed"))
        for k in range(seeds)
    ]
    best = F.array_min(F.array(*misses))["seed"].alias("seed")
    return stage(totals.select("source", "source_size", "target", best), "mix-plan"), few


def _copies(seeds: int) -> Column:
    """How often a row is taken, from its doc_id and the plan of its source."""
    draw = F.element_at(F.array(*_draws(F.col("doc_id"), seeds)), F.col("seed") + 1)
    more = F.when(draw < _rate() - F.floor(_rate()), 1).otherwise(0)
    return (F.floor(_rate()) + more).cast("int")


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seeds: int = SEEDS,
    broadcast_sources: int = BROADCAST_SOURCES,
) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken, copies.

    A source's repetition rate is target / size. Each document is taken
    floor(rate) times and once more if its hash draw is below the fraction. Of
    ``seeds`` seeds every source uses the one whose total comes nearest to its
    target (ties: the first), because the draws of few long documents scatter.

    A null or blank text has size 0; its copies follow the same rate. A source
    of size 0 has rate 1: its rows, which cost no words, stay once. Null is a
    source of its own. Rows with one id draw alike; a null id is one more id.
    Other columns are ignored; an empty table gives an empty result. Results
    depend on ids, sizes and sources alone, so reruns agree.
    """
    sizes = _sizes(docs, doc_id, text, source)
    plan, few = source_plan(sizes, weights, share, most, seeds, broadcast_sources)
    taken = _with_source(sizes, plan, few).withColumn("copies", _copies(seeds))
    return taken.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("bigint").alias("taken"), "copies"
    )


def mixed_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seeds: int = SEEDS,
    broadcast_sources: int = BROADCAST_SOURCES,
) -> DataFrame:
    """The mix itself: every row of ``docs``, all columns, as often as ``mix`` takes it."""
    plan, few = source_plan(_sizes(docs, doc_id, text, source), weights, share, most, seeds, broadcast_sources)
    rows = docs.select(F.struct("*").alias("_row"), F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"))
    counted = _with_source(rows, plan, few).select("_row", F.array_repeat(F.lit(1), _copies(seeds)).alias("_times"))
    return counted.select("_row", F.explode("_times")).select("_row.*")
