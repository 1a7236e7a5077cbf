"""A lookup join that survives hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# At most this many keys can be hot, so the broadcast table has a fixed bound:
# fewer than MAX_HOT_KEYS keys can each hold over 1 / MAX_HOT_KEYS of the rows.
MAX_HOT_KEYS = 100_000
# Groups below this size need no special treatment.
MIN_HOT_ROWS = 100_000


def lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    columns: list[str],
    scatter: str,
    weight: str,
    max_hot_keys: int = MAX_HOT_KEYS,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """``left`` with ``columns`` of ``right`` (null where the key is absent).

    ``right`` holds each key once and, in ``weight``, the number of ``left``
    rows with that key. Give it every key of ``left``, with nulls where there is
    nothing to find: a key can only be recognised as hot if it is listed. Keys
    above the limit are joined by broadcast, and their rows are then scattered
    by ``scatter`` so that no task receives a hot group in the shuffle that
    serves the other keys. ``right`` is read several times: stage it when it is
    costly.
    """
    found = right.agg(F.sum(weight).alias("total"), F.max(weight).alias("top")).first()
    limit = max(min_hot_rows, -(-(found["total"] or 0) // max_hot_keys))
    if (found["top"] or 0) < limit:
        return left.join(right.select(key, *columns), key, "left")

    value = F.struct(*columns)
    is_hot = F.col(weight) >= F.lit(limit)
    hot = right.filter(is_hot).select(key, value.alias("_hot"))
    known = F.greatest(*[F.col(c).isNotNull() for c in columns], F.lit(False))
    # Zero for every key, but no literal: the optimizer would fold that and drop
    # the spot from the shuffle key.
    spot = F.pmod(F.xxhash64(key), F.lit(1).cast("bigint"))
    cold = right.filter(~is_hot & known).select(key, spot.alias("_spot"), value.alias("_cold"))
    marked = left.join(F.broadcast(hot), key, "left").withColumn(
        "_spot",
        F.when(F.col("_hot").isNotNull(), F.xxhash64(scatter)).otherwise(F.lit(0).cast("bigint")),
    )
    joined = marked.join(cold, [key, "_spot"], "left").withColumn("_hit", F.coalesce("_hot", "_cold"))
    kept = [F.col(c) for c in left.columns]
    return joined.select(*kept, *[F.col("_hit")[c].alias(c) for c in columns])
