"""One-row results side by side, and row numbers over tables of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textprep.session import stage

# Rows that one task may sort.
ONE_TASK_ROWS = 1_000_000


def side_by_side(*parts: DataFrame) -> DataFrame:
    """One row holding the columns of several one-row tables.

    The rows are stacked and folded by an aggregate, so no join is involved.
    """
    packed = [p.select(F.struct(*p.columns).alias(f"_{i}")) for i, p in enumerate(parts)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), packed)
    row = stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])
    return row.select(*[F.col(f"_{i}.{c}") for i, p in enumerate(parts) for c in p.columns])


def settled(row: DataFrame) -> DataFrame:
    """A one-row table as a literal, independent of what it was computed from."""
    return row.sparkSession.createDataFrame([row.first()], row.schema)


def numbered(rows: DataFrame, name: str, *order, in_one_task: int | None = None) -> DataFrame:
    """Add ``name``: 1, 2, ... in the given order. ``rows`` is read twice.

    More rows than one task should sort are cut into ranges of the order, each
    numbered on its own on top of the rows of the ranges below it.
    """
    limit = ONE_TASK_ROWS if in_one_task is None else in_one_task
    n = rows.count()
    if n <= limit:
        return rows.withColumn(name, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))
    # Range boundaries are sampled anew by every job: pin them by staging.
    ranges = stage(
        rows.repartitionByRange(-(-n // limit) * 2, *order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # one row per range
    below = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_start"))
    inside = ranges.withColumn("_inside", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    placed = inside.join(F.broadcast(starts), "_range")
    return placed.select(*rows.columns, (F.col("_inside") + F.col("_start")).alias(name))
