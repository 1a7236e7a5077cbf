"""Conflicting labels and exact copies.

Everything is decided on a narrow group table (one fixed-width row per distinct
text, built with map-side partial aggregation), so a text with a third of all
rows costs one partial row per task. Survivors are then taken from the wide
table by ``row_id``, which is unique and cannot be skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textprep.config import PrepConfig
from textprep.operators.keys import text_key
from textprep.operators.skew import lookup

def is_conflict() -> Column:
    return F.col("label_low") < F.col("label_high")


def text_groups(df: DataFrame, text: str = "clean_text") -> DataFrame:
    """Per distinct text: rows, smallest and largest label, first row."""
    narrow = df.select(text_key(F.col(text)).alias("text_key"), "label", "row_id")
    return narrow.groupBy("text_key").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("label").alias("label_low"),
        F.max("label").alias("label_high"),
        F.min("row_id").alias("first_row"),
    )


def dedup_stats(groups: DataFrame, cfg: PrepConfig = PrepConfig()) -> DataFrame:
    """Row counts before, dropped by each rule, and after, in one row."""
    dropped = is_conflict() if cfg.drop_conflicting_duplicates else F.lit(False)
    extra = F.col("n_rows") - 1 if cfg.deduplicate_by_clean_text else F.lit(0)
    zero = F.lit(0)
    sums = groups.agg(
        F.coalesce(F.sum("n_rows"), zero).cast("bigint").alias("rows_before"),
        F.coalesce(F.sum(F.when(dropped, F.col("n_rows"))), zero)
        .cast("bigint").alias("conflicting_text_rows_dropped"),
        F.coalesce(F.sum(F.when(~dropped, extra)), zero)
        .cast("bigint").alias("exact_text_duplicates_dropped"),
    )
    return sums.withColumn(
        "rows_after",
        F.col("rows_before")
        - F.col("conflicting_text_rows_dropped")
        - F.col("exact_text_duplicates_dropped"),
    )


def _mark_conflicts(df: DataFrame, groups: DataFrame, text: str) -> DataFrame:
    conflicts = groups.select("text_key", "n_rows", F.when(is_conflict(), True).alias("_conflict"))
    keyed = df.withColumn("text_key", text_key(F.col(text)))
    return lookup(keyed, conflicts, "text_key", ["_conflict"], scatter="row_id", weight="n_rows")


def drop_conflicts(df: DataFrame, groups: DataFrame, text: str = "clean_text") -> DataFrame:
    """Without every row of a text that carries more than one label."""
    marked = _mark_conflicts(df, groups, text)
    return marked.filter(F.col("_conflict").isNull()).select(*df.columns)


def conflict_rows(df: DataFrame, groups: DataFrame, text: str = "clean_text") -> DataFrame:
    """The rows ``drop_conflicts`` removes."""
    marked = _mark_conflicts(df, groups, text)
    return marked.filter(F.col("_conflict").isNotNull()).select(*df.columns)


def surviving_rows(groups: DataFrame, cfg: PrepConfig = PrepConfig()) -> DataFrame:
    """``row_id`` of the first row of each text that is kept."""
    kept = groups.filter(~is_conflict()) if cfg.drop_conflicting_duplicates else groups
    return kept.select(F.col("first_row").alias("row_id"))


def deduplicate(df: DataFrame, groups: DataFrame, cfg: PrepConfig = PrepConfig()) -> DataFrame:
    """Apply both rules as configured; the first row in input order survives."""
    if cfg.deduplicate_by_clean_text:
        return df.join(surviving_rows(groups, cfg), "row_id", "left_semi").select(*df.columns)
    if cfg.drop_conflicting_duplicates:
        return drop_conflicts(df, groups)
    return df


def kept_rows(df: DataFrame, groups: DataFrame, cfg: PrepConfig = PrepConfig()) -> DataFrame:
    """``row_id`` and ``label`` of the rows ``deduplicate`` keeps; moves no text."""
    return deduplicate(df, groups, cfg).select("row_id", "label")
