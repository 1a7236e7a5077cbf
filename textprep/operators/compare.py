"""Ranking of result documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")


def leaderboard(results: DataFrame) -> DataFrame:
    """Result documents (with ``source_file``) as flat rows; missing is null."""
    return results.select(
        "model_name",
        "model_kind",
        "split",
        "num_samples",
        "threshold_used",
        *[F.col(f"metrics.{m}").alias(m) for m in METRICS],
        "source_file",
    )


def rank_models(board: DataFrame) -> DataFrame:
    """Best f1 first, then best AUC; missing values last."""
    return board.orderBy(F.desc_nulls_last("f1"), F.desc_nulls_last("roc_auc"), "source_file")


def best_model(board: DataFrame) -> DataFrame:
    return rank_models(board).limit(1)


def training_table(summaries: DataFrame) -> DataFrame:
    """Run summaries (with ``source_file``) as one row per model and split."""
    parts = F.array(
        *[F.struct(F.lit(s).alias("split"), F.col(f"{s}_metrics").alias("m")) for s in ("val", "test")]
    )
    rows = summaries.select("model", "source_file", F.explode(parts).alias("p"))
    return rows.select("model", "p.split", *[F.col(f"p.m.{m}").alias(m) for m in METRICS], "source_file")


def metrics_long(board: DataFrame, keys: list[str]) -> DataFrame:
    """One row per model and metric, for tables and heat maps."""
    return board.unpivot(keys, list(METRICS), "metric", "value")
