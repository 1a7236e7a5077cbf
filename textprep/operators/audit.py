"""Leakage between splits.

One table with a row per distinct text and its row count in each split answers
the per-split statistics, the overlaps and the effect of dropping leaked rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textprep.config import SPLITS
from textprep.functions.labels import coerce_label
from textprep.operators.keys import text_key
from textprep.operators.rows import side_by_side
from textprep.operators.skew import lookup

PAIRS = (("train", "val"), ("train", "test"), ("val", "test"))


def texts_by_split(df: DataFrame, text: str = "clean_text") -> DataFrame:
    """Per distinct text the number of rows in each split; null counts as empty."""
    narrow = df.select(text_key(F.col(text)).alias("text_key"), "split")
    return narrow.groupBy("text_key").agg(
        *[F.count_if(F.col("split") == s).alias(s) for s in SPLITS]
    )


def after_drop(texts: DataFrame) -> DataFrame:
    """The table as it is once leaked validation and test rows are dropped."""
    leaked = F.col("train") > 0
    return texts.select(
        "text_key",
        "train",
        *[F.when(leaked, F.lit(0)).otherwise(F.col(s)).alias(s) for s in ("val", "test")],
    )


def flags_after_drop(flags: DataFrame) -> DataFrame:
    """The flags once leaked rows are dropped: a text of train is shared no more."""
    return flags.filter(~F.col("in_train"))


def _present(split: str) -> Column:
    return F.col(split) > 0


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")


def _stats_struct(split: str) -> Column:
    rows, unique = _total(F.col(split)), F.count_if(_present(split))
    return F.struct(
        rows.alias("rows"),
        unique.alias("unique_texts"),
        (rows - unique).alias("duplicate_within_split"),
    )


def _overlap_columns() -> list[Column]:
    pairs = [F.count_if(_present(a) & _present(b)).alias(f"{a}_{b}") for a, b in PAIRS]
    everywhere = _present("train") & _present("val") & _present("test")
    return [*pairs, F.count_if(everywhere).alias("triple_overlap")]


def split_stats(texts: DataFrame) -> DataFrame:
    """Rows, distinct texts and repeats of each split."""
    wide = texts.agg(*[_stats_struct(s).alias(s) for s in SPLITS])
    named = F.array(*[F.struct(F.lit(s).alias("split"), F.col(s).alias("stats")) for s in SPLITS])
    return wide.select(F.explode(named).alias("r")).select("r.split", "r.stats.*")


def split_overlap(texts: DataFrame) -> DataFrame:
    """Distinct texts shared by each pair of splits and by all three."""
    return texts.agg(*_overlap_columns())


def label_flags(df: DataFrame, text: str = "clean_text", label: str = "label") -> DataFrame:
    """Per distinct text: the splits it is in, the pairs of splits whose label
    sets differ for it, and ``in_train``, whether dropping overlap removes it.

    Sets are compared label by label with flags, so no set is ever collected.
    A null text shares the key of the empty one but is in no split here, and a
    label that is not a number is in no set.
    """
    rows = df.select(
        text_key(F.col(text)).alias("text_key"),
        coerce_label(df, label).alias("_label"),
        F.col(text).isNotNull().alias("_is_text"),
        "split",
    )
    labels = rows.groupBy("text_key", "_label").agg(
        *[F.max(F.col("_is_text") & (F.col("split") == s)).alias(s) for s in SPLITS],
        F.max(F.col("split") == "train").alias("in_train"),
    )
    counted = F.col("_label").isNotNull()
    return labels.groupBy("text_key").agg(
        *[F.max(s).alias(s) for s in SPLITS],
        *[F.max(counted & (F.col(a) != F.col(b))).alias(f"{a}_{b}") for a, b in PAIRS],
        F.max("in_train").alias("in_train"),
    )


def label_conflicts(flags: DataFrame) -> DataFrame:
    """Shared texts whose label sets differ between the two splits."""
    return flags.agg(
        *[F.count_if(F.col(a) & F.col(b) & F.col(f"{a}_{b}")).alias(f"{a}_{b}") for a, b in PAIRS]
    )


def overlap_label_conflicts(df: DataFrame, text: str = "clean_text", label: str = "label") -> DataFrame:
    """``label_conflicts`` of a table of rows."""
    return label_conflicts(label_flags(df, text, label))


def drop_train_overlap(df: DataFrame, texts: DataFrame, text: str = "clean_text") -> DataFrame:
    """Without the validation and test rows whose text occurs in train.

    All texts are listed with their rows, so that a frequent one is scattered
    whether it leaks or not.
    """
    is_leaked = _present("train") & (_present("val") | _present("test"))
    leaked = texts.withColumn("_rows", F.col("train") + F.col("val") + F.col("test")).select(
        "text_key", "_rows", F.when(is_leaked, True).alias("_leaked")
    )
    keyed = df.withColumn("text_key", text_key(F.col(text)))
    marked = lookup(keyed, leaked, "text_key", ["_leaked"], scatter="row_id", weight="_rows")
    return marked.filter((F.col("split") == "train") | F.col("_leaked").isNull()).select(*df.columns)


def dropped_eval_rows(texts: DataFrame) -> DataFrame:
    """How many rows ``drop_train_overlap`` removes from each split."""
    leaked = _present("train")
    return texts.agg(
        *[_total(F.when(leaked, F.col(s))).alias(f"{s}_dropped") for s in ("val", "test")]
    )


def leakage_audit(texts: DataFrame, flags: DataFrame | None = None) -> DataFrame:
    """The audit as one row; label conflicts are included when ``flags`` are given.

    It needs the tables per distinct text alone. The audit after dropping
    overlap follows from ``after_drop(texts)`` and ``flags_after_drop(flags)``.
    """
    audit = texts.agg(
        F.struct(*[_stats_struct(s).alias(s) for s in SPLITS]).alias("split_stats"),
        F.struct(*_overlap_columns()).alias("cross_split_overlap"),
    )
    if flags is None:
        return audit
    conflicts = label_conflicts(flags)
    packed = conflicts.select(F.struct(*conflicts.columns).alias("overlap_label_conflicts"))
    return side_by_side(audit, packed)
