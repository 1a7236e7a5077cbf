"""Row-level preparation: labels, cleaning, length filter and the row funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textprep.config import PrepConfig
from textprep.functions.clean import as_text, with_clean_text
from textprep.functions.labels import coerce_label, is_binary
from textprep.operators.rows import side_by_side
from textprep.session import staging_path

REQUIRED_COLUMNS = ("text", "label")


def require_columns(df: DataFrame, required=REQUIRED_COLUMNS) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"columns {sorted(required)} are required, missing: {missing}")


def require_row_ids(df: DataFrame) -> None:
    """Every row needs a ``row_id`` of its own: rows are told apart by nothing else.

    One narrow shuffle of ids, pre-aggregated where they repeat.
    """
    per_id = df.groupBy("row_id").agg(F.count(F.lit(1)).alias("n"))
    found = per_id.agg(
        F.coalesce(F.sum(F.when(F.col("row_id").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
        F.count_if(F.col("row_id").isNotNull() & (F.col("n") > 1)).alias("repeated"),
    ).first()
    if found["missing"] or found["repeated"]:
        raise ValueError(f"row_id is null in {found['missing']} rows and {found['repeated']} ids repeat")


def resolve_text_column(df: DataFrame, preferred: str = "clean_text") -> str:
    for name in (preferred, "clean_text", "text"):
        if name in df.columns:
            return name
    raise ValueError("no usable text column, expected clean_text or text")


def judged_rows(df: DataFrame, cfg: PrepConfig = PrepConfig()) -> DataFrame:
    """Every row with ``clean_text`` and why it goes, in ``dropped``.

    Reasons: ``label`` (none, or no number), ``binary`` (neither 0 nor 1), ``short``;
    empty for rows that stay. Texts of rows without a usable label are not cleaned.
    """
    require_columns(df)
    label = coerce_label(df)
    usable = df.withColumn("text", as_text(F.col("text"))).withColumn("label", label).withColumn(
        "_text", F.when(is_binary(F.col("label")), F.col("text"))
    )
    cleaned = with_clean_text(usable, cfg, "_text").drop("_text")
    reason = (
        F.when(F.col("label").isNull(), "label")
        .when(~is_binary(F.col("label")), "binary")
        .when(F.length("clean_text") < cfg.min_text_length, "short")
        .otherwise("")
    )
    return cleaned.withColumn("dropped", reason)


def staged_rows(df: DataFrame, cfg: PrepConfig = PrepConfig()) -> tuple[DataFrame, dict[str, int]]:
    """The rows of ``prepare_rows``, staged, and how many rows went for which reason.

    One scan: a row that goes is written as well, with nothing in it, into a folder of
    its reason, where it costs next to no space and only its number is read.
    """
    judged = judged_rows(df, cfg)
    stays = F.col("dropped") == ""
    kept = [F.when(stays, F.col(f"`{c}`")).alias(c) for c in judged.columns if c not in ("dropped", "label")]
    # Labels of rows that go may not fit the type of those that stay.
    narrow = judged.select(*kept, F.when(stays, F.col("label")).cast("int").alias("label"), "dropped")
    columns = [c for c in judged.columns if c != "dropped"]
    path = staging_path(df.sparkSession, "cleaned")
    renamed = narrow.select(*[F.col(f"`{c}`") for c in columns], F.when(stays, "kept").otherwise(F.col("dropped")).alias("_dropped"))
    renamed.write.partitionBy("_dropped").parquet(path)
    table = df.sparkSession.read.schema(renamed.schema).parquet(path)
    counts = {r["_dropped"]: r["count"] for r in table.groupBy("_dropped").count().collect()}  # a line per reason
    rows = table.filter(F.col("_dropped") == "kept").select(*[F.col(f"`{c}`") for c in columns])
    return rows, counts


def prepare_rows(df: DataFrame, cfg: PrepConfig = PrepConfig()) -> DataFrame:
    """Rows with a binary label and a cleaned text of at least the minimal length.

    Narrow: no shuffle. All input columns are kept, ``clean_text`` is added.
    """
    require_columns(df)
    labelled = (
        df.withColumn("text", as_text(F.col("text")))
        .withColumn("label", coerce_label(df))
        .filter(is_binary(F.col("label")))
        .withColumn("label", F.col("label").cast("int"))
    )
    cleaned = with_clean_text(labelled, cfg)
    return cleaned.filter(F.length("clean_text") >= cfg.min_text_length)


def row_funnel(raw: DataFrame, min_length_ok: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before, at each filter, after, and dropped overall, in one row.

    ``raw`` is the input, ``min_length_ok`` the outcome of ``prepare_rows`` and
    ``after`` the deduplicated rows.
    """
    label = coerce_label(raw)
    start = raw.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count(label).alias("rows_with_label"),
        F.count_if(is_binary(label)).alias("rows_with_binary_label"),
    )
    middle = min_length_ok.agg(F.count(F.lit(1)).alias("rows_long_enough"))
    end = after.agg(F.count(F.lit(1)).alias("rows_after"))
    return side_by_side(start, middle, end).withColumn(
        "rows_dropped", F.col("rows_before") - F.col("rows_after")
    )
