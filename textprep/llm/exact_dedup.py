"""Exact duplicates, found in two combining steps.

1. Each map task combines equal texts by partial aggregation, so it sends one row per
   distinct text, also of a text that a third of all rows hold. Texts move once.
2. Each row looks up its class by digest, salt and a second hash. A class is listed for
   the salts that its rows have, as bits of one number, so no key of that join is hot.

The whole normalised text is part of the grouping key: texts are equal only if their
content is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textprep.llm.columns import SPACE, whole

SALTS = 32


def normalised(text: Column) -> Column:
    """Every run of white space as one space; null counts as empty.

    The pattern skips single spaces, which stay as they are.
    """
    return F.regexp_replace(whole(text), rf"[\x09-\x0D]{SPACE}*|\x20{SPACE}+", " ")


def exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int = SALTS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest id stays. Null and empty texts, and
    texts of nothing but white space next to each other, are ordinary texts. A
    null id is larger than any other; if all ids of a group are null, keep_id is
    null and one row stays. Of repeated rows with one id and text, one stays.
    Other columns are ignored. An empty table gives an empty result. There are at most
    64 salts, which only spread the work.
    """
    salts = min(salts, 64)
    content = normalised(F.col(text))
    keyed = docs.select(
        F.col(doc_id).alias("doc_id"),
        content.alias("content"),
        F.sha2(content, 256).alias("text_sha256"),
        F.pmod(F.xxhash64(F.col(doc_id)), F.lit(salts)).cast("int").alias("salt"),
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("salt"))
    groups = keyed.groupBy("text_sha256", "content").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"), F.bit_or(bit).alias("bits")
    )
    present = F.filter(
        F.array(*[F.lit(i) for i in range(salts)]),
        lambda i: F.call_function("shiftright", F.col("bits"), i).bitwiseAND(F.lit(1).cast("bigint")) != 0,
    )
    classes = groups.select(
        "text_sha256", F.explode(present).alias("salt"), F.xxhash64("content").alias("mark"), "keep_id", "group_size"
    )
    rows = keyed.select("doc_id", "text_sha256", "salt", F.xxhash64("content").alias("mark"))
    found = rows.join(classes, ["text_sha256", "salt", "mark"])
    repeated = Window.partitionBy("text_sha256", "salt", "mark", "doc_id").orderBy("doc_id")
    first = F.row_number().over(repeated) == 1
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & first).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs``, all columns, that ``exact_duplicates`` keeps.

    Of repeated rows with one id and text, the first by its other columns, written as
    JSON, stays; columns of any type are allowed. An empty table stays empty.
    """
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    stay = exact_duplicates(docs, doc_id, text, salts).filter("kept")
    stay = stay.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_key"), F.col("text_sha256").alias("_sha"))
    row = docs.select(F.struct("*").alias("_row"), key.alias("_key"), F.sha2(normalised(F.col(text)), 256).alias("_sha"))
    found = row.join(stay, ["_key", "_sha"])
    others = [F.col("_row")[c].alias(c) for c in docs.columns if c not in (doc_id, text)]
    written = [F.to_json(F.struct(*others))] if others else []
    turn = F.row_number().over(Window.partitionBy("_key", "_sha").orderBy(*written, F.col("_row")[text]))
    return found.withColumn("_turn", turn).filter("_turn = 1").select("_row.*")
