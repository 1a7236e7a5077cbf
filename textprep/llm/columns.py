"""Column expressions and readers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space is the six ASCII characters; everything else belongs to words.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARACTERS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(text, F.lit(""))


def without(text: Column, characters: str) -> Column:
    """``text`` less every occurrence of the given characters."""
    return F.translate(text, characters, "")


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document: CRC-32 of its id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds
