"""Label coercion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from textprep.config import BINARY_LABELS

# Decimal spellings read as numbers. Spark's own cast would also take type
# suffixes such as "1d" and the word "NaN".
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Beyond this a double no longer fits a BIGINT.
BIGINT_LIMIT = 2.0**63


def coerce_label(df: DataFrame, column: str = "label") -> Column:
    """The label as BIGINT, cut toward zero; null where it is not a finite number."""
    label = F.col(column)
    kind = df.schema[column].dataType
    if isinstance(kind, (NumericType, BooleanType)):
        number = label.cast("double")
    else:
        text = label.cast("string")
        number = F.when(text.rlike(NUMBER), text.try_cast("double"))
    # NaN compares greater than every number, so the bound drops it as well.
    return F.when(F.abs(number) < F.lit(BIGINT_LIMIT), number.cast("bigint"))


def is_binary(label: Column) -> Column:
    return label.isin(*BINARY_LABELS)


def binary_label(df: DataFrame, column: str = "label") -> Column:
    """The label as INT; a row whose label is not 0 or 1 fails the job."""
    label = coerce_label(df, column)
    return F.when(is_binary(label), label.cast("int")).otherwise(_refuse("label is not 0 or 1", F.col(column)))


def _refuse(message: str, value: Column) -> Column:
    shown = F.coalesce(value.cast("string"), F.lit("null"))
    return F.raise_error(F.concat(F.lit(f"{message}: "), shown)).cast("int")


def checked_label(column: str = "label") -> Column:
    """The column as it is; a value other than 0 and 1, null too, fails the job."""
    label = F.col(column)
    return F.when(label.isin(*BINARY_LABELS), label).otherwise(_refuse(f"{column} is not 0 or 1", label))


def checked_score(column: str = "prob") -> Column:
    """The column as it is; a score that is null or NaN fails the job."""
    score = F.col(column)
    return F.when(score.isNotNull() & ~F.isnan(score), score).otherwise(_refuse(f"{column} is no number", score))
