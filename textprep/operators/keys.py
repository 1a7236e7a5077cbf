"""Fixed-width keys for texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textprep.functions.clean import as_text


def text_key(text: Column) -> Column:
    """32 bytes that stand for a text of any length in shuffles (SHA-256)."""
    return F.unhex(F.sha2(as_text(text), 256))
