"""Bounded training samples, and scoring of whole tables with a fitted model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textprep.llm.columns import fold


def in_fold(doc_id: Column, folds: int, held: int) -> Column:
    """Whether a row is held out; a row with a null id is not."""
    return F.coalesce(fold(doc_id, folds) == held, F.lit(False))


def window(text: str, doc_id: str, most: int) -> Column:
    """The text, or of a longer one ``most`` characters from a place drawn by the id."""
    places = F.length(text) - most + 1
    start = F.pmod(F.xxhash64(doc_id, F.lit("place")), places).cast("int") + 1
    return F.when(F.length(text) > most, F.substring(F.col(text), start, F.lit(most))).otherwise(F.col(text))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    folds: int,
    held: int,
    per_class: dict[int, int],
    max_chars: int,
) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """(text, label) of at most ``per_class`` documents of each class.

    They come from the folds that are not held out and have the smallest hashes
    of their ids. Of a text longer than ``max_chars`` characters a window of that
    length is learned, at a place drawn by the id; null texts are not learned. Of
    contradicting labels of one document the larger counts. With the sample comes
    how many documents each class has in all. Only the chosen ids, a bounded number,
    are broadcast to the scan.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~in_fold(F.col("doc_id"), folds, held))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    spark = docs.sparkSession
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = []
    for value, most in per_class.items():
        mine = known.filter(F.col("label") == value)
        chosen += [(r["doc_id"], value) for r in mine.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id").collect()]
    ids = spark.createDataFrame(chosen or [(None, 0)], "doc_id bigint, label int")
    texts = docs.select("doc_id", window("text", "doc_id", max_chars).alias("text")).filter(F.col("text").isNotNull())
    found = texts.join(F.broadcast(ids), "doc_id").select("doc_id", "label", "text").collect()
    return [(r["text"], r["label"]) for r in sorted(found, key=lambda r: (r["doc_id"], r["text"]))], sizes


def scored(
    docs: DataFrame, folds: int, held: int, score: Callable[[], Callable[[list[str]], np.ndarray]], threshold: float
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    ``score`` is called once per task and returns the function that scores a
    list of texts, with null as empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_texts = score()
        for batch in batches:
            values = np.asarray(of_texts([t or "" for t in batch.column("text").to_pylist()]), np.float64)
            predicted = (values >= threshold).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(values), pa.array(predicted)],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", in_fold(F.col("doc_id"), folds, held).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")
