"""Word vocabulary and fixed-length id sequences."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textprep.config import OOV_ID, SequenceConfig
from textprep.functions.clean import as_text
from textprep.functions.tokens import attention_mask, pad_post, sequence_tokens, truncate
from textprep.operators.features import SORT_ROWS, fits_locally, top_rows
from textprep.operators.rows import numbered
from textprep.operators.skew import lookup
from textprep.session import stage

FIRST_WORD_ID = OOV_ID + 1


def _words(text: str) -> Column:
    return sequence_tokens(as_text(F.col(text)))


def word_counts(df: DataFrame, text: str = "clean_text") -> DataFrame:
    """Occurrences of each word and the first row it appears in.

    Fixed-width values only, so the partial aggregation is a hash aggregation.
    """
    words = df.select("row_id", F.explode(_words(text)).alias("term"))
    return words.groupBy("term").agg(
        F.count(F.lit(1)).alias("tf"), F.min("row_id").alias("first_row")
    )


def _first_positions(df: DataFrame, words: DataFrame, text: str) -> DataFrame:
    """Where each word stands in its first row; reads those rows only."""
    # Unless the words are few, Spark picks the joins by size.
    ship = F.broadcast if fits_locally(words) else lambda table: table
    ends = words.agg(F.min("first_row").alias("low"), F.max("first_row").alias("high")).first()
    near = df.select("row_id", text).filter(F.col("row_id").between(ends["low"], ends["high"]))
    firsts = words.select(F.col("first_row").alias("row_id")).distinct()
    rows = near.join(ship(firsts), "row_id", "left_semi")
    places = rows.select(F.col("row_id").alias("first_row"), F.posexplode(_words(text)).alias("pos", "term"))
    return places.join(ship(words), ["first_row", "term"]).groupBy("term").agg(F.min("pos").alias("pos"))


def sequence_vocab(
    df: DataFrame, cfg: SequenceConfig = SequenceConfig(), text: str = "clean_text"
) -> DataFrame:
    """The most frequent words with ids from 2; ties by first appearance.

    Ids below ``vocab_size`` exist, 0 is padding and 1 any other word.
    """
    limit = cfg.vocab_size - FIRST_WORD_ID
    if limit <= 0:
        raise ValueError("vocab_size leaves no room for words")
    counts = stage(word_counts(df, text), "words")
    last = top_rows(counts, limit, "tf", "first_row").orderBy("tf", F.col("first_row").desc()).first()
    empty = counts.select("term", F.lit(0).alias("id"), "tf").limit(0)
    if last is None:
        return empty
    # Words level with the last one stand in the same row: its position decides.
    level = (F.col("tf") == last["tf"]) & (F.col("first_row") <= last["first_row"])
    words = counts.filter((F.col("tf") > last["tf"]) | level)
    placed = stage(words.join(_first_positions(df, words, text), "term"), "placed-words")
    ranked = numbered(placed, "_place", F.col("tf").desc(), "first_row", "pos", in_one_task=SORT_ROWS)
    ranked = ranked.withColumn("id", (F.col("_place") + (FIRST_WORD_ID - 1)).cast("int"))
    return ranked.filter(F.col("id") < cfg.vocab_size).select("term", "id", "tf")


def _id_lookup(vocab: DataFrame):
    """A function from a word list column to the list of ids."""
    table = vocab.select("term", "id").toPandas()
    shared = vocab.sparkSession.sparkContext.broadcast((table["term"].tolist(), table["id"].tolist()))
    cache: dict[str, tuple] = {}

    @F.arrow_udf("array<int>")
    def ids(words: pa.Array) -> pa.Array:
        if "vocab" not in cache:
            terms, numbers = shared.value
            # One entry more than words: what is not found takes the last one.
            cache["vocab"] = (pa.array(terms, pa.string()), pa.array([*numbers, OOV_ID], pa.int32()))
        terms, numbers = cache["vocab"]
        place = pc.fill_null(pc.index_in(words.flatten(), value_set=terms), len(terms))
        sizes = pc.fill_null(pc.list_value_length(words), 0)
        ends = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes).cast(pa.int32())])
        return pa.ListArray.from_arrays(ends, numbers.take(place))

    return ids


def _ids_by_join(df: DataFrame, vocab: DataFrame) -> DataFrame:
    """The same for a vocabulary too large to ship: at most ``max_len`` words of
    a row are joined and collected again. Needs a unique ``row_id``."""
    words = df.select("row_id", F.posexplode("_words").alias("pos", "term"))
    # Every word of the rows with its count: one outside the vocabulary can be hot too.
    rows_of = words.groupBy("term").agg(F.count(F.lit(1)).alias("_rows"))
    listed = stage(rows_of.join(vocab.select("term", "id"), "term", "left"), "listed-words")
    found = lookup(words, listed, "term", ["id"], scatter="row_id", weight="_rows")
    item = F.struct("pos", F.coalesce("id", F.lit(OOV_ID)).alias("id"))
    lists = found.groupBy("row_id").agg(F.array_sort(F.collect_list(item)).alias("_items"))
    joined = df.join(lists, "row_id", "left")
    ids = F.coalesce(F.col("_items.id"), F.array().cast("array<int>"))
    return joined.withColumn("ids", ids).drop("_items")


def encode(
    df: DataFrame,
    vocab: DataFrame,
    cfg: SequenceConfig = SequenceConfig(),
    text: str = "clean_text",
    local_vocabulary: int | None = None,
) -> DataFrame:
    """Add ``ids`` of length ``max_len`` and the attention ``mask``.

    Every word has an id, so lists are cut before the lookup and no task
    handles more than ``max_len`` words of a row.
    """
    # Two steps: the cut refers to the words several times.
    words = df.withColumn("_all", _words(text))
    cut = words.withColumn("_words", truncate(F.col("_all"), cfg.max_len, cfg.truncate_strategy)).drop("_all")
    if fits_locally(vocab, local_vocabulary):
        found = cut.withColumn("ids", _id_lookup(vocab)(F.col("_words")))
    else:
        found = _ids_by_join(cut, vocab)
    padded = found.drop("_words").withColumn("ids", pad_post(F.col("ids"), cfg.max_len))
    return padded.withColumn("mask", attention_mask(F.col("ids")))
