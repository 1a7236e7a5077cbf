"""The jobs. Each reads files, composes operators and writes files.

What a job stages is removed when it ends. The field names in the documents
they write are fixed values: other tools read them.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textprep.config import (
    LINEAR_MODEL,
    METRICS_NAME,
    MODEL_PATH_FIELDS,
    REPORT_NAME,
    SEQUENCE_LENGTHS,
    SEQUENCE_MODELS,
    PrepConfig,
    SequenceConfig,
    TfidfConfig,
)
from textprep.functions.labels import binary_label
from textprep.functions.scores import softmax_prob
from textprep.operators import audit, dedup, features, metrics, model, report, sequences, split
from textprep.operators.compare import best_model, leaderboard
from textprep.operators.prepare import require_row_ids, resolve_text_column, staged_rows
from textprep.operators.rows import settled, side_by_side
from textprep.session import removes_staged, stage
from textprep.sources import documents
from textprep.sources.corpus import read_corpus, read_split, read_splits, resolve_split_dir, write_splits
from textprep.sources.paths import join
from textprep.sources.publish import published, settle


ENCODED = "encoded.parquet"


def split_kept(cleaned: DataFrame, groups: DataFrame, cfg: PrepConfig) -> DataFrame:
    """The rows that survive deduplication, with their split.

    Survivors and quotas are settled on row ids and labels, so the texts take
    part in a single join.
    """
    keys = stage(dedup.kept_rows(cleaned, groups, cfg), "kept-rows")
    kept = cleaned.join(keys.select("row_id"), "row_id", "left_semi").select(*cleaned.columns)
    return split.stratified_split(kept, cfg, keys)


@removes_staged
def prepare(
    spark: SparkSession,
    source: str,
    target: str,
    cfg: PrepConfig = PrepConfig(),
    row_id: str | None = None,
    csv: bool = False,
    multiline: bool = True,
) -> DataFrame:
    """Clean, filter, deduplicate, split and report. Returns the report row.

    A null or repeated ``row_id`` fails the job, since rows would be lost or
    come back by it. With ``multiline`` off a large CSV is read in parallel.

    The source is read once: the cleaned texts are written with what is needed to
    count the rows that go. Deduplication and the quotas of the split then work on
    narrow columns of that table, and the texts move once more when the survivors are
    taken. Splits and report appear together, or the earlier ones stay.
    """
    raw = read_corpus(spark, source, row_id, multiline)
    cleaned, counts = staged_rows(raw, cfg)
    rows_before = sum(counts.values())
    require_row_ids(cleaned)
    groups = stage(dedup.text_groups(cleaned), "text-groups")
    stats = dedup.dedup_stats(groups, cfg)
    with published(spark, target) as fresh:
        write_splits(split_kept(cleaned, groups, cfg), fresh, csv)
        done = spark.read.parquet(join(fresh, "splits.parquet"))
        funnel = stats.withColumn("rows_before_preprocessing", F.lit(rows_before)).withColumn(
            "rows_dropped", F.lit(rows_before) - F.col("rows_after")
        )
        overlap = audit.split_overlap(audit.texts_by_split(done))
        row = settled(report.build_report(report.split_label_table(done), overlap, cfg, funnel))
        result = row.select("deduplication.rows_after", "num_samples.full").first()
        if result["rows_after"] != result["full"]:
            raise RuntimeError(f"{result['rows_after']} rows were to be kept, {result['full']} were written")
        documents.write_json(row, join(fresh, REPORT_NAME))
    return row


def _audited(
    splits: DataFrame, text: str, label: str | None, drop: bool
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Splits (without leaked rows if asked), audits before/after, drop counts.

    Both audits follow from two tables per distinct text; no text is staged.
    """
    texts = stage(audit.texts_by_split(splits, text), "texts-by-split")
    flags = None if label is None else stage(audit.label_flags(splits, text, label), "label-flags")
    before = audit.leakage_audit(texts, flags)
    if drop:
        kept = audit.drop_train_overlap(splits, texts, text)
        after = audit.leakage_audit(audit.after_drop(texts), None if flags is None else audit.flags_after_drop(flags))
        dropped = audit.dropped_eval_rows(texts)
    else:
        kept, after = splits, before
        dropped = audit.dropped_eval_rows(texts.limit(0))
    both = side_by_side(
        before.select(F.struct(*before.columns).alias("before")),
        after.select(F.struct(*after.columns).alias("after")),
    )
    return kept, both.select(F.struct("before", "after").alias("leakage_audit")), dropped


def _packed(row: DataFrame, name: str) -> DataFrame:
    return row.select(F.struct(*row.columns).alias(name))


def _literals(name: str, values: dict) -> Any:
    return F.struct(*[F.lit(v).alias(k) for k, v in values.items()]).alias(name)


@removes_staged
def train_tfidf_logreg(
    spark: SparkSession,
    data_dir: str,
    model_dir: str,
    cfg: TfidfConfig = TfidfConfig(),
    text_col: str = "clean_text",
    label_col: str = "label",
    drop_train_overlap: bool = False,
) -> DataFrame:
    """Fit vocabulary and classifier on train, evaluate val and test, save all.

    Returns the run summary row.
    """
    splits = read_splits(spark, data_dir)
    text = resolve_text_column(splits, text_col)
    splits, audits, dropped = _audited(splits, text, None, drop_train_overlap)
    rows = splits.select("row_id", "split", F.col(text).alias("text"), binary_label(splits, label_col).alias("label"))
    rows = stage(rows, "labelled-texts")
    train = rows.filter(F.col("split") == "train")

    vocab = stage(features.tfidf_vocab(train, cfg, "text"), "vocabulary")
    fitted = model.fit_logreg(train, vocab, cfg, "text")
    held_out = rows.filter(F.col("split") != "train")
    scored = stage(
        model.predict_prob(held_out, fitted, vocab, cfg, "text").select("split", "label", "prob"), "scores"
    )
    measured = metrics.evaluate_splits(scored, cfg.threshold).select("val_metrics", "test_metrics")
    head = spark.range(1).select(
        F.lit(LINEAR_MODEL).alias("model"),
        F.lit(data_dir).alias("data_dir"),
        F.lit(resolve_split_dir(spark, data_dir)).alias("resolved_split_dir"),
        F.lit(text).alias("text_col"),
        F.lit(label_col).alias("label_col"),
        F.lit(drop_train_overlap).alias("drop_train_overlap_from_eval"),
        _literals(
            "hyperparameters",
            {
                "ngram_min": cfg.ngram_min,
                "ngram_max": cfg.ngram_max,
                "max_features": cfg.max_features,
                "min_df": cfg.min_df,
                "max_df": cfg.max_df,
                "C": cfg.c,
                "max_iter": cfg.max_iter,
                "threshold": cfg.threshold,
            },
        ),
        _literals("train_shape", {"rows": train.count(), "features": vocab.count()}),
    )
    summary = settled(side_by_side(head, _packed(dropped, "dropped_eval_rows"), audits, measured))
    with published(spark, model_dir) as fresh:
        documents.save_classifier(fitted, vocab, fresh)
        documents.write_json(summary, join(fresh, METRICS_NAME))
    return summary


@removes_staged
def encode_sequences(
    spark: SparkSession,
    data_dir: str,
    model_dir: str,
    cfg: SequenceConfig = SequenceConfig(),
    text_col: str = "clean_text",
    label_col: str = "label",
    drop_train_overlap: bool = False,
) -> DataFrame:
    """The data half of sequence models: vocabulary from train, encoded splits.

    Writes the vocabulary and the encoded rows, and a summary with the leakage
    audit and the class weights. Returns the encoded rows.
    """
    splits = read_splits(spark, data_dir)
    if label_col not in splits.columns:
        raise ValueError(f"missing label column {label_col!r}")
    text = resolve_text_column(splits, text_col)
    splits, audits, dropped = _audited(splits, text, label_col, drop_train_overlap)
    rows = splits.select("row_id", "split", F.col(text).alias("text"), binary_label(splits, label_col).alias("label"))
    rows = stage(rows, "labelled-texts")
    train = rows.filter(F.col("split") == "train")

    weights = metrics.class_weights(train)  # one entry per class
    entries = F.array_sort(F.collect_list(F.struct(F.col("label").cast("string"), "weight")))
    summary = side_by_side(
        spark.range(1).select(
            F.lit(data_dir).alias("data_dir"),
            F.lit(resolve_split_dir(spark, data_dir)).alias("resolved_split_dir"),
            F.lit(text).alias("text_col"),
            F.lit(label_col).alias("label_col"),
            F.lit(drop_train_overlap).alias("drop_train_overlap_from_eval"),
            _literals(
                "hyperparameters",
                {
                    "vocab_size": cfg.vocab_size,
                    "max_len": cfg.max_len,
                    "truncate_strategy": cfg.truncate_strategy,
                },
            ),
        ),
        _packed(dropped, "dropped_eval_rows"),
        audits,
        weights.agg(F.map_from_entries(entries).alias("class_weights")),
    )
    with published(spark, model_dir) as fresh:
        documents.save_word_vocab(sequences.sequence_vocab(train, cfg, "text"), fresh)
        encoded = sequences.encode(rows, documents.load_word_vocab(spark, fresh), cfg, "text").drop("text")
        encoded.write.mode("overwrite").partitionBy("split").parquet(join(fresh, ENCODED))
        documents.write_json(summary, join(fresh, METRICS_NAME))
    return spark.read.parquet(join(model_dir, ENCODED))


@removes_staged
def evaluate_sequence_model(
    spark: SparkSession,
    model_dir: str,
    load_fn: Callable[[], Any],
    predict_fn: Callable,
    kind: str = "rnn_family",
    model_name: str | None = None,
    threshold: float | None = None,
    batch_size: int = 16,
) -> DataFrame:
    """Score the encoded validation and test rows with the caller's trained model.

    Without a threshold the best one is searched on the validation rows alone
    and applied to both splits. The summary that ``encode_sequences`` wrote is
    completed by the model's name, the threshold and the metrics, so that later
    scoring uses both. Returns the summary row.
    """
    settle(spark, model_dir)
    path = join(model_dir, METRICS_NAME)
    encoded = spark.read.parquet(join(model_dir, ENCODED)).filter(F.col("split") != "train")
    logits = model.score_batches(encoded, load_fn, predict_fn, ["split", "label"], batch_size)
    scored = stage(logits.select("split", "label", softmax_prob(F.col("logits")).alias("prob")), "scores")
    measured = metrics.evaluate_splits(scored, threshold)
    saved = documents.read_json(spark, path)
    earlier = saved.drop("model", *measured.columns)
    name = F.lit(model_name or SEQUENCE_MODELS[kind]).alias("model")
    # The file is replaced by what is computed from it.
    row = side_by_side(spark.range(1).select(name), earlier, measured)
    used = F.col("hyperparameters").withField("threshold_used", F.col("threshold_used"))
    summary = settled(row.withColumn("hyperparameters", used).drop("threshold_used"))
    with published(spark, model_dir) as fresh:
        documents.write_json(summary, join(fresh, METRICS_NAME))
    return summary


def _write_result(
    scored: DataFrame, threshold: float, target: str, fields: dict, optional: dict
) -> DataFrame:
    measured = metrics.evaluate(scored, threshold)
    row = settled(measured.select(
        *[F.lit(v).alias(k) for k, v in fields.items()],
        F.lit(threshold).alias("threshold_used"),
        *[F.lit(v).alias(k) for k, v in optional.items()],
        "num_samples",
        "metrics",
    ))
    documents.write_json(row, target)
    return row


@removes_staged
def score_and_evaluate(
    spark: SparkSession,
    data_dir: str,
    model_dir: str,
    target: str,
    split_name: str = "test",
    text_col: str = "clean_text",
    label_col: str = "label",
    threshold: float | None = None,
) -> DataFrame:
    """Score one split with a saved classifier and write the result document."""
    fitted, vocab = documents.load_classifier(spark, model_dir)
    saved = documents.load_run_config(spark, model_dir).get("hyperparameters", {})
    cfg = TfidfConfig(
        ngram_min=int(saved.get("ngram_min", TfidfConfig.ngram_min)),
        ngram_max=int(saved.get("ngram_max", TfidfConfig.ngram_max)),
    )
    rows = read_split(spark, data_dir, split_name)
    text = resolve_text_column(rows, text_col)
    rows = rows.withColumn("label", binary_label(rows, label_col))
    scored = model.predict_prob(rows.select("row_id", "label", text), fitted, vocab, cfg, text)
    return _write_result(
        scored,
        model.resolve_threshold(threshold, saved, "tfidf_logreg"),
        target,
        {
            "model_name": LINEAR_MODEL,
            "model_kind": "tfidf_logreg",
            "model_dir": model_dir,
            "data_dir": data_dir,
            "split": split_name,
            "text_col": text,
            "label_col": label_col,
        },
        {},
    )


@removes_staged
def score_sequences_and_evaluate(
    spark: SparkSession,
    data_dir: str,
    model_dir: str,
    target: str,
    load_fn: Callable[[], Any],
    predict_fn: Callable,
    kind: str = "rnn_family",
    split_name: str = "test",
    text_col: str = "clean_text",
    label_col: str = "label",
    threshold: float | None = None,
    max_len: int | None = None,
    truncate_strategy: str | None = None,
    batch_size: int = 16,
    model_path: str | None = None,
) -> DataFrame:
    """The same for a sequence model the caller loads; it gets ids and mask.

    ``model_path`` is where ``load_fn`` finds it, for the record.
    """
    meta = documents.load_run_config(spark, model_dir)
    saved = meta.get("hyperparameters", {})
    cfg = SequenceConfig(
        max_len=int(model.resolve_setting(max_len, saved, "max_len", default=SEQUENCE_LENGTHS[kind])),
        truncate_strategy=str(
            model.resolve_setting(truncate_strategy, saved, "truncate_strategy", default="post")
        ),
    )
    rows = read_split(spark, data_dir, split_name)
    text = resolve_text_column(rows, text_col)
    rows = rows.select("row_id", F.col(text).alias("text"), binary_label(rows, label_col).alias("label"))
    encoded = sequences.encode(rows, documents.load_word_vocab(spark, model_dir), cfg, "text")
    scored = model.score_batches(encoded.drop("text"), load_fn, predict_fn, ["label"], batch_size)
    used: dict[str, Any] = {"max_len_used": cfg.max_len}
    if kind == "rnn_family":
        used["truncate_strategy"] = cfg.truncate_strategy
    return _write_result(
        scored.withColumn("prob", softmax_prob(F.col("logits"))),
        model.resolve_threshold(threshold, saved, kind),
        target,
        {
            "model_name": str(meta.get("model", SEQUENCE_MODELS[kind])),
            "model_kind": kind,
            "model_dir": model_dir,
            MODEL_PATH_FIELDS[kind]: model_path or model_dir,
            "data_dir": data_dir,
            "split": split_name,
            "text_col": text,
            "label_col": label_col,
        },
        used,
    )


@removes_staged
def compare(spark: SparkSession, inputs: list[str], json_path: str, csv_path: str) -> DataFrame:
    """Rank result documents, write the comparison and return the best model."""
    results = documents.read_results(spark, inputs)
    documents.write_comparison(results, json_path, csv_path)
    return best_model(leaderboard(results))
