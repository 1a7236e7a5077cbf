"""Registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textprep.config import METRICS_NAME, NA_TOKENS, SPLITS, PrepConfig, SequenceConfig, TfidfConfig
from textprep.functions.clean import normalize_unicode, with_clean_text
from textprep.functions.labels import coerce_label
from textprep.functions.scores import softmax_prob
from textprep.operators import audit, compare, dedup, features, metrics, model, report, sequences, split
from textprep.operators.custom import Brier, LogLoss, custom_metrics
from textprep.operators.prepare import prepare_rows, row_funnel
from textprep.plans import jobs
from textprep.plans.jobs import prepare, split_kept
from textprep.session import spread, stage, staging_path
from textprep.sources.corpus import na_to_null, read_corpus, read_split, read_splits, write_splits
from textprep.sources.documents import (
    load_classifier,
    read_json,
    read_results,
    read_summaries,
    save_classifier,
    write_json,
)

Query = Callable[[SparkSession, str], DataFrame]

CFG = PrepConfig()
# Label spellings as they occur in hand-made CSV files.
LABEL_SPELLINGS = (
    "1", "0", " 1 ", "1e0", "+1", "1_0", "1.9", "0.7", "-0.5",
    "1d", "1f", "0x1", "NaN", "inf", "true", "", "abc", "2",
)


# Strings and their NFKC forms.
NFKC_PAIRS = (
    ("\ufb01n", "fin"), ("\uff21\uff22", "AB"), ("\u2460", "1"), ("e\u0301", "\u00e9"), ("\u00e9", "\u00e9"),
    ("\u1112\u1161\u11ab", "\ud55c"), ("\uff76\uff9e", "\u30ac"), ("\u0438\u0306", "\u0439"), ("\u4e2d\u6587", "\u4e2d\u6587"),
    ("\u00bd", "1\u20442"), ("plain", "plain"),
)


# --- inputs ---------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_table(spark, sf_dir, "documents"), "doc_id").withColumnRenamed("doc_id", "row_id")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their quality label."""
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"), F.col("quality").alias("label"))
    return _documents(spark, sf_dir).join(labels, "row_id").select("row_id", "text", "label", "source")


def _conflicting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, labelled so that some copies contradict each other."""
    docs = _documents(spark, sf_dir)
    return docs.select("row_id", "text", (F.col("row_id") % 2).cast("int").alias("label"))


def _raw_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with labels in many spellings, valid and not."""
    spellings = F.array(*[F.lit(s) for s in LABEL_SPELLINGS])
    place = (F.col("row_id") % len(LABEL_SPELLINGS)).cast("int") + 1
    return _documents(spark, sf_dir).select("row_id", "text", F.element_at(spellings, place).alias("label"))


def _cleaned(rows: DataFrame) -> DataFrame:
    return stage(prepare_rows(rows, CFG), "cleaned")


def _presplit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents split by a hash before deduplication: copies do leak."""
    b = F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 4), 16, 10).cast("int") % 100
    return _table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"),
        "text",
        (F.col("doc_id") % 2).cast("int").alias("label"),
        F.when(b < 72, "train").when(b < 80, "val").otherwise("test").alias("split"),
    )


def _scores_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    noise = ((F.col("row_id") * 7919) % 1000).cast("double")
    prob = F.lit(0.35) * F.col("label") + F.lit(0.65) * noise / F.lit(999.0)
    return _labelled(spark, sf_dir).select("row_id", "source", "label", prob.alias("prob"))


def _scores_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = (F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17) % 1000
    return _table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (mix.cast("double") / F.lit(999.0)).alias("prob"),
    )


def _logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    prob = F.col("prob")
    odds = F.log((prob + F.lit(0.001)) / (F.lit(1.001) - prob))
    return _scores_small(spark, sf_dir).select("row_id", "label", F.array(F.lit(0.0), odds).alias("logits"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


# --- preparation ----------------------------------------------------------


def clean_documents(spark, sf_dir):
    return with_clean_text(_documents(spark, sf_dir).select("row_id", "text"), CFG).select("row_id", "clean_text")


def clean_pages_text(spark, sf_dir):
    pages = spread(_table(spark, sf_dir, "pages").select("page_id", "html"), "page_id")
    return with_clean_text(pages, CFG, source="html").select("page_id", "clean_text")


def clean_strict(spark, sf_dir):
    cfg = PrepConfig(keep_sentence_punctuation=False, remove_emails=False)
    return with_clean_text(_documents(spark, sf_dir).select("row_id", "text"), cfg).select("row_id", "clean_text")


def label_coercion(spark, sf_dir):
    raw = _raw_labels(spark, sf_dir)
    return raw.select("row_id", coerce_label(raw).alias("label")).filter(F.col("label").isNotNull())


def label_share_clean(spark, sf_dir):
    """Label share of the clean, conflict-free corpus without copies."""
    cleaned = prepare_rows(_labelled(spark, sf_dir), CFG)
    kept = dedup.text_groups(cleaned).filter(~dedup.is_conflict())
    counts = kept.groupBy(F.col("label_low").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # over one row per label
    return counts.select("label", F.round(F.col("n") / total, 6).alias("share"))


def dedup_keep_first(spark, sf_dir):
    cleaned = _cleaned(_conflicting(spark, sf_dir))
    kept = dedup.deduplicate(cleaned, dedup.text_groups(cleaned), CFG)
    return kept.select("row_id", "label", "clean_text")


def dedup_stats(spark, sf_dir):
    return dedup.dedup_stats(dedup.text_groups(prepare_rows(_conflicting(spark, sf_dir), CFG)), CFG)


def _conflicts(spark, sf_dir, pick) -> DataFrame:
    cleaned = _cleaned(_conflicting(spark, sf_dir))
    groups = stage(dedup.text_groups(cleaned), "text-groups")
    return pick(cleaned, groups).select("row_id", "label")


def drop_conflicts(spark, sf_dir):
    return _conflicts(spark, sf_dir, dedup.drop_conflicts)


def conflict_rows(spark, sf_dir):
    return _conflicts(spark, sf_dir, dedup.conflict_rows)


def funnel(spark, sf_dir):
    raw = _raw_labels(spark, sf_dir)
    cleaned = _cleaned(raw)
    after = dedup.deduplicate(cleaned, dedup.text_groups(cleaned), CFG)
    return row_funnel(raw, cleaned, after)


def _kept_keys(rows: DataFrame) -> DataFrame:
    """Row ids and labels of the prepared rows after deduplication."""
    cleaned = _cleaned(rows)
    return stage(dedup.kept_rows(cleaned, dedup.text_groups(cleaned), CFG), "kept-rows")


def stratified_split(spark, sf_dir):
    return split.stratified_split(_kept_keys(_labelled(spark, sf_dir)), CFG)


def split_sizes(spark, sf_dir):
    done = split.stratified_split(_kept_keys(_conflicting(spark, sf_dir)), CFG)
    return done.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


def _split_lazily(spark, sf_dir) -> DataFrame:
    cleaned = _cleaned(_labelled(spark, sf_dir))
    return split_kept(cleaned, dedup.text_groups(cleaned), CFG)


def _split_corpus(spark, sf_dir) -> DataFrame:
    return stage(_split_lazily(spark, sf_dir), "splits")


def prep_report(spark, sf_dir):
    done = _split_corpus(spark, sf_dir)
    overlap = audit.split_overlap(audit.texts_by_split(done))
    row = report.build_report(report.split_label_table(done), overlap, CFG)
    lines = [
        F.struct(
            F.lit(p).alias("part"),
            F.col(f"num_samples.{p}").alias("num_samples"),
            F.round(F.col(f"text_length_stats.{p}_mean"), 6).alias("mean_length"),
            *[
                F.round(F.try_element_at(F.col(f"label_distribution.{p}"), F.lit(k)), 6).alias(f"share_{k}")
                for k in ("0", "1")
            ],
            F.col("split_overlap.triple_overlap").alias("triple_overlap"),
            F.col("config.min_text_length").cast("bigint").alias("min_text_length"),
        )
        for p in ("full", *SPLITS)
    ]
    return row.select(F.explode(F.array(*lines)).alias("r")).select("r.*")


def label_distribution(spark, sf_dir):
    table = report.split_label_table(_split_corpus(spark, sf_dir))
    return _rounded(report.label_distribution(table), "share")


def length_stats(spark, sf_dir):
    table = report.split_label_table(_split_corpus(spark, sf_dir))
    return _rounded(report.length_stats(table), "mean_length")


def length_histogram(spark, sf_dir):
    return report.length_histogram(_presplit(spark, sf_dir), 500, "text")


def write_read_splits(spark, sf_dir):
    """Splits written as partitioned Parquet, and one of them read back."""
    folder = staging_path(spark, "written-splits")
    write_splits(_split_lazily(spark, sf_dir), folder)
    return read_split(spark, folder, "test").select("row_id", "label", F.length("clean_text").alias("n_chars"))


def prepare_job(spark, sf_dir):
    """The whole preparation job, from a Parquet corpus to written splits."""
    folder = staging_path(spark, "prepare-job")
    source = f"{folder}/corpus.parquet"
    _labelled(spark, sf_dir).select(F.col("row_id").alias("id"), "text", "label").write.parquet(source)
    prepare(spark, source, f"{folder}/out", CFG, row_id="id")
    return read_splits(spark, f"{folder}/out").select("row_id", "label", "split")


def _by_row(spark, sf_dir, values: tuple[str, ...]) -> DataFrame:
    """One of the values for each document, in turn."""
    place = (F.col("row_id") % len(values)).cast("int") + 1
    listed = F.array(*[F.lit(v) for v in values])
    return _documents(spark, sf_dir).select("row_id", F.element_at(listed, place).alias("value"))


def na_tokens(spark, sf_dir):
    """What a CSV reader takes as missing, among whole texts and strings that only look alike."""
    looks = (*NA_TOKENS, "na", "Null", " NA", "none", "text")
    rows = _by_row(spark, sf_dir, looks).join(_documents(spark, sf_dir).select("row_id", "text"), "row_id")
    value = F.when(F.col("row_id") % 3 == 0, F.col("text")).otherwise(F.col("value"))
    return na_to_null(rows.select("row_id", value.alias("value")))


def nfkc_strings(spark, sf_dir):
    rows = _by_row(spark, sf_dir, tuple(raw for raw, _ in NFKC_PAIRS))
    return rows.select("row_id", normalize_unicode(F.col("value")).alias("value"))


def nfkc_texts(spark, sf_dir):
    """Whole texts with characters that NFKC changes put in after each blank."""
    rows = _by_row(spark, sf_dir, tuple(raw for raw, _ in NFKC_PAIRS)).join(_documents(spark, sf_dir).select("row_id", "text"), "row_id")
    mixed = F.replace(F.col("text"), F.lit(" "), F.concat(F.lit(" "), F.col("value")))
    return rows.select("row_id", normalize_unicode(mixed).alias("value"))


def _prepared_folder(spark, sf_dir) -> str:
    """The folder the preparation job wrote from the labelled corpus."""
    folder = staging_path(spark, "prepared")
    source = f"{folder}/corpus.parquet"
    _labelled(spark, sf_dir).select(F.col("row_id").alias("id"), "text", "label").write.parquet(source)
    prepare(spark, source, f"{folder}/split", CFG, row_id="id")
    return folder


def report_document(spark, sf_dir):
    """The report as the job wrote it, one line per part."""
    row = read_json(spark, f"{_prepared_folder(spark, sf_dir)}/split/preprocessing_report.json")
    lines = [
        F.struct(
            F.lit(p).alias("part"),
            F.col(f"num_samples.{p}").alias("num_samples"),
            F.round(F.col(f"text_length_stats.{p}_mean"), 6).alias("mean_length"),
            F.col("deduplication.rows_before_preprocessing").alias("rows_read"),
            F.col("deduplication.rows_dropped").alias("rows_dropped"),
        )
        for p in ("full", *SPLITS)
    ]
    return row.select(F.explode(F.array(*lines)).alias("r")).select("r.*")


def read_corpus_csv(spark, sf_dir):
    """The labelled corpus written as CSV, read as a raw corpus and prepared."""
    folder = staging_path(spark, "corpus") + ".csv"
    rows = _labelled(spark, sf_dir).select(F.col("row_id").alias("id"), "text", "label")
    rows.write.option("header", True).option("escape", '"').csv(folder)
    corpus = read_corpus(spark, folder, row_id="id")
    return prepare_rows(corpus, CFG).select("row_id", "label", "clean_text")


# --- leakage --------------------------------------------------------------


def _leaky(spark, sf_dir) -> DataFrame:
    return audit.texts_by_split(_presplit(spark, sf_dir), "text")


def split_overlap(spark, sf_dir):
    return audit.split_overlap(_leaky(spark, sf_dir))


def split_stats(spark, sf_dir):
    return audit.split_stats(_leaky(spark, sf_dir))


def overlap_label_conflicts(spark, sf_dir):
    return audit.overlap_label_conflicts(_presplit(spark, sf_dir), "text")


def drop_train_overlap(spark, sf_dir):
    rows = _presplit(spark, sf_dir)
    texts = stage(audit.texts_by_split(rows, "text"), "texts-by-split")
    return audit.drop_train_overlap(rows, texts, "text").select("row_id", "split", "label")


def dropped_eval_rows(spark, sf_dir):
    return audit.dropped_eval_rows(_leaky(spark, sf_dir))


def leakage_audit(spark, sf_dir):
    """Before and after dropping leaked rows, one line per split and stage."""
    rows = _presplit(spark, sf_dir)
    texts = stage(audit.texts_by_split(rows, "text"), "texts-by-split")
    flags = stage(audit.label_flags(rows, "text"), "label-flags")
    stages = {
        "before": audit.leakage_audit(texts, flags),
        "after": audit.leakage_audit(audit.after_drop(texts), audit.flags_after_drop(flags)),
    }

    def lines(name: str, row: DataFrame) -> DataFrame:
        parts = [F.struct(F.lit(s).alias("split"), F.col(f"split_stats.{s}").alias("v")) for s in SPLITS]
        return row.select(
            F.lit(name).alias("stage"),
            "cross_split_overlap.*",
            F.col("overlap_label_conflicts.train_test").alias("conflicts_train_test"),
            F.explode(F.array(*parts)).alias("p"),
        ).select("stage", "p.split", "p.v.*", "train_val", "train_test", "val_test", "triple_overlap",
                 "conflicts_train_test")

    return lines("before", stages["before"]).unionByName(lines("after", stages["after"]))


# --- metrics --------------------------------------------------------------


def class_weights(spark, sf_dir):
    return _rounded(metrics.class_weights(_labelled(spark, sf_dir)), "weight")


def _counts(spark, sf_dir) -> DataFrame:
    return metrics.confusion_counts(metrics.with_prediction(_scores_large(spark, sf_dir), 0.5))


def binary_metrics(spark, sf_dir):
    return _rounded(metrics.binary_metrics(_counts(spark, sf_dir)), "accuracy", "precision", "recall", "f1")


def confusion_matrix(spark, sf_dir):
    cells = metrics.confusion_matrix(_counts(spark, sf_dir)).select(F.posexplode("confusion_matrix").alias("label", "r"))
    return cells.select("label", F.posexplode("r").alias("pred", "n"))


def classification_report(spark, sf_dir):
    lines = metrics.classification_report(_counts(spark, sf_dir)).withColumnRenamed("f1-score", "f1_score")
    return _rounded(lines, "precision", "recall", "f1_score")


def roc_auc(spark, sf_dir):
    return _rounded(metrics.roc_auc(_scores_large(spark, sf_dir)), "roc_auc")


def best_f1_threshold(spark, sf_dir):
    return _rounded(metrics.best_f1_threshold(_scores_large(spark, sf_dir)), "threshold", "best_f1")


def val_threshold_on_test(spark, sf_dir):
    """The threshold found on validation rows, and what it gives on test rows."""
    parts = _presplit(spark, sf_dir).select("row_id", "split")
    row = metrics.evaluate_splits(_scores_small(spark, sf_dir).join(parts, "row_id"))
    return _rounded(
        row.select(
            F.col("threshold_used").alias("threshold"),
            F.col("val_threshold_search.best_f1_at_threshold").alias("best_val_f1"),
            F.col("test_metrics.f1").alias("test_f1"),
            F.col("test_metrics.accuracy").alias("test_accuracy"),
        ),
        "threshold", "best_val_f1", "test_f1", "test_accuracy",
    )


def softmax(spark, sf_dir):
    logits = _logits(spark, sf_dir)
    return logits.select("row_id", F.round(softmax_prob(F.col("logits")), 6).alias("prob"))


def checkpoint_metrics(spark, sf_dir):
    rows = metrics.checkpoint_metrics(_logits(spark, sf_dir))
    return _rounded(rows, *rows.columns)


def _results(spark, sf_dir) -> DataFrame:
    """One result per source of the scored documents."""
    return metrics.evaluate(_scores_small(spark, sf_dir), 0.5, "source").select(
        F.col("source").alias("model_name"),
        F.lit("by_source").alias("model_kind"),
        F.lit("test").alias("split"),
        "num_samples",
        F.lit(0.5).alias("threshold_used"),
        "metrics",
        F.col("source").alias("source_file"),
    )


def _board(spark, sf_dir) -> DataFrame:
    return compare.leaderboard(_results(spark, sf_dir))


def _ranked(board: DataFrame) -> DataFrame:
    ranked = compare.rank_models(board)
    return _rounded(ranked, *compare.METRICS).select("model_name", "split", "num_samples", *compare.METRICS)


def rank_models(spark, sf_dir):
    return _ranked(_board(spark, sf_dir))


def result_documents(spark, sf_dir):
    """The same ranking over result documents written as JSON and read back."""
    folder = staging_path(spark, "results")
    results = _results(spark, sf_dir).drop("source_file")
    document = F.to_json(F.struct(*results.columns), {"ignoreNullFields": "false"})
    # One folder, and so one file, per result.
    named = results.select(F.md5(F.col("model_name").cast("binary")).alias("of"), document.alias("value"))
    named.write.partitionBy("of").text(folder)
    return _ranked(compare.leaderboard(read_results(spark, [folder])))


def compare_job(spark, sf_dir):
    """The comparison job over result documents; its CSV read back."""
    folder = staging_path(spark, "compared")
    results = _results(spark, sf_dir).drop("source_file")
    document = F.to_json(F.struct(*results.columns), {"ignoreNullFields": "false"})
    named = results.select(F.md5(F.col("model_name").cast("binary")).alias("of"), document.alias("value"))
    named.write.partitionBy("of").text(f"{folder}/in")
    jobs.compare(spark, [f"{folder}/in"], f"{folder}/comparison.json", f"{folder}/comparison.csv")
    types = ", ".join(f"{m} double" for m in compare.METRICS)
    schema = f"model_name string, model_kind string, split string, num_samples bigint, threshold_used double, {types}, source_file string"
    return _ranked(spark.read.schema(schema).option("header", True).csv(f"{folder}/comparison.csv"))


def best_model(spark, sf_dir):
    best = compare.best_model(_board(spark, sf_dir))
    return _rounded(best, *compare.METRICS).select("model_name", "num_samples", "f1", "roc_auc")


def metrics_long(spark, sf_dir):
    return _rounded(compare.metrics_long(_board(spark, sf_dir), ["model_name"]), "value")


# --- features and sequences -----------------------------------------------

TFIDF = TfidfConfig()
# Accented raw text, so that accents are removed; single words only.
TFIDF_RAW = TfidfConfig(ngram_max=1)


def term_stats(spark, sf_dir):
    return features.term_stats(prepare_rows(_labelled(spark, sf_dir), CFG), TFIDF)


def term_stats_accents(spark, sf_dir):
    return features.term_stats(_labelled(spark, sf_dir), TFIDF_RAW, "text")


def tfidf_vocab(spark, sf_dir):
    rows = _cleaned(_labelled(spark, sf_dir))
    return _rounded(features.tfidf_vocab(rows, TFIDF), "idf")


def _fitted(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = _cleaned(_labelled(spark, sf_dir))
    return rows, stage(features.tfidf_vocab(rows, TFIDF), "vocabulary")


def tfidf_weights(spark, sf_dir):
    rows, vocab = _fitted(spark, sf_dir)
    return _rounded(features.tfidf_weights(rows, vocab, TFIDF).select("row_id", "id", "value"), "value")


def tfidf_vectors(spark, sf_dir):
    """The same weights, taken from the vectors the classifier gets."""
    rows, vocab = _fitted(spark, sf_dir)
    vectors = features.tfidf_vectors(rows.select("row_id", "clean_text"), vocab, TFIDF)
    raw = vectors.select("row_id", F.unwrap_udt("features").alias("v"))
    pairs = raw.select("row_id", F.inline(F.arrays_zip(F.col("v.indices").alias("id"), F.col("v.values").alias("value"))))
    return _rounded(pairs, "value")


def word_vocab(spark, sf_dir):
    return sequences.sequence_vocab(_cleaned(_labelled(spark, sf_dir)), SequenceConfig())


def _joined(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), " ")


def _encoded(spark, sf_dir, strategy: str) -> DataFrame:
    rows = _cleaned(_labelled(spark, sf_dir))
    # A vocabulary small enough that many words are outside it.
    cfg = SequenceConfig(2000, 500, strategy)
    vocab = stage(sequences.sequence_vocab(rows, cfg), "words")
    encoded = sequences.encode(rows.select("row_id", "clean_text"), vocab, cfg)
    return encoded.select("row_id", _joined(F.col("ids")).alias("ids"), _joined(F.col("mask")).alias("mask"))


def encode_sequences_head_tail(spark, sf_dir):
    return _encoded(spark, sf_dir, "head_tail")


def encode_sequences_post(spark, sf_dir):
    return _encoded(spark, sf_dir, "post")


# --- models ---------------------------------------------------------------


def logreg_scores(spark, sf_dir):
    """Fit on the training split, score every row."""
    done = _split_corpus(spark, sf_dir)
    train = done.filter(F.col("split") == "train")
    vocab = stage(features.tfidf_vocab(train, TFIDF), "vocabulary")
    fitted = model.fit_logreg(train, vocab, TFIDF)
    scored = model.predict_prob(done.select("row_id", "split", "label", "clean_text"), fitted, vocab, TFIDF)
    return _rounded(scored.drop("clean_text"), "prob")


# No entry of the objective's gradient may be larger, per unit of row weight.
GRADIENT_BOUND = 1e-4


def _largest_gradient(rows: DataFrame, fitted, vocab: DataFrame) -> DataFrame:
    """The largest entry of the gradient of the objective over the training rows."""
    n = rows.count()
    balanced = rows.join(F.broadcast(metrics.class_weights(rows).select("label", "weight")), "label")
    # Staged, so that no task holds the Python steps of scores and vectors at once.
    scored = stage(model.predict_prob(balanced, fitted, vocab, TFIDF), "scored")
    vectors = features.tfidf_vectors(scored, vocab, TFIDF, bias=True).select(
        (F.col("weight") * (F.col("prob") - F.col("label"))).alias("miss"), F.unwrap_udt("features").alias("v")
    )
    cells = vectors.select("miss", F.inline(F.arrays_zip(F.col("v.indices").alias("id"), F.col("v.values").alias("x"))))
    sums = cells.groupBy("id").agg(F.sum(F.col("miss") * F.col("x")).alias("g"))
    coefficients = rows.sparkSession.createDataFrame(
        [(i, float(b)) for i, b in enumerate(fitted.coefficients)], "id int, beta double"
    )
    slope = F.abs(F.coalesce(F.col("g"), F.lit(0.0)) + F.col("beta") / TFIDF.c) / n
    return coefficients.join(sums, "id", "left").agg(F.max(slope).alias("largest"))


def train_job(spark, sf_dir):
    """Train, save and reload: rows per split, and whether the fit is at the minimum."""
    folder = _prepared_folder(spark, sf_dir)
    summary = jobs.train_tfidf_logreg(spark, folder, f"{folder}/model", TFIDF, drop_train_overlap=True)
    fitted, vocab = load_classifier(spark, f"{folder}/model")
    rows = read_split(spark, folder, "train").select("row_id", "label", "clean_text")
    largest = _largest_gradient(rows, fitted, vocab).first()["largest"]
    seen = [
        F.struct(F.lit(s).alias("split"), F.aggregate(F.flatten(F.col(f"{s}_metrics.confusion_matrix")), F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n"))
        for s in ("val", "test")
    ]
    train = F.struct(F.lit("train").alias("split"), F.col("train_shape.rows").cast("bigint").alias("n"))
    lines = summary.select(F.explode(F.array(train, *seen)).alias("r")).select("r.*")
    return lines.withColumn("at_minimum", F.lit(largest <= GRADIENT_BOUND))


def score_job(spark, sf_dir):
    """A saved classifier scores the test split: the figures of the training run."""
    folder = _prepared_folder(spark, sf_dir)
    summary = jobs.train_tfidf_logreg(spark, folder, f"{folder}/model", TFIDF)
    jobs.score_and_evaluate(spark, folder, f"{folder}/model", f"{folder}/result.json")
    result = read_results(spark, [f"{folder}/result.json"])
    same = F.round(F.col("metrics.f1"), 6) == F.lit(round(summary.first()["test_metrics"]["f1"], 6))
    return result.select("model_kind", "split", "num_samples", "threshold_used", same.alias("as_in_training"))


ENCODING = SequenceConfig(2000, 500)


def _encoded_folder(spark, sf_dir) -> str:
    folder = _prepared_folder(spark, sf_dir)
    jobs.encode_sequences(spark, folder, f"{folder}/words", ENCODING)
    return f"{folder}/words"


def encode_job(spark, sf_dir):
    """All splits encoded with the vocabulary of the training split."""
    rows = spark.read.parquet(f"{_encoded_folder(spark, sf_dir)}/encoded.parquet")
    return rows.select("row_id", "label", "split", _joined(F.col("ids")).alias("ids"))


def _evaluated(spark, sf_dir) -> str:
    """A fixed scorer in place of a network, evaluated on the encoded splits."""

    def predict(scale, rows):
        return [[0.0, sum(ids) % 1000 / scale - 2.0] for ids in rows["ids"]]

    folder = _encoded_folder(spark, sf_dir)
    jobs.evaluate_sequence_model(spark, folder, lambda: 250.0, predict, model_name="fixed")
    return f"{folder}/metrics.json"


def evaluate_job(spark, sf_dir):
    """The threshold found on the validation split, as the summary records it."""
    row = read_json(spark, _evaluated(spark, sf_dir)).select(
        F.col("hyperparameters.threshold_used").alias("threshold"),
        F.col("val_threshold_search.best_f1_at_threshold").alias("best_val_f1"),
    )
    return _rounded(row, "threshold", "best_val_f1")


def training_table(spark, sf_dir):
    """Validation and test metrics of a run summary, one row per split."""
    table = compare.training_table(read_summaries(spark, [_evaluated(spark, sf_dir)]))
    return _rounded(table.drop("source_file"), *compare.METRICS)


def score_sequences_job(spark, sf_dir):
    """The test split scored with the threshold and settings that the summary holds."""

    def predict(scale, rows):
        return [[0.0, sum(ids) % 1000 / scale - 2.0] for ids in rows["ids"]]

    words = _evaluated(spark, sf_dir).rsplit("/", 1)[0]
    folder = words.rsplit("/", 1)[0]
    target = f"{folder}/sequences.json"
    jobs.score_sequences_and_evaluate(spark, folder, words, target, lambda: 250.0, predict)
    return _figures(read_results(spark, [target]))


def _figures(results: DataFrame) -> DataFrame:
    named = results.select("model_kind", "split", "num_samples", "threshold_used", "metrics.accuracy", "metrics.f1")
    return _rounded(named, "threshold_used", "accuracy", "f1")


def _given_model(spark, vocab: DataFrame):
    """A classifier whose coefficients follow a rule, in place of fitted ones."""
    size = vocab.count()
    return model.linear_model(spark, [(i * 7919 % 1000) / 500.0 - 1.0 for i in range(size)] + [0.25])


def given_coefficients(spark, sf_dir):
    """Probabilities of a linear classifier with known coefficients."""
    rows, vocab = _fitted(spark, sf_dir)
    scored = model.predict_prob(rows.select("row_id", "clean_text"), _given_model(spark, vocab), vocab, TFIDF)
    return _rounded(scored.select("row_id", "prob"), "prob")


def saved_threshold(spark, sf_dir):
    """A saved classifier scores the test split at the threshold saved with it."""
    folder = _prepared_folder(spark, sf_dir)
    vocab = stage(features.tfidf_vocab(read_split(spark, folder, "train"), TFIDF), "vocabulary")
    save_classifier(_given_model(spark, vocab), vocab, f"{folder}/model")
    saved = F.struct(F.lit(0.55).alias("threshold"), F.lit(1).alias("ngram_min"), F.lit(3).alias("ngram_max"))
    write_json(spark.range(1).select(saved.alias("hyperparameters")), f"{folder}/model/{METRICS_NAME}")
    jobs.score_and_evaluate(spark, folder, f"{folder}/model", f"{folder}/result.json")
    return _figures(read_results(spark, [f"{folder}/result.json"]))


def custom_metric(spark, sf_dir):
    """Log loss and Brier score as metrics of the caller."""
    found = custom_metrics(_scores_large(spark, sf_dir), {"log_loss": LogLoss(), "brier": Brier()})
    return _rounded(found, "log_loss", "brier")


def score_batches(spark, sf_dir):
    """Any model of the caller, here one scoring a text by its length."""

    def load() -> dict:
        return {"step": 7919, "cycle": 1000, "scale": 250.0, "shift": 2.0}

    def predict(weights, rows):
        sizes = rows["text"].str.len() * weights["step"] % weights["cycle"]
        return [[0.0, z] for z in sizes / weights["scale"] - weights["shift"]]

    docs = _documents(spark, sf_dir).select("row_id", "text")
    scored = model.score_batches(docs, load, predict, ["row_id"])
    return scored.select("row_id", F.round(softmax_prob(F.col("logits")), 6).alias("prob"))


REGISTRY: dict[str, Query] = {
    "clean_documents": clean_documents,
    "clean_pages_text": clean_pages_text,
    "clean_strict": clean_strict,
    "label_coercion": label_coercion,
    "label_share_clean": label_share_clean,
    "dedup_keep_first": dedup_keep_first,
    "dedup_stats": dedup_stats,
    "drop_conflicts": drop_conflicts,
    "conflict_rows": conflict_rows,
    "row_funnel": funnel,
    "stratified_split": stratified_split,
    "split_sizes": split_sizes,
    "prep_report": prep_report,
    "label_distribution": label_distribution,
    "length_stats": length_stats,
    "length_histogram": length_histogram,
    "write_read_splits": write_read_splits,
    "read_corpus_csv": read_corpus_csv,
    "prepare_job": prepare_job,
    "na_tokens": na_tokens,
    "nfkc_strings": nfkc_strings,
    "nfkc_texts": nfkc_texts,
    "report_document": report_document,
    "split_overlap": split_overlap,
    "split_stats": split_stats,
    "overlap_label_conflicts": overlap_label_conflicts,
    "drop_train_overlap": drop_train_overlap,
    "dropped_eval_rows": dropped_eval_rows,
    "leakage_audit": leakage_audit,
    "class_weights": class_weights,
    "binary_metrics": binary_metrics,
    "confusion_matrix": confusion_matrix,
    "classification_report": classification_report,
    "roc_auc": roc_auc,
    "best_f1_threshold": best_f1_threshold,
    "val_threshold_on_test": val_threshold_on_test,
    "softmax_prob": softmax,
    "checkpoint_metrics": checkpoint_metrics,
    "rank_models": rank_models,
    "result_documents": result_documents,
    "compare_job": compare_job,
    "best_model": best_model,
    "metrics_long": metrics_long,
    "term_stats": term_stats,
    "term_stats_accents": term_stats_accents,
    "tfidf_vocab": tfidf_vocab,
    "tfidf_weights": tfidf_weights,
    "tfidf_vectors": tfidf_vectors,
    "word_vocab": word_vocab,
    "encode_sequences_head_tail": encode_sequences_head_tail,
    "encode_sequences_post": encode_sequences_post,
    "logreg_scores": logreg_scores,
    "train_job": train_job,
    "score_job": score_job,
    "encode_job": encode_job,
    "evaluate_job": evaluate_job,
    "training_table": training_table,
    "score_sequences_job": score_sequences_job,
    "given_coefficients": given_coefficients,
    "saved_threshold": saved_threshold,
    "custom_metric": custom_metric,
    "score_batches": score_batches,
}
