"""Binary classification metrics over ``label`` and ``prob`` (or ``pred``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textprep.config import DEFAULT_THRESHOLD, SWEEP_COUNT
from textprep.functions.labels import checked_label, checked_score
from textprep.functions.scores import (
    apply_threshold,
    softmax_prob,
    sweep_threshold,
    thresholds_passed,
)
from textprep.operators.custom import Metric, custom_metrics
from textprep.operators.rows import side_by_side
from textprep.session import stage

# Distinct scores that a single window task may rank.
WINDOW_ROWS = 1_000_000


def with_prediction(df: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    return df.withColumn("pred", apply_threshold(F.col("prob"), threshold))


def _ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as a double, 0 where nothing is divided by."""
    return F.when(bottom > 0, top.cast("double") / bottom.cast("double")).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, *by: str) -> DataFrame:
    """tn, fp, fn and tp from ``label`` and ``pred``, per group of ``by``.

    Every row is in one of the cells: a label or a prediction that is not 0 or 1
    fails the job.
    """
    rows = df.select(*by, checked_label().alias("label"), checked_label("pred").alias("pred"))

    def cell(label: int, pred: int) -> Column:
        return F.count_if((F.col("label") == label) & (F.col("pred") == pred))

    return rows.groupBy(*by).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """Add ``confusion_matrix``: [[tn, fp], [fn, tp]]."""
    return counts.withColumn("confusion_matrix", _matrix())


def _matrix() -> Column:
    return F.array(F.array("tn", "fp"), F.array("fn", "tp"))


def _class_scores(hit: Column, wrong: Column, missed: Column) -> dict[str, Column]:
    return {
        "precision": _ratio(hit, hit + wrong),
        "recall": _ratio(hit, hit + missed),
        "f1": _ratio(2 * hit, 2 * hit + wrong + missed),
    }


def _scores(label: int) -> dict[str, Column]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return _class_scores(tp, fp, fn) if label == 1 else _class_scores(tn, fn, fp)


def _accuracy() -> Column:
    return _ratio(F.col("tn") + F.col("tp"), F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp"))


def binary_metrics(counts: DataFrame) -> DataFrame:
    """accuracy, precision, recall and f1 of class 1; other columns are kept."""
    keys = [c for c in counts.columns if c not in ("tn", "fp", "fn", "tp")]
    one = _scores(1)
    return counts.select(*keys, _accuracy().alias("accuracy"), *[one[m].alias(m) for m in one])


def _report_parts() -> dict[str, Column]:
    """Structs of precision, recall, f1-score and support by report line."""
    support = {0: F.col("tn") + F.col("fp"), 1: F.col("fn") + F.col("tp")}
    total = support[0] + support[1]
    scores = {c: _scores(c) for c in (0, 1)}

    def line(value, count: Column) -> Column:
        names = (("precision", "precision"), ("recall", "recall"), ("f1", "f1-score"))
        return F.struct(
            *[value(m).alias(name) for m, name in names], count.cast("double").alias("support")
        )

    def weighted(m: str) -> Column:
        return _ratio(scores[0][m] * support[0] + scores[1][m] * support[1], total)

    return {
        "0": line(lambda m: scores[0][m], support[0]),
        "1": line(lambda m: scores[1][m], support[1]),
        "macro avg": line(lambda m: (scores[0][m] + scores[1][m]) / 2, total),
        "weighted avg": line(weighted, total),
    }


def classification_report(counts: DataFrame) -> DataFrame:
    """One row per class and average: precision, recall, f1-score, support."""
    keys = [c for c in counts.columns if c not in ("tn", "fp", "fn", "tp")]
    lines = F.array(
        *[F.struct(F.lit(k).alias("line"), v.alias("v")) for k, v in _report_parts().items()]
    )
    return counts.select(*keys, F.explode(lines).alias("r")).select(*keys, "r.line", "r.v.*")


def _report_struct() -> Column:
    parts = _report_parts()
    return F.struct(
        parts["0"].alias("0"),
        parts["1"].alias("1"),
        _accuracy().alias("accuracy"),
        parts["macro avg"].alias("macro avg"),
        parts["weighted avg"].alias("weighted avg"),
    )


def _all_counted(rows: str) -> Column:
    """A count of labels, if with the other label it covers all ``n`` rows."""
    wrong = F.concat(F.lit("rows whose label is not 0 or 1: "), (F.col("n") - F.col("pos") - F.col("neg")).cast("string"))
    return F.when(F.col("pos") + F.col("neg") == F.col("n"), F.col(rows)).otherwise(F.raise_error(wrong).cast("bigint"))


def score_table(df: DataFrame, *by: str) -> DataFrame:
    """Rows of each label per distinct score: all that metrics need of a table.

    Staged, so that the predictions are read once however many metrics follow.
    A row with a bad label or score fails the job.
    """
    counts = df.groupBy(*by, "prob").agg(
        F.count_if(F.col("label") == 1).alias("pos"),
        F.count_if(F.col("label") == 0).alias("neg"),
        F.count(F.lit(1)).alias("n"),
    )
    # Checked on the few distinct scores, so that a model's output is computed once per row.
    checked = counts.select(*by, checked_score().alias("prob"), *[_all_counted(c).alias(c) for c in ("pos", "neg")])
    return stage(checked, "scores")


def _cells(threshold: float) -> list[Column]:
    """Aggregates tn, fp, fn and tp over a score table."""
    hit = apply_threshold(F.col("prob"), threshold) == 1

    def cell(side: Column, rows: str) -> Column:
        return F.coalesce(F.sum(F.when(side, F.col(rows))), F.lit(0))

    return [
        cell(~hit, "neg").alias("tn"),
        cell(hit, "neg").alias("fp"),
        cell(~hit, "pos").alias("fn"),
        cell(hit, "pos").alias("tp"),
    ]


def _negatives_below(scores: DataFrame, by: tuple[str, ...], window_rows: int) -> DataFrame:
    """Add ``below``: the negatives with a smaller score.

    Few scores are summed up by one window; more are cut into score ranges,
    each summed on its own on top of the total of the ranges below it.
    """
    keys = list(by) or [F.lit(0)]
    before = (Window.unboundedPreceding, -1)
    n = scores.count()
    if n <= window_rows:
        order = Window.partitionBy(*keys).orderBy("prob").rowsBetween(*before)
        return scores.withColumn("below", F.coalesce(F.sum("neg").over(order), F.lit(0)))
    # Range boundaries are sampled anew by every job: pin them by staging.
    ranges = stage(
        scores.repartitionByRange(-(-n // window_rows) * 2, *by, "prob").withColumn(
            "_range", F.spark_partition_id()
        ),
        "score-ranges",
    )
    totals = ranges.groupBy(*by, "_range").agg(F.sum("neg").alias("_neg"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(*before)
    offsets = totals.select(
        *[F.col(c).alias(f"_of_{c}") for c in (*by, "_range")],
        F.coalesce(F.sum("_neg").over(earlier), F.lit(0)).alias("_offset"),
    )
    order = Window.partitionBy(*by, "_range").orderBy("prob").rowsBetween(*before)
    inside = ranges.withColumn("_inside", F.coalesce(F.sum("neg").over(order), F.lit(0)))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in (*by, "_range")]
    return inside.join(offsets, same).select(
        *scores.columns, (F.col("_inside") + F.col("_offset")).alias("below")
    )


def _auc() -> Column:
    """The aggregate over a score table with ``below``; null for one class."""
    # Twice the positive/negative pairs in the right order, ties counting one;
    # decimals, since the product outgrows a BIGINT.
    won = F.col("pos").cast("decimal(19,0)") * (2 * F.col("below") + F.col("neg")).cast("decimal(19,0)")
    pairs = 2 * F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return F.when(pairs > 0, F.sum(won).cast("double") / pairs)


def roc_auc(df: DataFrame, *by: str, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Exact area under the ROC curve, ties counting one half; null for one class."""
    ranked = _negatives_below(score_table(df, *by), by, window_rows)
    return ranked.groupBy(*by).agg(_auc().alias("roc_auc"))


def best_f1_threshold(df: DataFrame) -> DataFrame:
    """The threshold of the sweep with the best f1; the lowest wins a tie.

    A histogram over the number of thresholds each score passes (at most 82
    rows) replaces one pass per threshold.
    """
    spark = df.sparkSession
    checked = df.select(checked_label().alias("label"), checked_score().alias("prob"))
    hist = checked.groupBy(thresholds_passed(F.col("prob")).alias("passed")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    empty = spark.range(0, SWEEP_COUNT + 1, 1, 1).select(
        F.col("id").cast("int").alias("passed"),
        F.lit(0).cast("bigint").alias("pos"),
        F.lit(0).cast("bigint").alias("neg"),
    )
    full = hist.unionByName(empty).groupBy("passed").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    every = Window.partitionBy(F.lit(0))
    at_least = every.orderBy(F.col("passed").desc()).rowsBetween(Window.unboundedPreceding, 0)
    swept = full.select(
        (F.col("passed") - 1).alias("i"),
        F.sum("pos").over(at_least).alias("tp"),
        F.sum("neg").over(at_least).alias("fp"),
        F.sum("pos").over(every).alias("p"),
    ).filter(F.col("i") >= 0)
    f1 = _class_scores(F.col("tp"), F.col("fp"), F.col("p") - F.col("tp"))["f1"]
    best = swept.withColumn("best_f1", f1).orderBy(F.col("best_f1").desc(), "i").limit(1)
    return best.select(sweep_threshold(F.col("i")).alias("threshold"), "best_f1")


def evaluate(
    df: DataFrame, threshold: float = DEFAULT_THRESHOLD, *by: str, metrics: dict[str, Metric] | None = None
) -> DataFrame:
    """All metrics of a prediction table as one struct ``metrics`` per group.

    Also gives ``num_samples``. The predictions are read once, and once more for
    ``metrics`` of the caller, which come as one struct ``custom``.
    """
    if metrics:
        own = custom_metrics(df, metrics, *by).select(
            *[F.col(c).alias(f"_{c}") for c in by], F.struct(*[F.col(f"`{m}`") for m in metrics]).alias("custom")
        )
        same = [F.col(c).cast("string").eqNullSafe(F.col(f"_{c}")) for c in by]  # one row per group
        both = evaluate(df, threshold, *by)
        joined = both.join(F.broadcast(own), reduce(lambda a, b: a & b, same)) if by else side_by_side(both, own)
        return joined.drop(*[f"_{c}" for c in by])
    ranked = _negatives_below(score_table(df, *by), by, WINDOW_ROWS)
    counts = ranked.groupBy(*by).agg(*_cells(threshold), _auc().alias("roc_auc"))
    one = _scores(1)
    return counts.select(
        *by,
        (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("num_samples"),
        F.struct(
            _accuracy().alias("accuracy"),
            *[one[m].alias(m) for m in one],
            F.col("roc_auc"),
            _matrix().alias("confusion_matrix"),
            _report_struct().alias("classification_report"),
        ).alias("metrics"),
    )


def evaluate_splits(df: DataFrame, threshold: float | None = None) -> DataFrame:
    """Validation and test metrics of scored splits in one row.

    Without a threshold the one with the best validation f1 is searched and
    then applied to both splits.
    """
    searched = threshold is None
    best_f1 = None
    if searched:
        threshold, best_f1 = best_f1_threshold(df.filter(F.col("split") == "val")).first()
    by_split = evaluate(df.filter(F.col("split") != "train"), threshold, "split")
    measured = [
        F.first(F.when(F.col("split") == s, F.col("metrics")), ignorenulls=True).alias(f"{s}_metrics")
        for s in ("val", "test")
    ]
    search = F.struct(
        F.lit(searched).alias("enabled"), F.lit(best_f1).cast("double").alias("best_f1_at_threshold")
    )
    return by_split.agg(*measured).select(
        F.lit(threshold).alias("threshold_used"), search.alias("val_threshold_search"), "val_metrics", "test_metrics"
    )


def checkpoint_metrics(df: DataFrame) -> DataFrame:
    """accuracy, precision, recall, f1 and AUC at 0.5 of ``logits``, one row."""
    scored = df.withColumn("prob", softmax_prob(F.col("logits")))
    metrics = evaluate(scored, DEFAULT_THRESHOLD).select("metrics.*")
    return metrics.select("accuracy", "precision", "recall", "f1", "roc_auc")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(0))  # over one row per class
    return counts.select(
        label,
        "n",
        (F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))).alias("weight"),
    )
