"""Metrics against published results and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from textprep.config import SWEEP_COUNT
from textprep.functions.scores import STEP, softmax_prob, thresholds_passed
from textprep.operators import metrics

# Tn, fp, fn, tp and the metrics published with them.
GOLDEN = {
    "tfidf": ((491, 81, 121, 249), (0.7855626326963907, 0.7545454545454545, 0.672972972972973, 0.7114285714285714)),
    "bigru": ((353, 219, 84, 286), (0.678343949044586, 0.5663366336633663, 0.772972972972973, 0.6537142857142857)),
    "lstm": ((51, 521, 20, 350), (0.4256900212314225, 0.4018369690011481, 0.9459459459459459, 0.5640612409347301)),
    "rnn": ((303, 269, 201, 169), (0.5010615711252654, 0.3858447488584475, 0.45675675675675675, 0.4183168316831683)),
}
BIGRU_REPORT = {
    "0": (0.8077803203661327, 0.6171328671328671, 0.6997026759167493, 572.0),
    "1": (0.5663366336633663, 0.772972972972973, 0.6537142857142857, 370.0),
    "macro avg": (0.6870584770147494, 0.6950529200529201, 0.6767084808155175, 942.0),
    "weighted avg": (0.7129457512790589, 0.678343949044586, 0.6816392954762912, 942.0),
}


def predictions(spark, cells):
    pairs = [(0, 0), (0, 1), (1, 0), (1, 1)]
    rows = [p for p, n in zip(pairs, cells) for _ in range(n)]
    return spark.createDataFrame(rows, "label int, pred int")


@pytest.mark.parametrize("name", GOLDEN)
def test_published_metrics(spark, name):
    cells, want = GOLDEN[name]
    counts = metrics.confusion_counts(predictions(spark, cells))
    assert tuple(metrics.binary_metrics(counts).first()) == want
    tn, fp, fn, tp = cells
    assert metrics.confusion_matrix(counts).first()["confusion_matrix"] == [[tn, fp], [fn, tp]]


def test_published_report(spark):
    counts = metrics.confusion_counts(predictions(spark, GOLDEN["bigru"][0]))
    got = {r["line"]: tuple(r)[1:] for r in metrics.classification_report(counts).collect()}
    assert got == BIGRU_REPORT


def test_thresholds_are_the_published_doubles():
    assert 0.1 + 32 * STEP == 0.4199999999999998
    assert 0.1 + 30 * STEP == 0.3999999999999998


def auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    won = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return won / (len(pos) * len(neg)) if pos and neg else None


def best(rows):
    found = (0.5, -1.0)
    for i in range(SWEEP_COUNT):
        thr = 0.1 + i * STEP
        tp = sum(y for y, p in rows if p >= thr)
        fp = sum(1 - y for y, p in rows if p >= thr)
        fn = sum(y for y, p in rows if p < thr)
        f1 = 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0
        if f1 > found[1]:
            found = (thr, f1)
    return found


def scores(seed, n=300):
    rng = random.Random(seed)
    grid = [0.1 + i * STEP for i in range(SWEEP_COUNT)]
    pick = [rng.random, lambda: rng.choice(grid), lambda: round(rng.random(), 2), lambda: rng.choice([0.0, 1.0])]
    return [(rng.randint(0, 1), float(rng.choice(pick)())) for _ in range(n)]


CASES = {
    **{f"random {s}": scores(s) for s in range(3)},
    "one class": [(1, 0.2), (1, 0.7)],
    "no positives found": [(1, 0.01), (0, 0.02)],
    "all equal": [(1, 0.5), (0, 0.5), (1, 0.5)],
    "all low": [(1, 0.05), (0, 0.09), (1, 0.0999)],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("window_rows", [1_000_000, 20])
def test_auc(spark, case, window_rows):
    rows = CASES[case]
    df = spark.createDataFrame(rows, "label int, prob double")
    got = metrics.roc_auc(df, window_rows=window_rows).first()["roc_auc"]
    want = auc(rows)
    assert got == want if want is None else got == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("window_rows", [1_000_000, 20])
def test_auc_per_group_and_mirrored(spark, window_rows):
    rows = [(str(s) if s else None, y, p) for s in range(3) for y, p in scores(s)]
    df = spark.createDataFrame(rows, "g string, label int, prob double")
    got = {r["g"]: r["roc_auc"] for r in metrics.roc_auc(df, "g", window_rows=window_rows).collect()}
    assert got == {str(s) if s else None: pytest.approx(auc(scores(s)), abs=1e-12) for s in range(3)}
    mirror = df.withColumn("prob", -F.col("prob"))
    back = {r["g"]: r["roc_auc"] for r in metrics.roc_auc(mirror, "g").collect()}
    assert all(back[g] == pytest.approx(1 - got[g], abs=1e-12) for g in got)


@pytest.mark.parametrize("case", CASES)
def test_best_threshold(spark, case):
    rows = CASES[case]
    got = metrics.best_f1_threshold(spark.createDataFrame(rows, "label int, prob double")).first()
    assert tuple(got) == best(rows)


def test_thresholds_passed_is_exact(spark):
    grid = [0.1 + i * STEP for i in range(SWEEP_COUNT)]
    near = [x + d for x in grid for d in (-1e-16, 0.0, 1e-16, -1e-9, 1e-9)] + [0.0, 1.0, 0.5]
    df = spark.createDataFrame([(p,) for p in near], "prob double")
    got = [tuple(r) for r in df.select("prob", thresholds_passed(F.col("prob"))).collect()]
    assert got == [(p, sum(t <= p for t in grid)) for p in near]


def test_softmax_is_stable(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([1000.0, 1000.0],), ([-2000.0, 0.0],), ([1.0, 3.0],)], "l array<double>")
    got = [r[0] for r in df.select(softmax_prob(F.col("l"))).collect()]
    assert got == [0.5, 0.5, 1.0, pytest.approx(0.8807970779778823)]


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")
    got = {r["label"]: r["weight"] for r in metrics.class_weights(df).collect()}
    assert got == {0: 8 / 12, 1: 2.0}


def test_evaluate_struct(spark):
    rows = scores(5)
    row = metrics.evaluate(spark.createDataFrame(rows, "label int, prob double"), 0.4).first()
    m = row["metrics"]
    assert row["num_samples"] == 300 and m["roc_auc"] == pytest.approx(auc(rows))
    assert m["classification_report"]["1"]["f1-score"] == m["f1"]
    assert m["classification_report"]["accuracy"] == m["accuracy"]
    assert sum(map(sum, m["confusion_matrix"])) == 300


@pytest.mark.parametrize("given", [None, 0.3])
def test_evaluate_splits(spark, given):
    rows = [(part, y, p) for part, seed in (("train", 0), ("val", 1), ("test", 2)) for y, p in scores(seed)]
    row = metrics.evaluate_splits(spark.createDataFrame(rows, "split string, label int, prob double"), given).first()
    thr, f1 = best(scores(1)) if given is None else (given, None)
    assert row["threshold_used"] == thr
    assert tuple(row["val_threshold_search"]) == (given is None, f1)
    tp = sum(y for y, p in scores(2) if p >= thr)
    assert row["test_metrics"]["confusion_matrix"][1][1] == tp


@pytest.mark.parametrize("bad", [(None, 0.5), (2, 0.5), (1, None), (1, float("nan"))])
def test_bad_rows_are_refused_not_dropped(spark, bad):
    rows = spark.createDataFrame([(0, 0.1), (1, 0.9), bad], "label int, prob double")
    for measure in (metrics.roc_auc, metrics.best_f1_threshold, metrics.evaluate):
        with pytest.raises(Exception, match="not 0 or 1|no number"):
            measure(rows).collect()


@pytest.mark.parametrize("bad", [(None, 1), (2, 1), (1, None)])
def test_bad_predictions_are_refused(spark, bad):
    rows = spark.createDataFrame([(0, 0), (1, 1), bad], "label int, pred int")
    with pytest.raises(Exception, match="not 0 or 1"):
        metrics.confusion_counts(rows).collect()
