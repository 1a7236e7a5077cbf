"""Deduplication, split and audit against brute force."""

import itertools
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from textprep.config import PrepConfig
from textprep.operators import audit, dedup, report, split
from textprep.operators.prepare import row_funnel
from textprep.operators.skew import lookup

SCHEMA = "row_id long, label int, clean_text string"
from textprep.session import stage


def corpus():
    """A third of the rows is one text; some copies contradict each other."""
    rows = []
    for i in range(300):
        if i % 3 == 0:
            rows.append((i, 1, "the same hot text"))
        elif i % 10 == 1:
            rows.append((i, i % 4 % 2, "contradicting copy"))
        else:
            rows.append((i, i % 2, f"text {i % 70}"))
    return rows


@pytest.mark.parametrize("conflicts,copies", list(itertools.product([True, False], repeat=2)))
def test_deduplicate(spark, conflicts, copies):
    cfg = PrepConfig(drop_conflicting_duplicates=conflicts, deduplicate_by_clean_text=copies)
    rows = corpus()
    labels = defaultdict(set)
    for _, label, text in rows:
        labels[text].add(label)
    want = [r for r in rows if not (conflicts and len(labels[r[2]]) > 1)]
    dropped = len(rows) - len(want)
    if copies:
        first = {}
        for r in want:
            first.setdefault(r[2], r)
        want = list(first.values())
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    groups = dedup.text_groups(df)
    got = dedup.deduplicate(df, groups, cfg).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
    stats = dedup.dedup_stats(groups, cfg).first().asDict()
    assert stats == {
        "rows_before": 300,
        "conflicting_text_rows_dropped": dropped,
        "exact_text_duplicates_dropped": 300 - dropped - len(want),
        "rows_after": len(want),
    }


def test_dedup_stats_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert list(dedup.dedup_stats(dedup.text_groups(empty)).first()) == [0, 0, 0, 0]


@pytest.mark.parametrize("hot_rows", [1, 50, 10**9])
def test_lookup_finds_the_same_with_hot_keys(spark, hot_rows):
    rows = corpus()
    counts = Counter(text for _, _, text in rows)
    values = {t: i for i, t in enumerate(sorted(counts)) if i % 5}
    left = spark.createDataFrame(rows, SCHEMA)
    right = spark.createDataFrame([(t, v, counts[t]) for t, v in values.items()], "clean_text string, v int, w long")
    got = lookup(left, right, "clean_text", ["v"], "row_id", "w", min_hot_rows=hot_rows).collect()
    assert {r["row_id"]: r["v"] for r in got} == {i: values.get(t) for i, _, t in rows}
    assert len(got) == len(rows)


@pytest.mark.parametrize("found", [True, False])
def test_lookup_scatters_a_hot_key(spark, found):
    """No task of the join gets much over its share, also if the hot key finds nothing."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") < 4000, 0).otherwise(F.col("id"))
        left = stage(spark.range(5000).select(F.col("id").alias("row_id"), key.alias("k")), "left")
        value = F.when((F.col("k") != 0) | F.lit(found), F.col("k"))
        right = stage(left.groupBy("k").agg(F.count("*").alias("w")).withColumn("v", value), "right")
        got = lookup(left, right, "k", ["v"], "row_id", "w", min_hot_rows=100)
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 5000 and max(sizes) <= 2 * 5000 / 8
        assert got.filter("v is null").count() == (0 if found else 4000)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_row_funnel(spark):
    raw = spark.createDataFrame([(1, "1"), (2, "5"), (3, "x"), (4, None)], "row_id long, label string")
    part = raw.limit(1)
    got = row_funnel(raw, part, part).first().asDict()
    assert got == {
        "rows_before": 4, "rows_with_label": 2, "rows_with_binary_label": 1,
        "rows_long_enough": 1, "rows_after": 1, "rows_dropped": 3,
    }


def test_largest_remainder():
    assert split.largest_remainder([572, 370], 754) == [458, 296]
    assert split.largest_remainder([1, 1, 1], 2) == [1, 1, 0]
    assert split.largest_remainder([10, 0], 3) == [3, 0]


def test_quotas_have_the_published_size():
    for n in (4706, 4710):
        test = sum(t for t, _ in split.split_quotas([n * 6 // 10, n - n * 6 // 10], PrepConfig()))
        assert test == 942
    with pytest.raises(ValueError):
        split.split_quotas([100, 1], PrepConfig())


def labelled(spark, n=1000):
    return spark.range(n).select(F.col("id").alias("row_id"), (F.col("id") % 7 < 3).cast("int").alias("label"))


@pytest.mark.parametrize("rank_rows", [1_000_000, 2])
def test_split_equals_full_sort(spark, monkeypatch, rank_rows):
    monkeypatch.setattr(split, "RANK_ROWS", rank_rows)
    monkeypatch.setattr(split, "DIGITS", 1 if rank_rows == 2 else 3)
    import hashlib

    cfg = PrepConfig()
    df = labelled(spark)
    rows = [tuple(r) for r in df.collect()]
    want = {}
    counts = [sum(1 for r in rows if r[1] == label) for label in (0, 1)]
    for label, (n_test, n_val) in zip((0, 1), split.split_quotas(counts, cfg)):
        order = sorted(i for i, l in rows if l == label)
        order.sort(key=lambda i: hashlib.md5(f"{cfg.random_state}:{i}".encode()).hexdigest())
        for place, i in enumerate(order):
            want[i] = "test" if place < n_test else "val" if place < n_test + n_val else "train"
    got = {r["row_id"]: r["split"] for r in split.stratified_split(df, cfg).collect()}
    assert got == want
    sizes = Counter(got.values())
    assert sizes["test"] == math.ceil(0.2 * 1000) and sizes["val"] == math.ceil(0.1 * 800)
    shuffled = {r["row_id"]: r["split"] for r in split.stratified_split(df.repartition(7), cfg).collect()}
    assert shuffled == want


def test_split_of_nothing_and_of_one_label(spark):
    for n in (0, 1):
        with pytest.raises(ValueError):
            split.stratified_split(labelled(spark, n))


def test_split_depends_on_the_seed(spark):
    df = labelled(spark, 200)
    a, b = (
        {r["row_id"] for r in split.stratified_split(df, PrepConfig(random_state=s)).filter("split = 'test'").collect()}
        for s in (42, 43)
    )
    assert a != b and len(a) == len(b) == 40


AUDIT_ROWS = [
    (1, "a", "1", "train"), (2, "a", "0", "train"), (3, "a", "1", "val"), (4, "b", "1", "train"),
    (5, "b", "1", "test"), (6, "b", "x", "test"), (7, None, "1", "train"), (8, None, "0", "test"),
    (9, "c", "0", "val"), (10, "c", "oops", "test"), (11, "d", "0", "train"), (12, "d", "0", "val"),
    (13, "d", "0", "test"), (14, "e", "1", "train"), (15, "f", None, "val"), (16, "f", "bad", "test"),
]


def audit_frame(spark):
    return spark.createDataFrame(AUDIT_ROWS, "row_id long, clean_text string, label string, split string")


def test_audit_against_sets(spark):
    df = audit_frame(spark)
    texts = audit.texts_by_split(df)
    sets = defaultdict(set)
    maps = defaultdict(lambda: defaultdict(set))
    for _, text, label, part in AUDIT_ROWS:
        sets[part].add(text or "")
        if text is not None:
            maps[part][text] |= {int(label)} if label in ("0", "1") else set()
    stats = {r["split"]: tuple(r)[1:] for r in audit.split_stats(texts).collect()}
    for part in ("train", "val", "test"):
        n = sum(1 for r in AUDIT_ROWS if r[3] == part)
        assert stats[part] == (n, len(sets[part]), n - len(sets[part]))
    overlap = audit.split_overlap(texts).first().asDict()
    conflicts = audit.overlap_label_conflicts(df).first().asDict()
    for a, b in audit.PAIRS:
        assert overlap[f"{a}_{b}"] == len(sets[a] & sets[b])
        shared = set(maps[a]) & set(maps[b])
        assert conflicts[f"{a}_{b}"] == sum(maps[a][k] != maps[b][k] for k in shared)
    assert overlap["triple_overlap"] == len(sets["train"] & sets["val"] & sets["test"])


@pytest.mark.parametrize("hot_rows", [1, 10**9])
def test_drop_train_overlap(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(audit, "lookup", lambda *a, **k: lookup(*a, **k, min_hot_rows=hot_rows))
    df = audit_frame(spark)
    texts = audit.texts_by_split(df)
    kept = audit.drop_train_overlap(df, texts)
    train = {t or "" for _, t, _, s in AUDIT_ROWS if s == "train"}
    want = {i for i, t, _, s in AUDIT_ROWS if s == "train" or (t or "") not in train}
    assert {r["row_id"] for r in kept.collect()} == want
    dropped = audit.dropped_eval_rows(texts).first()
    assert sum(dropped) == len(AUDIT_ROWS) - len(want)
    after = audit.split_overlap(audit.texts_by_split(kept)).first()
    assert after["train_val"] == after["train_test"] == 0
    redone = audit.leakage_audit(audit.texts_by_split(kept), audit.label_flags(kept)).first()
    after = audit.leakage_audit(audit.after_drop(texts), audit.flags_after_drop(audit.label_flags(df)))
    assert after.first() == redone


def test_report(spark):
    df = spark.createDataFrame(
        [(1, 0, "aaaa", "train"), (2, 1, "bb", "train"), (3, 1, "cccccc", "val"), (4, 0, "dd", "test")],
        "row_id long, label int, clean_text string, split string",
    )
    overlap = audit.split_overlap(audit.texts_by_split(df))
    row = report.build_report(report.split_label_table(df), overlap, PrepConfig()).first().asDict(True)
    assert row["config"]["random_state"] == 42 and row["config"]["test_size"] == 0.2
    assert row["num_samples"] == {"full": 4, "train": 2, "val": 1, "test": 1}
    assert row["label_distribution"]["full"] == {"0": 0.5, "1": 0.5}
    assert row["label_distribution"]["val"] == {"1": 1.0}
    assert row["text_length_stats"] == {"full_mean": 3.5, "train_mean": 3.0, "val_mean": 6.0, "test_mean": 2.0}
    assert set(row["split_overlap"].values()) == {0}


def test_row_ids_must_be_given_and_unique(spark):
    from textprep.operators.prepare import require_row_ids

    require_row_ids(spark.range(5).withColumnRenamed("id", "row_id"))
    for ids in ([1, None], [1, 2, 2]):
        with pytest.raises(ValueError, match="row_id"):
            require_row_ids(spark.createDataFrame([(i,) for i in ids], "row_id long"))


@pytest.mark.parametrize("limit", [1000, 7])
def test_numbered(spark, limit):
    from textprep.operators.rows import numbered

    rows = spark.range(100).select((F.col("id") * 37 % 100).alias("v"), (F.col("id") % 3).alias("w")).repartition(5)
    got = numbered(rows, "place", F.col("v").desc(), in_one_task=limit).collect()
    assert {(r["v"], r["place"]) for r in got} == {(v, 100 - v) for v in range(100)}


def test_same_corpus_in_other_files_gets_the_same_split(spark, tmp_path):
    from textprep.plans import jobs
    from textprep.sources import corpus

    rows = [(f"some text number {i % 150} here", str(i % 150 % 2)) for i in range(200)]
    found = []
    for parts in (1, 7):
        source = str(tmp_path / f"c{parts}.parquet")
        spark.createDataFrame(rows if parts == 1 else rows[::-1], "text string, label string").repartition(parts).write.parquet(source)
        jobs.prepare(spark, source, str(tmp_path / f"out{parts}"))
        done = corpus.read_splits(spark, str(tmp_path / f"out{parts}")).select("row_id", "clean_text", "label", "split")
        found.append(sorted(map(tuple, done.collect())))
    assert found[0] == found[1] and len(found[0]) == 150
