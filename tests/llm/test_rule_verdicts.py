"""The verdicts of the quality rules: brute-force EM, and filters on the result."""

import time

import numpy as np
import pytest

from textprep.llm import exact_dedup, jaccard_join, mixing, quality_rules

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, kept string, row string, quality map<string,int>"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def brute_quality(rows):
    """Posterior of every row by EM over rows (not patterns), in arrays."""
    value = np.full((len(rows), len(quality_rules.RULES)), np.nan)
    for i, r in enumerate(rows):
        if r["n_words"]:
            w, c, lines = r["n_words"], r["word_chars"], r["n_lines"]
            value[i] = [
                (r["n_symbols"] + r["n_capitals"]) / c, r["n_symbols"] / w, r["n_capitals"] / c,
                r["n_repeat_words"] / w, r["n_dup_lines"] / lines, abs(c / w - 5.75),
            ]
    good = np.array([g for _, g, _ in quality_rules.RULES.values()])
    bad = np.array([b for _, _, b in quality_rules.RULES.values()])
    ups, downs = value <= good, value >= bad
    share, pseudo = quality_rules.PRIOR_GOOD, quality_rules.PSEUDO
    start = quality_rules.START
    up = {c: np.full(len(good), start[c][1]) for c in start}
    down = {c: np.full(len(good), start[c][0]) for c in start}

    def posterior():
        for_good = np.maximum(0, np.log(up["good"] / up["bad"]))
        against = np.minimum(0, np.log(down["good"] / down["bad"]))
        odds = np.log(share / (1 - share)) + ups @ for_good + downs @ against
        return 1 / (1 + np.exp(-odds))

    for _ in range(quality_rules.ROUNDS):
        p = posterior()
        share = (p.sum() + pseudo * quality_rules.PRIOR_GOOD) / (len(rows) + pseudo)
        for c, weight in (("good", p), ("bad", 1 - p)):
            up[c] = (weight @ ups + pseudo * start[c][1]) / (weight.sum() + pseudo)
            down[c] = (weight @ downs + pseudo * start[c][0]) / (weight.sum() + pseudo)
    return posterior(), downs.any(axis=1)


def test_verdicts_follow_from_em(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = quality_rules.judge(docs).collect()
    quality, any_bad = brute_quality(rows)
    assert np.allclose(quality, [r["quality"] for r in rows], atol=1e-9)
    passed = np.array([not r["base_failed"] for r in rows])
    kept = np.array([r["kept"] for r in rows])
    assert (kept == (passed & (quality >= 0.5))).all()
    # A single bad vote does not decide, so this is no filter that all must pass.
    assert (kept != (passed & ~any_bad)).any()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    good = [k for r, k in zip(rows, kept) if known.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert sum(good) >= 0.99 * len(good)


@pytest.mark.parametrize("condition", ["kept", "base_failed", "n_repeat_words > 0", "quality < 0.5"])
def test_filters_on_the_result_end(docs, condition):
    began = time.monotonic()
    judged = quality_rules.judge(docs)
    count = judged.filter(condition).count()
    assert count == sum(r["x"] for r in judged.selectExpr(f"{condition} as x").collect())
    assert quality_rules.text_counts(docs).filter("n_repeat_words > 0").count() >= 0
    assert time.monotonic() - began < 60


def test_whole_rows_stay_as_they_are(spark):
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, long, None, "a", "b", {"x": 1}), (1, long, None, "a", "b", {"x": 1}), (None, long, "en", None, None, None), (2, None, "en", "k", "r", {})]
    odd = spark.createDataFrame(rows, SCHEMA)
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0, r["kept"] or "") for r in kept.collect()) == [(0, ""), (1, "a"), (1, "a")]
    assert quality_rules.keep_good(odd.limit(0)).count() == 0
    assert [r["kept"] for r in quality_rules.judge(odd).orderBy("doc_id").collect()] == [True, True, True, False]


def test_stages_keep_odd_rows_and_columns(spark):
    long = " ".join(f"word{i}" for i in range(60))
    near = long.replace("word59", "other")
    rows = [
        (1, long, None, "a", "b", {"x": 1}), (1, long, None, "a", "b", {"x": 2}), (None, long, "en", None, None, None), (None, near, "en", None, None, None),
        (2, None, "en", "k", "r", {}), (3, near, "en", "k", "r", {}), (4, near, "en", "k", "r", {}), (2, "", "de", "k", "r", {}),
    ]
    odd = spark.createDataFrame(rows, SCHEMA)
    first = exact_dedup.keep_first(odd)
    assert first.columns == odd.columns
    assert sorted((r["doc_id"] or 0) for r in first.collect()) == [1, 2, 3]
    left = jaccard_join.keep_one(odd)
    assert left.columns == odd.columns
    # Rows of id 1 go or stay together, rows without id stay, 3 and 4 are like 1.
    assert sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 0, 1, 1, 2, 2]
    for function in (exact_dedup.keep_first, jaccard_join.keep_one, quality_rules.keep_good):
        assert function(odd.limit(0)).count() == 0
    documents = odd.selectExpr("doc_id", "text", "lang", "kept as source", "row", "quality")
    assert mixing.mixed_documents(documents.limit(0)).count() == 0
