"""MinHash near duplicates against brute force, and its parts on their own."""

import random

import numpy as np
import pytest

from textprep.llm import groups, minhash, overlap
from test_operators import brute_components

SCHEMA = "doc_id bigint, text string, a string, b int, component string, thing int"


def components(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1, None, 2) for r in rows], SCHEMA)
    return minhash.near_duplicates(df, **options)


def compare(found, rows, size, percent):
    want = brute_components({i: t or "" for i, t in rows if i is not None}, size, percent)
    got = {r["doc_id"]: r for r in found.collect() if r["doc_id"] is not None}
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_against_brute_force(spark, size, percent):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    compare(minhash.near_duplicates(docs, size=size, percent=percent), rows, size, percent)


def test_large_groups_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(groups, "CELL_SHINGLES", 1500)
    monkeypatch.setattr(minhash, "BLOCK_SIGNATURES", 16)
    monkeypatch.setattr(overlap, "BLOCK_SHINGLES", 2000)
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(120):  # near copies of one original, and copies of copies that drift away
        words = list(base)
        for k in rng.sample(range(200), rng.randrange(0, 14)):
            words[k] = f"v{rng.randrange(10**6)}"
        rows.append((i + 10, " ".join(words)))
    chain = list(base)
    for i in range(40):
        chain[rng.randrange(200)] = f"u{i}"
        rows.append((500 + i, "  ".join(chain).upper()))
    rows += [(900, None), (901, ""), (902, " \t"), (903, "one two"), (904, "One  two"), (None, "one two"), (None, None)]
    rows += [(910, "x " * 50_000), (911, "x " * 40_000), (912, " ".join(base)), (912, " ".join(base)), (5, " ".join(base))]
    rows += [(920, " ".join(f"q{k}" for k in range(30_000))), (921, " ".join(f"q{k}" for k in range(3, 30_000)))]
    found = components(spark, rows, size=3, percent=85)
    assert found.count() == len(rows)
    compare(found, rows, 3, 85)
    loose = [r for r in found.collect() if r["doc_id"] is None]
    assert all(r["component_id"] is None and r["kept"] for r in loose)
    assert components(spark, rows[:0]).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 30_000).astype(np.uint64)
    for share in (0.3, 0.85):
        sets = [np.unique(np.concatenate([pool[:300], pool[300 + k * 300 :][: int(300 * (1 - share) / share / 1)]])) for k in range(40)]
        minima = minhash.signatures(sets)
        agree = (minima[0] == minima[1:]).mean()
        exact = np.mean([len(np.intersect1d(sets[0], s)) / len(np.union1d(sets[0], s)) for s in sets[1:]])
        assert abs(agree - exact) < 0.03
    assert not minhash.signatures([np.empty(0, np.uint64)]).any()


def test_least_agreements_miss_no_more_than_chosen():
    least = minhash.least_agreements(85)
    assert list(least) == list(range(16, 161, 16))
    rng = np.random.default_rng(2)
    draws = rng.random((200_000, 160)) < 0.85
    pruned = np.zeros(len(draws), bool)
    for n, m in least.items():
        pruned |= draws[:, :n].sum(axis=1) < m
    assert pruned.mean() < 1e-4
    unlike = rng.random((20_000, 160)) < 0.4
    assert np.mean([unlike[:, :n].sum(axis=1) < m for n, m in least.items()][-1]) > 0.99
    assert minhash.least_agreements(100)[160] == 160


def test_product_equals_set_overlap():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 50))).astype(np.uint64) for _ in range(60)]
    x, y = (a.ravel() for a in np.meshgrid(np.arange(60), np.arange(60)))
    for percent in (30, 85):
        got = overlap.product(x, y, sets, percent)
        for i, j, similar in zip(x, y, got):
            both = len(np.intersect1d(sets[i], sets[j]))
            assert similar == (both > 0 and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both))
