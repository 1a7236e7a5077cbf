"""Hard-negative mining against brute force, and on odd input."""

import math
import random

import pytest

from textprep.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, anchor string, block int"


def brute(rows, every=100, positives=5, negatives=5):
    valid = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        valid.append((i, [math.floor(256 * float(x)) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = set()
    for a, va, la in {(i, tuple(v), label) for i, v, label in valid}:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, v, label in valid if i != a and len(v) == len(va))
        for s, p, _ in [x for x in scored if x[2] == la][:positives]:
            hard = [x for x in scored if x[2] != la and 80 * -s <= 100 * -x[0] <= 100 * -s]
            out |= {(a, p, k, i, -s, -t) for k, (t, i, _) in enumerate(hard[:negatives], 1)}
    return out


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = [tuple(r) for r in hard_negatives.hard_negatives(df, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("block_bytes", [1 << 25, 700])
def test_against_brute_force(spark, block_bytes):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()][:900]
    assert mined(spark, rows, block_bytes=block_bytes, every=50) == brute(rows, every=50)


def test_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SCORES", 50)
    rng = random.Random(3)
    # Few distinct small vectors: most scores tie; labels beyond 9 and negative scores occur.
    rows = [(i, [float(rng.choice([-1, 0, 1, 2])) for _ in range(3)], rng.randrange(12)) for i in range(0, 400, 2)]
    rows += [
        (2, None, 1), (4, [1.0, 2.0, 3.0], None), (6, [float("nan"), 0.0, 1.0], 2), (8, [float("-inf"), 0.0, 1.0], 2),
        (12, [None, 0.0, 1.0], 2), (None, [1.0, 0.0, 1.0], 2), (1100, [], 3), (1101, [], 3), (1102, [], 4),
        (1200, [1.0], 3), (1201, [1.0, 2.0], 3), (-700, [1.0, 1.0, 1.0], 3), (-7, [1.0, 1.0, 1.0], 3),
        (1300, [2.0**26, 2.0**20], 3), (1303, [2.0**20, 1.0], 3), (1302, [2.0**20, 0.5], 4),
    ]
    assert mined(spark, rows) == brute(rows)


def test_repeated_rows_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 1.0], 2), (2, [0.5, 0.0], 2)]
    found = mined(spark, [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (3, [1.0, 0.0], 2), (5, [1.0, 1.0], 1), (6, [0.9, 9.0], 2)])
    assert mined(spark, rows) == set()  # the moved label of id 0 leaves it alone
    assert {r[:2] for r in found} == {(0, 3)}
    assert mined(spark, []) == set()
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(100, [2.0**100], 1), (3, [2.0**100], 1), (4, [1.0], 2)])
