"""Phrase mining against brute force, and its counting on its own."""

import collections
import random
import re

import numpy as np
import pytest

from textprep.llm import phrases

SCHEMA = "text string, lang string, phrase string, rank int, a int, doc_id bigint"


def brute(rows, least=10, kept=2000):
    count = collections.defaultdict(collections.Counter)
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                count[lang if lang is not None else "und"].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = set()
    for lang, f in count.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        wanted = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        found = []
        for p, a in wanted.items():
            if len(p) == 2 and any(len(q) == 3 and p in (q[:2], q[1:]) and 100 * c >= 50 * a for q, c in wanted.items()):
                continue
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:kept], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n, -s))
    return out


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1, 2, None) for r in rows], SCHEMA)
    got = phrases.collocations(df, **options).collect()
    assert len(got) == len({(r["lang"], r["rank"]) for r in got})
    return {tuple(r) for r in got}


ODD = [
    (None, "en"), ("", "en"), (" \t\n.,", None), ("one", None), ("A b. a B", "en"), ("été là-bas " * 30, "fr"),
    ("x" * 70_000 + " y", "fr"), ("a b c " * 40_000, "en"), ("a b c", "und"), ("a b c. " * 12, None), ("a b\tc; " * 12, "und"),
]


@pytest.mark.parametrize(("words", "pairs"), [(1 << 16, 1 << 18), (40, 30), (0, 0)])
def test_against_brute_force(spark, monkeypatch, words, pairs):
    monkeypatch.setattr(phrases, "BUFFER", 5_000)
    monkeypatch.setattr(phrases, "_CHUNK", 20_000)
    rng = random.Random(words)
    pool = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    rows = list(ODD)
    for _ in range(300):
        marks = [rng.choice(["", "", "", ".", ",", "\n", "?"]) for _ in range(40)]
        rows.append((" ".join(rng.choice(pool) + m for m in marks), rng.choice(["en", "de", None])))
    rows += rows[-50:]
    assert mined(spark, rows, words=words, pairs=pairs) == brute(rows)
    assert mined(spark, rows, words=words, pairs=pairs, kept=7) == brute(rows, kept=7)


def test_empty_table(spark):
    assert mined(spark, []) == set()


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 3_000_000_000_001, 3_000_000_000_777, 3_000_000_000_123
    row = spark.createDataFrame([(a, left, right)], "a bigint, l bigint, r bigint").select(phrases._score("a", "l", "r")).first()
    assert row[0] == 1000000 * a * a // (left * right)


@pytest.mark.parametrize("dense_from", [1, 30, 10**9])
def test_tiles_count_what_a_dictionary_counts(dense_from):
    rng = np.random.default_rng(4)
    left, right = rng.zipf(1.4, 5000) % 97, rng.zipf(1.4, 5000) % 53
    a, b, n = phrases.counted(left, right, 53, tile=8, dense_from=dense_from)
    got = dict(zip(zip(a.tolist(), b.tolist()), n.tolist()))
    assert len(got) == len(a) and got == collections.Counter(zip(left.tolist(), right.tolist()))
    assert len(phrases.counted(left[:0], right[:0], 53)[0]) == 0
