"""N-grams, vocabularies, vectors and sequences against brute force."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textprep.config import SequenceConfig, TfidfConfig
from textprep.functions import tokens
from textprep.operators import features, sequences

SCHEMA = "row_id long, clean_text string"


def texts(seed=3, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["x", "it's", "end."]
    return [(i, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(n)]


def grams(text, low, high):
    words = [w for w in text.replace("'", " ").replace(".", " ").split() if len(w) > 1]
    return [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize(
    "words,want",
    [(["a", "b", "c"], ["a", "b", "c", "a b", "b c", "a b c"]), (["a"], ["a"]), ([], [])],
)
def test_ngrams(spark, words, want):
    df = spark.createDataFrame([(words,)], "t array<string>")
    assert df.select(tokens.word_ngrams(F.col("t"), 1, 3)).first()[0] == want


@pytest.mark.parametrize(
    "seq,max_len,want",
    [
        (list(range(1, 10)), 5, [1, 2, 7, 8, 9]),
        ([1, 2, 3], 5, [1, 2, 3, 0, 0]),
        ([], 5, [0, 0, 0, 0, 0]),
        ([4, 5], 1, [4]),
        (list(range(1, 8)), 4, [1, 2, 6, 7]),
    ],
)
def test_head_tail_and_padding(spark, seq, max_len, want):
    df = spark.createDataFrame([(seq,)], "s array<int>")
    padded = tokens.pad_post(tokens.truncate(F.col("s"), max_len, "head_tail"), max_len)
    row = df.select(padded, tokens.attention_mask(padded)).first()
    assert row[0] == want and row[1] == [int(v != 0) for v in want]


def test_truncate_post_and_errors(spark):
    df = spark.createDataFrame([([1, 2, 3],)], "s array<int>")
    assert df.select(tokens.truncate(F.col("s"), 2, "post")).first()[0] == [1, 2]
    for strategy in ("post", "head_tail"):
        with pytest.raises(ValueError):
            tokens.truncate(F.col("s"), 0, strategy)
    with pytest.raises(ValueError):
        tokens.truncate(F.col("s"), 2, "pre")


def test_sequence_tokens(spark):
    df = spark.createDataFrame([("It's A-test, (yes)\tno_w\nEND!",)], "t string")
    got = df.select(tokens.sequence_tokens(F.col("t"))).first()[0]
    assert got == ["it's", "a", "test", "yes", "no", "w", "end"]


def vocabulary(rows, cfg):
    tf, df = Counter(), Counter()
    for _, text in rows:
        g = grams(text, cfg.ngram_min, cfg.ngram_max)
        tf.update(g)
        df.update(set(g))
    ok = [t for t in tf if cfg.min_df <= df[t] <= cfg.max_df * len(rows)]
    chosen = sorted(sorted(ok, key=lambda t: (-tf[t], t))[: cfg.max_features])
    idf = {t: math.log((1 + len(rows)) / (1 + df[t])) + 1 for t in chosen}
    return {t: (i, tf[t], df[t], idf[t]) for i, t in enumerate(chosen)}


def weights(rows, vocab, cfg):
    out = {}
    for i, text in rows:
        counts = Counter(g for g in grams(text, cfg.ngram_min, cfg.ngram_max) if g in vocab)
        raw = {vocab[t][0]: (1 + math.log(n)) * vocab[t][3] for t, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out |= {(i, k): v / norm for k, v in raw.items()}
    return out


CONFIGS = [TfidfConfig(), TfidfConfig(max_features=20), TfidfConfig(ngram_min=2, ngram_max=2, min_df=1), TfidfConfig(max_df=0.3)]


@pytest.mark.parametrize("cfg", CONFIGS)
@pytest.mark.parametrize("cut", [False, True])
def test_vocabulary(spark, monkeypatch, cfg, cut):
    if cut:
        monkeypatch.setattr(features, "SORT_FACTOR", 0)
    df = spark.createDataFrame(texts(), SCHEMA).repartition(3)
    got = {r["term"]: tuple(r)[1:] for r in features.tfidf_vocab(df, cfg).collect()}
    want = vocabulary(texts(), cfg)
    assert got == {t: (*v[:3], pytest.approx(v[3])) for t, v in want.items()}


@pytest.mark.parametrize("cfg", CONFIGS)
def test_vectors_and_long_form(spark, monkeypatch, cfg):
    rows = texts()
    fresh = [*texts(9, 20), (99, "unknown only"), (100, "")]
    vocab = features.tfidf_vocab(spark.createDataFrame(rows, SCHEMA), cfg)
    want = weights(fresh, vocabulary(rows, cfg), cfg)
    df = spark.createDataFrame(fresh, SCHEMA)
    vectors = {r["row_id"]: r["features"] for r in features.tfidf_vectors(df, vocab, cfg).collect()}
    assert len(vectors) == len(fresh)
    got = {(i, int(k)): v for i, f in vectors.items() for k, v in zip(f.indices, f.values)}
    assert got == {k: pytest.approx(v) for k, v in want.items()}
    for limit in (features.LOCAL_VOCABULARY, 0):
        monkeypatch.setattr(features, "LOCAL_VOCABULARY", limit)
        long = features.tfidf_weights(df, vocab, cfg).collect()
        assert {(r["row_id"], r["id"]): r["value"] for r in long} == {k: pytest.approx(v) for k, v in want.items()}


def test_bias_and_sign(spark):
    df = spark.createDataFrame(texts(), SCHEMA)
    vocab = features.tfidf_vocab(df)
    n = vocab.count()
    plain = {r["row_id"]: r["features"] for r in features.tfidf_vectors(df, vocab).collect()}
    sign = F.when(F.col("row_id") % 2 == 0, -1.0).otherwise(1.0)
    signed = features.tfidf_vectors(df, vocab, bias=True, sign=sign).collect()
    for r in signed:
        s = -1.0 if r["row_id"] % 2 == 0 else 1.0
        assert r["features"].size == n + 1 and r["features"][n] == s
        assert list(r["features"].values[:-1]) == [pytest.approx(s * v) for v in plain[r["row_id"]].values]


def test_limits_that_exclude_all(spark):
    stats = spark.createDataFrame([("a", 1, 1)], "term string, tf long, df long")
    with pytest.raises(ValueError):
        features.eligible_terms(stats, 1, TfidfConfig(min_df=2))


def word_ids(rows, size):
    counts, first = Counter(), {}
    for i, text in sorted(rows):
        for pos, w in enumerate(text.replace(".", " ").split()):
            counts[w] += 1
            first.setdefault(w, (i, pos))
    order = sorted(counts, key=lambda w: (-counts[w], first[w]))
    return {w: i for i, w in enumerate(order[: size - 2], start=2)}


@pytest.mark.parametrize("size", [3, 8, 15, 100])
def test_word_vocabulary_ties(spark, size):
    rows = [(7, "b a c c"), (3, "d e f d"), (5, "h g e"), (9, "i j k l m n o p")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r["term"]: r["id"] for r in sequences.sequence_vocab(df, SequenceConfig(vocab_size=size)).collect()}
    assert got == word_ids(rows, size)


def test_word_vocabulary_of_nothing(spark):
    df = spark.createDataFrame([(1, "")], SCHEMA)
    assert sequences.sequence_vocab(df, SequenceConfig()).count() == 0
    with pytest.raises(ValueError):
        sequences.sequence_vocab(df, SequenceConfig(vocab_size=2))


@pytest.mark.parametrize("strategy", ["head_tail", "post"])
@pytest.mark.parametrize("local", [10**6, 0])
def test_encode(spark, strategy, local):
    rows = [*texts(), (1000, None)]
    cfg = SequenceConfig(vocab_size=12, max_len=6, truncate_strategy=strategy)
    df = spark.createDataFrame(rows, SCHEMA)
    known = [(i, t or "") for i, t in rows]
    ids = word_ids(known, 12)
    vocab = sequences.sequence_vocab(df, cfg)
    got = {r["row_id"]: (r["ids"], r["mask"]) for r in sequences.encode(df, vocab, cfg, local_vocabulary=local).collect()}
    assert len(got) == len(rows)
    for i, text in known:
        seq = [ids.get(w, 1) for w in text.replace(".", " ").split()]
        if len(seq) > 6:
            seq = seq[:3] + seq[-3:] if strategy == "head_tail" else seq[:6]
        assert got[i] == (seq + [0] * (6 - len(seq)), [1] * len(seq) + [0] * (6 - len(seq)))


def test_counters_take_little_memory_whatever_the_batch():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    words = pa.DictionaryArray.from_arrays(rng.integers(0, 40, 2_000_000).astype(np.int32), [f"w{i}" for i in range(40)]).cast(pa.string())
    rows = pa.ListArray.from_arrays(np.arange(0, 2_000_001, 200, dtype=np.int32), words)
    batch = pa.RecordBatch.from_arrays([rows], names=["tokens"])
    tracemalloc.start()
    (out,) = features._summaries(TfidfConfig(), 1 << 20)(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(out.column("tf").to_pylist()) == 10_000 * (200 + 199 + 198)
    assert max(out.column("df").to_pylist()) <= 10_000 and peak < 128 << 20


def test_merging_distinct_counters_takes_little_memory():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(6)
    words = pa.DictionaryArray.from_arrays(rng.integers(0, 5000, 2_500_000).astype(np.int32), [f"w{i}" for i in range(5000)]).cast(pa.string())
    rows = pa.ListArray.from_arrays(np.arange(0, 2_500_001, 250, dtype=np.int32), words)
    batch = pa.RecordBatch.from_arrays([rows], names=["tokens"])
    tracemalloc.start()
    (out,) = features._summaries(TfidfConfig(), 1 << 20)(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.num_rows <= (1 << 20) + 1 and peak < 224 << 20


@pytest.mark.parametrize("capacity", [1, 40, 10_000])
def test_counters_and_their_bound_hold_the_true_counts(capacity, monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(features, "SUMMARY_NEW", 300)
    monkeypatch.setattr(features, "SLICE_TOKENS", 50)
    rows = [text.split() for _, text in texts(7, 200)]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], names=["tokens"])
    (out,) = features._summaries(TfidfConfig(), capacity)(iter([batch]))
    *counters, end = out.to_pylist()
    found, lost = {c["h"]: (c["tf"], c["df"]) for c in counters}, end["lost"]
    assert len(found) == len(counters) and all(c["lost"] == 0 for c in counters)
    assert (lost == 0) == (capacity == 10_000)
    tf, df, hashes = Counter(), Counter(), {}
    for row in rows:
        own = [tuple(row[i : i + n]) for n in (1, 2, 3) for i in range(len(row) - n + 1)]
        tf.update(own)
        df.update(set(own))
    for gram in tf:
        keys = features._token_keys(pa.array(gram, pa.string()))
        whole, _ = features._gram_keys(keys, np.zeros(len(gram), np.int64), len(gram))
        hashes[gram] = int(whole[:, 0].view(np.int64)[0])
    assert set(found) <= set(hashes.values())
    for gram, h in hashes.items():
        low_tf, low_df = found.get(h, (0, 0))
        assert low_tf <= tf[gram] <= low_tf + lost and low_df <= df[gram] <= low_df + lost
