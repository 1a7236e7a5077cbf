"""Scores of the classifiers recomputed text by text in plain Python."""

import math

import numpy as np
import pytest
import zstandard

from textprep.llm import language_id, quality_classifier, toxicity
from textprep.llm.labelled import labelled_sample

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").union(
        spark.createDataFrame([(-1, None, "en", "x", 0), (-2, "", "en", "x", 0), (-3, "a", None, None, 1)], "doc_id long, text string, lang string, source string, n_chars long")
    )
    return docs.cache(), spark.read.parquet(f"{SF}/labels.parquet")


def compressor(content, window_log=14, **parameters):
    code = zstandard.ZstdCompressionParameters(
        window_log=window_log, hash_log=12, chain_log=12, write_content_size=False, write_checksum=False, write_dict_id=False, **parameters
    )
    words = zstandard.ZstdCompressionDict(content.ljust(8, b"\0"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return lambda part: len(zstandard.ZstdCompressor(dict_data=words, compression_params=code).compress(part))


def logistic(row, weights):
    return 1 / (1 + math.exp(-max(-30, min(30, sum(x * w for x, w in zip(row, weights)) + weights[-1]))))


def cut(data, size):
    return [data[i : i + size] for i in range(0, len(data), size)]


def test_toxicity(tables):
    docs, labels = tables
    sample, _ = labelled_sample(docs, labels, "toxic", 5, 0, toxicity.TRAIN, toxicity.MAX_CHARS)
    pairs, weights = toxicity.fit(sample)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in toxicity.score_toxicity(docs, labels).collect():
        row, parts = [], [w + b"\n" * 40 for w in cut(texts[r["doc_id"]].lower().encode(), 128)]
        for (toxic, ordinary), (gram, _, clear) in zip(pairs, toxicity.PAIRS):
            one, two = (compressor(c, min_match=gram, strategy=1, target_length=1) for c in (toxic, ordinary))
            saved = sorted((max(0, two(p) - one(p)) for p in parts), reverse=True)
            if saved:
                total = sum(s for s in saved if s >= clear)
                row += [
                    math.log1p(total), total / len(saved), sum(s >= 1 for s in saved) / len(saved),
                    sum(s >= clear for s in saved) / len(saved), math.sqrt(saved[0]), math.sqrt(saved[1] if len(saved) > 1 else 0),
                ]
        row = row + [math.log1p(len(parts))] if parts else [0.0] * 13
        assert r["score"] == pytest.approx(logistic(row, weights), abs=1e-9)
        assert r["predicted"] == int(r["score"] >= 0.5)


def test_quality(tables):
    docs, labels = tables
    first, second, weights = quality_classifier.fit(
        *labelled_sample(docs, labels, "quality", 4, 2, quality_classifier.TRAIN, quality_classifier.MAX_CHARS)
    )
    options = {"strategy": 3, "min_match": 4, "search_log": 3, "window_log": 17}
    good, bad = compressor(first, **options), compressor(second, **options)
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    for r in quality_classifier.score_quality(docs, labels).collect():
        data, row = texts[r["doc_id"]], [0.0] * 6
        if data:
            g, b = ([f(p) for p in cut(data, 1024)] for f in (good, bad))
            difference = (sum(b) - sum(g)) / max(sum(b), sum(g))
            worst = min((y - x) / max(x, y) for x, y in zip(g, b))
            share = sum(good(p) for p in cut(data, 65536)) / len(data)
            row = [10 * difference, math.tanh(20 * difference), math.tanh(20 * worst), share, min(share, 0.3), math.log1p(len(data)) / 10]
        assert r["score"] == pytest.approx(logistic(row, weights), abs=1e-9)
        assert r["predicted"] == int(r["score"] >= 0.7)


def test_language(tables):
    docs, _ = tables
    sample = language_id.training_sample(docs, 5, 0, language_id.PER_LANGUAGE)
    model = language_id.Model(sample)

    def strings(text):
        data = text.lower().encode()
        return {data[i : i + n] for n in (1, 2, 3) for i in range(len(data) - n + 1)}

    taken, marks = {}, []
    for text, lang in sample:
        taken[lang] = taken.get(lang, 0) + 1
        if taken[lang] <= language_id.LANDMARKS:
            marks.append(strings(text))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in language_id.identify_languages(docs).collect():
        text = texts[r["doc_id"]]
        if text is None or not any(map(str.isalpha, text)):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        own = strings(text)
        kernel = np.array([len(own & m) / math.sqrt(len(own) * len(m)) for m in marks])
        values = language_id.SHARPNESS * (kernel @ model.map @ model.weights[:-1] + model.weights[-1])
        shares = np.exp(values - values.max()) / np.exp(values - values.max()).sum()
        assert r["score"] == pytest.approx(shares.max(), abs=1e-4)
        assert shares[model.languages.index(r["lang_pred"])] == pytest.approx(shares.max(), abs=1e-4)
