"""What the classifiers learn from: every language, every class, texts of any length."""

import random

import pytest

from textprep.llm import language_id, quality_classifier, toxicity
from textprep.llm.labelled import labelled_sample

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def language(seed):
    rng = random.Random(seed)
    return [a + b + c for a, b, c in ("".join(rng.choices(LETTERS, k=3)) for _ in range(12))]


def documents(spark, wanted):
    """wanted: (language, rows, words per row)."""
    rows, rng = [], random.Random(5)
    for name, count, words in wanted:
        pool = language(name)
        rows += [(name, " ".join(rng.choices(pool, k=words))) for _ in range(count)]
    rows = [(i, text, name, "x") for i, (name, text) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, shared string").repartition(4)


def accuracy(docs):
    found = language_id.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    hits = {}
    for r in found.collect():
        hits.setdefault(r["lang"], []).append(r["lang"] == r["lang_pred"])
    return {k: sum(v) / len(v) for k, v in hits.items()}


def test_languages_of_only_short_or_only_long_texts(spark):
    got = accuracy(documents(spark, [("usual", 120, 60), ("short", 120, 3), ("long", 40, 2500)]))
    assert set(got) == {"usual", "short", "long"} and min(got.values()) > 0.8


def test_many_languages(spark, monkeypatch):
    got = accuracy(documents(spark, [(f"l{k}", 12, 40) for k in range(150)]))
    assert len(got) > 120 and sum(got.values()) / len(got) > 0.8
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 3)
    with pytest.raises(ValueError, match="languages"):
        language_id.identify_languages(documents(spark, [(f"l{k}", 3, 40) for k in range(4)]))


@pytest.mark.parametrize(("module", "score"), [(toxicity, "score_toxicity"), (quality_classifier, "score_quality")])
def test_a_class_of_only_long_texts_is_learned(spark, module, score):
    rng, rows = random.Random(2), []
    for i in range(160):
        marked = i % 2
        pool = ["vile", "scum", "rot", "filth"] if marked else ["calm", "kind", "warm", "bright"]
        words = [rng.choice(pool if rng.random() < 0.3 else language("base")) for _ in range(6000 if marked else 300)]
        rows.append((i, " ".join(words), marked))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, y, y) for i, _, y in rows], "doc_id bigint, toxic int, quality int")
    sample, sizes = labelled_sample(docs, labels, "toxic", 5, 0, {0: 50, 1: 50}, 20_000)
    assert sum(y for _, y in sample) == 50 and max(len(t) for t, _ in sample) == 20_000 and sum(sizes.values()) < 160
    found = {r["doc_id"]: r for r in getattr(module, score)(docs, labels).collect()}
    held = [(r["score"] >= 0.5) == bool(i % 2) for i, r in found.items() if r["held_out"]]
    assert sum(held) >= 0.9 * len(held)
