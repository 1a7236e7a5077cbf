"""Cleaning and labels against rules stated in Python."""

import itertools
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from textprep.config import PrepConfig
from textprep.functions import clean
from textprep.functions.clean import strip_accents, with_clean_text
from textprep.functions.labels import coerce_label
from textprep.operators.prepare import prepare_rows, require_columns, resolve_text_column

HOSTILE = [
    "@a@b @c",
    "Mail ÉLAN.x@host.de now",
    "é@b",
    "x@y.zz.",
    "foo..-@bar-.co_m!",
    "a\x1cb\x85c  d e f　g\x0bh",
    "HTTPſ://x y",
    "ﬁne ① ½ ＡＢＣ",
    "İstanbul ΣΑΣ",
    "<a\nhref='x'>hi</a> 3<4 and 5>2",
    "www.x y",
    "Kelvin Sign",
    "日本語@x.jp ok",
    "áb@c.de",
    "ab_@x, -@y",
    "zero​width",
    "०१२ digits",
    "user@x.ýz",
    "Hello&nbsp;World",
    "",
    "WWW.Site.org and Http://Q.r/s?t=u end",
    "x@y.zz.@q.com",
]


def expected(text: str, cfg: PrepConfig) -> str:
    """The rules in order: form, tags, addresses, case, symbols, spaces."""
    rules = [
        (cfg.remove_html, r"<[^>]+>"),
        (cfg.remove_urls, r"(?i)https?://\S+|www\.\S+"),
        (cfg.remove_emails, r"\b[\w.\-]+@[\w.\-]+\.\w+\b"),
        (cfg.remove_mentions, r"(?<!\w)@[A-Za-z0-9_]+"),
    ]
    out = unicodedata.normalize("NFKC", text) if cfg.normalize_unicode else text
    for active, pattern in rules:
        out = re.sub(pattern, " ", out) if active else out
    out = out.lower() if cfg.lowercase else out
    if cfg.remove_non_alnum:
        allowed = set("abcdefghijklmnopqrstuvwxyz0123456789")
        allowed |= set(".!?,'-") if cfg.keep_sentence_punctuation else set()
        out = "".join(c if c in allowed else " " for c in out)
    return " ".join(out.split())


def cleaned(spark, texts, cfg):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = with_clean_text(df, cfg).orderBy("i").collect()
    return [r["clean_text"] for r in rows]


CONFIGS = [
    PrepConfig(),
    PrepConfig(keep_sentence_punctuation=False),
    PrepConfig(normalize_unicode=False),
    PrepConfig(lowercase=False),
    PrepConfig(remove_non_alnum=False),
    PrepConfig(remove_urls=False, remove_emails=False),
    PrepConfig(remove_html=False, remove_mentions=False, lowercase=False, remove_non_alnum=False),
]


@pytest.mark.parametrize("cfg", CONFIGS)
def test_hostile_strings(spark, cfg):
    assert cleaned(spark, HOSTILE, cfg) == [expected(t, cfg) for t in HOSTILE]


@pytest.mark.parametrize("cfg", CONFIGS)
def test_random_strings(spark, cfg):
    rng = random.Random(7)
    bits = ["@", ".", "-", "_", " ", "\n", "a", "Z", "9", "é", "ß", "<", ">", "www.", "http://", "x@y.de", "ﬁ", " ", "!", "日"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(400)]
    assert cleaned(spark, texts, cfg) == [expected(t, cfg) for t in texts]


def test_cleaning_twice_changes_nothing(spark):
    once = cleaned(spark, HOSTILE, PrepConfig())
    assert cleaned(spark, once, PrepConfig()) == once


def test_null_text_is_empty(spark):
    df = spark.createDataFrame([(None,)], "text string")
    assert with_clean_text(df).first()["clean_text"] == ""


def test_bypassed_characters_are_stable_under_nfkc():
    safe = [c for c in map(chr, range(0x3000)) if not re.search(clean.NFKC_SUSPECT, c)]
    assert len(safe) > 300
    for c in safe:
        assert unicodedata.normalize("NFKC", c) == c and not unicodedata.combining(c)
    for a, b in itertools.product(safe, safe):
        assert unicodedata.normalize("NFKC", a + b) == a + b
    latin = [chr(i) for i in range(256) if not re.search(clean.NOT_PLAIN_LATIN1, chr(i))]
    assert all(unicodedata.normalize("NFKC", c) == c for c in latin)


def test_strip_accents(spark):
    texts = ["déjà vu", "plain", "ÅÄÖ ﬁ ™", "हिन्दी"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(strip_accents(F.col("t"))).collect()]
    want = [
        t if t.isascii() else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
        for t in texts
    ]
    assert got == want


LABELS = {
    "1": 1, "0": 0, " 1 ": 1, "1e0": 1, "+1": 1, "1_0": None, "1.9": 1, "0.7": 0, "-0.5": 0,
    "1d": None, "1f": None, "0x1": None, "NaN": None, "inf": None, "true": None, "": None,
    "abc": None, "1e999": None, "2": 2, "-3.7": -3,
}


def test_label_spellings(spark):
    df = spark.createDataFrame([(k,) for k in LABELS] + [(None,)], "label string")
    got = [r[0] for r in df.select(coerce_label(df)).collect()]
    assert got == [*LABELS.values(), None]


def test_numeric_labels(spark):
    df = spark.createDataFrame([(1.9,), (-0.5,), (float("nan"),), (float("inf"),), (None,)], "label double")
    assert [r[0] for r in df.select(coerce_label(df)).collect()] == [1, 0, None, None, None]


def test_prepare_rows_filters_and_keeps_columns(spark):
    rows = [(1, "Long enough", "1", "x"), (2, "abc!", "1", "x"), (3, "Long enough", "2", "x"), (4, None, "0", "x")]
    df = spark.createDataFrame(rows, "row_id long, text string, label string, extra string")
    got = prepare_rows(df, PrepConfig()).collect()
    assert [(r["row_id"], r["label"], r["clean_text"], r["extra"]) for r in got] == [(1, 1, "long enough", "x")]


def test_column_checks(spark):
    df = spark.createDataFrame([("a",)], "body string")
    with pytest.raises(ValueError, match="label.*text"):
        require_columns(df)
    with pytest.raises(ValueError, match="text column"):
        resolve_text_column(df)
    assert resolve_text_column(df, "body") == "body"
    assert resolve_text_column(df.withColumnRenamed("body", "text"), "other") == "text"


def test_filter_does_not_clean_twice(spark):
    df = spark.createDataFrame([(1, "abc def", "1")], "row_id long, text string, label string")
    plan = prepare_rows(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(clean.URL) == 1
