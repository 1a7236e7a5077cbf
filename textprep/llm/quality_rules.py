"""Quality by weak supervision: rules vote or abstain, EM weighs them.

Every rule measures something else in the text and may vote good or bad. None of
them decides alone: expectation-maximisation over the vote patterns estimates how
often each rule errs on good and on bad documents, without labels, and a document
is judged by the posterior probability that follows from all its votes.

All counts are taken inside the row from the whole text and staged, so the text
is read once; nothing but the vote patterns (at most 3^rules rows, counted by
Spark) reaches the driver. The fit runs on that table of patterns, whatever the
size of the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textprep.llm.columns import SPACE_CHARACTERS, WORD, whole, without
from textprep.session import stage

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Rule: (measure, votes good up to, votes bad from); it abstains in between.
RULES = {
    "letters": ("(n_symbols + n_capitals) / word_chars", 0.06, 0.09),
    "symbols": ("n_symbols / n_words", 0.02, 0.1),
    "capitals": ("n_capitals / word_chars", 0.06, 0.3),
    "repeats": ("n_repeat_words / n_words", 0.02, 0.1),
    "dup_lines": ("n_dup_lines / n_lines", 0.0, 0.15),
    "word_length": ("abs(word_chars / n_words - 5.75)", 1.25, 1.75),
}
# Where the fit starts: the share of good documents, and the chances of a bad and
# of a good vote on each class. It holds to that as to PSEUDO documents, a fixed
# number, so that rules without votes on a class stay defined.
PRIOR_GOOD = 0.85
START = {"good": (0.05, 0.80), "bad": (0.30, 0.30)}
PSEUDO = 20.0
ROUNDS = 20


def text_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the counts the rules and the base test read, from whole texts.

    Windows of three words are compared by 64-bit hash. A text without words,
    empty or null, has zeros throughout. The result comes out of an exploded
    array of one row, so that filters on it stay above the counts: pushed below,
    each would repeat the nested expressions many times over.
    """
    content = docs.select(F.col(doc_id).alias("doc_id"), whole(F.col(text)).alias("content"))
    split = content.select(
        "doc_id",
        "content",
        F.regexp_extract_all("content", F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split("content", "\n"), lambda line: line.rlike(WORD)).alias("lines"),
    )
    counted = split.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(without(F.col("content"), SPACE_CHARACTERS)).cast("bigint").alias("word_chars"),
        (F.length("content") - F.length(without(F.col("content"), SYMBOLS))).cast("bigint").alias("n_symbols"),
        (F.length("content") - F.length(without(F.col("content"), CAPITALS))).cast("bigint").alias("n_capitals"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    starts = F.sequence(F.lit(0), F.greatest(F.size("hashes") - 3, F.lit(0)))
    windows = F.when(
        F.size("hashes") >= 3,
        F.transform(starts, lambda i: F.xxhash64(F.get("hashes", i), F.get("hashes", i + 1), F.get("hashes", i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    windowed = counted.withColumn("windows", windows)
    # Only texts with a repeated window are sorted: equal windows become
    # neighbours, and each run of them gives the places it stands at.
    places = F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    ranked = windowed.withColumn(
        "places",
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), places),
    )
    twice = F.filter(
        "places",
        lambda x, k: (F.get("places", k - 1)["w"].eqNullSafe(x["w"])) | (F.get("places", k + 1)["w"].eqNullSafe(x["w"])),
    )
    repeated = ranked.withColumn("at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("at", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("at", k + 1) - p, F.lit(3)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    row = F.struct(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
        "n_lines",
        "n_capitals",
    )
    return repeated.select(F.explode(F.array(row)).alias("row")).select("row.*")


def votes(rules: dict = RULES) -> list[Column]:
    """1 for good, -1 for bad, 0 for abstaining, per rule; without words all abstain."""
    found = []
    for name, (measure, good, bad) in rules.items():
        value = F.expr(measure.replace("n_words", "nullif(n_words, 0)").replace("n_lines", "nullif(n_lines, 0)").replace("word_chars", "nullif(word_chars, 0)"))
        vote = F.when(value >= bad, -1)
        if good is not None:
            vote = vote.when(value <= good, 1)
        found.append(vote.otherwise(0).alias(f"vote_{name}"))
    return found


def fit_rules(patterns: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = ROUNDS) -> tuple:
    """EM over counted vote patterns: (prior log-odds, log-odds per rule of a bad and a good vote).

    Each class has its own chance of a bad and of a good vote for every rule, the
    rest abstains. A vote never counts against its own meaning: abstaining and
    voting are compared only in the direction the rule states. The pseudo-counts
    make the estimate well defined for any input, empty ones too.
    """
    total = sum(n for _, n in patterns)
    good_share = PRIOR_GOOD
    chance = {c: [{-1: START[c][0], 1: START[c][1]} for _ in range(n_rules)] for c in ("good", "bad")}

    def weights() -> tuple[float, list[dict[int, float]]]:
        rows = []
        for j in range(n_rules):
            g, b = chance["good"][j], chance["bad"][j]
            rows.append({-1: min(0.0, math.log(g[-1] / b[-1])), 1: max(0.0, math.log(g[1] / b[1]))})
        return math.log(good_share / (1 - good_share)), rows

    for _ in range(rounds):
        prior, table = weights()
        mass = {c: [{-1: 0.0, 0: 0.0, 1: 0.0} for _ in range(n_rules)] for c in ("good", "bad")}
        good_total = 0.0
        for pattern, n in patterns:
            odds = prior + sum(table[j][v] for j, v in enumerate(pattern) if v)
            p = 1.0 / (1.0 + math.exp(-odds))
            good_total += n * p
            for j, v in enumerate(pattern):
                mass["good"][j][v] += n * p
                mass["bad"][j][v] += n * (1 - p)
        good_share = (good_total + PSEUDO * PRIOR_GOOD) / (total + PSEUDO)
        for c in ("good", "bad"):
            for j in range(n_rules):
                seen = sum(mass[c][j].values()) + PSEUDO
                for v, start in zip((-1, 1), START[c]):
                    chance[c][j][v] = (mass[c][j][v] + PSEUDO * start) / seen
    return weights()


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: dict = RULES) -> DataFrame:
    """One row per row of ``docs``: counts, base_failed, the votes, quality, kept.

    ``quality`` is the posterior probability that the document is good given its
    votes; it is kept if it passes the base test and quality >= 0.5. Null, empty
    and blank texts have zero counts and fail the base test. Repeated rows are
    judged alike, null ids too; other columns are ignored; an empty table gives
    an empty result. The counts are staged: they are read by the fit and by the
    verdict.
    """
    counts = stage(text_counts(docs, doc_id, text), "quality-counts")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    voted = counts.withColumn("base_failed", failed).select("*", *votes(rules))
    names = [f"vote_{name}" for name in rules]
    patterns = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3^rules rows
    ordered = sorted((tuple(r[n] for n in names), r["n"]) for r in patterns)
    prior, table = fit_rules(ordered, len(names))
    odds = F.lit(prior)
    for name, row in zip(names, table):
        odds = odds + F.when(F.col(name) == 1, row[1]).when(F.col(name) == -1, row[-1]).otherwise(0.0)
    quality = 1.0 / (1.0 + F.exp(-odds))
    return voted.withColumn("quality", quality).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))


def keep_good(docs: DataFrame, text: str = "text", rules: dict = RULES) -> DataFrame:
    """The rows of ``docs``, all columns, that ``judge`` keeps; nothing is shuffled.

    The whole rows are staged with their counts. Null ids, repeated rows and any
    columns of their own names stay as they are; an empty table stays empty.
    """
    whole_rows = docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text"))
    return judge(whole_rows, "_row", "_text", rules).filter("kept").select("doc_id.*")
