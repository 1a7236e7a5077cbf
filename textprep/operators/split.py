"""Stratified train/val/test split with exact quotas and no sort of the corpus.

Rows are ordered inside each label by an MD5 of seed and ``row_id``. The split
needs only the hash at which each quota is reached: prefix histograms find the
bucket holding it, and only that bucket is ranked. Assigning the split is then
a projection comparing each row's hash with a few literals.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textprep.config import PrepConfig

DIGITS = 3  # hex digits per histogram level: at most 4,096 buckets per label
RANK_ROWS = 1_000_000  # a bucket up to this size is ranked by one task
MAX_LABELS = 100  # default of ``max_labels``: strata whose counts the driver holds


def largest_remainder(counts: list[int], draws: int) -> list[int]:
    """Share ``draws`` among strata in proportion to ``counts``; ties to the first."""
    total = sum(counts)
    shares = [c * draws // total for c in counts]
    order = sorted(range(len(counts)), key=lambda i: -(counts[i] * draws % total))
    for i in order[: draws - sum(shares)]:
        shares[i] += 1
    return shares


def split_quotas(counts: list[int], cfg: PrepConfig) -> list[tuple[int, int]]:
    """Per label the number of test and of validation rows.

    The larger part is allotted first at each of the two stages, and the
    smaller part takes what is left of each label.
    """

    def small_part(sizes: list[int], fraction: float) -> list[int]:
        n = sum(sizes)
        held = math.ceil(fraction * n)
        if min(sizes) < 2:
            raise ValueError("every label needs at least two rows to be split")
        if held < len(sizes) or n - held < len(sizes):
            raise ValueError("a part of the split would hold fewer rows than labels")
        return [s - k for s, k in zip(sizes, largest_remainder(sizes, n - held))]

    test = small_part(counts, cfg.test_size)
    rest = [c - t for c, t in zip(counts, test)]
    return list(zip(test, small_part(rest, cfg.val_size_from_train)))


@dataclass
class _Cut:
    """The ``offset``-th row of ``label`` under ``prefix`` ends a part."""

    label: int
    part: str
    offset: int
    prefix: str = ""
    rows: int = 0


def row_hash(seed: int, row_id: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")).cast("binary"))


def _histogram(rows: DataFrame, depth: int, max_labels: int) -> dict[tuple[int, str], int]:
    """Rows per label and hash prefix; at most 4,096 prefixes per open bucket."""
    buckets = rows.groupBy("label", F.substring("_hash", 1, depth).alias("prefix")).count()
    bound = 2 * max_labels * 16**DIGITS
    found = buckets.limit(bound + 1).collect()
    if len(found) > bound:
        raise ValueError(f"more than {max_labels} labels to stratify by")
    return {(r["label"], r["prefix"]): r["count"] for r in found}


def _under(cuts: list[_Cut]) -> Column:
    tests = {(c.label, c.prefix) for c in cuts}
    return reduce(
        lambda a, b: a | b,
        [(F.col("label") == l) & F.col("_hash").startswith(p) for l, p in sorted(tests)],
    )


def _descend(cut: _Cut, buckets: dict[tuple[int, str], int]) -> None:
    inside = sorted(
        (p, n) for (l, p), n in buckets.items() if l == cut.label and p.startswith(cut.prefix)
    )
    for prefix, n in inside:
        if cut.offset <= n:
            cut.prefix, cut.rows = prefix, n
            return
        cut.offset -= n


def _find_cuts(rows: DataFrame, cfg: PrepConfig, max_labels: int) -> dict[tuple[int, str], tuple[str, int]]:
    buckets = _histogram(rows, DIGITS, max_labels)
    counts: dict[int, int] = {}
    for (label, _), n in sorted(buckets.items()):
        counts[label] = counts.get(label, 0) + n
    if not counts:
        raise ValueError("there are no rows to split")
    if len(counts) > max_labels:
        raise ValueError(f"more than {max_labels} labels to stratify by")
    labels = list(counts)
    cuts = []
    for label, (n_test, n_val) in zip(labels, split_quotas([counts[l] for l in labels], cfg)):
        cuts.append(_Cut(label, "test", n_test))
        cuts.append(_Cut(label, "val", n_test + n_val))
    cuts = [c for c in cuts if c.offset > 0]
    for cut in cuts:
        _descend(cut, buckets)
    while open_cuts := [c for c in cuts if c.rows > RANK_ROWS]:
        depth = len(open_cuts[0].prefix) + DIGITS
        buckets = _histogram(rows.filter(_under(open_cuts)), depth, max_labels)
        for cut in open_cuts:
            _descend(cut, buckets)

    order = Window.partitionBy("label", "_prefix").orderBy("_hash", "row_id")
    ends = []
    for depth in sorted({len(c.prefix) for c in cuts}):
        level = [c for c in cuts if len(c.prefix) == depth]
        ranked = (
            rows.filter(_under(level))
            .withColumn("_prefix", F.substring("_hash", 1, depth))
            .withColumn("_rank", F.row_number().over(order))
        )
        wanted = reduce(
            lambda a, b: a | b,
            [
                (F.col("label") == c.label) & (F.col("_prefix") == c.prefix) & (F.col("_rank") == c.offset)
                for c in level
            ],
        )
        ends += ranked.filter(wanted).collect()  # one row per cut
    at = {(r["label"], r["_prefix"], r["_rank"]): (r["_hash"], r["row_id"]) for r in ends}
    return {(c.label, c.part): at[(c.label, c.prefix, c.offset)] for c in cuts}


def stratified_split(
    df: DataFrame, cfg: PrepConfig = PrepConfig(), keys: DataFrame | None = None, max_labels: int = MAX_LABELS
) -> DataFrame:
    """Add ``split``. Needs unique ``row_id`` and an integer ``label``.

    ``max_labels`` bounds the table of hash prefixes the driver holds (4,096 per
    label); more labels than that are refused, never dropped.

    A few narrow jobs first read ``keys``: ``row_id`` and ``label`` of the same
    rows, by default taken from ``df``. Stage what they read when it is costly.
    """
    narrow = (df if keys is None else keys).select("label", "row_id").withColumn(
        "_hash", row_hash(cfg.random_state, F.col("row_id"))
    )
    cuts = _find_cuts(narrow, cfg, max_labels)

    def reached(part: str) -> Column:
        tests = [
            (F.col("label") == label)
            & ((F.col("_hash") < h) | ((F.col("_hash") == h) & (F.col("row_id") <= r)))
            for (label, p), (h, r) in cuts.items()
            if p == part
        ]
        return reduce(lambda a, b: a | b, tests, F.lit(False))

    return (
        df.withColumn("_hash", row_hash(cfg.random_state, F.col("row_id")))
        .withColumn(
            "split",
            F.when(reached("test"), "test").when(reached("val"), "val").otherwise("train"),
        )
        .drop("_hash")
    )
