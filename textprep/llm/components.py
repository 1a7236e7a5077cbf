"""Connected components by alternating star operations, for links of any number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textprep.session import stage


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (the smallest id reachable) for every id in ``links`` (a, b).

    A large-star step hangs the larger neighbours of each node under its
    smallest neighbour, a small-star step the smaller ones. Both are a grouped
    minimum and a join on the node, and rounds grow with the logarithm of the
    longest chain. Each round is written to the shared folder, which cuts the
    lineage. Ends when a round changes nothing.
    """
    edges = stage(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    mark = _mark(edges)
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").filter((F.col("b") > F.col("a")) & (F.col("b") != F.col("m"))).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(floor, "a").filter(F.col("b") != F.col("m")).select("b", "m")
        small = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(floor.select("a", F.col("m").alias("b")))
        edges = stage(small.filter(F.col("a") != F.col("b")).distinct(), "links")
        mark, before = _mark(edges), mark
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]
