"""Links of large groups of similar documents, without all pairs of a group.

A group is what documents share: a band, an n-gram, a set. Equal sets are linked
through their smallest id. Larger groups are first paired with their most central
member. Groups that have it in common are one family, so the many groups that near
copies share count once. Once components are known, the members of a family that are
in different ones are compared with each other, in cells of bounded size, and a cell
gives no more links than connect its components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textprep.llm.overlap import Incidence, overlap_needed, packed_texts, sets_of
from textprep.operators.skew import lookup
from textprep.session import stage

# Equal sets are combined per salt first, so that no task looks up a hot set alone.
SALTS = 32
# Members of a group in a block, and n-grams of the members of a family in a block.
CELL_MEMBERS = 1024
CELL_SHINGLES = 500_000


def possible(percent: int, n_a, pos_a, n_b, pos_b):
    """Whether sizes and places allow the overlap, taking the shared n-gram as the first.

    A place counts the elements that come before it in a common order; 0 says nothing.
    """
    need = overlap_needed(percent, n_a, n_b)
    return (np.minimum(n_a - pos_a, n_b - pos_b) >= need) & (np.minimum(n_a, n_b) >= need)


def equal_sets(sets: DataFrame, key: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of each id to the smallest with the same key, and (key, doc_id) of those.

    ``sets`` has doc_id, not null, and the key columns.
    """
    held = sets.select("doc_id", *key, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    salted = held.groupBy(*key, "salt").agg(F.min("doc_id").alias("low"))
    least = stage(salted.groupBy(*key).agg(F.min("low").alias("doc_id"), F.collect_list("salt").alias("salts")), f"{name}-sets")
    classes = least.select(*key, F.col("doc_id").alias("b"), F.explode("salts").alias("salt"))  # SALTS at most
    copies = held.join(classes, [*key, "salt"]).select(F.col("doc_id").alias("a"), "b").filter("a <> b")
    return stage(copies.distinct(), f"{name}-copies"), least.select(*key, "doc_id")


def families(crowd: DataFrame, name: str) -> DataFrame:
    """leader, m, doc_id, n: each member with the most central one of its groups, staged.

    ``crowd`` is staged: key, doc_id, n and ``central``, larger for more central ones;
    m is the leader's n.
    """
    lead = F.max(F.struct("central", "doc_id", "n"))
    leaders = crowd.groupBy("key").agg(lead["doc_id"].alias("leader"), lead["n"].alias("m"), F.count(F.lit(1)).alias("members"))
    leaders = stage(leaders, f"{name}-leaders")
    met = lookup(crowd.select("key", "doc_id", "n"), leaders, "key", ["leader", "m"], "doc_id", "members")
    return stage(met.select("leader", "m", "doc_id", "n").distinct(), f"{name}-families")


def starred(family: DataFrame) -> DataFrame:
    """Pairs (a, n_a, b, n_b) of each member with its leader."""
    first = F.col("doc_id") < F.col("leader")
    return family.filter("doc_id <> leader").select(
        F.least("doc_id", "leader").alias("a"),
        F.when(first, F.col("n")).otherwise(F.col("m")).alias("n_a"),
        F.greatest("doc_id", "leader").alias("b"),
        F.when(first, F.col("m")).otherwise(F.col("n")).alias("n_b"),
    )


def _dealt(met: DataFrame, size: Column, out: Column, capacity: int, members: list[str]) -> DataFrame:
    """Members of mixed groups in cells (key, column, line), with ``meets`` and ``owner``.

    Every member owns a cell of each line in its own column; an outsider meets the
    owners of its own line in each column.
    """
    columns, lines = (F.ceil(x / capacity).cast("int") for x in (size, out))
    spot = lambda seed, count: F.pmod(F.xxhash64("doc_id", F.lit(seed)), count).cast("int")
    known = met.withColumn("outsider", F.col("root") != F.col("top"))
    every_line = F.explode(F.sequence(F.lit(0), lines - 1))
    as_member = known.select("*", spot(1, columns).alias("column"), every_line.alias("line"), F.lit(True).alias("owner"))
    every_column = F.explode(F.sequence(F.lit(0), columns - 1))
    as_outsider = known.filter("outsider").select("*", every_column.alias("column"), spot(2, lines).alias("line"), F.lit(False).alias("owner"))
    both = as_member.unionByName(as_outsider).groupBy("key", "column", "line", *members, "outsider")
    dealt = both.agg(F.max(~F.col("owner")).alias("meets"), F.max("owner").alias("owner"))
    return dealt.select(F.xxhash64("key", "column", "line").alias("cell"), *members, "meets", "outsider", "owner")


def _rooted(members: DataFrame, roots: DataFrame, weight: str, name: str) -> DataFrame:
    """Members of groups with several components: ``root``, and of the group the largest
    component ``top``, the weight ``size`` of all and ``out`` of the others."""
    component = roots.select(F.col("node").alias("doc_id"), "component")
    rooted = members.join(component, "doc_id", "left").withColumn("root", F.coalesce("component", "doc_id")).drop("component")
    rooted = stage(rooted, f"{name}-rooted")
    per_root = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"), F.sum(F.expr(weight)).alias("w"))
    top = F.max(F.struct("m", "root", "w"))
    sizes = per_root.groupBy("key").agg(
        top["root"].alias("top"), F.sum("m").alias("members"), F.sum("w").alias("size"), (F.sum("w") - top["w"]).alias("out")
    )
    facts = sizes.select("key", "members", *[F.when(F.col("out") > 0, F.col(c)).alias(c) for c in ("top", "size", "out")])
    facts = stage(facts, f"{name}-mixed")
    return lookup(rooted, facts, "key", ["top", "size", "out"], "doc_id", "members").filter("top is not null")


_PLACED = ("doc_id", "n", "pos", "root", "meets", "outsider", "owner")


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of one cell at a time, out of batches sorted by cell."""
    held: list[pa.RecordBatch] = []

    def whole() -> list[np.ndarray]:
        return [np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in _PLACED]

    for batch in batches:
        cell = batch.column("cell").to_numpy()
        edges = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1, [len(cell)]])
        for start, stop in zip(edges[:-1], edges[1:]):
            if held and held[-1].column("cell")[0].as_py() != cell[start]:
                yield whole()
                held = []
            if stop > start:
                held.append(batch.slice(start, stop - start))
    if held:
        yield whole()


def _cross(percent: int):
    """Per cell of a group: possible pairs of its outsiders with the other members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, n, pos, root, meets, outsider, owner in _cells(batches):
            for o in np.flatnonzero(meets):
                # Two outsiders meet in each other's cells: the smaller id takes the pair.
                partner = (root != root[o]) & owner & (~outsider | (doc > doc[o])) & possible(percent, n, pos, n[o], pos[o])
                other, m = doc[partner], n[partner]
                if len(other):
                    first = other < doc[o]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.minimum(other, doc[o])), pa.array(np.where(first, m, n[o])),
                            pa.array(np.maximum(other, doc[o])), pa.array(np.where(first, n[o], m)),
                        ],
                        names=["a", "n_a", "b", "n_b"],
                    )

    return run


def cross_pairs(crowd: DataFrame, roots: DataFrame, percent: int, name: str) -> DataFrame:
    """Pairs (a, n_a, b, n_b) of a group whose components differ and whose places allow it.

    ``crowd`` has key, doc_id, n and pos, ``roots`` node and component. A group of one
    component costs nothing here.
    """
    met = _rooted(crowd.select("key", "doc_id", "n", "pos"), roots, "1", name)
    cells = _dealt(met, F.col("size"), F.col("out"), CELL_MEMBERS, ["doc_id", "n", "pos", "root"])
    by_cell = cells.repartition("cell").sortWithinPartitions("cell")
    return by_cell.mapInArrow(_cross(percent), "a bigint, n_a bigint, b bigint, n_b bigint").distinct()


_MEMBER = ("doc_id", "root", "meets", "outsider", "owner")


def _cell_links(size: int, percent: int, prune: Callable | None):
    """Links between the components of a cell: each found pair unites two of them."""

    def run(key: tuple, cell: pa.Table) -> pa.Table:
        doc, label, meets, outsider, owner = (cell.column(c).to_numpy().copy() for c in _MEMBER)
        sets = list(sets_of(cell.column("thing"), size))
        rows = Incidence(sets)
        rank = None if prune is None else prune(sets)
        n, links = rows.sizes, ([], [])
        for o in np.flatnonzero(meets & (n > 0)).tolist():
            bound = overlap_needed(percent, n, n[o])
            # Two outsiders meet in each other's cells: the smaller id takes the pair.
            can = (label != label[o]) & owner & (~outsider | (doc > doc[o])) & (np.minimum(n, n[o]) >= bound) & (n > 0)
            partners = np.flatnonzero(can)
            if rank is not None and len(partners):
                partners = rank(o, partners)
            start, step = 0, 16
            while start < len(partners):
                some = partners[start : start + step]
                some = some[label[some] != label[o]]
                similar = some[rows.overlaps(o, some) >= bound[some]] if len(some) else some
                for p in similar.tolist():
                    if label[p] != label[o]:
                        links[0].append(min(doc[o], doc[p]))
                        links[1].append(max(doc[o], doc[p]))
                        label[label == label[p]] = label[o]
                start, step = start + step, 2 * step
        return pa.table({"a": pa.array(links[0], pa.int64()), "b": pa.array(links[1], pa.int64())})

    return run


def cross_links(
    docs: DataFrame, family: DataFrame, roots: DataFrame, size: int, percent: int, name: str, prune: Callable | None = None
) -> DataFrame:
    """Links (a, b) that connect components within a family, staged.

    ``roots`` has node and component. A family of one component costs nothing here.
    ``prune`` gets
    the sets of a cell and gives a function that orders the partners of a member and
    leaves out the unlikely ones.
    """
    members = family.select(F.col("leader").alias("key"), "doc_id", "n")
    met = _rooted(members, roots, "n", name)
    dealt = stage(_dealt(met, F.col("size"), F.col("out"), CELL_SHINGLES, ["doc_id", "root"]), f"{name}-dealt")
    brought = packed_texts(docs, dealt).join(dealt.hint("merge"), "doc_id").select("cell", *_MEMBER, "thing")
    found = brought.groupBy("cell").applyInArrow(_cell_links(size, percent, prune), "a bigint, b bigint")
    return stage(found.distinct(), f"{name}-cross")
