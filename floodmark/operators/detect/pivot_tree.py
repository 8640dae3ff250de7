"""Approximate neighbours through trees of pivots, with bounded work per query.

A tree deals the reference rows to leaves: the root's rows choose the nearest of up to ``FANOUT`` pivots, those of each branch the nearest
of the branch's own pivots, and so on until a node holds at most ``LEAF_ROWS`` rows. Pivots are drawn among a node's rows
by a hash of the id. Nodes and pivots are tables: rows and queries go down level by level through equi-joins on the node, in
groups of bounded size, so neither a big node nor its pivots meet one task or the driver.

A query goes down with a beam: at each level it keeps the ``beam`` nearest of all pivots seen there, so it meets at most
beam * FANOUT pivots a level and the rows of at most ``beam`` leaves per tree, whatever the size of the table. Several trees (different
hashes) make up for borders that a tree draws between neighbours. Candidates of all trees are measured exactly and the k best stay.

Nodes of equal rows cannot be parted by pivots and are cut by the hash into leaves that are met together; ids break ties.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floodmark.plans.staging import stage

#: Pivots of a node, rows of a leaf, levels at most, rows of one group of a join, trees and beam unless a caller says otherwise.
FANOUT, LEAF_ROWS, MAX_LEVELS, GROUP_ROWS = 16, 256, 12, 4096
TREES, BEAM = 4, 8
#: Rows and numbers of one group of queries, or of one block of a leaf, that are compared with each other.
COMPARED_ROWS, COMPARED_VALUES = 32_768, 2_000_000
#: A search that needs a wider beam than this meets fewer, bigger leaves instead (``cut_back``), so a query does not travel with thousands of nodes.
MAX_BEAM = 32


@dataclass
class PivotTree:
    """Tables of a tree: ``pivots`` (level, node, child, p) and ``leaves`` (node, r_id, v); ``levels`` of pivots."""

    pivots: DataFrame
    leaves: DataFrame
    levels: int
    metric: str


def cut_back(tree: PivotTree, levels: int, fanout: int = FANOUT) -> PivotTree:
    """The tree with ``levels`` of pivots only: leaves further down go together in their ancestor there."""
    first_below = (fanout ** (levels + 1) - 1) // (fanout - 1)
    node = F.col("node")
    for _ in range(tree.levels - levels):
        node = F.when(node >= first_below, F.floor((node - 1) / fanout).cast("long")).otherwise(node)
    return PivotTree(tree.pivots.where(F.col("level") < levels), tree.leaves.withColumn("node", node), levels, tree.metric)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column (all of one length) as an array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distances (squared for euclidean) of all pairs."""
    if metric in ("manhattan", "hamming"):
        out = np.empty((len(a), len(b)))
        step = max(1, 2_000_000 // max(1, b.size))
        for i in range(0, len(a), step):
            part = a[i : i + step, None, :]
            out[i : i + step] = np.abs(part - b).sum(axis=2) if metric == "manhattan" else (part != b).mean(axis=2)
        return out
    return np.maximum(np.square(a).sum(axis=1)[:, None] + np.square(b).sum(axis=1) - 2.0 * (a @ b.T), 0.0)


def _met(rows: DataFrame, pivots: DataFrame, sizes: DataFrame, row_id: str, work, schema: str) -> DataFrame:
    """``work(rows, pivots)`` for every node, its rows cut into groups of about GROUP_ROWS and its pivots repeated for each."""
    groups = sizes.select("node", F.ceil(F.col("n") / GROUP_ROWS).cast("int").alias("_groups"))
    dealt = rows.join(groups, "node").withColumn("_group", F.pmod(F.xxhash64(row_id), "_groups").cast("int")).drop("_groups")
    offered = pivots.join(groups, "node").withColumn("_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1))).drop("_groups")
    return dealt.groupBy("node", "_group").cogroup(offered.groupBy("node", "_group")).applyInArrow(work, schema)


def _draw_pivots(rows: DataFrame, sizes: DataFrame, seed: int, fanout: int) -> DataFrame:
    """Up to ``fanout`` distinct rows of every node, the first ones in the order of a hash of the id.

    Of a big node only the rows whose hash lies below a bound go to the window, some 4 * fanout of them.
    """
    unit = (F.pmod(F.xxhash64(F.lit(seed), "r_id"), F.lit(1 << 30)) / float(1 << 30)).alias("_u")
    few = rows.join(sizes, "node").select("node", "r_id", "v", "n", unit).where(F.col("_u") * F.col("n") <= 4.0 * fanout + 64)
    distinct = few.groupBy("node", "v").agg(F.min(F.struct("_u", "r_id")).alias("_first"))
    order = Window.partitionBy("node").orderBy("_first")
    drawn = distinct.withColumn("child", F.row_number().over(order) - 1).where(F.col("child") < fanout)
    return drawn.select("node", F.col("child").cast("int").alias("child"), F.col("v").alias("p"))


def build_tree(ref: DataFrame, metric: str = "euclidean", seed: int = 1, fanout: int = FANOUT, leaf_rows: int = LEAF_ROWS) -> PivotTree:
    """``ref``: r_id (long) and v (array of double). Every level of rows and pivots is staged once."""
    spark = ref.sparkSession
    rows = ref.select(F.lit(0).cast("long").alias("node"), "r_id", "v")
    sizes = stage(rows.groupBy("node").agg(F.count("*").alias("n")), "tree-sizes")
    pivot_tables, leaf_tables, levels = [], [], 0

    def nearest(own: pa.Table, offered: pa.Table) -> pa.Table:
        node = pa.array(np.zeros(0), pa.int64())
        if own.num_rows:
            parent, child = offered.column("node")[0].as_py(), np.asarray(offered.column("child"))
            gaps = distances(matrix(own.column("v")), matrix(offered.column("p")), metric)
            node = pa.array(parent * fanout + 1 + child[gaps.argmin(axis=1)], pa.int64())
        return pa.table([node, own.column("r_id"), own.column("v")], names=["node", "r_id", "v"])

    while levels < MAX_LEVELS:
        big = sizes.where(F.col("n") > leaf_rows)
        pivots = stage(_draw_pivots(rows, big, seed + levels, fanout).withColumn("level", F.lit(levels)), "tree-pivots")
        # nodes whose rows are all equal have one pivot only and stay leaves, whatever their size
        parted = pivots.groupBy("node").agg(F.count("*").alias("_many")).where("_many > 1").select("node")
        inner = stage(big.join(parted, "node"), "tree-inner")
        if inner.isEmpty():
            break
        leaf_tables.append(rows.join(inner.select("node"), "node", "left_anti").select("node", "r_id", "v"))
        pivots = pivots.join(inner.select("node"), "node", "left_semi")
        pivot_tables.append(pivots)
        rows = stage(_met(rows.join(inner.select("node"), "node", "left_semi"), pivots.drop("level"), inner, "r_id", nearest, "node long, r_id long, v array<double>"), "tree-rows")
        sizes = stage(rows.groupBy("node").agg(F.count("*").alias("n")), "tree-sizes")
        levels += 1
    leaf_tables.append(rows)
    leaves = leaf_tables[0]
    for more in leaf_tables[1:]:
        leaves = leaves.unionByName(more)
    table = spark.createDataFrame([], "node long, child int, p array<double>, level int")
    for more in pivot_tables:
        table = table.unionByName(more)
    return PivotTree(table, stage(leaves, "tree-leaves"), levels, metric)


def descend(queries: DataFrame, tree: PivotTree, beam: int = BEAM, fanout: int = FANOUT) -> DataFrame:
    """``q_id``, ``v`` and ``node`` of the leaves that each query reaches, at most ``beam`` of them.

    Leaves above the last level stay in the beam with the distance of their pivot, and are found again at each level.
    """
    # ids may come with several vectors or be null: a beam belongs to an id and its vector
    asked = queries.select("q_id", "v").dropDuplicates().withColumn("_key", F.xxhash64("q_id", "v"))
    beamed = asked.select("q_id", "_key", F.lit(0).cast("long").alias("node"), F.lit(0.0).alias("gap"))

    def with_vectors(beam: DataFrame) -> DataFrame:
        own = asked.withColumnsRenamed({"q_id": "_q_id", "_key": "_own"})
        return beam.join(own, (F.col("_key") == F.col("_own")) & F.col("q_id").eqNullSafe(F.col("_q_id"))).drop("_q_id", "_own")

    metric = tree.metric

    def spread(own: pa.Table, offered: pa.Table) -> pa.Table:
        if not own.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64())], names=["q_id", "_key", "node", "gap"])
        if not offered.num_rows:  # a leaf
            return own.select(["q_id", "_key", "node", "gap"])
        gaps = distances(matrix(own.column("v")), matrix(offered.column("p")), metric)
        child = np.asarray(offered.column("node")) * fanout + 1 + np.asarray(offered.column("child"))
        many = min(beam, gaps.shape[1])
        best = np.argpartition(gaps, many - 1, axis=1)[:, :many]
        picked = own.select(["q_id", "_key"]).take(pa.array(np.repeat(np.arange(own.num_rows), many)))
        return picked.append_column("node", pa.array(child[best].ravel(), pa.int64())).append_column("gap", pa.array(np.take_along_axis(gaps, best, axis=1).ravel()))

    for level in range(tree.levels):
        sizes = beamed.groupBy("node").agg(F.count("*").alias("n"))
        pivots = tree.pivots.where(F.col("level") == level).drop("level")
        # the vectors are joined to the few nodes of a beam; all nodes seen go through the window without them
        met = _met(with_vectors(beamed), pivots, sizes, "_key", spread, "q_id long, _key long, node long, gap double")
        order = Window.partitionBy("q_id", "_key").orderBy("gap", "node")
        kept = met.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= beam).drop("_rank")
        beamed = stage(kept, "tree-beam")
    return with_vectors(beamed).select("q_id", "v", "node")


def compared(reached: DataFrame, tree: PivotTree, k: int, exclude_self: bool = False) -> DataFrame:
    """The k nearest rows (q_id, n_id, dist) of every leaf that a query reached (``descend``)."""
    from floodmark.operators.detect.neighbors import top_k

    metric = tree.metric
    sizes = tree.leaves.groupBy("node").agg(F.count("*").alias("n"), F.greatest(F.max(F.size("v")), F.lit(1)).alias("d"))
    sizes = sizes.withColumn("_most", F.least(F.lit(COMPARED_ROWS), F.ceil(F.lit(COMPARED_VALUES) / F.col("d"))))
    blocks = sizes.select("node", F.ceil(F.col("n") / F.col("_most")).cast("int").alias("_blocks"), "_most")
    load = reached.groupBy("node").agg(F.count("*").alias("_load"))
    both = blocks.join(load, "node").select("node", "_blocks", F.ceil(F.col("_load") / F.col("_most")).cast("int").alias("_groups"))
    both = stage(both, "tree-load")
    asking = reached.join(both, "node").withColumn("_group", F.pmod(F.xxhash64("q_id"), "_groups").cast("int"))
    asking = asking.withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks", "_groups")
    offering = tree.leaves.join(both, "node").withColumn("_block", F.pmod(F.xxhash64("r_id"), "_blocks").cast("int"))
    offering = offering.withColumn("_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1))).drop("_blocks", "_groups")

    def compare(asked: pa.Table, offered: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if asked.num_rows and offered.num_rows:
            ids = np.asarray(asked.column("q_id"))
            q, n, dist, _ = top_k(matrix(asked.column("v")), matrix(offered.column("v")), np.asarray(offered.column("r_id")), k, metric, ids if exclude_self else None)
            found = [ids[q], n, dist]
        return pa.table([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())], names=["q_id", "n_id", "dist"])

    keys = ["node", "_group", "_block"]
    return asking.groupBy(*keys).cogroup(offering.groupBy(*keys)).applyInArrow(compare, "q_id long, n_id long, dist double")


def search(queries: DataFrame, trees: list[PivotTree], k: int, exclude_self: bool = False, beam: int = BEAM, fanout: int = FANOUT) -> tuple[DataFrame, DataFrame]:
    """(q_id, n_id, dist) of each query's candidates, the k best of every leaf met, and (q_id, met): the rows that it was compared with."""
    found, met = [], []
    for tree in trees:
        reached = descend(queries, tree, beam, fanout)
        found.append(compared(reached, tree, k, exclude_self))
        met.append(reached.join(tree.leaves.groupBy("node").agg(F.count("*").alias("n")), "node").select("q_id", "n"))
    found, met = (reduce(DataFrame.unionByName, x) for x in (found, met))
    # one leaf's rows may come again from another tree, with the same distance but for its last bits
    return found.groupBy("q_id", "n_id").agg(F.min("dist").alias("dist")), met.groupBy("q_id").agg(F.sum("n").alias("met"))
