"""Exact neighbours in few dimensions, with work per query that does not grow with the table.

A binary tree of cuts, drawn from a sample of the reference rows, deals them to boxes of about BOX_ROWS rows; the corners of a box are
those of its rows. A query meets its own box first, whose k-th row bounds the search, and then only the boxes that come nearer than that.
Of rows with one vector only those with the smallest ids can be neighbours, so copies neither fill a box nor are met twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floodmark.operators.detect.pivot_tree import matrix
from floodmark.plans.staging import stage

#: Rows of a box, boxes at most (beyond, they hold more rows), sample rows per box on the driver, queries of one group of a box.
BOX_ROWS, MAX_BOXES, SAMPLE_ROWS, QUERY_ROWS = 1024, 16_384, 32, 16_384
#: In more dimensions than these a query's surroundings reach into most boxes.
DIMENSIONS = 6
#: References up to this many are compared whole.
FEW_ROWS = 8192
#: Sample rows that either side of a cut must hold.
LEAST_SIDE = 4
NO_ID = 2**63 - 1


@dataclass
class Boxes:
    """Nodes of the tree, parents first: a cut of ``axis`` at ``cut`` (up to it left), or a box (axis -1); corners and rows below each."""

    axis: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    low: np.ndarray
    high: np.ndarray
    count: np.ndarray

    def place(self, x: np.ndarray) -> np.ndarray:
        """Node of the box that each row falls into."""
        at, every = np.zeros(len(x), int), np.arange(len(x))
        while True:
            axis = self.axis[at]
            if (axis < 0).all():
                return at
            child = np.where(x[every, np.maximum(axis, 0)] <= self.cut[at], self.left[at], self.right[at])
            at = np.where(axis < 0, at, child)

    def within(self, x: np.ndarray, reach: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
        """(row, box) of all boxes whose corners leave room for a row within reach."""
        row, node, found = np.arange(len(x)), np.zeros(len(x), int), []
        while len(row):
            gap = np.maximum(np.maximum(self.low[node] - x[row], x[row] - self.high[node]), 0.0)
            gap = gap.sum(axis=1) if metric == "manhattan" else np.sqrt(np.square(gap).sum(axis=1))
            near = gap <= reach[row] * (1.0 + 1e-9) + 1e-9
            row, node = row[near], node[near]
            leaf = self.axis[node] < 0
            found.append((row[leaf], node[leaf]))
            row, node = row[~leaf], node[~leaf]
            row, node = np.concatenate([row, row]), np.concatenate([self.left[node], self.right[node]])
        return tuple(np.concatenate(part) for part in zip(*found)) if found else (row, node)

    def all_within(self, x: np.ndarray, reach: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
        """``within`` for many rows, some at a time."""
        parts = [(np.zeros(0, int), np.zeros(0, int))]
        for start in range(0, len(x), 2048):
            row, node = self.within(x[start : start + 2048], reach[start : start + 2048], metric)
            parts.append((row + start, node))
        return tuple(np.concatenate(part) for part in zip(*parts))

    def sum_up(self) -> None:
        """Corners and counts of inner nodes from those of the boxes below."""
        for node in range(len(self.axis) - 1, -1, -1):
            if self.axis[node] >= 0:
                two = [self.left[node], self.right[node]]
                self.count[node] = self.count[two].sum()
                self.low[node], self.high[node] = self.low[two].min(axis=0), self.high[two].max(axis=0)


def _cut(x: np.ndarray, least: int = LEAST_SIDE) -> tuple[int, float] | None:
    """(axis, value) that parts the rows best: the widest axis whose middle leaves enough rows on both sides."""
    best, most = None, least - 1
    for axis in np.argsort(x.min(axis=0) - x.max(axis=0), kind="stable"):
        values = np.sort(x[:, axis])
        cut = values[(len(values) - 1) // 2]
        if cut == values[-1]:
            below = np.searchsorted(values, cut)
            if not below:
                continue
            cut = values[below - 1]
        left = np.searchsorted(values, cut, side="right")
        side = min(left, len(values) - left)
        if 4 * side >= len(values) and side >= least:
            return int(axis), float(cut)
        if side > most:
            best, most = (int(axis), float(cut)), side
    return best


def draw(sample: np.ndarray, d: int, rows: int = SAMPLE_ROWS, least: int = LEAST_SIDE) -> Boxes:
    """Cuts from the sample, halving it until a box holds ``rows`` of it."""
    axis, cuts, left, right, todo = [-1], [0.0], [0], [0], [(0, sample)]
    while todo:
        node, x = todo.pop()
        found = _cut(x, least) if len(x) > rows else None
        if found is None:
            continue
        below = x[:, found[0]] <= found[1]
        axis[node], cuts[node], left[node], right[node] = *found, len(axis), len(axis) + 1
        for part in (x[below], x[~below]):
            todo.append((len(axis), part))
            for column, value in ((axis, -1), (cuts, 0.0), (left, 0), (right, 0)):
                column.append(value)
    many = len(axis)
    return Boxes(np.array(axis), np.array(cuts), np.array(left), np.array(right), np.full((many, d), np.inf), np.full((many, d), -np.inf), np.zeros(many, int))


def _measured(boxes: Boxes, placed: DataFrame, d: int, least: int) -> np.ndarray:
    """Fill in corners and counts from the placed rows; a cut with fewer than ``least`` rows on a side is taken back. The box of every node."""
    ends = [f(F.get("v", F.lit(i))).alias(f"{f.__name__}{i}") for i in range(d) for f in (F.min, F.max)]
    for r in placed.groupBy("box").agg(F.count("*").alias("n"), *ends).collect():
        boxes.count[r["box"]] = r["n"]
        boxes.low[r["box"]], boxes.high[r["box"]] = [r[f"min{i}"] for i in range(d)], [r[f"max{i}"] for i in range(d)]
    boxes.sum_up()
    for node in np.flatnonzero(boxes.axis >= 0):
        if boxes.count[[boxes.left[node], boxes.right[node]]].min() < least:
            boxes.axis[node] = -1
    box = np.arange(len(boxes.axis))
    for node in range(len(box)):  # parents come first: below a box everything belongs to it
        if boxes.axis[node] < 0 or box[node] != node:
            box[[boxes.left[node], boxes.right[node]]] = box[node] if boxes.left[node] else box[[boxes.left[node], boxes.right[node]]]
    return box


def _finite(df: DataFrame) -> DataFrame:
    """Rows whose vector has a place."""
    return df.where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def _compared(asked: DataFrame, offered: DataFrame, many: int, work, schema: str, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``work(queries, rows)`` for every box, its queries cut into groups of about ``query_rows`` and its rows repeated for each."""
    groups = asked.groupBy("box").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("_groups"))
    groups = F.broadcast(stage(groups, "box-load"))  # at most one small row per box
    asking = asked.join(groups, "box").withColumn("_group", F.pmod(F.xxhash64("key"), "_groups").cast("int")).drop("_groups")
    offering = offered.join(groups, "box").withColumn("_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1))).drop("_groups")
    # few bytes but much work per box: a fixed number of partitions is not merged by AQE
    tasks = max(asked.sparkSession.sparkContext.defaultParallelism * 3, min(many, 512))
    asking, offering = (df.repartition(tasks, "box", "_group") for df in (asking, offering))
    return asking.groupBy("box", "_group").cogroup(offering.groupBy("box", "_group")).applyInArrow(work, schema)


def _placing(boxes: Broadcast):
    """A map of batches that adds the box of every row."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.append_column("box", pa.array(boxes.value.place(matrix(batch.column("v"))), pa.int32()))

    return place


def _lists(parts: np.ndarray, of: int, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Values as one list per query 0 .. of - 1, ``parts`` (ascending) saying whose they are."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(parts, np.arange(of + 1)), pa.int32()), pa.array(values, kind))


def _reach(q: np.ndarray, dist: np.ndarray, of: int, k: int) -> np.ndarray:
    """As far as distances that count as equal to the k-th one of each query (ascending), without a bound where fewer were found."""
    from floodmark.operators.detect.neighbors import DIGITS

    reach, found = np.full(of, np.inf), np.bincount(q, minlength=of)
    last = np.cumsum(found) - 1
    reach[found >= k] = dist[last[found >= k]] + 2 * 10.0**-DIGITS
    return reach


def deal(ref: DataFrame, needed: int, d: int, n: int, seed: int, box_rows: int) -> tuple[Boxes, DataFrame]:
    """Boxes of about ``box_rows`` of the ``n`` rows (r_id, v), each with ``needed`` rows or more, and the rows with their box."""
    spark = ref.sparkSession
    copies = Window.partitionBy("v").orderBy("r_id")
    rows = _finite(ref).select(F.coalesce("r_id", F.lit(NO_ID)).alias("r_id"), "v")
    rows = rows.withColumn("_copy", F.dense_rank().over(copies)).where(F.col("_copy") <= needed).drop("_copy")
    wanted = int(min(MAX_BOXES, max(1, n // box_rows)))
    share = min(1.0, wanted * SAMPLE_ROWS / max(n, 1))
    rows = stage(rows, "box-ref")
    drawn = rows.where(F.pmod(F.xxhash64(F.lit(seed), "r_id", "v"), F.lit(1 << 30)) < share * (1 << 30))
    drawn = matrix(drawn.select("v").toArrow().column("v")).reshape(-1, d) if wanted > 1 else np.zeros((0, d))
    boxes = draw(drawn, d)
    cuts = spark.sparkContext.broadcast(boxes)

    placed = stage(rows.mapInArrow(_placing(cuts), "r_id long, v array<double>, box int"), "box-rows")
    own_box = _measured(boxes, placed, d, needed)
    if (own_box != np.arange(len(own_box))).any():
        moved = spark.createDataFrame([(i, int(b)) for i, b in enumerate(own_box)], "box int, _to int")
        placed = placed.join(F.broadcast(moved), "box").select("r_id", "v", F.col("_to").alias("box"))
    return boxes, placed


def nearest(queries: DataFrame, ref: DataFrame, k: int, d: int, n: int, metric: str, exclude_self: bool = False, seed: int = 42, box_rows: int = BOX_ROWS) -> DataFrame:
    """(q_id, n_id, dist, rank) for rows (q_id, v) and ``n`` rows (r_id, v) of ``d`` numbers; every query row is answered on its own.

    ``metric`` is euclidean or manhattan. Rows whose vector holds nulls or no finite numbers neither ask nor are found.
    """
    from floodmark.operators.detect.neighbors import DIGITS, top_k

    spark, needed = ref.sparkSession, k + 1 if exclude_self else k
    boxes, placed = deal(ref, needed, d, n, seed, box_rows)
    known = spark.sparkContext.broadcast(boxes)
    many = int((boxes.axis < 0).sum())
    # a key of its own for every query row, written with it: ids may repeat
    asked = stage(_finite(queries).select(F.monotonically_increasing_id().alias("key"), "q_id", F.coalesce("q_id", F.lit(-1 - NO_ID)).alias("own"), "v"), "box-queries")
    asked = asked.mapInArrow(_placing(known), "key long, q_id long, own long, v array<double>, box int")

    def best(own: pa.Table, offered: pa.Table, reach: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        x = matrix(own.column("v"))
        q, n_id, dist, _ = top_k(x, matrix(offered.column("v")), np.asarray(offered.column("r_id")), k, metric, np.asarray(own.column("own")) if exclude_self else None, reach)
        return x, q, n_id, dist

    home_schema = pa.schema([("key", pa.int64()), ("q_id", pa.int64()), ("own", pa.int64()), ("v", pa.list_(pa.float64())), ("n_ids", pa.list_(pa.int64())), ("dists", pa.list_(pa.float64())), ("reach", pa.float64()), ("boxes", pa.list_(pa.int32()))])

    def at_home(own: pa.Table, offered: pa.Table) -> pa.Table:
        if not own.num_rows or not offered.num_rows:
            return home_schema.empty_table()
        x, q, n_id, dist = best(own, offered, None)
        of, box = own.num_rows, own.column("box")[0].as_py()
        reach = _reach(q, dist, of, k)
        row, node = known.value.all_within(x, reach, metric)
        row, node = row[node != box], node[node != box]
        order = np.argsort(row, kind="stable")
        columns = [own.column("key"), own.column("q_id"), own.column("own"), own.column("v"), _lists(q, of, n_id, pa.int64()), _lists(q, of, dist, pa.float64()), pa.array(reach), _lists(row[order], of, node[order], pa.int32())]
        return pa.table([c.cast(f.type) for c, f in zip(columns, home_schema)], schema=home_schema)

    home = stage(_compared(asked, placed, many, at_home, "key long, q_id long, own long, v array<double>, n_ids array<long>, dists array<double>, reach double, boxes array<int>"), "box-home")
    more_schema = pa.schema([("key", pa.int64()), ("n_ids", pa.list_(pa.int64())), ("dists", pa.list_(pa.float64()))])

    def beyond(own: pa.Table, offered: pa.Table) -> pa.Table:
        if not own.num_rows or not offered.num_rows:
            return more_schema.empty_table()
        _, q, n_id, dist = best(own, offered, np.asarray(own.column("reach")))
        out = pa.table([own.column("key").combine_chunks(), _lists(q, own.num_rows, n_id, pa.int64()), _lists(q, own.num_rows, dist, pa.float64())], schema=more_schema)
        return out.filter(pa.array(np.bincount(q, minlength=own.num_rows) > 0))

    further = home.select("key", "own", "v", "reach", F.explode("boxes").alias("box"))
    more = _compared(further, placed, many, beyond, "key long, n_ids array<long>, dists array<double>")
    found = home.select("key", "q_id", "n_ids", "dists").unionByName(more.withColumn("q_id", F.lit(None).cast("long")))
    pairs = F.transform(F.arrays_zip("n_ids", "dists"), lambda p: F.struct(F.round(p["dists"], DIGITS).alias("near"), p["n_ids"].alias("n_id"), p["dists"].alias("dist")))
    merged = found.groupBy("key").agg(F.max("q_id").alias("q_id"), F.slice(F.sort_array(F.flatten(F.collect_list(pairs))), 1, k).alias("found"))
    ranked = merged.select("q_id", F.posexplode("found").alias("pos", "p"))
    return ranked.select("q_id", F.nullif(F.col("p.n_id"), F.lit(NO_ID)).alias("n_id"), F.col("p.dist").alias("dist"), (F.col("pos") + 1).alias("rank"))
