"""Nearest neighbours.

A reference side of proven small size is broadcast. A bigger one of few dimensions is dealt to boxes (``boxes``). One of many dimensions
is grouped around hash-drawn pivots into cells: a query first meets its own cell, which bounds the distance of its k-th neighbour, and then only the
cells that can hold a nearer row by the triangle inequality. Cells are cut into bounded blocks and the
queries into bounded groups, small cells go together, so a cell of duplicates or a hot cell is spread over many tasks.
Each (block, query group) yields at most the k best rows per query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floodmark.functions.scores import flag_above
from floodmark.operators.detect import boxes, factors, pivot_tree
from floodmark.operators.detect.thresholds import percentile_threshold
from floodmark.plans.moments import mean_and_covariance
from floodmark.plans.ordering import order_hash, take_in_hash_order
from floodmark.plans.sizing import skew_join, spread
from floodmark.plans.staging import stage

BLOCK_ROWS = 8192
QUERY_ROWS = 32_768
BROADCAST_VALUES = 4_000_000
MAX_PIVOTS = 256
#: Of an approximate index: cells hold about ``block_rows`` rows up to this many of them (65,536 vectors on the driver).
MAX_PROBED_PIVOTS = 1 << 16
#: Queries whose exact neighbours tell how many cells an approximate search needs, and what is added to the recall asked for,
#: some three standard errors of the sample.
SAMPLE_QUERIES, SAMPLE_MARGIN = 400, 0.03
MAX_TASKS = 20_000
#: Query groups are cut smaller, down to so many rows, until every core has so many pairs of a group and a bundle.
LEAST_QUERY_ROWS, PAIRS_PER_CORE = 2048, 6
#: Rows and numbers of the cells that are compared with one group of queries.
BUNDLE_ROWS, BUNDLE_VALUES = 65_536, 4_000_000
METRICS = ("euclidean", "manhattan", "cosine", "mahalanobis", "hamming")


def _pair_distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distances of aligned rows."""
    if metric == "manhattan":
        return np.abs(a - b).sum(axis=1)
    if metric == "hamming":
        return (a != b).mean(axis=1)
    return np.sqrt(np.square(a - b).sum(axis=1))


def _all_distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    if metric in ("manhattan", "hamming"):
        out = np.empty((len(a), len(b)))
        step = max(1, 4_000_000 // max(1, b.size))
        for i in range(0, len(a), step):
            part = a[i : i + step, None, :]
            out[i : i + step] = np.abs(part - b).sum(axis=2) if metric == "manhattan" else (part != b).mean(axis=2)
        return out
    squared = np.square(a).sum(axis=1)[:, None] + np.square(b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0.0))


def _levels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float] | None:
    """Both sides as whole numbers 0 .. 255 of one scale, the size of a step, and the most that a manhattan distance in them is off."""
    low, high = min(a.min(), b.min()), max(a.max(), b.max())
    if not np.isfinite(high - low) or a.shape[1] > 256:  # sums of steps must fit 16 bits
        return None
    step = (high - low) / 255.0 or 1.0
    a, b = (np.ascontiguousarray(np.rint((x - low) / step).astype(np.uint8).T) for x in (a, b))
    return a, b, step, step * len(a) * (1.0 + 1e-6)


def _codes(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Numbers of the distinct values per column, in one byte; equal codes are equal values."""
    out = np.empty((a.shape[1], len(a) + len(b)), np.uint8)
    if a.shape[1] > 254 or not len(a) or not len(b):  # 255 stands for a hidden pair
        return None
    for j in range(a.shape[1]):
        values, code = np.unique(np.concatenate([a[:, j], b[:, j]]), return_inverse=True, equal_nan=False)
        if len(values) > 256:
            return None
        out[j] = code
    return out[:, : len(a)], out[:, len(a) :]


#: Pairs whose distances are added up at once, column by column, in the cache.
TILE_ROWS, TILE_COLUMNS = 64, 2048


def _steps(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Manhattan distances in steps, or numbers of unequal codes, of all pairs of two sides laid out by column."""
    out = np.zeros((a.shape[1], b.shape[1]), np.uint16 if metric == "manhattan" else np.uint8)
    for i in range(0, a.shape[1], TILE_ROWS):
        for j in range(0, b.shape[1], TILE_COLUMNS):
            tile = out[i : i + TILE_ROWS, j : j + TILE_COLUMNS]
            total, gap, least = np.zeros(tile.shape, out.dtype), np.empty(tile.shape, np.uint8), np.empty(tile.shape, np.uint8)
            for x, y in zip(a[:, i : i + TILE_ROWS, None], b[:, None, j : j + TILE_COLUMNS]):
                if metric == "manhattan":
                    np.maximum(x, y, out=gap)
                    np.minimum(x, y, out=least)
                    np.subtract(gap, least, out=gap)
                else:
                    np.not_equal(x, y, out=gap.view(bool))
                np.add(total, gap, out=total)
            tile[:] = total
    return out


def _screened(queries: np.ndarray, refs: np.ndarray, k: int, metric: str, hidden: np.ndarray, reach: np.ndarray | None, sides: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that can be among the k nearest, from distances of small whole numbers that are off by a known amount at most."""
    steps = _steps(sides[0], sides[1], metric)
    step, off = (sides[2], sides[3]) if metric == "manhattan" else (1.0 / queries.shape[1], 0.0)
    top = np.iinfo(steps.dtype).max
    if hidden is not None:
        steps[hidden] = top
    limit = np.full(len(queries), np.inf)
    if len(refs) > k:
        kth = np.partition(steps, k - 1, axis=1)[:, k - 1]
        limit = np.where(kth == top, np.inf, kth * step + 2.0 * off)
    if reach is not None:
        limit = np.minimum(limit, reach + off)
    most = np.minimum(np.floor((limit + 1e-9) / step + 1e-6), top - 1)
    keep = steps <= most.astype(steps.dtype)[:, None]
    return np.nonzero(keep)


def _rough(queries: np.ndarray, refs: np.ndarray, ref_squares: np.ndarray | None, k: int, metric: str, hidden: np.ndarray | None, reach: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that can be among the k nearest, from distances that are right but for their last digits."""
    squares = ref_squares is not None
    if squares:
        q_squares = np.square(queries).sum(axis=1)
        rough = queries @ (-2.0 * refs.T)
        rough += ref_squares
        rough += q_squares[:, None]
        margin = 1e-9 * (1.0 + q_squares + ref_squares.max())  # far above the digits that count
    else:
        rough = _all_distances(queries, refs, metric)
        margin = np.full(len(queries), 1e-9)
    if hidden is not None:
        rough[hidden] = np.inf
    limit = np.partition(rough, k - 1, axis=1)[:, k - 1] if len(refs) > k else np.full(len(queries), np.inf)
    if reach is not None:
        limit = np.minimum(limit, np.square(reach) if squares else reach)
    return np.nonzero(rough <= np.minimum(limit + margin, 1e300)[:, None])


#: References from which distances are screened in small numbers first; rows and references of a tile of pairs, pairs measured at once.
SCREENED_ROWS, PIECE_ROWS, TILE_PAIRS, MEASURED_PAIRS = 256, 4096, 1 << 19, 1 << 16
#: Share of a tile's pairs that single precision may leave undecided; beyond, the tile is screened in double precision.
UNDECIDED = 0.05


class _Squares:
    """Squared distances of all pairs in single precision, around the centre of the references, each off by ``off`` of its query at most."""

    hidden = np.float32(np.inf)

    def __init__(self, queries: np.ndarray, refs: np.ndarray):
        centre = refs.mean(axis=0)
        a, b = queries - centre, refs - centre
        self.scale = max(np.abs(a).max(), np.abs(b).max()) or 1.0
        a, b = a / self.scale, b / self.scale
        a_squares, b_squares = np.square(a).sum(axis=1), np.square(b).sum(axis=1)
        self.a = np.column_stack([-2.0 * a, a_squares, np.ones(len(a))]).astype(np.float32)
        self.b = np.column_stack([b, np.ones(len(b)), b_squares]).astype(np.float32).T
        self.off = 4.0 * (refs.shape[1] + 8) * 2.0**-24 * (a_squares + b_squares.max())

    def rough(self, rows: slice, cols: slice) -> np.ndarray:
        return self.a[rows] @ self.b[:, cols]

    def upper(self, rough: np.ndarray, rows: slice, cols: slice) -> np.ndarray:
        """Distances that pairs of these rough ones do not pass."""
        return np.sqrt(np.maximum(rough + self.off[rows], 0.0)) * self.scale

    def most(self, upper: np.ndarray, rows: slice, cols: slice) -> np.ndarray:
        """Rough distances that pairs within ``upper`` do not pass."""
        return (np.square((upper + 2.0 * 10.0**-DIGITS) / self.scale) * (1.0 + 1e-6) + self.off[rows]).astype(np.float32)


class _Levels:
    """Manhattan distances of all pairs in steps of one size. A row's own distance to its steps is known, which bounds what a pair is off by.

    |x - y| = x + y - 2 min(x, y), and four minima of numbers below 64 fit a byte.
    """

    hidden, top, most_columns = np.uint16(65_535), 63, 1024

    def __init__(self, queries: np.ndarray, refs: np.ndarray):
        low = np.minimum(queries.min(axis=0), refs.min(axis=0))
        self.step = float((np.maximum(queries.max(axis=0), refs.max(axis=0)) - low).max()) / self.top or 1.0
        self.sides, self.sums, self.off = [], [], []
        for x in (queries - low, refs - low):
            level = np.minimum(np.rint(x / self.step), self.top)
            self.off.append(np.abs(x - level * self.step).sum(axis=1) * (1.0 + 1e-9) + 1e-12 * self.step)
            self.sums.append(level.sum(axis=1).astype(np.uint16))
            self.sides.append(np.ascontiguousarray(level.astype(np.uint8).T))

    def rough(self, rows: slice, cols: slice) -> np.ndarray:
        (a, b), (a_sums, b_sums) = (self.sides[0][:, rows], self.sides[1][:, cols]), (self.sums[0][rows], self.sums[1][cols])
        out = a_sums[:, None] + b_sums
        for i in range(0, a.shape[1], TILE_ROWS):
            for j in range(0, b.shape[1], TILE_COLUMNS):
                tile = out[i : i + TILE_ROWS, j : j + TILE_COLUMNS]
                both, total, least = np.zeros(tile.shape, np.uint16), np.empty(tile.shape, np.uint8), np.empty(tile.shape, np.uint8)
                x, y = a[:, i : i + TILE_ROWS, None], b[:, None, j : j + TILE_COLUMNS]
                for c in range(0, len(a), 4):
                    np.minimum(x[c], y[c], out=total)
                    for more in range(c + 1, min(c + 4, len(a))):
                        np.minimum(x[more], y[more], out=least)
                        np.add(total, least, out=total)
                    np.add(both, total, out=both)
                tile -= both
                tile -= both
        return out

    def _off(self, rows: slice, cols: slice) -> np.ndarray:
        return self.off[0][rows] + self.off[1][cols].max()

    def upper(self, rough: np.ndarray, rows: slice, cols: slice) -> np.ndarray:
        return np.where(rough == self.hidden, np.inf, rough * self.step + self._off(rows, cols))

    def most(self, upper: np.ndarray, rows: slice, cols: slice) -> np.ndarray:
        steps = (upper + self._off(rows, cols) + 2.0 * 10.0**-DIGITS) / self.step
        return np.minimum(np.floor(steps * (1.0 + 1e-9) + 1e-6), int(self.hidden) - 1).astype(np.uint16)


def _screen(queries: np.ndarray, refs: np.ndarray, metric: str) -> _Squares | _Levels | None:
    """A screen for the pairs of two sides; none where they are few or out of its range."""
    if metric == "hamming" or len(refs) < SCREENED_ROWS or not len(queries) or not refs.shape[1]:
        return None
    with np.errstate(over="ignore", invalid="ignore"):
        size = np.abs(refs).max() + np.abs(queries).max()
    if not size < 1e100 or (metric == "manhattan" and refs.shape[1] > _Levels.most_columns):
        return None
    return _Levels(queries, refs) if metric == "manhattan" else _Squares(queries, refs)


def _kth_at_most(rough: np.ndarray, k: int) -> np.ndarray | None:
    """Per row a number that its k-th smallest one does not pass: the k-th of the smallest ones of disjoint columns."""
    groups = min(rough.shape[1], max(256, 8 * k))
    if groups < k:
        return None
    least = rough[:, :groups].copy()
    for start in range(groups, rough.shape[1] - groups + 1, groups):
        np.minimum(least, rough[:, start : start + groups], out=least)
    return np.partition(least, k - 1, axis=1)[:, k - 1]


def _own_pairs(own: np.ndarray | None, ref_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, reference) of equal ids, by query; nulls equal nothing."""
    if own is None:
        return np.zeros(0, int), np.zeros(0, int)
    order = np.argsort(ref_ids, kind="stable")
    first, last = (np.searchsorted(ref_ids[order], own, side=side) for side in ("left", "right"))
    many = np.where(own == own, last - first, 0)
    rows = np.repeat(np.arange(len(own)), many)
    return rows, order[np.repeat(first - np.cumsum(many) + many, many) + np.arange(len(rows))]


def _measured(queries: np.ndarray, refs: np.ndarray, rows: np.ndarray, cols: np.ndarray, metric: str) -> np.ndarray:
    out = np.empty(len(rows))
    for start in range(0, len(rows), MEASURED_PAIRS):
        part = slice(start, start + MEASURED_PAIRS)
        out[part] = _pair_distances(queries[rows[part]], refs[cols[part]], metric)
    return out


def _ranked(rows: np.ndarray, cols: np.ndarray, exact: np.ndarray, ref_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k best of every row, in order: (row, column, distance, rank from 0)."""
    order = np.lexsort((ref_ids[cols], np.round(exact, DIGITS), rows))
    rows, cols, exact = rows[order], cols[order], exact[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    keep = rank < k
    return rows[keep], cols[keep], exact[keep], rank[keep]


def _nearest(screen: _Squares | _Levels, queries: np.ndarray, refs: np.ndarray, ref_ids: np.ndarray, k: int, metric: str, own: np.ndarray | None, reach: np.ndarray | None) -> Iterator[tuple]:
    """``top_k`` of tiles of queries, that meet the references piece by piece within what the pieces before left possible."""
    own_rows, own_cols = _own_pairs(own, ref_ids)
    step = max(64, TILE_PAIRS // min(len(refs), PIECE_ROWS))
    ref_squares = np.square(refs).sum(axis=1) if metric != "manhattan" else None
    for start in range(0, len(queries), step):
        rows = slice(start, min(start + step, len(queries)))
        q = queries[rows]
        near = np.full(len(q), np.inf) if reach is None else reach[rows].astype(float)
        mine = slice(*np.searchsorted(own_rows, [rows.start, rows.stop]))
        mine_rows, mine_cols = own_rows[mine] - start, own_cols[mine]
        held, waiting = (np.zeros(0, int), np.zeros(0, int), np.zeros(0)), []
        for at in range(0, len(refs), PIECE_ROWS):
            cols = slice(at, min(at + PIECE_ROWS, len(refs)))
            rough = screen.rough(rows, cols)
            hide = (mine_cols >= at) & (mine_cols < cols.stop)
            rough[mine_rows[hide], mine_cols[hide] - at] = screen.hidden
            kth = _kth_at_most(rough, k)
            if kth is not None:
                near = np.minimum(near, screen.upper(kth, rows, cols))
            keep = rough <= screen.most(near, rows, cols)[:, None]
            keep[mine_rows[hide], mine_cols[hide] - at] = False
            found = np.flatnonzero(keep)
            if ref_squares is not None and len(found) > UNDECIDED * rough.size + 2 * k * len(q):
                hidden = np.zeros(rough.shape, bool)
                hidden[mine_rows[hide], mine_cols[hide] - at] = True
                r, c = _rough(q, refs[cols], ref_squares[cols], k, metric, hidden, near)
            else:
                r, c = np.divmod(found, rough.shape[1])
            waiting.append((r, c + at))
            if at and cols.stop < len(refs) and sum(len(w[0]) for w in waiting) < 4 * k * len(q):
                continue
            # the k best so far, whose last one bounds what is yet to come
            r, c = (np.concatenate(part) for part in zip(*waiting))
            exact, waiting = _measured(q, refs, r, c, metric), []
            if reach is not None:
                within = exact <= reach[rows][r] + 1e-9
                r, c, exact = r[within], c[within], exact[within]
            held = _ranked(*(np.concatenate(part) for part in zip(held, (r, c, exact))), ref_ids, k)
            last = held[3] == k - 1
            near[held[0][last]] = np.minimum(near[held[0][last]], held[2][last])
            held = held[:3]
        yield held[0] + start, ref_ids[held[1]], held[2], np.arange(len(held[0])) - np.searchsorted(held[0], held[0]) + 1


def top_k(
    queries: np.ndarray, refs: np.ndarray, ref_ids: np.ndarray, k: int, metric: str, own: np.ndarray | None = None, reach: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query position, reference id, distance, rank) of the k nearest references within reach, ties by id.

    Candidates come from a fast screen of all pairs with a safety margin and are measured again exactly.
    """
    screen = _screen(queries, refs, metric)
    if screen is not None:
        return tuple(np.concatenate(x) for x in zip(*_nearest(screen, queries, refs, ref_ids, k, metric, own, reach)))
    squares = metric not in ("manhattan", "hamming")
    ref_squares = np.square(refs).sum(axis=1) if squares else None
    # few numbers are not worth a screen
    sides = None if squares or len(refs) < SCREENED_ROWS or not len(queries) else _levels(queries, refs) if metric == "manhattan" else _codes(queries, refs)
    step = max(1, 4_000_000 // max(1, len(refs)))
    parts = []
    for start in range(0, len(queries), step):
        q = queries[start : start + step]
        hidden = None if own is None else own[start : start + step, None] == ref_ids[None, :]
        if sides is not None:
            rows, cols = _screened(q, refs, k, metric, hidden, None if reach is None else reach[start : start + step], (sides[0][:, start : start + step], *sides[1:]))
        else:
            rows, cols = _rough(q, refs, ref_squares, k, metric, hidden, None if reach is None else reach[start : start + step])
        exact = _measured(q, refs, rows, cols, metric)
        if sides is not None and reach is not None:
            near = exact <= reach[start : start + step][rows] + 1e-9
            rows, cols, exact = rows[near], cols[near], exact[near]
        rows, cols, exact, rank = _ranked(rows, cols, exact, ref_ids, k)
        parts.append((rows + start, ref_ids[cols], exact, rank + 1))
    return tuple(np.concatenate(x) for x in zip(*parts))


#: Distances count as equal when they agree in so many decimals; ties go to the smaller id.
DIGITS = 12


@dataclass
class CellIndex:
    """Bounded summary of the reference side: pivots and per-cell counts, radii and block counts."""

    pivots: np.ndarray
    counts: np.ndarray
    low: np.ndarray
    high: np.ndarray
    slots: np.ndarray


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float)


def _assign(df: DataFrame, pivots: np.ndarray, metric: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(pivots)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch["v"])
            step = max(1, 4_000_000 // len(shared.value))
            cell = np.concatenate([_all_distances(x[i : i + step], shared.value, metric).argmin(axis=1) for i in range(0, len(x), step)])
            yield batch.assign(cell=cell.astype("int32"), radius=_pair_distances(x, shared.value[cell], metric))

    return df.mapInPandas(nearest, "r_id long, v array<double>, cell int, radius double")


def _per_cell(df: DataFrame, **numbers) -> DataFrame:
    """``df`` with columns of numbers per cell; at most one small row per pivot is broadcast."""
    rows = [(c, *(int(v[c]) for v in numbers.values())) for c in range(len(next(iter(numbers.values()))))]
    table = df.sparkSession.createDataFrame(rows, "cell int, " + ", ".join(f"{k} int" for k in numbers))
    return df.join(F.broadcast(table), "cell")


def _index(ref: DataFrame, n: int, metric: str, seed: int, block_rows: int, probed: bool = False) -> tuple[CellIndex, DataFrame]:
    """Exact search prunes cells by their radius, for which few are enough; probing compares whole cells and keeps them small."""
    wanted = int(min(MAX_PIVOTS, max(1, math.isqrt(n) // 8)))
    if probed:
        wanted = int(min(MAX_PROBED_PIVOTS, max(wanted, n // block_rows)))
    sample = take_in_hash_order(ref, order_hash(seed, "r_id"), wanted).select("v").collect()
    pivots = np.unique(_matrix(pd.Series([r["v"] for r in sample])), axis=0)
    cells = stage(_assign(ref, pivots, metric), "cells")
    stats = {
        r["cell"]: r
        for r in cells.groupBy("cell").agg(F.count("*").alias("n"), F.min("radius").alias("lo"), F.max("radius").alias("hi")).collect()
    }
    every = range(len(pivots))
    counts = np.array([stats[c]["n"] if c in stats else 0 for c in every])
    index = CellIndex(
        pivots,
        counts,
        np.array([stats[c]["lo"] if c in stats else np.inf for c in every]),
        np.array([stats[c]["hi"] if c in stats else -np.inf for c in every]),
        # cells that fit one bundle stay whole: a query travels once per block
        np.maximum(1, -(-counts // max(block_rows, _bundle_rows(pivots)))),
    )
    slot = F.pmod(F.xxhash64("r_id"), F.col("_slots")).cast("int")
    return index, _per_cell(cells, _slots=index.slots).select("r_id", "v", "cell", slot.alias("slot"))


def _route_closest(queries: DataFrame, index: CellIndex, k: int, metric: str, probes: int) -> DataFrame:
    """Add ``cells``: the ``probes`` closest cells, more where they hold fewer than k rows."""
    shared = queries.sparkSession.sparkContext.broadcast(index)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ix = shared.value
        for batch in batches:
            if not len(batch):
                continue
            x, cells = _matrix(batch["v"]), []
            step = max(1, 4_000_000 // len(ix.pivots))
            for i in range(0, len(x), step):
                d = _all_distances(x[i : i + step], ix.pivots, metric)
                d[:, ix.counts == 0] = np.inf
                closest = np.argsort(d, axis=1)
                held = np.cumsum(ix.counts[closest], axis=1)
                enough = (held < min(k, int(ix.counts.sum()))).sum(axis=1) + 1
                need = np.minimum(np.maximum(probes, enough), int((ix.counts > 0).sum()))
                cells += [c[:m].tolist() for c, m in zip(closest, need)]
            yield batch.assign(cells=cells)

    return queries.mapInPandas(route, "q_id long, v array<double>, cells array<int>")


def _route_within(bounded: DataFrame, index: CellIndex, metric: str) -> DataFrame:
    """Replace ``cells`` (already searched) by the other cells that may hold a row within ``reach``."""
    shared = bounded.sparkSession.sparkContext.broadcast(index)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ix = shared.value
        for batch in batches:
            if not len(batch):
                continue
            d = _all_distances(_matrix(batch["v"]), ix.pivots, metric)
            reach = batch["reach"].to_numpy(dtype=float)
            slack = (reach + 1e-6 * (1.0 + d.max(axis=1) + np.where(np.isfinite(reach), reach, 0.0)))[:, None]
            near = (d - ix.high <= slack) & (ix.low - d <= slack) & ((d - d.min(axis=1)[:, None]) / 2.0 <= slack)
            near &= ix.counts > 0
            for i, seen in enumerate(batch["cells"]):
                near[i, np.asarray(seen, dtype=int)] = False
            yield batch.assign(cells=[np.flatnonzero(row).tolist() for row in near])

    return bounded.mapInPandas(route, "q_id long, v array<double>, cells array<int>, reach double")


def _bundle_rows(pivots: np.ndarray) -> int:
    """Rows that are compared with one group of queries."""
    return max(1, min(BUNDLE_ROWS, BUNDLE_VALUES // max(1, pivots.shape[1])))


def _bundles(index: CellIndex) -> np.ndarray:
    """Bundle of every cell: neighbouring cells (pivots are in order) up to BUNDLE_VALUES numbers; a cell cut into blocks stays alone."""
    most = _bundle_rows(index.pivots)
    out, held = np.zeros(len(index.counts), int), 0
    for c in range(1, len(out)):
        held += int(index.counts[c - 1])
        new = held + index.counts[c] > most or index.slots[c] > 1 or index.slots[c - 1] > 1
        out[c], held = out[c - 1] + new, 0 if new else held
    return out


def _compare_blocks(
    routed: DataFrame, blocks: DataFrame, index: CellIndex, k: int, metric: str, exclude_self: bool, query_rows: int
) -> DataFrame:
    """The k best rows of each (query, block or bundle of cells) among the routed pairs: (q_id, n_id, dist).

    A query goes once to a bundle with any of its cells and meets only those of them, so what is shuffled does not grow with the number
    of cells that a query needs.
    """
    query_rows = max(1, min(query_rows, BUNDLE_VALUES // max(1, index.pivots.shape[1])))
    bundle = _bundles(index)
    bundle_of = F.array(*[F.lit(int(b)) for b in bundle])
    asked = routed.withColumn("bundle", F.explode(F.array_distinct(F.transform("cells", lambda c: F.get(bundle_of, c)))))
    # the queries of a bundle are cut into groups, its reference blocks repeated once per group
    load = {r["bundle"]: r["count"] for r in asked.groupBy("bundle").count().collect()}
    many = int(bundle[-1]) + 1
    # pairs are hashed to tasks: few big ones would leave cores idle
    cores = routed.sparkSession.sparkContext.defaultParallelism
    query_rows = min(query_rows, max(LEAST_QUERY_ROWS, sum(load.values()) // (PAIRS_PER_CORE * cores)))
    groups = [max(1, -(-load.get(b, 0) // query_rows)) for b in range(many)]
    slots = np.ones(many, int)
    np.maximum.at(slots, bundle, index.slots)
    asked = _per_cell(asked.withColumnRenamed("bundle", "cell"), _groups=groups, _slots=slots).withColumnRenamed("cell", "bundle")
    asked = asked.withColumn("grp", F.pmod(F.xxhash64("q_id"), F.col("_groups")).cast("int"))
    asked = asked.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("_slots") - 1))).drop("_groups", "_slots")
    offered = _per_cell(blocks, bundle=bundle, _groups=[groups[b] for b in bundle])
    offered = offered.withColumn("grp", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1))).drop("_groups")
    bounded = "reach" in routed.columns

    def compare(asking: pd.DataFrame, offering: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"q_id": [], "n_id": [], "dist": []})
        if not len(asking) or not len(offering):
            return empty
        ids, x, refs, ref_ids = asking["q_id"].to_numpy(), _matrix(asking["v"]), _matrix(offering["v"]), offering["r_id"].to_numpy()
        reach = asking["reach"].to_numpy(dtype=float, copy=True) if bounded else None
        cells = offering["cell"].to_numpy()
        wanted = asking["cells"].explode()
        at, wanted = asking["cells"].map(len).to_numpy(), wanted.to_numpy(dtype=float)
        at = np.repeat(np.arange(len(ids)), at)
        found = []
        for cell in np.unique(cells):
            rows, own = at[wanted == cell], np.flatnonzero(cells == cell)
            if len(rows):
                q, n, dist, rank = top_k(x[rows], refs[own], ref_ids[own], k, metric, ids[rows] if exclude_self else None, None if reach is None else reach[rows])
                found.append((rows[q], n, dist))
                if reach is not None:  # the next cells need not reach further than the k-th row of this one
                    last = rank == k
                    at_last = rows[q[last]]
                    reach[at_last] = np.minimum(reach[at_last], dist[last] + 2 * 10.0**-DIGITS)
        if not found:
            return empty
        q, n, dist = (np.concatenate(part) for part in zip(*found))
        order = np.lexsort((n, np.round(dist, DIGITS), q))
        q, n, dist = q[order], n[order], dist[order]
        keep = np.arange(len(q)) - np.searchsorted(q, q) < k
        return pd.DataFrame({"q_id": ids[q[keep]], "n_id": n[keep], "dist": dist[keep]})

    # few bytes but much work per group: a fixed number of partitions is not merged by AQE
    keys = ["bundle", "slot", "grp"]
    pairs = int(sum(g * s for g, s in zip(groups, slots)))
    tasks = max(cores, min(2 * pairs, MAX_TASKS))  # so that few share one
    asked, offered = asked.repartition(tasks, *keys), offered.repartition(tasks, *keys)
    return asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInPandas(compare, "q_id long, n_id long, dist double")


def _broadcast_neighbours(queries: DataFrame, ref: DataFrame, k: int, metric: str, exclude_self: bool) -> DataFrame:
    """Compare every query with a reference side whose size was checked; no shuffle."""
    rows = ref.toPandas()
    shared = queries.sparkSession.sparkContext.broadcast((rows["r_id"].to_numpy(), _matrix(rows["v"])))

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, refs = shared.value
        for batch in batches:
            if not len(batch) or not len(ids):
                continue
            own = batch["q_id"].to_numpy()
            q, n, dist, rank = top_k(_matrix(batch["v"]), refs, ids, k, metric, own if exclude_self else None)
            yield pd.DataFrame({"q_id": own[q], "n_id": n, "dist": dist, "rank": rank.astype("int32")})

    return spread(queries).mapInPandas(nearest, "q_id long, n_id long, dist double, rank int")


def _prepare(df: DataFrame, vector: str, metric: str, whitening: np.ndarray | None) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    if metric == "cosine":
        norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
        v = F.transform(v, lambda x: F.coalesce(F.try_divide(x, norm), F.lit(0.0)))
    elif metric == "mahalanobis":
        rows = F.array(*[F.array(*[F.lit(float(a)) for a in row]) for row in whitening])
        v = F.transform(rows, lambda r: F.aggregate(F.zip_with(r, v, lambda a, x: a * x), F.lit(0.0), lambda s, t: s + t))
    return df.withColumn("v", v)


def knn_join(
    queries: DataFrame,
    ref: DataFrame,
    k: int,
    q_id: str,
    r_id: str,
    vector: str = "vector",
    metric: str = "euclidean",
    exclude_self: bool = False,
    probes: int | None = None,
    seed: int = 42,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    broadcast_values: int = BROADCAST_VALUES,
    least_recall: float | None = None,
) -> DataFrame:
    """k nearest reference rows per query: (q_id, n_id, dist, rank); ties by id.

    Exact for every metric. With ``probes`` only that many closest cells are searched (more where they
    hold fewer than k rows), and with ``least_recall`` as many more as a sample of the queries needs for it.
    ``exclude_self`` skips the reference row with the query's own id.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}")
    whitening = _whitening(ref, vector) if metric == "mahalanobis" else None
    inner = "euclidean" if metric in ("cosine", "mahalanobis") else metric
    right = _prepare(ref, vector, metric, whitening).select(F.col(r_id).cast("long").alias("r_id"), "v")
    left = _prepare(queries, vector, metric, whitening).select(F.col(q_id).cast("long").alias("q_id"), "v")
    size = right.agg(F.count("*").alias("n"), F.sum(F.size("v")).alias("values"), F.max(F.size("v")).alias("d")).first()
    low = probes is None and inner != "hamming" and 0 < (size["d"] or 0) <= boxes.DIMENSIONS
    if probes is None and (size["values"] or 0) <= (min(broadcast_values, boxes.FEW_ROWS * size["d"]) if low else broadcast_values):
        ranked = _broadcast_neighbours(left, right, k, inner, exclude_self)
    elif low:
        ranked = boxes.nearest(left, right, k, size["d"], size["n"], inner, exclude_self, seed, min(block_rows, boxes.BOX_ROWS))
    else:
        right = stage(right, "knn-ref")
        needed = k + 1 if exclude_self else k
        index, blocks = _index(right, size["n"], inner, seed, block_rows, probes is not None)
        if probes is not None and least_recall is not None:
            sample = stage(take_in_hash_order(left, order_hash(seed + 1, "q_id"), SAMPLE_QUERIES), "knn-sample")
            exact = knn_join(sample, right, k, "q_id", "r_id", "v", inner, exclude_self, None, seed, BLOCK_ROWS, query_rows, broadcast_values)
            probes = max(probes, _probes_needed(sample, exact, blocks, index, inner, least_recall))
        routed = stage(_route_closest(left, index, needed, inner, probes or 1), "knn-route")
        found = _compare_blocks(routed, blocks, index, k, inner, exclude_self, query_rows)
        if probes is None:
            found = stage(found, "knn-home")
            best = Window.partitionBy("q_id").orderBy(F.round("dist", DIGITS), "n_id")
            kth = found.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") == k)
            bounded = routed.join(kth.select("q_id", F.col("dist").alias("reach")), "q_id", "left")
            # as far as distances that count as equal to the k-th
            bounded = bounded.withColumn("reach", F.coalesce(F.col("reach") + 2 * 10.0**-DIGITS, F.lit(float("inf"))))
            further = stage(_route_within(bounded, index, inner).filter(F.size("cells") > 0), "knn-further")
            found = found.unionByName(_compare_blocks(further, blocks, index, k, inner, exclude_self, query_rows))
        # distances of equal pairs may differ in the last bits between blocks; compare them at 12 digits
        best = Window.partitionBy("q_id").orderBy(F.round("dist", DIGITS), "n_id")
        ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    dist = F.col("dist") * F.col("dist") / 2.0 if metric == "cosine" else F.col("dist")
    return ranked.select(F.col("q_id").alias(q_id), "n_id", dist.alias("dist"), "rank")


def _probes_needed(sample: DataFrame, exact: DataFrame, blocks: DataFrame, index: CellIndex, metric: str, least_recall: float) -> int:
    """Closest cells that hold the share ``least_recall`` (and the margin) of the sample's exact neighbours."""
    ranked = _route_closest(sample, index, 1, metric, len(index.pivots)).select("q_id", "cells")
    placed = exact.select("q_id", "n_id").join(blocks.select(F.col("r_id").alias("n_id"), "cell"), "n_id").join(F.broadcast(ranked), "q_id")
    share = min(1.0, least_recall + SAMPLE_MARGIN)
    need = placed.agg(F.percentile(F.array_position("cells", F.col("cell")), F.lit(share))).first()[0]
    return math.ceil(need or 1)


def knn_approx(
    queries: DataFrame, ref: DataFrame, k: int, q_id: str, r_id: str, vector: str = "vector", probes: int = 4, least_recall: float | None = 0.9, **options
) -> DataFrame:
    """Neighbours from the closest cells only: ``probes`` of them, or more until ``least_recall`` is reached.

    Cells hold about ``block_rows`` rows, so a query is compared with about probes * block_rows rows. How many cells
    hold the neighbours depends on the data: few where rows form clusters, most of them where many dimensions are
    filled evenly. It is read off the exact neighbours of SAMPLE_QUERIES queries. Without ``least_recall`` the work of a
    query does not depend on the size of the table (from MAX_PROBED_PIVOTS * block_rows rows on cells grow with it), but
    recall falls as cells become more.
    """
    return knn_join(queries, ref, k, q_id, r_id, vector, probes=probes, least_recall=least_recall, **options)


@dataclass
class TreeIndex:
    """Pivot trees over a reference side, with what is needed to prepare queries for it and the beam that it needs."""

    trees: list[pivot_tree.PivotTree]
    metric: str
    whitening: np.ndarray | None
    beam: int
    recall: float | None = None


def tree_index(
    ref: DataFrame, r_id: str, vector: str = "vector", metric: str = "euclidean", k: int = 5, least_recall: float | None = 0.9, trees: int = pivot_tree.TREES,
    beam: int = pivot_tree.BEAM, leaf_rows: int = pivot_tree.LEAF_ROWS, seed: int = 42,
) -> TreeIndex:
    """Build ``trees`` pivot trees (``pivot_tree``).

    With ``least_recall`` the beam is doubled until SAMPLE_QUERIES reference rows find that share (and the margin) of their exact k
    neighbours, so recall is measured on the table at hand. Where rows form clusters the first beam is enough at every size, and a
    query's work does not grow with the table; rows that fill many dimensions evenly need a wider one. Beyond ``pivot_tree.MAX_BEAM``
    the trees are cut back by a level, down to their roots, where every row is met and one tree is enough.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}")
    whitening = _whitening(ref, vector) if metric == "mahalanobis" else None
    inner = "euclidean" if metric in ("cosine", "mahalanobis") else metric
    rows = stage(_prepare(ref, vector, metric, whitening).select(F.col(r_id).cast("long").alias("r_id"), "v"), "tree-ref")
    index = TreeIndex([pivot_tree.build_tree(rows, inner, seed + 1000 * t, leaf_rows=leaf_rows) for t in range(trees)], metric, whitening, beam)
    if least_recall is None:
        return index
    sample = stage(take_in_hash_order(rows, order_hash(seed + 1, "r_id"), SAMPLE_QUERIES).select(F.col("r_id").alias("q_id"), "v"), "tree-sample")
    # the few queries are the side that is compared with every block of the reference
    exact = stage(_all_against_few(sample, rows, k, inner), "tree-exact")
    wanted, levels = min(1.0, least_recall + SAMPLE_MARGIN), max((t.levels for t in index.trees), default=0)
    while True:
        leaves = max((t.leaves.select("node").distinct().count() for t in index.trees), default=1)
        while True:
            index.recall = recall(_best(pivot_tree.search(sample, index.trees, k, True, index.beam)[0], k), exact, "q_id").first()["recall"]
            if index.recall is None or index.recall >= wanted or index.beam >= min(leaves, max(beam, pivot_tree.MAX_BEAM)):
                break
            index.beam *= 2
        if index.recall is None or index.recall >= wanted or levels == 0 or index.beam >= leaves:
            return index
        levels, index.beam = levels - 1, beam
        index.trees = [pivot_tree.cut_back(t, min(t.levels, levels)) for t in (index.trees if levels else index.trees[:1])]


def _all_against_few(few: DataFrame, rows: DataFrame, k: int, metric: str) -> DataFrame:
    """Exact k nearest rows of few queries (the rows' own ids left out): they are broadcast, and every task keeps its k best."""
    held = few.toPandas()
    shared = rows.sparkSession.sparkContext.broadcast((held["q_id"].to_numpy(), _matrix(held["v"])))

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, queries = shared.value
        for batch in batches:
            if len(batch) and len(ids):
                q, n, dist, _ = top_k(queries, _matrix(batch["v"]), batch["r_id"].to_numpy(), k, metric, ids)
                yield pd.DataFrame({"q_id": ids[q], "n_id": n, "dist": dist})

    return _best(rows.mapInPandas(nearest, "q_id long, n_id long, dist double"), k)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q_id").orderBy(F.round("dist", DIGITS), "n_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def tree_join(queries: DataFrame, index: TreeIndex, k: int, q_id: str, vector: str = "vector", exclude_self: bool = False) -> DataFrame:
    """k nearest rows among the leaves that each query reaches: (q_id, n_id, dist, rank), as ``knn_join``."""
    left = _prepare(queries, vector, index.metric, index.whitening).select(F.col(q_id).cast("long").alias("q_id"), "v")
    ranked = _best(pivot_tree.search(stage(left, "tree-queries"), index.trees, k, exclude_self, index.beam)[0], k)
    dist = F.col("dist") * F.col("dist") / 2.0 if index.metric == "cosine" else F.col("dist")
    return ranked.select(F.col("q_id").alias(q_id), "n_id", dist.alias("dist"), "rank")


def _whitening(ref: DataFrame, vector: str) -> np.ndarray:
    d = len(ref.select(vector).first()[0])
    wide = ref.select(*[F.col(vector)[i].cast("double").alias(f"x{i}") for i in range(d)])
    _, _, cov = mean_and_covariance(wide, wide.columns)
    return np.linalg.inv(np.linalg.cholesky(cov + 1e-12 * np.eye(d)))


def recall(approx: DataFrame, exact: DataFrame, q_id: str) -> DataFrame:
    """Share of the exact neighbours that the approximate result found."""
    hits = exact.select(q_id, "n_id").join(approx.select(q_id, "n_id").withColumn("_hit", F.lit(1)), [q_id, "n_id"], "left")
    return hits.agg(F.avg(F.coalesce("_hit", F.lit(0)).cast("double")).alias("recall"), F.count("*").alias("n"))


@dataclass
class DistanceModel:
    """Mean-distance detector: the train rows and the cut-off."""

    ref: DataFrame
    row_id: str
    vector: str
    k: int
    metric: str
    threshold: float


def _mean_distance(neighbours: DataFrame, q_id: str) -> DataFrame:
    return neighbours.groupBy(q_id).agg(F.avg("dist").alias("mean_dist"))


def knn_distance_fit(
    train: DataFrame, row_id: str, vector: str = "vector", k: int = 5, metric: str = "euclidean", percentile: float = 95.0, include_self: bool = False
) -> DistanceModel:
    """Cut-off = train percentile of the mean distance to the k nearest other rows.

    ``include_self`` counts a train row as its own nearest neighbour.
    """
    near = knn_join(train, train, k, row_id, row_id, vector, metric, exclude_self=not include_self)
    cut = percentile_threshold(_mean_distance(near, row_id), percentile, "mean_dist")
    return DistanceModel(train, row_id, vector, k, metric, cut)


def knn_distance_predict(df: DataFrame, model: DistanceModel, q_id: str) -> DataFrame:
    """Per query: mean distance, score = distance / cut-off, flag above the cut-off."""
    near = knn_join(df, model.ref, model.k, q_id, model.row_id, model.vector, model.metric)
    out = _mean_distance(near, q_id)
    out = out.withColumn("score", F.col("mean_dist") / F.lit(model.threshold + 1e-10))
    return out.withColumn("y_pred", flag_above("mean_dist", model.threshold))


@dataclass
class LofModel:
    """Train rows, their k-distance and local density (a staged table), and the cut-off."""

    ref: DataFrame
    density: DataFrame
    scores: DataFrame
    row_id: str
    vector: str
    k: int
    metric: str
    probes: int | None
    threshold: float
    index: TreeIndex | None = None
    boxed: factors.Factors | None = None


def _reach_density(neighbours: DataFrame, k_distance: DataFrame, q_id: str) -> DataFrame:
    """Local density per query from reach distances max(dist, k-distance of the neighbour)."""
    known = skew_join(neighbours, k_distance.select(F.col("row_id").alias("n_id"), "k_dist"), ["n_id"], "inner")
    reach = F.greatest("dist", "k_dist")
    return known.groupBy(q_id).agg((1.0 / (F.avg(reach) + F.lit(1e-10))).alias("lrd"))


def _outlier_factor(neighbours: DataFrame, own: DataFrame, density: DataFrame, q_id: str) -> DataFrame:
    """Mean density of the neighbours over the own density."""
    around = skew_join(neighbours, density.select(F.col("row_id").alias("n_id"), F.col("lrd").alias("n_lrd")), ["n_id"], "inner")
    means = around.groupBy(q_id).agg(F.avg("n_lrd").alias("m_lrd"))
    return means.join(own, q_id).select(q_id, (F.col("m_lrd") / F.col("lrd")).alias("score"))


def lof_fit(
    train: DataFrame, row_id: str, vector: str = "vector", k: int = 20, metric: str = "euclidean", contamination: float | None = None, probes: int | None = None,
    exact_values: int | None = None, least_recall: float | None = 0.9, unique_ids: bool = False, **tree_options,
) -> LofModel:
    """k-distance and local reachability density per train row; cut-off 1.5 or the train percentile.

    Neighbours are exact at any size (or of ``probes`` cells, if given). Where a caller bounds the exact search by ``exact_values``, those
    of train rows that hold more numbers come from a ``tree_index`` with ``least_recall``, which the model keeps for scoring. With
    ``unique_ids`` (whole numbers, here and where rows are scored) few dimensions are searched without writing neighbours (``factors``).
    """
    if unique_ids and probes is None and exact_values is None and metric in ("euclidean", "manhattan"):
        rows = train.select(F.col(row_id).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("v"))
        size = rows.agg(F.count("v").alias("n"), F.max(F.size("v")).alias("d")).first()
        if size["n"] and 0 < size["d"] <= boxes.DIMENSIONS:
            boxed, found = factors.fit(rows, k, size["d"], size["n"], metric)
            scores = found.select(F.col("key").alias(row_id), "score")
            cut = 1.5 if contamination is None else percentile_threshold(scores, 100.0 * (1.0 - contamination))
            return LofModel(train, found.select(F.col("key").alias("row_id"), "k_dist", "lrd"), scores, row_id, vector, k, metric, probes, cut, boxed=boxed)
    index = None
    many = exact_values is not None and probes is None and (train.agg(F.sum(F.size(vector))).first()[0] or 0) > exact_values
    if many:
        index = tree_index(train, row_id, vector, metric, k, least_recall, **tree_options)
        near = tree_join(train, index, k, row_id, vector, exclude_self=True)
    else:
        near = knn_join(train, train, k, row_id, row_id, vector, metric, exclude_self=True, probes=probes)
    near = stage(near, "lof-near")
    k_dist = near.groupBy(F.col(row_id).alias("row_id")).agg(F.max("dist").alias("k_dist"))
    lrd = _reach_density(near, k_dist, row_id).withColumnRenamed(row_id, "row_id")
    density = stage(k_dist.join(lrd, "row_id"), "lof-density")
    own = density.select(F.col("row_id").alias(row_id), "lrd")
    scores = stage(_outlier_factor(near, own, density, row_id), "lof-train")
    cut = 1.5 if contamination is None else percentile_threshold(scores, 100.0 * (1.0 - contamination))
    return LofModel(train, density, scores, row_id, vector, k, metric, probes, cut, index)


def lof_score(df: DataFrame, model: LofModel, q_id: str) -> DataFrame:
    """Novelty score of new rows against the train side; about 1 = as dense as its neighbours."""
    if model.boxed is not None:
        rows = df.select(F.col(q_id).cast("long").alias("key"), F.col(model.vector).cast("array<double>").alias("v"))
        return factors.score(rows, model.boxed).withColumnRenamed("key", q_id)
    if model.index is not None:
        near = tree_join(df, model.index, model.k, q_id, model.vector)
    else:
        near = knn_join(df, model.ref, model.k, q_id, model.row_id, model.vector, model.metric, probes=model.probes)
    near = stage(near, "lof-query")
    own = _reach_density(near, model.density, q_id)
    return _outlier_factor(near, own, model.density, q_id)


def lof_predict(df: DataFrame, model: LofModel, q_id: str) -> DataFrame:
    return lof_score(df, model, q_id).withColumn("y_pred", flag_above("score", model.threshold))
