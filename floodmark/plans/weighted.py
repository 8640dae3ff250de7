"""Passes over weighted distinct rows, and spread-out starts for clusterings.

Equal rows are one row with a weight, so a flood of copies costs one row per pass and cannot fill one task. An algorithm is written
once against ``Passes``: over arrays inside a task while the distinct rows are few, over a staged table otherwise. Draws depend on
a hash of the values and the weight alone, not on partitions.
"""

from __future__ import annotations

import math
import threading
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodmark.plans.moments import sum_vectors
from floodmark.plans.sizing import file_partitions

WEIGHT = "_weight"
#: Rounds of the seeding, centres drawn per round as a multiple of k, passes of refinement over all rows.
ROUNDS, OVERSAMPLE, REFINEMENTS = 5, 2.0, 3

Step = Callable[[np.ndarray, np.ndarray], np.ndarray]


def weighted_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows of ``columns`` and how often each occurs; equal rows are counted before the shuffle."""
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return values.groupBy(*columns).agg(F.count("*").cast("double").alias(WEIGHT))


def unit_hash(x: np.ndarray, seed: int) -> np.ndarray:
    """A number in (0, 1) for every row, from its values alone."""
    mixed = np.full(len(x), (seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for column in np.ascontiguousarray(x.T + 0.0):
        mixed = mixed * np.uint64(0xBF58476D1CE4E5B9) + column.view(np.uint64)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(32)
    return ((mixed >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


class LocalPasses:
    """Passes over arrays."""

    def __init__(self, x: np.ndarray, weights: np.ndarray):
        order = np.lexsort(x.T[::-1]) if len(x) else np.zeros(0, int)
        self.x, self.weights = x[order], weights[order]
        self.rows = len(x)

    def sums(self, step: Step, length: int) -> np.ndarray:
        return step(self.x, self.weights) if self.rows else np.zeros(length)

    def draw(self, odds: Step, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        chances = np.minimum(odds(self.x, self.weights), 1.0)
        chosen = unit_hash(self.x, seed) < chances
        return self.x[chosen], self.weights[chosen], chances[chosen]


class TablePasses:
    """Passes over a staged table of ``weighted_rows``; only vectors as long as a model, and drawn rows, leave the executors."""

    def __init__(self, table: DataFrame, columns: list[str], rows: int):
        self.table, self.columns, self.rows = table, columns, rows
        self.parts = file_partitions(table)

    def sums(self, step: Step, length: int) -> np.ndarray:
        return self.many_sums([(step, length)])[0]

    def many_sums(self, asked: list[tuple[Step, int]]) -> list[np.ndarray]:
        """The sums of several steps from one job that reads every row once."""
        columns = self.columns

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            totals = [np.zeros(length) for _, length in asked]
            for batch in batches:
                if len(batch):
                    x, weights = batch[columns].to_numpy(dtype=float), batch[WEIGHT].to_numpy()
                    for total, (step, _) in zip(totals, asked):
                        total += step(x, weights)
            yield pd.DataFrame({"s": [np.concatenate(totals)]})

        ends = np.cumsum([length for _, length in asked])
        whole = sum_vectors(self.table.mapInPandas(run, "s array<double>"), "s", self.parts * int(ends[-1]))
        return np.split(whole, ends[:-1])

    def draw(self, odds: Step, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows are drawn with their ``odds``; callers choose these so that a bounded number is expected."""
        return self.many_draws([(odds, seed)])[0]

    def many_draws(self, asked: list[tuple[Step, int]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        columns = self.columns

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                x, weights = batch[columns].to_numpy(dtype=float), batch[WEIGHT].to_numpy()
                for at, (odds, seed) in enumerate(asked):
                    chances = np.minimum(odds(x, weights), 1.0)
                    chosen = unit_hash(x, seed) < chances
                    if chosen.any():
                        yield pd.DataFrame({"at": at, "x": pd.Series(list(x[chosen]), dtype=object), "w": weights[chosen], "p": chances[chosen]})

        drawn: list[list] = [[] for _ in asked]
        for r in self.table.mapInPandas(run, "at int, x array<double>, w double, p double").collect():
            drawn[r["at"]].append((tuple(r["x"]), r["w"], r["p"]))
        out = []
        for found in map(sorted, drawn):
            x = np.array([f[0] for f in found], float).reshape(-1, len(columns))
            out.append((x, np.array([f[1] for f in found], float), np.array([f[2] for f in found], float)))
        return out


class SharedPasses:
    """Passes of several fits that run side by side: once every fit waits for a pass, one job answers them all.

    Every fit is written as if it had the table to itself; the table is read as often as the longest fit asks, not as often as all do.
    """

    def __init__(self, passes: TablePasses):
        self.passes, self.rows = passes, passes.rows
        self._turn, self._waiting, self._running = threading.Condition(), [], 0

    def run(self, fits: list[Callable[[], object]], at_once: int = 64) -> list:
        """Results of ``fits``, whose passes go through this object."""
        todo, out = iter(range(len(fits))), [None] * len(fits)
        self._running = min(at_once, len(fits))

        def work() -> None:
            try:
                while (at := self._next(todo)) is not None:
                    out[at] = fits[at]()
            finally:
                with self._turn:
                    self._running -= 1
                    self._answer()

        with ThreadPoolExecutor(self._running) as pool:
            for one in [pool.submit(work) for _ in range(self._running)]:
                one.result()
        return out

    def _next(self, todo: Iterator[int]) -> int | None:
        with self._turn:
            return next(todo, None)

    def sums(self, step: Step, length: int) -> np.ndarray:
        return self._ask("many_sums", (step, length))

    def draw(self, odds: Step, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self._ask("many_draws", (odds, seed))

    def _ask(self, kind: str, asked: tuple):
        one = {"kind": kind, "asked": asked}
        with self._turn:
            self._waiting.append(one)
            self._answer()
            self._turn.wait_for(lambda: "found" in one or "error" in one)
        if "error" in one:
            raise one["error"]
        return one["found"]

    def _answer(self) -> None:
        """Called with the lock held; all other fits wait as well when there is something to do."""
        if not self._waiting or len(self._waiting) < self._running:
            return
        waiting, self._waiting = self._waiting, []
        for kind in ("many_sums", "many_draws"):
            own = [w for w in waiting if w["kind"] == kind]
            try:
                for w, found in zip(own, getattr(self.passes, kind)([w["asked"] for w in own]) if own else []):
                    w["found"] = found
            except Exception as error:  # every fit that asked fails with it
                for w in own:
                    w["error"] = error
        self._turn.notify_all()


Passes = LocalPasses | TablePasses | SharedPasses


def gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres."""
    out = np.square(x).sum(axis=1)[:, None] - 2.0 * (x @ centres.T) + np.square(centres).sum(axis=1)
    return np.maximum(out, 0.0)


def nearest(x: np.ndarray, centres: np.ndarray, rows: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of every row and the squared distance, in blocks of rows that stay in the processor's cache."""
    turned, own = -2.0 * centres.T, np.square(centres).sum(axis=1)
    which, least = np.empty(len(x), int), np.empty(len(x))
    for start in range(0, len(x), rows):
        part = x[start : start + rows]
        out = part @ turned
        out += np.square(part).sum(axis=1)[:, None]
        out += own
        best = out.argmin(axis=1)
        which[start : start + rows], least[start : start + rows] = best, out[np.arange(len(part)), best]
    return which, np.maximum(least, 0.0)


def spread_centres(passes: Passes, k: int, centre: np.ndarray, scale: np.ndarray, total: float, seed: int) -> np.ndarray:
    """At most ``k`` distinct spread-out centres: seeding by oversampled rounds, then refinement.

    ``centre``, ``scale`` and ``total`` are the mean, the deviations and the number of all rows; distances are taken of scaled
    rows. Every round draws rows of all the table in proportion to their weight and their squared distance from the centres so
    far, about ``OVERSAMPLE * k`` of them; candidates are weighted by the rows they attract and reduced to k on the
    driver (some ten rows per component). Fewer than k distinct rows give as many centres as there are.
    """
    d = len(centre)

    def scaled(x: np.ndarray) -> np.ndarray:
        return (x - centre) / scale

    first, at = np.zeros((0, d)), 0
    while not len(first):  # about 20 rows are expected, so once is enough but for some e**-20
        first, _, chances = passes.draw(lambda x, w: 20.0 * w / total, seed + 101 * at)
        at += 1
        if at > 50:
            raise ValueError("no rows to start from")
    race = -np.log(unit_hash(first, seed)) / chances
    centres = scaled(first[[int(race.argmin())]])
    for r in range(ROUNDS):
        known = centres

        def reach(x: np.ndarray, w: np.ndarray, known: np.ndarray = known) -> np.ndarray:
            near = nearest(scaled(x), known)[1]
            return w * np.where(near > 1e-12, near, 0.0)

        cost = float(passes.sums(lambda x, w: np.array([reach(x, w).sum()]), 1)[0])
        if cost <= 1e-12 * total:
            break
        more, _, _ = passes.draw(lambda x, w, c=cost: max(OVERSAMPLE * k, 8.0) * reach(x, w) / c, seed + 1000 + r)
        if len(more):
            centres = np.unique(np.vstack([centres, scaled(more)]), axis=0)
    held = passes.sums(lambda x, w: np.bincount(nearest(scaled(x), centres)[0], w, len(centres)), len(centres))
    means = _reduced(centres, held, k, np.random.default_rng(seed))
    for _ in range(REFINEMENTS):
        many = len(means)

        def move(x: np.ndarray, w: np.ndarray, means: np.ndarray = means) -> np.ndarray:
            z = scaled(x)
            near = nearest(z, means)[0]
            return np.stack([np.bincount(near, c, len(means)) for c in (w, *(w * z.T))], axis=1).ravel()

        sums = passes.sums(move, many * (d + 1)).reshape(many, d + 1)
        means = np.where(sums[:, :1] > 0, sums[:, 1:] / np.maximum(sums[:, :1], 1e-300), means)
    return means * scale + centre


def _reduced(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Weighted k-means of few points, from the best of some spread-out starts."""
    if len(points) <= k:
        return points
    best, least = points[:k], math.inf
    for _ in range(8):
        means = points[[int(rng.choice(len(points), p=weights / weights.sum()))]]
        while len(means) < k:
            cost = weights * gaps(points, means).min(axis=1)
            if cost.sum() <= 0:
                break
            means = np.vstack([means, points[int(rng.choice(len(points), p=cost / cost.sum()))]])
        for _ in range(30):
            near = gaps(points, means).argmin(axis=1)
            mass = np.bincount(near, weights, len(means))
            moved = np.stack([np.bincount(near, weights * c, len(means)) for c in points.T], axis=1)
            means = np.where(mass[:, None] > 0, moved / np.maximum(mass[:, None], 1e-300), means)
        cost = float((weights * gaps(points, means).min(axis=1)).sum())
        if cost < least:
            best, least = means, cost
    return best
