"""Gaussian mixture detector: fit on benign rows, log density as score (low = anomalous)."""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.functions.scores import flag_below
from floodmark.operators.detect.thresholds import percentile_threshold
from floodmark.plans.moments import mean_and_covariance
from floodmark.plans.staging import staged
from floodmark.plans.weighted import WEIGHT, LocalPasses, Passes, SharedPasses, TablePasses, nearest, spread_centres, weighted_rows

RIDGE = 1e-6
START_ROWS = 5_000
EXPRESSION_TERMS = 60


@dataclass
class MixtureModel:
    columns: list[str]
    weights: list[float]
    means: list[list[float]]
    whitening: list[list[list[float]]] = field(default_factory=list)  # inverse Cholesky factor per component
    log_norm: list[float] = field(default_factory=list)  # log weight plus log normalising constant
    threshold: float | None = None


def mixture_model(columns: list[str], weights, means, covariances) -> MixtureModel:
    d = len(columns)
    whitening, log_norm = [], []
    for w, cov in zip(weights, covariances):
        factor = np.linalg.cholesky(np.asarray(cov, dtype=float))
        whitening.append(np.linalg.inv(factor).tolist())
        log_norm.append(float(math.log(max(w, 1e-300)) - 0.5 * d * math.log(2 * math.pi) - np.log(np.diag(factor)).sum()))
    return MixtureModel(list(columns), [float(w) for w in weights], np.asarray(means, dtype=float).tolist(), whitening, log_norm)


def gmm_fit(df: DataFrame, columns: list[str], k: int = 1, max_iter: int = 100, seed: int = 42, n_init: int = 1) -> MixtureModel:
    """Full-covariance mixture; of ``n_init`` starts the one with the best likelihood is kept.

    k = 1 is closed form: mean and population covariance plus a small ridge, from one aggregation.
    """
    if k == 1:
        _, mean, cov = mean_and_covariance(df, columns)
        return mixture_model(columns, [1.0], [mean], [cov + RIDGE * np.eye(len(columns))])
    return max(em_fits(df, columns, [(k, "full", seed + i) for i in range(n_init)], max_iter), key=lambda fit: fit[1])[0]


def log_density(model: MixtureModel) -> Column:
    """Log density of a row as one JVM expression; for models of a few dozen terms."""
    logs = []
    for mean, white, norm in zip(model.means, model.whitening, model.log_norm):
        shifted = [F.col(c) - F.lit(m) for c, m in zip(model.columns, mean)]
        squares = []
        for i, row in enumerate(white):
            z = reduce(lambda a, b: a + b, [F.lit(row[j]) * shifted[j] for j in range(i + 1)])
            squares.append(z * z)
        logs.append(F.lit(norm) - F.lit(0.5) * reduce(lambda a, b: a + b, squares))
    if len(logs) == 1:
        return logs[0]
    top = F.greatest(*logs)
    return top + F.log(reduce(lambda a, b: a + b, [F.exp(x - top) for x in logs]))


def _log_components(x: np.ndarray, model: MixtureModel) -> np.ndarray:
    """Log density of every component (rows) at every row of ``x`` (columns): long lines, which numpy adds up fast."""
    columns, parts = np.ascontiguousarray(x.T), np.empty((len(model.weights), len(x)))
    for part, mean, white, norm in zip(parts, model.means, model.whitening, model.log_norm):
        z = np.asarray(white) @ (columns - np.asarray(mean)[:, None])
        z *= z
        part[:] = norm - 0.5 * z.sum(axis=0)
    return parts


def _log_sum(parts: np.ndarray) -> np.ndarray:
    top = parts.max(axis=0)
    return top + np.log(np.exp(parts - top).sum(axis=0))


def gmm_score(df: DataFrame, model: MixtureModel) -> DataFrame:
    """Adds ``score`` = log density (low = anomalous)."""
    d = len(model.columns)
    if len(model.weights) * d * (d + 1) // 2 <= EXPRESSION_TERMS:
        return df.withColumn("score", log_density(model))
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def density(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        return pd.Series(_log_sum(_log_components(x, shared.value)))

    return df.withColumn("score", density(*model.columns))


def gmm_threshold(train: DataFrame, model: MixtureModel, percentile: float = 5.0) -> MixtureModel:
    """Set the cut-off to the lowest ``percentile`` per cent of train densities."""
    cut = percentile_threshold(gmm_score(train, model), 100.0 - percentile, side="low")
    return MixtureModel(model.columns, model.weights, model.means, model.whitening, model.log_norm, cut)


def gmm_predict(df: DataFrame, model: MixtureModel) -> DataFrame:
    return gmm_score(df, model).withColumn("y_pred", flag_below("score", model.threshold))


def _free_parameters(k: int, d: int, kind: str) -> int:
    shape = {"full": k * d * (d + 1) // 2, "tied": d * (d + 1) // 2, "diag": k * d, "spherical": k}[kind]
    return shape + k * d + k - 1


def _m_step(kind: str, weight: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """New weights, means, covariances from summed responsibilities (k), sums (k,d), outer products (k,d,d)."""
    k, d = first.shape
    mass = np.maximum(weight, 1e-10)
    means = first / mass[:, None]
    covs = second / mass[:, None, None] - np.einsum("ki,kj->kij", means, means)
    if kind == "tied":
        covs = np.broadcast_to(np.einsum("k,kij->ij", weight / weight.sum(), covs), (k, d, d)).copy()
    elif kind in ("diag", "spherical"):
        diagonal = np.einsum("kii->ki", covs)
        if kind == "spherical":
            diagonal = np.broadcast_to(diagonal.mean(axis=1, keepdims=True), (k, d))
        covs = np.einsum("ki,ij->kij", diagonal, np.eye(d))
    return weight / weight.sum(), means, covs + RIDGE * np.eye(d)


def _e_step(x: np.ndarray, w: np.ndarray, model: MixtureModel, centre: np.ndarray) -> np.ndarray:
    """Log likelihood, summed responsibilities, weighted rows and weighted outer products around ``centre``, in one vector."""
    k, d = len(model.weights), len(centre)
    i, j = np.triu_indices(d)
    total, second = np.zeros(1 + k + k * d), np.zeros((k, len(i)))
    step = min(16_384, max(256, 1_000_000 // (d * d)))
    for start in range(0, len(x), step):
        part, weight = x[start : start + step], w[start : start + step]
        share = _log_components(part, model)
        top = share.max(axis=0)
        np.exp(np.subtract(share, top, out=share), out=share)
        mass = share.sum(axis=0)
        logs = top + np.log(mass)
        share *= weight / mass
        z = np.ascontiguousarray((part - centre).T)
        total += np.concatenate([[float((weight * logs).sum())], share.sum(axis=1), (share @ z.T).ravel()])
        second += share @ (z[i] * z[j]).T
    products = np.empty((k, d, d))
    products[:, i, j] = products[:, j, i] = second
    return np.concatenate([total, products.ravel()])


def _climb(passes: Passes, columns: list[str], model: MixtureModel, centre: np.ndarray, n: float, kind: str, max_iter: int, tol: float) -> tuple[MixtureModel, float]:
    """EM passes over all rows until the mean log likelihood changes by less than ``tol``."""
    k, d = len(model.weights), len(columns)
    previous = likelihood = -math.inf
    for _ in range(max_iter):
        sums = passes.sums(lambda x, w, m=model: _e_step(x, w, m, centre), 1 + k + k * d + k * d * d)
        likelihood = float(sums[0])
        if abs(likelihood - previous) / n < tol:
            break
        previous = likelihood
        weight, first = sums[1 : 1 + k], sums[1 + k : 1 + k + k * d].reshape(k, d)
        shares, means, covs = _m_step(kind, weight, first, sums[1 + k + k * d :].reshape(k, d, d))
        model = mixture_model(columns, shares, means + centre, covs)
    return model, likelihood


@dataclass
class Start:
    """What the fits of one number of components share, whatever their shape: centres, and sums of the rows nearest to each."""

    means: np.ndarray
    sums: np.ndarray

    def model(self, columns: list[str], centre: np.ndarray, kind: str) -> MixtureModel:
        k, d = self.means.shape
        shares, found, covs = _m_step(kind, self.sums[:k], self.sums[k : k + k * d].reshape(k, d), self.sums[k + k * d :].reshape(k, d, d))
        return mixture_model(columns, shares, found + centre, covs)


def _start(passes: Passes, n: float, centre: np.ndarray, cov: np.ndarray, k: int, seed: int) -> Start:
    """Centres from seeding over all rows; distances of the rows to them are taken in units of the components' common spread."""
    means = spread_centres(passes, k, centre, np.sqrt(np.maximum(np.diag(cov), 1e-300)), n, seed)
    k, d = means.shape
    scale = np.sqrt(np.maximum(passes.sums(lambda x, w: (w[:, None] * np.square(x - centre)).sum(axis=0), d), 1e-300))

    def moments(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        near, z = nearest((x - centre) / scale, (means - centre) / scale)[0], x - centre
        own = [(z[near == c], w[near == c]) for c in range(k)]
        first = np.stack([(zc * wc[:, None]).sum(axis=0) for zc, wc in own])
        second = np.stack([(zc * wc[:, None]).T @ zc for zc, wc in own])
        return np.concatenate([np.bincount(near, w, k), first.ravel(), second.ravel()])

    return Start(means, passes.sums(moments, k + k * d + k * d * d))


Drawn = tuple[np.ndarray, np.ndarray, np.ndarray]


def _first_rows(passes: Passes, n: float, seed: int, start_rows: int) -> Drawn | None:
    """A weighted draw of about ``start_rows`` rows where there are many more."""
    return passes.draw(lambda x, w: start_rows * w / n, seed + 7) if passes.rows > 4 * start_rows else None


def _first_model(columns: list[str], centre: np.ndarray, cov: np.ndarray, k: int, kind: str, max_iter: int, tol: float, start: Start | None, drawn: Drawn | None) -> MixtureModel:
    """Where the passes over all rows begin: closed form for one component, otherwise EM from the start on the drawn rows."""
    if k == 1:
        d = len(columns)
        full = {"full": cov, "tied": cov, "diag": np.diag(np.diag(cov)), "spherical": np.eye(d) * np.trace(cov) / d}[kind]
        return mixture_model(columns, [1.0], [centre], [full + RIDGE * np.eye(d)])
    model = start.model(columns, centre, kind)
    if drawn is not None:
        x, w, odds = drawn
        sample = LocalPasses(x, w / odds)  # a draw's inverse odds make its sums estimates of those over all rows
        model, _ = _climb(sample, columns, model, centre, float(sample.weights.sum()), kind, max_iter, tol)
    return model


def _finish(passes: Passes, columns: list[str], model: MixtureModel, centre: np.ndarray, n: float, k: int, kind: str, max_iter: int, tol: float) -> tuple[MixtureModel, float]:
    """EM on all rows; one component only needs its likelihood."""
    if k == 1:
        return model, float(passes.sums(lambda x, w: _e_step(x, w, model, centre)[:1], 1)[0])
    return _climb(passes, columns, model, centre, n, kind, max_iter, tol)


def _in_tasks(spark: SparkSession, many: int, work: Callable[[int], object]) -> list:
    """``work(0)`` to ``work(many - 1)``, each in a task of its own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for job in batch["id"]:
                yield pd.DataFrame({"job": [job], "found": [pickle.dumps(work(int(job)))]})

    rows = spark.range(0, many, 1, many).mapInPandas(run, "job long, found binary").collect()
    return [pickle.loads(r["found"]) for r in sorted(rows, key=lambda r: r["job"])]


def _moments(x: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    n = float(w.sum())
    centre = (w[:, None] * x).sum(axis=0) / n
    z = x - centre
    return n, centre, (w[:, None] * z).T @ z / n


#: Numbers of a table of distinct rows up to which every fit runs inside one task.
LOCAL_NUMBERS = 2_000_000


def em_fits(
    df: DataFrame, columns: list[str], wanted: list[tuple[int, str, int]], max_iter: int = 100, tol: float = 1e-3, start_rows: int = START_ROWS, local_numbers: int = LOCAL_NUMBERS
) -> list[tuple[MixtureModel, float, int]]:
    """A fit (model, total log likelihood, rows) for every (k, covariance shape, seed).

    Equal rows are counted first. While the distinct rows are few, they are broadcast and the fits are the tasks of one job, each
    doing the same passes in memory; otherwise the fits go side by side and one job over the staged table answers a pass of each.
    Fewer distinct rows than ``k`` give as many components as there are rows.
    """
    spark, d = df.sparkSession, len(columns)
    with staged(weighted_rows(df, columns), "gmm") as table:
        rows = table.count()
        if not rows:
            raise ValueError("a mixture needs rows to be fitted on")
        if rows * (d + 1) <= local_numbers:
            held = table.toPandas()
            x, w = held[columns].to_numpy(dtype=float), held[WEIGHT].to_numpy()
            shared = spark.sparkContext.broadcast((x, w))

            def local(job: int) -> tuple[MixtureModel, float, int]:
                k, kind, seed = wanted[job]
                passes = LocalPasses(*shared.value)
                n, centre, cov = _moments(passes.x, passes.weights)
                start, drawn = (_start(passes, n, centre, cov, k, seed), _first_rows(passes, n, seed, start_rows)) if k > 1 else (None, None)
                model = _first_model(columns, centre, cov, k, kind, max_iter, tol, start, drawn)
                return *_finish(passes, columns, model, centre, n, k, kind, max_iter, tol), int(n)

            found = _in_tasks(spark, len(wanted), local)
            shared.unpersist()
            return found
        n, centre, cov = mean_and_covariance(df, columns)
        passes = SharedPasses(TablePasses(table, columns, rows))
        # the shapes of one k and seed share their start, all fits of a seed the rows drawn
        pairs, seeds = (sorted({w[i] for w in wanted if w[0] > 1}) for i in (slice(0, 3, 2), 2))
        begun = passes.run([partial(_start, passes, float(n), centre, cov, *p) for p in pairs] + [partial(_first_rows, passes, float(n), s, start_rows) for s in seeds])
        starts, draws = dict(zip(pairs, begun)), dict(zip(seeds, begun[len(pairs) :]))
        given = spark.sparkContext.broadcast((starts, draws))

        def first(job: int) -> MixtureModel:
            k, kind, seed = wanted[job]
            return _first_model(columns, centre, cov, k, kind, max_iter, tol, given.value[0].get((k, seed)), given.value[1].get(seed))

        models = _in_tasks(spark, len(wanted), first)
        fits = [partial(_finish, passes, columns, model, centre, float(n), k, kind, max_iter, tol) for model, (k, kind, _) in zip(models, wanted)]
        return [(model, likelihood, n) for model, likelihood in passes.run(fits)]


def em_fit(df: DataFrame, columns: list[str], k: int, kind: str = "full", max_iter: int = 100, tol: float = 1e-3, seed: int = 42, start_rows: int = START_ROWS) -> tuple[MixtureModel, float, int]:
    """One fit of ``em_fits``."""
    return em_fits(df, columns, [(k, kind, seed)], max_iter, tol, start_rows)[0]


def gmm_select(
    df: DataFrame, columns: list[str], k_range=range(1, 10), kinds=("full", "tied", "diag", "spherical"), max_iter: int = 100, seed: int = 42, n_init: int = 1
) -> tuple[MixtureModel, DataFrame]:
    """Fit every (k, covariance shape) from ``n_init`` starts and keep the lowest BIC; also returns the table of fits."""
    wanted = [(k, kind, seed + i) for kind in kinds for k in k_range for i in range(n_init if k > 1 else 1)]
    best: dict[tuple[str, int], tuple[MixtureModel, float, int]] = {}
    for (k, kind, _), fit in zip(wanted, em_fits(df, columns, wanted, max_iter)):
        if (kind, k) not in best or fit[1] > best[kind, k][1]:
            best[kind, k] = fit
    rows = []
    for (kind, k), (model, likelihood, n) in best.items():
        p = _free_parameters(len(model.weights), len(columns), kind)
        rows.append((kind, k, p, likelihood, 2 * p - 2 * likelihood, p * math.log(n) - 2 * likelihood))
    report = df.sparkSession.createDataFrame(
        rows, "covariance string, k int, n_parameters int, log_likelihood double, aic double, bic double"
    )
    chosen = min(rows, key=lambda r: r[5])
    return best[chosen[0], chosen[1]][0], report
