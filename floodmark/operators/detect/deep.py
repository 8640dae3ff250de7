"""Deep autoencoder: batch normalisation and dropout between the layers of the network, trained like ``autoencoder``.

While training, a normalised layer uses the moments of its mini-batch, as usual. For scoring (and for the validation loss) its
moments are those of all train rows under the shared weights, summed over all parts of the table before every round, layer by
layer, as the moments of a later layer depend on those of an earlier one. So the model's moments are exact, not a moving average that
differs from part to part.

Dropout masks come from a generator keyed by the seed, the step and a checksum of the mini-batch: they differ between steps and
batches, and a task that runs again draws the same ones.

Rows must have no nulls (as for ``autoencoder``; see ``cleaning``). A layer that is constant over the rows has variance 0 and is
normalised to its shift.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodmark.functions.scores import flag_above
from floodmark.operators.detect.autoencoder import _layers, fit_rounds, initial_weights, layer_sizes, parameter_count
from floodmark.operators.detect.thresholds import percentile_threshold
from floodmark.plans.moments import sum_vectors

#: Added to a variance before its root is taken.
EPSILON = 1e-3

Moments = list[tuple[np.ndarray, np.ndarray]]


@dataclass
class DeepModel:
    columns: list[str]
    sizes: list[int]
    weights: list[float]  # dense layers, then scale and shift of every normalised layer
    normalised: list[int] = field(default_factory=lambda: [0])  # hidden layers that are normalised
    means: list[list[float]] = field(default_factory=list)
    variances: list[list[float]] = field(default_factory=list)
    threshold: float | None = None
    sigmoid: bool = True


def deep_initial(sizes: Sequence[int], normalised: Sequence[int], seed: int = 42) -> np.ndarray:
    """Dense weights as in ``autoencoder``; scales 1, shifts 0."""
    return np.concatenate([initial_weights(list(sizes), seed), *[np.repeat([1.0, 0.0], sizes[i + 1]) for i in normalised]])


def _affine(flat: np.ndarray, sizes: Sequence[int], normalised: Sequence[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    out, at = {}, parameter_count(list(sizes))
    for i in normalised:
        n = sizes[i + 1]
        out[i] = (flat[at : at + n], flat[at + n : at + 2 * n])
        at += 2 * n
    return out


def dropout_mask(x: np.ndarray, width: int, layer: int, rate: float, step: int, seed: int) -> np.ndarray:
    """Kept units of a mini-batch, scaled by the share that stays."""
    key = np.array([np.uint64(seed % 2**32) << np.uint64(32) | np.uint64(zlib.crc32(np.ascontiguousarray(x).tobytes())), np.uint64(step) << np.uint64(8) | np.uint64(layer)])
    kept = np.random.Generator(np.random.Philox(key=key)).random((len(x), width)) >= rate
    return kept / (1.0 - rate)


def _last(z: np.ndarray, sigmoid: bool) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60.0, 60.0))) if sigmoid else z


def deep_forward(x: np.ndarray, flat: np.ndarray, sizes: Sequence[int], normalised: Sequence[int], moments: Moments, sigmoid: bool, upto: int | None = None) -> np.ndarray:
    """Reconstruction with given moments; with ``upto`` the output of that hidden layer before it is normalised."""
    layers, affine, at = _layers(flat, list(sizes)), _affine(flat, sizes, normalised), dict(zip(normalised, moments))
    for i, (w, b) in enumerate(layers[:-1]):
        x = np.maximum(x @ w + b, 0.0)
        if i == upto:
            return x
        if i in affine:
            (scale, shift), (mean, variance) = affine[i], at[i]
            x = scale * (x - mean) / np.sqrt(variance + EPSILON) + shift
    return _last(x @ layers[-1][0] + layers[-1][1], sigmoid)


def deep_gradient(x: np.ndarray, flat: np.ndarray, sizes: Sequence[int], normalised: Sequence[int], masks: dict[int, np.ndarray], sigmoid: bool) -> tuple[float, np.ndarray]:
    """Mean squared error of a mini-batch under its own moments and the given masks, and its gradient."""
    layers, affine = _layers(flat, list(sizes)), _affine(flat, sizes, normalised)
    inputs, active, unit, root = [x], {}, {}, {}
    for i, (w, b) in enumerate(layers[:-1]):
        h = np.maximum(inputs[-1] @ w + b, 0.0)
        active[i] = h > 0
        if i in affine:
            root[i] = np.sqrt(h.var(axis=0) + EPSILON)
            unit[i] = (h - h.mean(axis=0)) / root[i]
            h = affine[i][0] * unit[i] + affine[i][1]
        inputs.append(h * masks[i] if i in masks else h)
    out = _last(inputs[-1] @ layers[-1][0] + layers[-1][1], sigmoid)
    error = out - x
    delta = 2.0 * error / error.size * (out * (1.0 - out) if sigmoid else 1.0)
    dense, own = [], {}
    for i in range(len(layers) - 1, -1, -1):
        dense[:0] = [(inputs[i].T @ delta).ravel(), delta.sum(axis=0)]
        if i == 0:
            break
        delta, below = delta @ layers[i][0].T, i - 1
        if below in masks:
            delta = delta * masks[below]
        if below in affine:
            own[below] = np.concatenate([(delta * unit[below]).sum(axis=0), delta.sum(axis=0)])
            d = delta * affine[below][0]
            delta = (d - d.mean(axis=0) - unit[below] * (d * unit[below]).mean(axis=0)) / root[below]
        delta = delta * active[below]
    return float(np.square(error).mean()), np.concatenate([*dense, *[own[i] for i in normalised]])


def layer_moments(rows: DataFrame, columns: list[str], flat: np.ndarray, sizes: Sequence[int], normalised: Sequence[int], partitions: int | None = None) -> Moments:
    """Mean and variance of every normalised layer over all rows: one pass for each, two vectors of its width travel from each partition.

    With a known number of ``partitions`` few vectors are summed without a shuffle. Sums are taken of differences from the layer's output at a row of zeros, so means far from 0 lose no digits to squares.
    """
    moments: Moments = []
    for place, layer in enumerate(normalised):
        known, width = list(moments), sizes[layer + 1]
        origin = deep_forward(np.zeros((1, sizes[0])), flat, sizes, normalised[:place], known, False, layer)[0]

        def sums(batches: Iterator[pd.DataFrame], layer: int = layer, known: Moments = known, before: Sequence[int] = tuple(normalised[:place]), origin: np.ndarray = origin) -> Iterator[pd.DataFrame]:
            total = np.zeros(1 + 2 * len(origin))
            for batch in batches:
                h = deep_forward(batch.to_numpy(dtype=float), flat, sizes, before, known, False, layer) - origin
                total += np.concatenate([[len(h)], h.sum(axis=0), np.square(h).sum(axis=0)])
            yield pd.DataFrame({"s": [total]})

        total = sum_vectors(rows.select(*columns).mapInPandas(sums, "s array<double>"), "s", partitions and partitions * (1 + 2 * width))
        n = max(total[0], 1.0) if len(total) else 1.0
        first, second = (total[1 : 1 + width] / n, total[1 + width :] / n) if len(total) else (np.zeros(width), np.zeros(width))
        moments.append((origin + first, np.maximum(second - first * first, 0.0)))
    return moments


def deep_fit(
    df: DataFrame, columns: list[str], row_id: str, sizes: list[int] | None = None, normalised: Sequence[int] = (0,), dropout: float = 0.2, epochs: int = 100,
    patience: int | None = 10, learning_rate: float = 1e-3, seed: int = 42, rows_per_partition: int = 4096, sigmoid: bool = True, validation: float = 0.2,
) -> tuple[DeepModel, list[tuple[float, float]]]:
    """Train on benign rows (in [0, 1] for a sigmoid output); returns the model and (train, validation loss) per epoch.

    ``normalised`` hidden layers are normalised and then dropped out with rate ``dropout`` (0 = none).
    """
    sizes, layers = list(sizes or layer_sizes(len(columns), "deep")), sorted(normalised)
    if layers and not 0 <= layers[0] <= layers[-1] < len(sizes) - 2:
        raise ValueError("only hidden layers can be normalised")

    def gradient(x: np.ndarray, flat: np.ndarray, step: int) -> tuple[float, np.ndarray]:
        masks = {i: dropout_mask(x, sizes[i + 1], i, dropout, step, seed) for i in layers} if dropout else {}
        return deep_gradient(x, flat, sizes, layers, masks, sigmoid)

    def errors(x: np.ndarray, flat: np.ndarray, moments: Moments) -> np.ndarray:
        return np.square(deep_forward(x, flat, sizes, layers, moments, sigmoid) - x).mean(axis=1)

    def refresh(table: DataFrame, flat: np.ndarray, parts: int) -> Moments:
        return layer_moments(table, columns, flat, sizes, layers, parts)

    best, moments, history = fit_rounds(
        df, columns, row_id, deep_initial(sizes, layers, seed), gradient, errors, refresh, epochs, patience, learning_rate, seed, rows_per_partition, validation
    )
    means, variances = [m.tolist() for m, _ in moments], [v.tolist() for _, v in moments]
    return DeepModel(list(columns), sizes, best.tolist(), layers, means, variances, None, sigmoid), history


def deep_score(df: DataFrame, model: DeepModel) -> DataFrame:
    """Adds ``mse`` per row; with a cut-off also ``score`` = mse / cut-off (high = anomalous)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def error(*columns: pd.Series) -> pd.Series:
        m = shared.value
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        moments = [(np.asarray(a), np.asarray(b)) for a, b in zip(m.means, m.variances)]
        return pd.Series(np.square(deep_forward(x, np.asarray(m.weights), m.sizes, m.normalised, moments, m.sigmoid) - x).mean(axis=1))

    out = df.withColumn("mse", error(*model.columns))
    return out if model.threshold is None else out.withColumn("score", F.col("mse") / F.lit(model.threshold))


def deep_threshold(train: DataFrame, model: DeepModel, percentile: float = 95.0) -> DeepModel:
    return replace(model, threshold=percentile_threshold(deep_score(train, replace(model, threshold=None)), percentile, "mse"))


def deep_predict(df: DataFrame, model: DeepModel) -> DataFrame:
    return deep_score(df, model).withColumn("y_pred", flag_above("mse", model.threshold))
