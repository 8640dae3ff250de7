"""Drift checks, retraining sets and the adaptive threshold."""

from __future__ import annotations

import bisect
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.functions.scores import ANOMALY, NORMAL

DAY_US = 86_400_000_000


def _histogram(df: DataFrame, columns: list[str], ranges: dict[str, tuple[float, float]], bins: int, name: str) -> DataFrame:
    entries = []
    for c in columns:
        low, high = ranges[c]
        value = F.col(c).cast("double")
        bin_ = F.floor((value - F.lit(low)) / F.lit((high - low) / bins))
        inside = value.between(low, high)
        entries.append(F.struct(F.lit(c).alias("feature"), F.when(inside, F.least(bin_, F.lit(bins - 1))).cast("int").alias("bin")))
    long = df.select(F.inline(F.array(*entries))).filter("bin is not null")
    return long.groupBy("feature", "bin").agg(F.count("*").alias(name))


def kl_drift(train: DataFrame, recent: DataFrame, columns: list[str], bins: int = 50, limit: float = 0.5) -> DataFrame:
    """KL divergence (nats) of binned feature distributions, train against recent, for every feature.

    Bins are equal-width on the train range, the last one closed; recent values outside are dropped. A
    constant feature is binned on [value - 0.5, value + 0.5].
    """
    row = train.agg(
        *[F.min(F.col(c).cast("double")).alias(f"a{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(c).cast("double")).alias(f"b{i}") for i, c in enumerate(columns)],
    ).first()
    ranges = {}
    for i, c in enumerate(columns):
        low, high = row[f"a{i}"], row[f"b{i}"]
        ranges[c] = (low, high) if low != high else (low - 0.5, high + 0.5)
    grid = train.sparkSession.createDataFrame([(c, b) for c in columns for b in range(bins)], "feature string, bin int")
    counts = grid.join(_histogram(train, columns, ranges, bins, "n_train"), ["feature", "bin"], "left").join(
        _histogram(recent, columns, ranges, bins, "n_recent"), ["feature", "bin"], "left"
    )
    totals = counts.groupBy("feature").agg(F.sum("n_train").alias("t_train"), F.sum("n_recent").alias("t_recent"))
    renorm = 1.0 + bins * 1e-10

    def share(n: str, total: str) -> Column:
        return (F.coalesce(F.try_divide(n, total), F.lit(0.0)) + 1e-10) / renorm

    p, q = share("n_train", "t_train"), share("n_recent", "t_recent")
    kl = counts.join(totals, "feature").groupBy("feature").agg(F.sum(p * F.log(p / q)).alias("kl"))
    return kl.withColumn("drifted", F.col("kl") > limit)


def retrain_set(df: DataFrame, now_us: int, last_trained_us: int, ts_us: str = "ts_us", y_pred: str = "y_pred", days: int = 7) -> tuple[bool, DataFrame]:
    """Whether retraining is due, and the rows of the last ``days`` days not flagged anomalous."""
    due = (now_us - last_trained_us) // DAY_US >= days
    recent = F.col(ts_us).between(F.lit(now_us - days * DAY_US), F.lit(now_us))
    return due, df.filter(recent & (F.col(y_pred) != ANOMALY))


class ScoreRing:
    """The last ``size`` accepted scores, in arrival and in sorted order.

    Only accepted scores move the threshold, so ``replay`` decides a whole run of flagged (or missing) scores by one array
    comparison and steps through accepted ones only. As flagged scores stay out, the threshold of a long key sinks: of n evenly
    spread scores about 20 * size * ln(n / (20 * size)) are accepted, and that is the number of Python steps.
    """

    def __init__(self, default: float, size: int = 1000, percentile: float = 95.0, minimum: int = 100, start=()):
        self.default, self.size, self.percentile, self.minimum = default, size, percentile, minimum
        self.arrival = deque(start)
        self.sorted = sorted(self.arrival)
        self.steps = 0  # accepted scores so far, each a Python step

    def threshold(self) -> float:
        if len(self.sorted) < self.minimum:
            return self.default
        at = (len(self.sorted) - 1) * self.percentile / 100.0
        low = int(at)
        high = min(low + 1, len(self.sorted) - 1)
        return self.sorted[low] + (self.sorted[high] - self.sorted[low]) * (at - low)

    def accept(self, score: float) -> None:
        if len(self.arrival) == self.size:
            del self.sorted[bisect.bisect_left(self.sorted, self.arrival.popleft())]
        self.arrival.append(score)
        bisect.insort(self.sorted, score)
        self.steps += 1

    def replay(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Threshold in force for each score and whether it is exceeded; accepted scores enter the ring.

        A missing score (NaN) is neither flagged nor remembered.
        """
        scores = np.asarray(scores, dtype=float)
        limits = np.empty(len(scores))
        at, limit = 0, self.threshold()
        while at < len(scores):
            end, width = at, 1
            while end < len(scores):  # the first accepted score, looked for in windows that double
                below = scores[end : end + width] <= limit
                first = int(below.argmax())
                if below[first]:
                    end += first
                    break
                end, width = min(end + width, len(scores)), width * 2
            limits[at : end + 1] = limit
            if end < len(scores):
                self.accept(float(scores[end]))
                limit = self.threshold()
            at = end + 1
        return limits, scores > limits


def tie_break(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns of ``columns`` that rows can be ordered by."""
    return [c for c in columns if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]


def adaptive_threshold(
    df: DataFrame, key: str, ts: str, score: str, default: float, size: int = 1000, percentile: float = 95.0, minimum: int = 100
) -> DataFrame:
    """Running percentile of the last ``size`` scores of the key that were not flagged, and the flag.

    The feedback makes each key sequential. Rows of a key stream through one task in time order as Arrow
    batches; the task holds one ring of ``size`` scores, never the whole key, and steps through accepted scores only.
    Keys may be null (one key of their own); a missing score is not flagged and gets the threshold in force.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("threshold", T.DoubleType()), T.StructField("y_pred", T.IntegerType())])
    rest = [c for c in df.columns if c not in (key, ts, score)]  # equal times replay in one order
    ordered = df.repartition(key).sortWithinPartitions(key, ts, *tie_break(df, rest), score)

    def replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, ring = None, None
        for batch in batches:
            keys = batch[key]
            same = (keys == keys.shift()) | (keys.isna() & keys.shift().isna())
            edges = [0, *(np.flatnonzero(~same.to_numpy(dtype=bool, na_value=False)[1:]) + 1), len(batch)]
            scores = batch[score].to_numpy(dtype=float, na_value=np.nan)
            limits, flags = np.empty(len(batch)), np.empty(len(batch), dtype=bool)
            for a, b in zip(edges, edges[1:]):
                k = None if pd.isna(keys.iloc[a]) else keys.iloc[a]
                if ring is None or k != current:
                    current, ring = k, ScoreRing(default, size, percentile, minimum)
                limits[a:b], flags[a:b] = ring.replay(scores[a:b])
            yield batch.assign(threshold=limits, y_pred=np.where(flags, ANOMALY, NORMAL).astype("int32"))

    return ordered.mapInPandas(replay, schema)
