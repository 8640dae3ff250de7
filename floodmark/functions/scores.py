"""Label and score expressions shared by detectors, ensembles and evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NORMAL, ANOMALY = 1, -1


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def binary_label(label: Column | str, mode: str = "benign") -> Column:
    """1 = normal, -1 = anomaly.

    ``strict`` knows only Normal and Anomalous (others become null); ``benign`` counts everything that
    is not Benign, a missing label included, as anomaly.
    """
    label = _col(label)
    if mode == "strict":
        return F.when(label == "Normal", NORMAL).when(label == "Anomalous", ANOMALY)
    return F.when(label.eqNullSafe(F.lit("Benign")), NORMAL).otherwise(ANOMALY)


def sigmoid_score(decision: Column | str) -> Column:
    """Map an SVM decision value (low = anomalous) to [0, 1] with high = anomalous."""
    return 1.0 / (1.0 + F.exp(_col(decision)))


def minmax_score(df: DataFrame, score: str, out: str = "score_01", invert: bool = False) -> DataFrame:
    """Scale a score to [0, 1] over the whole table; a constant score gives 0."""
    low, high = df.agg(F.min(score), F.max(score)).first()
    if low is None or high == low:
        return df.withColumn(out, F.lit(0.0))
    scaled = (F.col(score) - F.lit(low)) / F.lit(high - low)
    return df.withColumn(out, 1.0 - scaled if invert else scaled)


def flag_above(score: Column | str, threshold: float) -> Column:
    """-1 where the score exceeds the threshold, else 1."""
    return F.when(_col(score) > F.lit(threshold), ANOMALY).otherwise(NORMAL)


def flag_below(score: Column | str, threshold: float) -> Column:
    return F.when(_col(score) < F.lit(threshold), ANOMALY).otherwise(NORMAL)
