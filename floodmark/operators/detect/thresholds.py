"""Percentile cut-offs from train scores."""

from __future__ import annotations

from pyspark.sql import DataFrame

from floodmark.functions.scores import flag_above, flag_below
from floodmark.plans.quantiles import exact_quantile
from floodmark.plans.sketches import stored_quantiles
from floodmark.plans.staging import staged


def percentile_threshold(df: DataFrame, percentile: float, score: str = "score", side: str = "high") -> float:
    """Cut-off that leaves ``percentile`` per cent of the scores on the normal side (linear interpolation)."""
    with staged(df.select(score), "scores") as scores:  # the quantile takes several passes, the scorer runs once
        return exact_quantile(scores, score, (percentile if side == "high" else 100.0 - percentile) / 100.0)


def refresh_threshold(sketches: DataFrame, percentile: float, score: str = "score", side: str = "high") -> float:
    """``percentile_threshold`` from stored daily sketches: a value of the scores whose rank is off by at most ``rank_error``."""
    return stored_quantiles(sketches, [score], [(percentile if side == "high" else 100.0 - percentile) / 100.0])[0][0]


def apply_threshold(df: DataFrame, threshold: float, score: str = "score", side: str = "high") -> DataFrame:
    flag = flag_above if side == "high" else flag_below
    return df.withColumn("y_pred", flag(score, threshold))
