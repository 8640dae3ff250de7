"""Adaptive threshold as keyed stream state: a ring of accepted scores per key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from floodmark.functions.scores import ANOMALY, NORMAL
from floodmark.operators.drift import ScoreRing

OUTPUT = "key string, row_id long, ts_us long, score double, threshold double, y_pred int"


class AdaptiveThresholdProcessor(StatefulProcessor):
    """Replays scores of one key in time order within each micro-batch; state = accepted scores."""

    def __init__(self, default: float, size: int, percentile: float, minimum: int):
        self.default, self.size, self.percentile, self.minimum = default, size, percentile, minimum

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType([T.StructField("scores", T.ArrayType(T.DoubleType()))])
        self.state = handle.getValueState("ring", schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        start = list(self.state.get()[0]) if self.state.exists() else []
        ring = ScoreRing(self.default, self.size, self.percentile, self.minimum, start)
        # a micro-batch is bounded by the source's rate limit
        batch = pd.concat(list(rows)).sort_values(["ts_us", "row_id"])
        limits, flags = ring.replay(batch["score"].to_numpy(dtype=float, na_value=np.nan))
        self.state.update((list(ring.arrival),))
        yield pd.DataFrame(
            {
                "key": str(key[0]),
                "row_id": batch["row_id"].to_numpy(),
                "ts_us": batch["ts_us"].to_numpy(),
                "score": batch["score"].to_numpy(),
                "threshold": limits,
                "y_pred": np.where(flags, ANOMALY, NORMAL).astype("int32"),
            }
        )

    def close(self) -> None:
        pass


def stream_adaptive_threshold(
    scores: DataFrame, key: str, default: float, size: int = 1000, percentile: float = 95.0, minimum: int = 100
) -> DataFrame:
    """Stream twin of ``adaptive_threshold`` for rows (key, row_id, ts_us, score). Needs the RocksDB state store."""
    processor = AdaptiveThresholdProcessor(default, size, percentile, minimum)
    rows = scores.select(key, "row_id", "ts_us", "score")
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=OUTPUT, outputMode="Append", timeMode="None"
    )
