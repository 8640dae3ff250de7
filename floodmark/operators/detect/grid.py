"""Hyper-parameter search over distributed fits."""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable

from pyspark.sql import DataFrame

from floodmark.plans.staging import staged


def grid_search(
    train: DataFrame, fit: Callable[..., tuple[object, float]], grid: dict[str, list], smallest: bool = True
) -> tuple[object, DataFrame]:
    """Fit every combination on one staged train table; ``fit(df, **params)`` returns (model, quality).

    Returns the best model (lowest quality value when ``smallest``) and the table of tries.
    """
    rows, best = [], None
    with staged(train, "grid") as table:
        for values in itertools.product(*grid.values()):
            params = dict(zip(grid, values))
            model, quality = fit(table, **params)
            rows.append((json.dumps(params, sort_keys=True), float(quality)))
            if best is None or (quality < best[0]) == smallest and quality != best[0]:
                best = (quality, model)
    return best[1], train.sparkSession.createDataFrame(rows, "params string, quality double")
