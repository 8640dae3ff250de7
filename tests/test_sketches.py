import numpy as np
import pytest
from pyspark.sql import functions as F

from floodmark.operators import cleaning
from floodmark.operators.detect import thresholds
from floodmark.plans import sketches
from floodmark.plans.staging import scratch_path


def table(spark, values, day="a"):
    return spark.createDataFrame([(day, float(v) if v is not None else None) for v in values], "day string, x double")


def rank_gap(values, found, fraction):
    """How far the fraction lies outside the ranks that the value covers."""
    return max((values < found).mean() - fraction, fraction - (values <= found).mean(), 0.0)


@pytest.mark.parametrize("k", [50, 1000])
def test_merged_days_keep_the_stated_rank_error(spark, k):
    values = np.random.default_rng(3).lognormal(0, 2, 60_000)
    rows = spark.createDataFrame([(str(i % 37), float(v)) for i, v in enumerate(values)], "day string, x double")
    stored = sketches.sketch_columns(rows, ["x"], "day", k)
    assert stored.count() == 37
    for fraction in (0.01, 0.5, 0.95, 0.999):
        found = sketches.quantiles_by_column(stored, [fraction])["x"][0]
        assert rank_gap(values, found, fraction) <= sketches.rank_error(k)


def test_ties_nulls_nan_and_infinite_values(spark):
    df = table(spark, [1, 1, 1, 1, None, float("nan"), float("inf"), 2])
    (row,) = sketches.merged_quantiles(sketches.sketch_columns(df, ["x"], "day"), [0.0, 0.5, 1.0]).collect()
    assert (row.n, row.quantiles) == (6, [1.0, 1.0, float("inf")])
    assert sketches.sketch_columns(table(spark, [None, float("nan")]), ["x"], "day").count() == 0


def test_a_busy_day_is_summed_up_before_the_shuffle(spark):
    stored = sketches.sketch_columns(spark.range(400_000).select(F.lit("a").alias("day"), F.col("id").cast("double").alias("x")), ["x"], "day")
    plan = stored._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "partial_kll_sketch_agg_double" in plan
    (row,) = stored.collect()
    assert row.n == 400_000 and len(row.sketch) < 64_000


def test_days_written_again_are_replaced_and_old_ones_pruned(spark):
    path = scratch_path(spark, "sketches")
    sketches.store_sketches(sketches.sketch_columns(table(spark, range(10), "2024.01.01"), ["x"], "day"), path)
    sketches.store_sketches(sketches.sketch_columns(table(spark, [100] * 5, "2024.01.02"), ["x"], "day"), path)
    sketches.store_sketches(sketches.sketch_columns(table(spark, [200] * 7, "2024.01.02"), ["x"], "day"), path)
    assert {r.day: r.n for r in sketches.read_sketches(spark, path).collect()} == {"2024.01.01": 10, "2024.01.02": 7}
    newest = sketches.read_sketches(spark, path, first="2024.01.02")
    assert thresholds.refresh_threshold(newest, 95.0, "x") == 200.0
    plan = newest._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(day" in plan


def test_refreshed_values_agree_with_the_fits(spark):
    df = table(spark, range(1, 10))
    stored = sketches.sketch_columns(df, ["x"], "day")
    assert cleaning.median_refresh(stored, ["x"]).values == cleaning.median_fit(df, ["x"]).values == [5.0]
    limits = cleaning.clip_refresh(stored, ["x"], 0.0, 1.0)
    assert (limits.low, limits.high) == ([1.0], [9.0])


def test_empty_tables_and_unknown_columns(spark):
    empty = sketches.sketch_columns(table(spark, [1]).limit(0), ["x"], "day")
    assert empty.count() == 0 and sketches.quantiles_by_column(empty, [0.5]) == {}
    with pytest.raises(ValueError, match="no stored sketch of x"):
        thresholds.refresh_threshold(empty, 95.0, "x")
