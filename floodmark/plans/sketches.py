"""Stored quantile sketches: one KLL sketch per day and column, merged instead of rescanning old days.

Sketches are built by partial aggregation, so a day that holds most rows is summed up where it is read. A stored day is some kilobytes per
column whatever its rows; cut-offs, medians and clipping bounds of any span of days come from merging them. Ranks are off
by at most ``rank_error(k)`` of the rows with 99 % confidence, and not at all while a merge holds no more than ``k`` values.

Nulls and NaN are no values and are left out of ``n``; a column without values gives no row. Infinite values count as values. Rows
without a day get a null day, which spans leave out. An empty table stores nothing and has no quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

K = 1000


def rank_error(k: int = K) -> float:
    """Share of the rows by which a rank may be off: the published fit of the sketch's error at 99 % confidence."""
    return 2.296 / k**0.9723


def sketch_columns(df: DataFrame, columns: Sequence[str], day: Column | str, k: int = K) -> DataFrame:
    """One row per day and column: ``day``, ``column``, ``n``, ``sketch``. One pass, one shuffle of sketches."""
    values = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    wide = df.select((F.col(day) if isinstance(day, str) else day).alias("_day"), *[v.alias(f"_v{i}") for i, v in enumerate(values.values())]).groupBy("_day").agg(
        *[F.kll_sketch_agg_double(f"_v{i}", F.lit(k)).alias(f"_s{i}") for i in range(len(columns))],
        *[F.count(f"_v{i}").alias(f"_n{i}") for i in range(len(columns))],
    )
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("n"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(columns)]
    return wide.select(F.col("_day").alias("day"), F.inline(F.array(*parts))).filter("n > 0")


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Write the days of ``sketches`` to a table partitioned by day; days written again are replaced, others stay."""
    sketches.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_sketches(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Stored sketches of the days from ``first`` to ``last`` (both included); other days are pruned, not read."""
    stored = spark.read.schema("column string, n bigint, sketch binary, day string").parquet(path)
    if first is not None:
        stored = stored.filter(F.col("day") >= first)
    return stored if last is None else stored.filter(F.col("day") <= last)


def merged_quantiles(sketches: DataFrame, fractions: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Quantiles of every column (and group of ``by``) as ``quantiles``, in the order of ``fractions``, with the merged ``n``.

    A quantile is a value of the data: the smallest one whose rank reaches the fraction.
    """
    merged = sketches.groupBy("column", *by).agg(F.kll_merge_agg_double("sketch").alias("_all"), F.sum("n").alias("n"))
    asked = F.array(*[F.lit(float(f)) for f in fractions])
    return merged.select("column", *by, "n", F.kll_sketch_get_quantile_double("_all", asked).alias("quantiles"))


def quantiles_by_column(sketches: DataFrame, fractions: Sequence[float]) -> dict[str, list[float]]:
    """``merged_quantiles`` on the driver: a few numbers per column."""
    return {r["column"]: list(r["quantiles"]) for r in merged_quantiles(sketches, fractions).collect()}


def stored_quantiles(sketches: DataFrame, columns: Sequence[str], fractions: Sequence[float]) -> list[list[float]]:
    """Quantiles of ``columns`` in their order; raises for a column of which no value is stored."""
    found = quantiles_by_column(sketches.filter(F.col("column").isin(list(columns))), fractions)
    missing = [c for c in columns if c not in found]
    if missing:
        raise ValueError(f"no stored sketch of {', '.join(missing)}")
    return [found[c] for c in columns]
