"""Size checks that decide between plan shapes, and joins that survive hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD_BYTES = 256 << 20
SPLIT_BYTES = 128 << 20


def size_in_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan (no job is run)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def file_partitions(table: DataFrame) -> int:
    """Upper estimate of the partitions of a plain file scan (files plus full splits)."""
    return len(table.inputFiles()) + size_in_bytes(table) // SPLIT_BYTES


def spread(df: DataFrame) -> DataFrame:
    """Give a small input (few bytes, hence few file splits) all cores; big inputs are left alone."""
    if size_in_bytes(df) >= SPREAD_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def broadcast_limit(df: DataFrame) -> int:
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    value = text.lower().rstrip("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(value[-1:], 1)
    return int(value.rstrip("kmg")) * scale


def fits_broadcast(df: DataFrame) -> bool:
    return size_in_bytes(df) <= broadcast_limit(df)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    residual: Column | None = None,
    salts: int = 16,
    small: bool | None = None,
) -> DataFrame:
    """Join a large, possibly skewed ``left`` with a lookup table ``right`` (at most few rows per key).

    A lookup below the broadcast limit is broadcast. A bigger one is shuffled, with the left rows of
    one key spread over ``salts`` tasks and the lookup rows repeated once per salt.
    ``small`` says what the estimate cannot know, for a ``right`` that was counted. ``residual`` refers to plain column names, which must differ between both sides except ``keys``.
    """
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(key) == F.col(f"_r_{key}"))
    if residual is not None:
        condition = condition & residual
    drop = [f"_r_{k}" for k in keys]
    if fits_broadcast(right) if small is None else small:
        return left.join(F.broadcast(renamed), condition, how).drop(*drop)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    spread = renamed.withColumn("_r_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = salted.join(spread, condition & (F.col("_salt") == F.col("_r_salt")), how)
    return joined.drop(*drop, "_salt", "_r_salt")
