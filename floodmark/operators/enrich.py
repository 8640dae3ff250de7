"""Joins and set operations: labels, samples, geo blocks, threat lists, as-of scores, comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floodmark.functions.scores import ANOMALY, NORMAL
from floodmark.plans.chunks import overlap_chunks
from floodmark.plans.sizing import broadcast_limit, fits_broadcast, skew_join


def attach_labels(features: DataFrame, labels: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Join features and labels one to one by row id."""
    return features.join(labels, row_id)


def select_ids(df: DataFrame, ids: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Keep the rows whose id is listed; a small list is broadcast, a big one is shuffled."""
    ids = ids.select(row_id)
    return df.join(F.broadcast(ids) if fits_broadcast(ids) else ids, row_id, "left_semi")


def geo_enrich(
    df: DataFrame, blocks: DataFrame, address: str, columns: list[str], start: str = "start", end: str = "end",
    width: int = 1 << 16,
) -> DataFrame:
    """Attach the columns of the block whose [start, end] holds the address; unmatched rows keep nulls.

    Blocks are cut at multiples of ``width`` (a /16 prefix for IPv4 numbers), so the range condition
    becomes an equi-join on the prefix with a residual test.
    """
    cut = blocks.select(
        F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))).alias("_prefix"),
        F.col(start).alias("_start"),
        F.col(end).alias("_end"),
        *columns,
    )
    # Catalyst does not count what explode adds, so the prefixes are counted before anything may be broadcast
    prefixes = blocks.agg(F.sum(F.floor(F.col(end) / width) - F.floor(F.col(start) / width) + 1)).first()[0] or 0
    per_row = 48 * len(cut.columns)
    small = prefixes * per_row <= broadcast_limit(df)
    left = df.withColumn("_prefix", F.floor(F.col(address) / width))
    inside = F.col(address).between(F.col("_start"), F.col("_end"))
    return skew_join(left, cut, ["_prefix"], "left", inside, small=small).drop("_prefix", "_start", "_end")


def blacklist_flag(df: DataFrame, bad: DataFrame, key: str, out: str = "blacklisted") -> DataFrame:
    """1 where the key is on the threat list."""
    listed = bad.select(key).distinct().withColumn("_hit", F.lit(1))
    return skew_join(df, listed, [key]).withColumn(out, F.coalesce("_hit", F.lit(0))).drop("_hit")


def score_asof(ticks: DataFrame, scores: DataFrame, key: list[str], ts_us: str = "ts_us", ttl_seconds: int = 60) -> DataFrame:
    """For each tick the newest score of its key at or before it, null when older than the time to live.

    Time is cut into slots of a hundredth of the time to live. Inside (key, slot) ticks and scores are interleaved by time;
    the newest score of earlier slots comes from a table with one row per key and slot. So a busy key is served by
    as many tasks as it has slots, and no inequality join is planned.
    """
    ttl = ttl_seconds * 1_000_000
    size = ttl // 100
    others = [c for c in ticks.columns if c not in (*key, ts_us)]
    left = ticks.select(*key, ts_us, F.struct(*others).alias("_tick") if others else F.lit(1).alias("_tick"))
    left = left.withColumn("_score", F.lit(None).cast("double"))
    right = scores.select(*key, ts_us, F.col("score").cast("double").alias("_score"))
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_is_tick", F.col("_tick").isNotNull().cast("int"))
    both = both.withColumn("_slot", F.floor(F.col(ts_us) / F.lit(size)).cast("long"))
    known = F.when(F.col("_is_tick") == 0, F.struct(F.col(ts_us).alias("t"), F.col("_score").alias("s")))
    so_far = Window.partitionBy(*key, "_slot").orderBy(ts_us, "_is_tick").rowsBetween(Window.unboundedPreceding, 0)
    inside = both.withColumn("_last", F.last(known, True).over(so_far)).filter("_is_tick = 1")
    # the newest score of a slot: at equal times the last one in the order of the scores
    slots = both.groupBy(*key, "_slot").agg(F.max(known).alias("_newest")).withColumn("_start", F.col("_slot") * F.lit(size))
    before = Window.partitionBy(*key, "_chunk").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    earlier = overlap_chunks(slots, "_start", ttl + size).withColumn("_earlier", F.last("_newest", True).over(before)).filter(~F.col("_copy"))
    earlier = earlier.select(*[F.col(k).alias(f"_k_{k}") for k in key], F.col("_slot").alias("_k_slot"), "_earlier")
    same = F.col("_slot") == F.col("_k_slot")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = inside.join(earlier, same).withColumn("_last", F.coalesce("_last", "_earlier"))
    fresh = (F.col(ts_us) - F.col("_last.t")) <= ttl
    return joined.select(
        *key,
        ts_us,
        *[F.col(f"_tick.{c}").alias(c) for c in others],
        F.when(fresh, F.col("_last.s")).alias("score"),
        F.when(fresh, F.col("_last.t")).alias("score_ts_us"),
    )


def model_agreement(model: DataFrame, baseline: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Agreement of two predictions of the same rows, and anomalies found by only one of them."""
    joined = model.select(row_id, F.col("y_pred").alias("a")).join(
        baseline.select(row_id, F.col("y_pred").alias("b")), row_id
    )
    return joined.agg(
        F.count("*").alias("n"),
        F.avg((F.col("a") == F.col("b")).cast("double")).alias("agreement"),
        F.count_if((F.col("a") == ANOMALY) & (F.col("b") == NORMAL)).alias("model_only"),
        F.count_if((F.col("a") == NORMAL) & (F.col("b") == ANOMALY)).alias("baseline_only"),
    )


def compare_generations(metrics: DataFrame, generations: list[str], metric: str, base: str) -> DataFrame:
    """One row per model with the metric of each data generation and its change against ``base``."""
    wide = metrics.groupBy("model").pivot("generation", generations).agg(F.max(metric))
    deltas = [(F.col(g) - F.col(base)).alias(f"{g}_delta") for g in generations if g != base]
    return wide.select("model", *generations, *deltas)


def experiment_union(runs: dict[str, DataFrame]) -> DataFrame:
    """Concatenate runs, each tagged with its experiment name."""
    tagged = [df.withColumn("experiment", F.lit(name)) for name, df in runs.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
