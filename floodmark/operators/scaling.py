"""Scaling-decision analytics: replica rules, policies, cost, success rate, alerts. Pure table work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floodmark.functions.scores import ANOMALY
from floodmark.plans.chunks import lag_in_key

MIN_REPLICAS, MAX_REPLICAS, TARGET_CPU = 2, 10, 70.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hpa_replicas(current: Column | str, metric: Column | str, target: float = TARGET_CPU) -> Column:
    """ceil(current * metric / target), clamped to the replica limits."""
    desired = F.ceil(_col(current) * _col(metric) / F.lit(float(target))).cast("int")
    return F.greatest(F.lit(MIN_REPLICAS), F.least(F.lit(MAX_REPLICAS), desired))


def threat_aware_replicas(current: Column | str, cpu: Column | str, score: Column | str) -> Column:
    """Scale down in an attack, one step at a time when unsure, by CPU otherwise."""
    current, cpu, score = _col(current), _col(cpu), _col(score)
    fewer = F.greatest(F.lit(MIN_REPLICAS), current - 1)
    cautious = F.when(cpu > 90, current + 1).when(cpu < 30, fewer).otherwise(current)
    return F.when(score >= 0.7, fewer).when(score >= 0.3, cautious).otherwise(hpa_replicas(current, cpu)).cast("int")


def score_gate(score: Column | str, limit: float = 0.8) -> Column:
    """False blocks scaling up."""
    return ~(_col(score) > limit)


def attack_policy(y_pred: Column | str, packet_rate: Column | str, limit: float, current: Column | str) -> list[Column]:
    """Attack: limit suspicious traffic to 10/s and scale down; benign: follow the packet rate."""
    attack, rate = _col(y_pred) == ANOMALY, _col(packet_rate)
    shrink = F.when(_col(current) > MIN_REPLICAS, "down").otherwise("hold")
    by_load = F.when(rate > limit, "up").when(rate < limit, "down").otherwise("hold")
    return [
        F.when(attack, F.lit(10)).alias("rate_limit"),
        F.when(attack, shrink).otherwise(by_load).alias("action"),
    ]


def anomaly_share_gate(df: DataFrame, by: list[str], y_pred: str = "y_pred", limit: float = 0.5) -> DataFrame:
    """Per group: share of anomalies and whether scaling up is still allowed."""
    share = F.avg((F.col(y_pred) == ANOMALY).cast("double"))
    return df.groupBy(*by).agg(share.alias("anomaly_share")).withColumn("scale_up_allowed", F.col("anomaly_share") <= limit)


def scaling_cost(df: DataFrame, baseline: str, policy: str = "policy", deployment: str = "deployment", ts_us: str = "ts_us",
                 replicas: str = "replicas", per_pod_hour: float = 0.05) -> DataFrame:
    """Pod-seconds and cost per policy, and savings against ``baseline``.

    Each sample counts until the next sample of the same policy and deployment (the last one counts 0).
    """
    timed = lag_in_key(df, [policy, deployment], ts_us, [ts_us], forward=True)
    seconds = (F.coalesce(F.col(f"_next_{ts_us}"), F.col(ts_us)) - F.col(ts_us)) / F.lit(1e6)
    totals = timed.groupBy(policy).agg(F.sum(seconds * F.col(replicas)).alias("pod_seconds"))
    totals = totals.withColumn("cost", F.col("pod_seconds") / 3600.0 * per_pod_hour)
    base = F.max(F.when(F.col(policy) == baseline, F.col("cost"))).over(Window.partitionBy())  # one row per policy
    return totals.withColumns({"_base": base}).select(
        policy,
        "pod_seconds",
        "cost",
        (F.col("_base") - F.col("cost")).alias("savings"),
        F.coalesce(F.try_divide(100.0 * (F.col("_base") - F.col("cost")), F.col("_base")), F.lit(0.0)).alias("savings_pct"),
    )


def legit_success_rate(df: DataFrame, ts_us: str, start_us: int, end_us: int, legit: Column, ok: Column) -> DataFrame:
    """Percent of legitimate requests of a time range that succeeded."""
    rows = df.filter(F.col(ts_us).between(F.lit(start_us), F.lit(end_us)))
    return rows.agg(
        F.count_if(legit).alias("n_legit"),
        F.count_if(legit & ok).alias("n_success"),
        F.try_divide(100.0 * F.count_if(legit & ok), F.count_if(legit)).alias("success_pct"),
    )


def sustained_alert(df: DataFrame, key: str = "deployment", ts_us: str = "ts_us", score: str = "score", limit: float = 0.8,
                    seconds: int = 300, chunk_us: int = 86_400_000_000) -> DataFrame:
    """Runs of consecutive samples above ``limit`` that last at least ``seconds``.

    Runs are found inside (key, chunk) by gaps and islands; only the first and last run of a chunk can
    cross its edge, and those are stitched over one small row set per key.
    """
    high = F.col(score) > limit
    chunked = df.filter(F.col(score).isNotNull()).select(
        key, ts_us, high.alias("high"), F.floor(F.col(ts_us) / F.lit(chunk_us)).cast("long").alias("chunk")
    )
    ordered = Window.partitionBy(key, "chunk").orderBy(ts_us)
    lows = F.count_if(~F.col("high")).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    runs = chunked.withColumn("lows", lows).groupBy(key, "chunk", "lows").agg(
        F.min(F.when(F.col("high"), F.col(ts_us))).alias("start"),
        F.max(F.when(F.col("high"), F.col(ts_us))).alias("end"),
        F.count_if("high").alias("n"),
    )
    # a run with lows = 0 touches the left edge of its chunk; the run with the highest lows touches the right edge
    edges = Window.partitionBy(key, "chunk")
    runs = runs.withColumn("last_lows", F.max("lows").over(edges))
    inner = runs.filter((F.col("lows") > 0) & (F.col("lows") < F.col("last_lows")) & (F.col("n") > 0))
    edge = runs.filter((F.col("lows") == 0) | (F.col("lows") == F.col("last_lows")))
    # along the edge runs of a key a new island starts wherever a low sample precedes: lows > 0
    along = Window.partitionBy(key).orderBy("chunk", "lows").rowsBetween(Window.unboundedPreceding, 0)
    stitched = (
        edge.withColumn("island", F.sum((F.col("lows") > 0).cast("int")).over(along))
        .groupBy(key, "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"))
        .filter("n > 0")
    )
    found = inner.select(key, "start", "end", "n").unionByName(stitched.select(key, "start", "end", "n"))
    long_enough = (F.col("end") - F.col("start")) >= seconds * 1_000_000
    return found.filter(long_enough).select(
        key, F.col("start").alias("start_us"), F.col("end").alias("end_us"), F.col("n").alias("n_samples")
    )


def defensive_scaling_alert(df: DataFrame, key: str = "deployment", ts_us: str = "ts_us", replicas: str = "replicas",
                            cpu: str = "cpu_percent", limit: float = 90.0) -> DataFrame:
    """Samples where replicas fell against the previous sample while CPU was high."""
    timed = lag_in_key(df, [key], ts_us, [replicas])
    before = F.col(f"_prev_{replicas}")
    fell = (F.col(replicas) < before) & (F.col(cpu) > limit)
    return timed.filter(fell).select(key, ts_us, before.alias("replicas_before"), replicas, cpu)
