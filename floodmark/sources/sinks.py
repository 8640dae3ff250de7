"""Sinks: metrics tables, dated feature and anomaly tables, the current-score snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from floodmark.plans.staging import scratch_path
from floodmark.sources.models import drop_versions, model_versions

METRIC_COLUMNS = [
    "model", "dataset", "training_samples", "test_samples", "features", "accuracy", "precision", "recall", "f1", "fpr",
    "training_time_s", "prediction_time_s", "avg_prediction_ms", "throughput", "tp", "fp", "fn", "tn",
]


def metrics_row(quality: DataFrame, model: str, dataset: str, training_samples: int, features: int, training_time_s: float, prediction_time_s: float) -> DataFrame:
    """The run row of a metrics table from the output of ``binary_metrics`` and the measured times."""
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return quality.withColumns(
        {
            "model": F.lit(model),
            "dataset": F.lit(dataset),
            "training_samples": F.lit(training_samples).cast("long"),
            "test_samples": n,
            "features": F.lit(features),
            "training_time_s": F.lit(float(training_time_s)),
            "prediction_time_s": F.lit(float(prediction_time_s)),
            "avg_prediction_ms": F.try_divide(F.lit(1000.0 * prediction_time_s), n),
            "throughput": F.try_divide(n.cast("double"), F.lit(float(prediction_time_s))),
        }
    ).select(*METRIC_COLUMNS)


def append_metrics(df: DataFrame, path: str) -> None:
    """Append run metrics (one row per run) to a Parquet metrics table."""
    df.write.mode("append").parquet(path)


def with_date(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("date", F.date_format(ts, "yyyy.MM.dd"))


def dated_sink(stream: DataFrame, path: str, ts: str, checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Append a stream to a table partitioned by day (``date=yyyy.MM.dd``), exactly once per checkpoint."""
    spark = stream.sparkSession
    writer = (
        with_date(stream, ts)
        .writeStream.format("parquet")
        .partitionBy("date")
        .option("path", path)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "dated-checkpoint"))
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_retained(spark: SparkSession, path: str, today: dt.date, days: int = 7) -> DataFrame:
    """The last ``days`` days of a dated table; older partitions are pruned, not scanned."""
    first = (today - dt.timedelta(days=days - 1)).strftime("%Y.%m.%d")
    return spark.read.parquet(path).filter((F.col("date") >= first) & (F.col("date") <= today.strftime("%Y.%m.%d")))


def latest_scores(scores: DataFrame, key: list[str], ts: str, now: Column, ttl_seconds: int = 60) -> DataFrame:
    """Newest score per key, dropped when older than the time to live at ``now`` (both epoch micros)."""
    newest = scores.groupBy(*key).agg(F.max_by("score", ts).alias("score"), F.max(ts).alias(ts))
    return newest.filter((now - F.col(ts)).between(0, ttl_seconds * 1_000_000))


def merge_latest(fresh: DataFrame, path: str, key: list[str], ts: str, version: int, ttl_seconds: int | None = None) -> None:
    """Merge new scores with the last snapshot under ``path`` into version ``version``; versions below the last one go.

    With ``ttl_seconds`` keys that are older than that against the newest time seen leave the snapshot. Of scores at the same time the highest stays,
    so a version that is written again is the same.
    """
    spark = fresh.sparkSession
    known = [v for v in model_versions(spark, path) if v < version]
    if known:
        fresh = fresh.unionByName(spark.read.parquet(f"{path}/v={max(known)}"))
    newest = fresh.groupBy(*key).agg(F.max_by("score", F.struct(ts, "score")).alias("score"), F.max(ts).alias(ts))
    if ttl_seconds is not None:
        latest = newest.agg(F.max(ts).alias("_latest"))  # one row
        newest = newest.join(F.broadcast(latest), F.col(ts) >= F.col("_latest") - F.lit(ttl_seconds * 1_000_000)).drop("_latest")
    newest.write.mode("overwrite").parquet(f"{path}/v={version}")
    drop_versions(spark, path, below=max(known, default=version))


def latest_score_sink(stream: DataFrame, path: str, key: list[str], ts: str, checkpoint: str | None = None, ttl_seconds: int | None = None) -> StreamingQuery:
    """Keep one newest score per key in a versioned snapshot table under ``path``.

    Each micro-batch merges its pre-aggregated newest scores with the last snapshot and writes the next
    version; a replayed batch overwrites its own version. ``ttl_seconds`` as in ``merge_latest``: the snapshot so holds the live keys
    only. The two newest versions stay, for readers and replays. Read it with ``read_snapshot``.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_latest(batch.select(*key, ts, "score"), path, key, ts, batch_id, ttl_seconds)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "latest-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )


def read_snapshot(spark: SparkSession, path: str, ts: str, now: Column, ttl_seconds: int = 60) -> DataFrame:
    versions = model_versions(spark, path)
    if not versions:  # nothing has been published yet
        return spark.createDataFrame([], f"score double, {ts} long")
    snapshot = spark.read.parquet(f"{path}/v={max(versions)}")
    return snapshot.filter((now - F.col(ts)).between(0, ttl_seconds * 1_000_000))
