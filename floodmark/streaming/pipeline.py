"""Streaming forms of the traffic operators. Each has a batch twin built from the same expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from floodmark.functions.http import path_features, status_class, time_features, user_agent_features
from floodmark.operators.detect.ocsvm import OneClassModel, ocsvm_update
from floodmark.operators.traffic import PARTIALS, SECOND_US, pane_us, pane_windows, request_partials, window_ratios, windows_of_panes
from floodmark.plans.staging import scratch_path
from floodmark.sources.models import drop_versions, load_model, model_versions, save_model


def stream_features(events: DataFrame) -> DataFrame:
    """Per-event features on arrival: time, path, user agent and status class. Stateless, so batch = stream.

    Expects ts, path, query, user_agent and status. Static enrichment joins (geo, threat list) apply
    unchanged on top.
    """
    return events.select(
        "*", *time_features("ts"), *path_features("path", "query"), *user_agent_features("user_agent"), *status_class("status")
    )


def stream_windows(events: DataFrame, size_seconds: int, slide_seconds: int | None = None, watermark: str = "10 minutes",
                   source: str = "src", ts: str = "ts", path: str = "path", table: str | None = None,
                   checkpoint: str | None = None) -> DataFrame | StreamingQuery:
    """Window features per source; rows later than the watermark are dropped.

    A first stateful step merges per (window, source, path), a second merges paths, so a busy source is
    spread over many state partitions and distinct paths stay exact without one big set.

    Both steps keep a row for every window that holds an event. Given ``table``, a started query is returned instead that
    appends the closed windows to that folder and keeps one row per (pane, source, path), however many windows hold it.
    """
    if table:
        return _windows_to_table(events, size_seconds, slide_seconds or size_seconds, watermark, source, ts, path, table, checkpoint)
    window = F.window(ts, f"{size_seconds} seconds", f"{slide_seconds} seconds" if slide_seconds else None)
    per_path = events.withWatermark(ts, watermark).groupBy(window.alias("w"), source, path).agg(*request_partials())
    again = F.window(F.window_time("w"), f"{size_seconds} seconds") if not slide_seconds else F.col("w")
    totals = per_path.groupBy(again.alias("w"), source).agg(*[F.sum(c).alias(c) for c in PARTIALS], F.count(path).alias("unique_paths"))
    start = F.unix_micros(F.col("w.start")).alias("window_start_us")
    return totals.select(source, start, *window_ratios(size_seconds))


def _windows_to_table(events: DataFrame, size_seconds: int, slide_seconds: int, watermark: str, source: str, ts: str, path: str,
                      table: str, checkpoint: str | None) -> StreamingQuery:
    """Micro-batches merged into panes under ``checkpoint``; the windows that a batch closes go to ``table``/batch=<id>.

    Rows of a batch are judged by the watermark of the batches before, window by window, and the windows that end up to its own
    watermark are closed (as where Spark runs a batch without data after each); the next batch takes over the panes that a later window still holds. A batch that comes again starts
    from the same version and overwrites its own folders. The newest version of ``clock`` has the watermark and the late rows so far.
    """
    spark = events.sparkSession
    root = checkpoint or scratch_path(spark, "windows-checkpoint")
    panes, clock = f"{root}/panes", f"{root}/clock"
    first, last = pane_windows(size_seconds, slide_seconds)
    last_end = last * F.lit(slide_seconds * SECOND_US) + F.lit(size_seconds * SECOND_US)
    pane = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(pane_us(size_seconds, slide_seconds))).cast("long")

    def close(batch: DataFrame, batch_id: int) -> None:
        rows = batch.filter(F.col(ts).isNotNull()).groupBy(source, path, pane.alias("_pane")).agg(*request_partials(), F.max(ts).alias("_latest"))
        schema, after, late_before = rows.schema, 0, 0  # a watermark starts at the epoch
        older = [v for v in model_versions(spark, clock) if v < batch_id]
        if older:
            after, late_before = spark.read.parquet(f"{clock}/v={max(older)}").select("watermark_us", "late_rows").first()
            kept = batch.sparkSession.read.schema(schema).parquet(f"{panes}/v={max(older)}").filter(last_end > after)
            sums = [F.sum(c).cast(schema[c].dataType).alias(c) for c in PARTIALS]
            rows = rows.unionByName(kept).groupBy(source, path, "_pane").agg(*sums, F.max("_latest").alias("_latest"))
        rows.write.mode("overwrite").parquet(f"{panes}/v={batch_id}")
        rows = spark.read.schema(schema).parquet(f"{panes}/v={batch_id}")
        newest = F.unix_micros(F.max("_latest").cast("timestamp") - F.expr(f"INTERVAL {watermark}"))
        late = F.sum(F.when((first <= last) & (last_end <= after), F.col("n")))
        newest_us, n_late = rows.agg(newest, F.coalesce(late, F.lit(0))).first()
        until = max(after, newest_us or 0)
        closed = windows_of_panes(rows, size_seconds, slide_seconds, after, until, source, path)
        closed.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")
        state = spark.createDataFrame([(until, late_before + n_late)], "watermark_us long, late_rows long")
        state.coalesce(1).write.mode("overwrite").parquet(f"{clock}/v={batch_id}")
        for folder in (panes, clock):
            drop_versions(spark, folder, below=max(older, default=0))

    return events.writeStream.foreachBatch(close).option("checkpointLocation", f"{root}/stream").trigger(availableNow=True).start()


class LateRows:
    """Rows dropped by the watermark since the query started.

    A query remembers its last progress reports only (100 by default), so ``poll`` adds up what is new since the last call; call it
    more often than reports are dropped. Reports that were missed are noticed by their batch numbers and raise an error.
    """

    def __init__(self, query: StreamingQuery):
        self.query, self.total, self._last = query, 0, -1

    def poll(self) -> int:
        fresh = [p for p in self.query.recentProgress if p.batchId > self._last]
        seen: dict[int, int] = {}
        for p in fresh:
            seen[p.batchId] = max(seen.get(p.batchId, 0), sum(int(op.numRowsDroppedByWatermark) for op in p.stateOperators))
        if self._last >= 0 and seen and min(seen) > self._last + 1:
            raise RuntimeError(f"progress of batches {self._last + 1} to {min(seen) - 1} is gone: poll more often")
        self.total += sum(seen.values())
        self._last = max(seen, default=self._last)
        return self.total


def late_rows(query: StreamingQuery) -> int:
    """``LateRows`` of a query whose progress reports are all still there."""
    return LateRows(query).poll()


def stream_dedup(events: DataFrame, key: list[str], ts: str = "ts", watermark: str = "10 minutes") -> DataFrame:
    """Drop events that were sent again within the watermark."""
    return events.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(key)


def stream_score(events: DataFrame, score: Callable[[DataFrame], DataFrame], publish: Callable[[DataFrame, int], None],
                 checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Score every micro-batch with the batch scorers and hand it to ``publish(df, batch_id)``.

    ``publish`` should be idempotent per batch id (a replayed batch comes again).
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        publish(score(batch), batch_id)

    writer = events.writeStream.foreachBatch(run).option(
        "checkpointLocation", checkpoint or scratch_path(events.sparkSession, "score-checkpoint")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def newest_model_score(spark: SparkSession, path: str, kinds: list[type], score: Callable[[DataFrame, object], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """A scorer for ``stream_score`` that uses the newest model version under ``path`` for each micro-batch.

    A version is loaded once; a model published while the stream runs serves from the next batch on.
    """
    loaded: dict[int, object] = {}

    def run(batch: DataFrame) -> DataFrame:
        newest = max(model_versions(spark, path))
        if newest not in loaded:
            loaded.clear()
            loaded[newest] = load_model(spark, f"{path}/v={newest}", kinds)
        return score(batch, loaded[newest])

    return run


def ocsvm_online(events: DataFrame, model: OneClassModel, path: str, verified_normal: str = "verified_normal",
                 checkpoint: str | None = None) -> tuple[StreamingQuery, Callable[[], OneClassModel]]:
    """One gradient step per micro-batch of verified-normal rows; each version is saved under ``path``.

    A batch starts from the newest version before it, so a restarted stream goes on where it stopped and a batch that
    comes again is applied to the version it was applied to before. Versions below the previous one are removed.
    """
    spark = events.sparkSession

    def before(batch_id: int) -> OneClassModel:
        versions = [v for v in model_versions(spark, path) if v < batch_id]
        return load_model(spark, f"{path}/v={max(versions)}", [OneClassModel]) if versions else model

    def step(batch: DataFrame, batch_id: int) -> None:
        save_model(spark, ocsvm_update(batch.filter(F.col(verified_normal)), before(batch_id)), f"{path}/v={batch_id}")
        drop_versions(spark, path, below=batch_id - 1)

    query = (
        events.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "online-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    return query, lambda: before(2**62)


def stream_alert(scores: DataFrame, key: str = "deployment", ts: str = "ts", score: str = "score", limit: float = 0.8,
                 minutes: int = 5, watermark: str = "10 minutes") -> DataFrame:
    """Alert when the mean score of every one of ``minutes`` consecutive minutes exceeds the limit."""
    per_minute = scores.withWatermark(ts, watermark).groupBy(F.window(ts, "1 minute").alias("w"), key).agg(F.avg(score).alias("m"))
    sliding = F.window(F.window_time("w"), f"{minutes} minutes", "1 minute")
    spans = per_minute.groupBy(sliding.alias("w"), key).agg(F.min("m").alias("lowest"), F.count("*").alias("n"))
    return spans.filter((F.col("lowest") > limit) & (F.col("n") == minutes)).select(
        key, F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "lowest"
    )
