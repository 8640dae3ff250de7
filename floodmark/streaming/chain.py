"""One stream from log lines to decisions that feeds several tables under one batch number.

Every micro-batch is scored once and written as ``scored/batch=<id>``; the other outputs are made from that written table, the
snapshot of newest scores from it and the version before. Last comes a marker ``_committed/<id>``. Batches run one after the other, so at most
the batch after the newest marker can be half written: readers take batches up to the marker and see all tables at the same
state. A batch that comes again overwrites its own folders, or is passed over when its marker is there already, so a driver that
dies between two outputs, or between the marker and the checkpoint, neither loses nor doubles a row.

``score`` must be a function of the rows alone (and of a model kept by version), as a batch that comes again is computed again. An empty
micro-batch writes empty folders and a marker.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from floodmark.operators.traffic import PARTIALS, SECOND_US, request_partials, window_ratios
from floodmark.plans.staging import scratch_path
from floodmark.sources.models import model_versions
from floodmark.sources.sinks import merge_latest, with_date

MARKERS = "_committed"
SCORED, SNAPSHOT = "scored", "snapshot"


@dataclass(frozen=True)
class Output:
    """A table beside the scored rows: made from one batch of them, by day of ``date_of`` if given."""

    name: str
    rows: Callable[[DataFrame], DataFrame]
    date_of: str | None = None


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def committed(spark: SparkSession, root: str) -> int:
    """Number of the newest batch whose outputs are all written; -1 before the first."""
    files, folder = _files(spark, f"{root}/{MARKERS}")
    if not files.exists(folder):
        return -1
    return max((int(s.getPath().getName()) for s in files.listStatus(folder)), default=-1)


def _commit(spark: SparkSession, root: str, batch_id: int) -> None:
    """The new marker appears before older ones go, so there is always one."""
    files, folder = _files(spark, f"{root}/{MARKERS}")
    path = spark._jvm.org.apache.hadoop.fs.Path
    files.create(path(folder, str(batch_id)), True).close()
    for old in files.listStatus(folder):
        if int(old.getPath().getName()) < batch_id:
            files.delete(old.getPath(), False)


def _write(rows: DataFrame, path: str, date_of: str | None) -> None:
    writer = (with_date(rows, date_of) if date_of else rows).write.mode("overwrite")
    # one batch is one folder: replaced as a whole, whatever the session says of partitions
    (writer.option("partitionOverwriteMode", "static").partitionBy("date") if date_of else writer).parquet(path)


def chained_stream(
    events: DataFrame, score: Callable[[DataFrame], DataFrame], outputs: Sequence[Output], root: str, key: Sequence[str], ts_us: str = "ts_us",
    date_of: str = "ts", ttl_seconds: int | None = None, checkpoint: str | None = None, available_now: bool = True,
) -> StreamingQuery:
    """Run ``events`` (parsed, deduplicated, with features) through ``score`` into all tables under ``root``.

    ``score`` adds ``score``; rows without one stay in the scored table and leave the snapshot alone. The snapshot holds the newest score per
    ``key`` and drops keys older than ``ttl_seconds`` against the newest time seen.
    """
    spark = events.sparkSession
    names = [o.name for o in outputs]
    if len({*names, SCORED, SNAPSHOT, MARKERS}) < len(names) + 3:
        raise ValueError(f"names of outputs must differ from each other, {SCORED}, {SNAPSHOT} and {MARKERS}")

    def publish(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= committed(spark, root):
            batch.write.format("noop").mode("overwrite").save()  # state before the sinks still takes the rows in
            return
        here = f"{root}/{SCORED}/batch={batch_id}"
        scored = score(batch)
        _write(scored, here, date_of)
        rows = spark.read.schema(scored.schema).parquet(here)
        for output in outputs:
            _write(output.rows(rows), f"{root}/{output.name}/batch={batch_id}", output.date_of)
        merge_latest(rows.filter("score is not null").select(*key, ts_us, "score"), f"{root}/{SNAPSHOT}", list(key), ts_us, batch_id, ttl_seconds)
        _commit(spark, root, batch_id)

    writer = events.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint or scratch_path(spark, "chain-checkpoint"))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_output(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Rows of all committed batches of one table; a batch under way is pruned by its folder."""
    newest = committed(spark, root)
    if newest < 0:
        raise ValueError(f"nothing committed under {root}")
    return spark.read.parquet(f"{root}/{name}").filter(F.col("batch") <= newest)


def read_chain_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Newest scores as of the newest committed batch."""
    newest = [v for v in model_versions(spark, f"{root}/{SNAPSHOT}") if v <= committed(spark, root)]
    if not newest:
        raise ValueError(f"nothing committed under {root}")
    return spark.read.parquet(f"{root}/{SNAPSHOT}/v={max(newest)}")


def window_partials(size_seconds: int, source: str = "src", ts_us: str = "ts_us", path: str = "path") -> Callable[[DataFrame], DataFrame]:
    """Rows of an ``Output`` that sums up its batch per window, source and path: additive, so no state and no watermark."""
    size = size_seconds * SECOND_US

    def rows(batch: DataFrame) -> DataFrame:
        start = (F.floor(F.col(ts_us) / F.lit(size)) * F.lit(size)).cast("long")
        return batch.groupBy(source, start.alias("window_start_us"), path).agg(*request_partials())

    return rows


def read_windows(partials: DataFrame, size_seconds: int, source: str = "src", path: str = "path") -> DataFrame:
    """Window features over all batches so far; windows that are still filling are included."""
    sums = [F.sum(c).alias(c) for c in PARTIALS]
    per_path = partials.groupBy(source, "window_start_us", path).agg(*sums)
    totals = per_path.groupBy(source, "window_start_us").agg(*sums, F.count(path).alias("unique_paths"))
    return totals.select(source, "window_start_us", *window_ratios(size_seconds))
