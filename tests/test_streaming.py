import datetime as dt
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from floodmark.operators import drift, traffic
from floodmark.plans.staging import checkpoint_root, scratch_path
from floodmark.sources import sinks
from floodmark.streaming import adaptive, pipeline

SCHEMA = "src long, ts timestamp, path string, status int, payload double, row_id long"
T0 = dt.datetime(2024, 1, 1)


def row(src, second, path="/a", status=200, payload=1.0, row_id=0):
    return (src, T0 + dt.timedelta(seconds=second), path, status, payload, row_id)


def batches(spark, folder, groups):
    """Write one file per group and stream them one file per micro-batch, oldest first."""
    for i, rows in enumerate(groups):
        out = f"{folder}/part-{i}"
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(out)
        time.sleep(1.1)  # file order follows modification time
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def run(stream, name="t"):
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    query = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", scratch_path(spark, name))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path), query


def test_windows_match_batch_and_late_rows_are_dropped(spark, tmp_path):
    groups = [
        [row(1, 1), row(1, 9, "/b", 500, 3.0), row(2, 3)],
        [row(1, 4, "/a", 404)],  # out of order but in time
        [row(1, 1500), row(2, 1501)],
        [row(1, 1502)],  # lateness is judged by the watermark of the batch before
        [row(1, 5, "/late")],  # older than the watermark
        [row(1, 4000)],
    ]
    out, query = run(pipeline.stream_windows(batches(spark, tmp_path / "in", groups), 10))
    kept = [r for g in (0, 1, 2, 3) for r in groups[g]]
    batch = spark.createDataFrame(kept, SCHEMA).withColumn("ts_us", F.unix_micros("ts"))
    want = sorted(map(tuple, traffic.traffic_window(batch, 10).collect()))
    assert sorted(map(tuple, out.collect())) == want
    assert pipeline.late_rows(query) >= 1


def plain(rows):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


SLIDING = [
    [row(1, 1), row(1, 9, "/b", 500, 3.0), row(2, 3), row(1, 33), row(1, 34, None), row(None, 65, "/b", 404, None), row(1, 72, status=None)],
    [row(1, 12, "/b"), row(3, 700), (1, None, "/a", 200, 1.0, 0)],  # the watermark goes to second 100
    [row(1, 95), row(1, 20), row(2, 20), row(2, 130, "/b"), row(2, 131, "/b")],  # 95: late for the window up to 100 only; 20: late
    [row(1, 96), row(3, 745)],  # windows up to 145 are closed, the next ones still hold panes of the batches before
    [row(2, 148, "/c"), row(1, 4000)],
]


def closed_windows(groups, size, slide):
    """Windows that are closed after the last batch, row by row, and the number of late rows."""
    held, mark, late, zero = {}, 0, 0, dt.datetime(1970, 1, 1)
    for rows in groups:
        timed = [((r[1] - zero) // dt.timedelta(microseconds=1), r) for r in rows if r[1]]
        for us, r in timed:
            starts = [k * slide for k in range((us // 1_000_000 - size) // slide, us // 1_000_000 // slide + 1) if k * slide <= us / 1_000_000 < k * slide + size]
            kept = [s for s in starts if (s + size) * 1_000_000 > mark]
            late += bool(starts) and not kept
            for s in kept:
                held.setdefault((r[0], s), []).append(r)
        mark = max([mark, *(us - 600_000_000 for us, _ in timed)])
    out = []
    for (src, start), rows in held.items():
        if (start + size) * 1_000_000 <= mark:
            n, paid = len(rows), [r[4] for r in rows if r[4] is not None]
            shares = [sum(r[3] is not None and r[3] // 100 == k for r in rows) / n for k in (2, 4, 5)]
            out.append((src, start * 1_000_000, n, n / size, len({r[2] for r in rows} - {None}), *shares, sum(paid) / len(paid) if paid else None))
    return out, late


@pytest.mark.parametrize(("size", "slide"), [(60, 10), (20, 50)])
def test_windows_in_a_table_are_closed_by_the_watermark(spark, tmp_path, size, slide):
    stream, table, check = batches(spark, tmp_path / "in", SLIDING), str(tmp_path / "table"), str(tmp_path / "check")
    pipeline.stream_windows(stream, size, slide, table=table, checkpoint=check).awaitTermination()
    got, (want, late) = spark.read.parquet(table).drop("batch"), closed_windows(SLIDING, size, slide)
    assert got.schema.simpleString() == pipeline.stream_windows(stream, size).schema.simpleString()
    assert plain(got.collect()) == plain(want) and len(want) > 3
    newest = max(int(p.name[2:]) for p in (tmp_path / "check" / "clock").glob("v=*"))
    assert spark.read.parquet(f"{check}/clock/v={newest}").first().late_rows == late
    assert len(list((tmp_path / "check" / "panes").glob("v=*"))) == 2


def test_sliding_windows_keep_one_row_per_event(spark, tmp_path):
    """The stateful form keeps a row for each of the six windows of an event, twice."""
    rows = [row(i % 5, 60 * i, f"/{i}") for i in range(50)]
    stream = batches(spark, tmp_path / "in", [rows])
    table, check = str(tmp_path / "table"), str(tmp_path / "check")
    query = pipeline.stream_windows(stream, 60, 10, table=table, checkpoint=check)
    query.awaitTermination()
    assert not any(p.stateOperators for p in query.recentProgress)
    assert spark.read.parquet(f"{check}/panes").count() == 50
    assert spark.read.parquet(table).count() == 6 * len([r for r in rows if (r[1] - T0).total_seconds() + 60 <= 49 * 60 - 600])


def test_sliding_windows_go_on_after_a_restart(spark, tmp_path):
    """Stopped in between, with the commit of its last batch lost, the stream writes the windows of one run."""
    once = batches(spark, tmp_path / "once", SLIDING)
    pipeline.stream_windows(once, 60, 10, table=str(tmp_path / "one"), checkpoint=str(tmp_path / "one-check")).awaitTermination()
    for part in (SLIDING[:3], SLIDING[3:]):
        for rows in part:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/twice/part-{SLIDING.index(rows)}")
            time.sleep(1.1)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/twice/*")
        pipeline.stream_windows(stream, 60, 10, table=str(tmp_path / "two"), checkpoint=str(tmp_path / "two-check")).awaitTermination()
        commits = tmp_path / "two-check" / "stream" / "commits"
        newest = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
        if newest == 2:
            for lost in (commits / "2", commits / ".2.crc"):
                lost.unlink(missing_ok=True)
    assert plain(spark.read.parquet(str(tmp_path / "two")).collect()) == plain(spark.read.parquet(str(tmp_path / "one")).collect())


@pytest.mark.parametrize(("size", "slide"), [(60, 10), (60, 25), (20, 50), (600, 7)])
def test_windows_of_panes_equal_windows_of_events(spark, size, slide):
    rng = np.random.default_rng(5)
    rows = [row(int(s), int(t), None if p == 9 else f"/{p}", int(c), float(v)) for s, t, p, c, v in
            zip(rng.integers(0, 3, 800), rng.integers(0, 4000, 800), rng.integers(0, 10, 800), rng.choice([200, 404, 500], 800), rng.random(800))]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("ts_us", F.unix_micros("ts"))
    pane = F.floor(F.col("ts_us") / traffic.pane_us(size, slide)).cast("long").alias("_pane")
    panes = df.groupBy("src", "path", pane).agg(*traffic.request_partials())
    start = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    after, until = start + 900_000_000, start + 3_000_000_000
    want = traffic.traffic_window(df, size, slide).filter(f"window_start_us + {size}000000 > {after} and window_start_us + {size}000000 <= {until}")
    got = traffic.windows_of_panes(panes, size, slide, after, until)
    assert plain(got.collect()) == plain(want.collect()) and got.schema.simpleString() == want.schema.simpleString()


def test_resent_events_are_dropped(spark, tmp_path):
    groups = [[row(1, i, row_id=i) for i in range(5)] * 2, [row(1, i, row_id=i) for i in range(3, 8)]]
    out, _ = run(pipeline.stream_dedup(batches(spark, tmp_path / "in", groups), ["row_id"]))
    assert sorted(r.row_id for r in out.collect()) == list(range(8))


def test_alert_needs_consecutive_minutes(spark, tmp_path):
    rows = [row(1, 60 * m + 5, payload=0.9) for m in (0, 1, 2, 3, 4, 6, 7, 8, 9)] + [row(2, 60 * m, payload=0.95 if m != 3 else 0.1) for m in range(7)]
    stream = batches(spark, tmp_path / "in", [rows, [row(9, 9000)], [row(9, 20000)]])
    out, _ = run(pipeline.stream_alert(stream, key="src", score="payload"))
    start = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    assert [(r.src, r.start_us - start, r.end_us - start) for r in out.collect()] == [(1, 0, 300_000_000)]


def test_adaptive_stream_equals_batch(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [row(i % 3, i, payload=float(v), row_id=i) for i, v in enumerate(rng.lognormal(0, 1, 900))]
    stream = batches(spark, tmp_path / "in", [rows[:400], rows[400:]]).withColumn("ts_us", F.unix_micros("ts"))
    scores = stream.select("src", "row_id", "ts_us", F.col("payload").alias("score"))
    out, _ = run(adaptive.stream_adaptive_threshold(scores, "src", 3.0, size=100, minimum=30))
    table = spark.createDataFrame(rows, SCHEMA).withColumn("ts_us", F.unix_micros("ts"))
    want = drift.adaptive_threshold(table, "src", "ts_us", "payload", 3.0, size=100, minimum=30)
    a = sorted((r.row_id, r.threshold, r.y_pred) for r in out.collect())
    b = sorted((r.row_id, r.threshold, r.y_pred) for r in want.collect())
    assert a == b and len(a) == 900


def test_snapshot_keeps_newest_and_expires(spark, tmp_path):
    groups = [[row(1, 10, payload=0.1), row(2, 10, payload=0.2)], [row(1, 5, payload=0.9), row(1, 70, payload=0.3)]]
    stream = batches(spark, tmp_path / "in", groups).select("src", F.unix_micros("ts").alias("ts_us"), F.col("payload").alias("score"))
    path = scratch_path(spark, "snapshot")
    sinks.latest_score_sink(stream, path, ["src"], "ts_us").awaitTermination()
    now = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() + 75) * 1_000_000
    got = {r.src: r.score for r in sinks.read_snapshot(spark, path, "ts_us", F.lit(now)).collect()}
    assert got == {1: 0.3}
    table = spark.createDataFrame([r for g in groups for r in g], SCHEMA).select("src", F.unix_micros("ts").alias("ts_us"), F.col("payload").alias("score"))
    assert {r.src: r.score for r in sinks.latest_scores(table, ["src"], "ts_us", F.lit(now)).collect()} == got


def test_dated_sink_prunes_old_days(spark, tmp_path):
    stream = batches(spark, tmp_path / "in", [[row(1, 0), row(1, 86_400 * 8)]])
    path = scratch_path(spark, "dated")
    sinks.dated_sink(stream, path, "ts").awaitTermination()
    kept = sinks.read_retained(spark, path, dt.date(2024, 1, 9), days=7)
    assert [r.date for r in kept.collect()] == ["2024.01.09"]
    assert "PartitionFilters: [isnotnull(date" in kept._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_scoring_hands_each_batch_to_publish_once(spark, tmp_path):
    seen = {}
    stream = batches(spark, tmp_path / "in", [[row(1, 1)], [row(2, 2), row(3, 3)]])
    pipeline.stream_score(stream, lambda df: df.withColumn("score", F.col("payload") * 2), lambda df, i: seen.update({i: df.count()})).awaitTermination()
    assert sum(seen.values()) == 3 and len(seen) == 2


def test_checkpoint_folder_comes_from_the_session():
    class Conf:
        def get(self, key, default=None):
            return {"spark.checkpoint.dir": "hdfs://shared/folder/"}.get(key, default)

    class Session:
        conf = Conf()

    assert checkpoint_root(Session()) == "hdfs://shared/folder"


def test_online_model_goes_on_after_a_restart(spark, tmp_path):
    """Stopped in the middle and started again, the stream ends with the model of one run."""
    from floodmark.operators.detect import ocsvm

    start = ocsvm.OneClassModel(["payload"], "linear", 1.0, 0.5, [], [], [0.0], 0.0)
    groups = [[row(1, i, payload=float(i % 7)) for i in range(g * 10, g * 10 + 10)] for g in range(4)]

    models = []
    for name, runs in (("once", (range(4),)), ("twice", (range(2), range(2, 4)))):
        for files in runs:
            for i in files:
                spark.createDataFrame(groups[i], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/{name}-in/part-{i}")
                time.sleep(1.1)
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}-in/*")
            stream = stream.withColumn("verified_normal", F.lit(True))
            query, current = pipeline.ocsvm_online(stream, start, str(tmp_path / f"{name}-models"), checkpoint=str(tmp_path / f"{name}-check"))
            query.awaitTermination()
        models.append(current())
    assert models[0].w == models[1].w and models[0].rho == models[1].rho and models[0].w != [0.0]
    assert len(list((tmp_path / "twice-models").glob("v=*"))) == 2
