import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from floodmark.operators import traffic
from floodmark.streaming import chain, pipeline

SCHEMA = "src long, ts timestamp, path string, status int, payload double, row_id long"
T0 = dt.datetime(2024, 1, 1)
GROUPS = [[(i % 3, T0 + dt.timedelta(seconds=100 * g + i), f"/p{i % 4}", 200 if i % 5 else 500, float(i + g), 10 * g + i) for i in range(10)] for g in range(4)]


class Crash(Exception):
    pass


def feed(spark, folder, groups):
    for i, rows in groups:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/part-{i}")
        time.sleep(1.1)


def start(spark, folder, fail_on=None, between=lambda df: df):
    """The chain over ``folder``/in; building the second output fails once for batch row ids from ``fail_on``."""
    events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
    events = pipeline.stream_dedup(events, ["row_id"]).withColumn("ts_us", F.unix_micros("ts"))

    def alerts(rows):
        if fail_on is not None and rows.filter(F.col("row_id") >= fail_on).count():
            raise Crash("the driver died between two outputs")
        return rows.filter("score > 15")

    outputs = [chain.Output("windows", chain.window_partials(10)), chain.Output("alerts", alerts, "ts")]
    return chain.chained_stream(
        events, lambda df: df.withColumn("score", F.col("payload") * 2), outputs, f"{folder}/out", ["src"], checkpoint=f"{folder}/check"
    )


def state(spark, folder):
    root = f"{folder}/out"
    return {
        "scored": sorted((r.row_id, r.score) for r in chain.read_output(spark, root, "scored").collect()),
        "alerts": sorted((r.row_id, str(r.date)) for r in chain.read_output(spark, root, "alerts").collect()),
        "windows": sorted(map(tuple, chain.read_windows(chain.read_output(spark, root, "windows"), 10).collect())),
        "snapshot": sorted((r.src, r.score) for r in chain.read_chain_snapshot(spark, root).collect()),
    }


def wanted(spark, groups):
    rows = [r for g in groups for r in g]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("ts_us", F.unix_micros("ts"))
    newest = {r[0]: (r[1], 2 * r[4]) for r in sorted(rows, key=lambda r: r[1])}
    return {
        "scored": sorted((r[5], 2 * r[4]) for r in rows),
        "alerts": sorted((r[5], "2024.01.01") for r in rows if 2 * r[4] > 15),
        "windows": sorted(map(tuple, traffic.traffic_window(table, 10).collect())),
        "snapshot": sorted((k, v[1]) for k, v in newest.items()),
    }


def test_all_tables_equal_the_batch_result_and_resent_rows_count_once(spark, tmp_path):
    resent = [GROUPS[0], GROUPS[1] + GROUPS[0][:4], GROUPS[2], GROUPS[3]]
    feed(spark, tmp_path / "in", enumerate(resent))
    start(spark, tmp_path).awaitTermination()
    assert state(spark, tmp_path) == wanted(spark, GROUPS)


def test_death_between_outputs_neither_loses_nor_doubles_rows(spark, tmp_path):
    feed(spark, tmp_path / "in", enumerate(GROUPS))
    with pytest.raises(Exception, match="between two outputs"):
        start(spark, tmp_path, fail_on=20).awaitTermination()
    # batch 2 is half written: its scored rows and windows are there, its alerts and snapshot are not
    assert (tmp_path / "out" / "scored" / "batch=2").exists() and not (tmp_path / "out" / "alerts" / "batch=2").exists()
    assert chain.committed(spark, f"{tmp_path}/out") == 1
    assert state(spark, tmp_path) == wanted(spark, GROUPS[:2])
    start(spark, tmp_path).awaitTermination()
    assert state(spark, tmp_path) == wanted(spark, GROUPS)


def test_a_batch_that_comes_again_after_its_marker_is_passed_over(spark, tmp_path):
    feed(spark, tmp_path / "in", enumerate(GROUPS[:3]))
    start(spark, tmp_path).awaitTermination()
    # the checkpoint forgets the last batch, as when the driver dies right after the marker
    for name in ("2", ".2.crc"):
        (tmp_path / "check" / "commits" / name).unlink(missing_ok=True)
    written = sorted(p.name for p in (tmp_path / "out" / "scored" / "batch=2").iterdir())
    feed(spark, tmp_path / "in", [(3, GROUPS[3])])
    start(spark, tmp_path).awaitTermination()
    assert sorted(p.name for p in (tmp_path / "out" / "scored" / "batch=2").iterdir()) == written
    assert state(spark, tmp_path) == wanted(spark, GROUPS)


def test_names_of_outputs_and_empty_folders(spark, tmp_path):
    events = spark.readStream.schema(SCHEMA).parquet(str(tmp_path))
    with pytest.raises(ValueError, match="must differ"):
        chain.chained_stream(events, lambda df: df, [chain.Output("scored", lambda df: df)], str(tmp_path / "out"), ["src"])
    with pytest.raises(ValueError, match="nothing committed"):
        chain.read_output(spark, str(tmp_path / "none"), "scored")
