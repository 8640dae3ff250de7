"""Scans, sources and sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from floodmark.catalog.quality import CELLS_SQL, METRIC_TEXTS
from floodmark.catalog.registry import query, rounded
from floodmark.catalog.standins import FLOW, FLOW_FEATURES, JUDGED, REQ, flows, hash_sql, judged_flows, micros, requests, shape_requests, table
from floodmark.operators import cleaning, evaluation, splitting
from floodmark.operators.detect import gmm
from floodmark.plans.staging import scratch_path
from floodmark.sources import flows as flow_source
from floodmark.sources import logs, models, sinks


@query("read_flow_csv", f"""WITH {FLOW}
SELECT label, count(*) AS n, round(sum(l_quantity), 4) AS quantity, round(avg(l_extendedprice), 4) AS price
FROM flow GROUP BY label""")
def read_flow_csv(spark, sf_dir):
    columns = [*FLOW_FEATURES, "label"]
    path = scratch_path(spark, "flow-csv")
    flow_source.write_split(flows(spark, sf_dir).select(*columns), path, "csv")
    raw = flow_source.read_flow_csv(spark, path, columns)
    out = cleaning.to_numeric(raw, FLOW_FEATURES).groupBy("label").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"), F.avg("l_extendedprice").alias("price")
    )
    return rounded(out, 4)


@query("read_flow_folder", f"""WITH {FLOW} SELECT l_linestatus, count(*) AS n, count(*) FILTER (l_linestatus = 'O') AS n_taxed,
  round(sum(l_quantity), 4) AS quantity, 0::BIGINT AS n_damaged, 0::BIGINT AS n_unreadable, true AS bytes_known FROM flow GROUP BY 1""")
def read_flow_folder(spark, sf_dir):
    """Files of two layouts in one folder, read by their own headers, with the report of losses."""
    df, path = flows(spark, sf_dir), scratch_path(spark, "flow-folder")
    flow_source.write_split(df.filter("l_linestatus = 'O'").select("l_linestatus", "l_tax", "l_quantity"), path, "csv")
    flow_source.write_split(df.filter("l_linestatus <> 'O'").select("l_quantity", "l_linestatus"), path, "csv", "append")
    raw = flow_source.read_flow_csv(spark, path)
    damaged = flow_source.damaged_files(spark, path).count()
    unreadable = flow_source.unreadable_files(spark, path, raw).filter("source_path like '%.csv'").count()
    return rounded(cleaning.to_numeric(raw, ["l_quantity", "l_tax"]).groupBy("l_linestatus").agg(
        F.count("*").alias("n"), F.count("l_tax").alias("n_taxed"), F.sum("l_quantity").alias("quantity"),
        F.lit(damaged).cast("long").alias("n_damaged"), F.lit(unreadable).cast("long").alias("n_unreadable"),
        F.bool_and(F.col("source_bytes") > 0).alias("bytes_known"),
    ), 4)


@query("read_labelled_parquet", """SELECT l_returnflag AS label, count(*) AS n, 10 AS n_features FROM lineitem GROUP BY 1""")
def read_labelled_parquet(spark, sf_dir):
    df, features = flow_source.read_labelled_parquet(spark, f"{sf_dir}/lineitem.parquet", "l_returnflag")
    return df.groupBy(F.col("l_returnflag").alias("label")).agg(F.count("*").alias("n"), F.lit(len(features)).alias("n_features"))


@query("head_sample", f"""WITH {FLOW}
SELECT row_id, l_quantity, label FROM flow ORDER BY l_shipdate, row_id LIMIT 1000""")
def head_sample(spark, sf_dir):
    return flow_source.head_sample(flows(spark, sf_dir), 1000, ["l_shipdate", "row_id"], ["row_id", "l_quantity", "label"])


def access_lines(requests_df):
    """Requests written as access-log lines; every 13th key gives a line that does not parse."""
    src = F.col("src")
    address = F.concat_ws(".", F.lit("10"), F.floor(src / 65536), F.floor(src / 256) % 256, src % 256)
    line = F.concat(
        address, F.lit(" - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000] \""), "method", F.lit(" "),
        "path", F.lit("?"), "query", F.lit(" HTTP/1.1\" "), F.col("status").cast("string"), F.lit(" "),
        F.floor("payload").cast("string"), F.coalesce(F.concat(F.lit(" \""), "user_agent", F.lit("\"")), F.lit("")),
    )
    return F.when(F.col("k") % 13 == 0, F.concat(F.lit("broken "), "path")).otherwise(line)


@query("parse_access_log", f"""WITH {REQ}, parts AS (SELECT *, k % 13 = 0 AS bad FROM req)
SELECT row_id, bad AS malformed,
  CASE WHEN NOT bad THEN '10.' || (src // 65536) || '.' || (src // 256 % 256) || '.' || (src % 256) END AS remote_addr,
  CASE WHEN NOT bad THEN ts_us // 1000000 END AS epoch_s,
  CASE WHEN NOT bad THEN method END AS method, CASE WHEN NOT bad THEN path END AS path,
  CASE WHEN NOT bad THEN query END AS query, CASE WHEN NOT bad THEN status END AS status,
  CASE WHEN NOT bad THEN CAST(floor(payload) AS BIGINT) END AS body_bytes_sent,
  CASE WHEN NOT bad THEN user_agent END AS user_agent
FROM parts""")
def parse_access_log(spark, sf_dir):
    req = requests(spark, sf_dir)
    lines = req.select("row_id", access_lines(req).alias("line"))
    return logs.parse_access_log(lines).select(
        "row_id", "malformed", "remote_addr", F.unix_seconds("timestamp").alias("epoch_s"), "method", "path", "query",
        "status", "body_bytes_sent", "user_agent",
    )


def run_to_table(stream, name):
    """Run a stream over everything available and read back what it appended."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    stream.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", scratch_path(spark, f"{name}-checkpoint")
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    return shape_requests(events.withColumn("ts", F.col("ts").cast("timestamp")))


@query("read_log_stream", f"""WITH {REQ}
SELECT 'pod-' || (src % 7) AS pod, event_type AS app, count(*) AS n, CAST(sum(CASE WHEN k % 13 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_malformed
FROM req GROUP BY 1, 2""")
def read_log_stream(spark, sf_dir):
    req = requests(spark, sf_dir)
    path = scratch_path(spark, "container-logs")
    req.select(
        access_lines(req).alias("log"),
        F.lit("stdout").alias("stream"),
        F.col("ts").cast("timestamp").alias("time"),
        F.struct(
            F.concat(F.lit("pod-"), (F.col("src") % 7).cast("string")).alias("pod_name"),
            F.lit("default").alias("namespace_name"),
            F.create_map(F.lit("app"), "event_type").alias("labels"),
        ).alias("kubernetes"),
    ).write.json(path)
    parsed = logs.parse_access_log(logs.read_log_stream(spark, path))
    return run_to_table(parsed, "parsed-logs").groupBy("pod", "app").agg(
        F.count("*").alias("n"), F.count_if("malformed").alias("n_malformed")
    )


@query("write_split", f"""WITH {FLOW}
SELECT CASE WHEN label = 'Benign' AND NOT substr({hash_sql('42')}, 1, 8) < '33333333' THEN 'train' ELSE 'test' END AS part, label, count(*) AS n
FROM flow GROUP BY 1, 2""")
def write_split(spark, sf_dir):
    train, test = splitting.benign_split(flows(spark, sf_dir), "row_id")
    train_path, test_path = scratch_path(spark, "train"), scratch_path(spark, "test")
    flow_source.write_split(train, train_path)
    flow_source.write_split(test.select("row_id", "label"), test_path, "csv")
    parts = spark.read.parquet(train_path).select(F.lit("train").alias("part"), "label").unionAll(
        spark.read.schema("row_id string, label string").option("header", True).csv(test_path).select(F.lit("test").alias("part"), "label")
    )
    return parts.groupBy("part", "label").agg(F.count("*").alias("n"))


@query("save_load_model", f"""WITH {FLOW} SELECT count(*) AS n, 0.0::DOUBLE AS max_difference FROM flow""")
def save_load_model(spark, sf_dir):
    df = flows(spark, sf_dir)
    model = gmm.gmm_fit(df.filter("label = 'Benign'"), FLOW_FEATURES)
    path = scratch_path(spark, "model")
    models.save_model(spark, model, path)
    again = models.load_model(spark, path, [gmm.MixtureModel])
    scored = df.withColumn("a", gmm.log_density(model)).withColumn("b", gmm.log_density(again))
    return scored.agg(F.count("*").alias("n"), F.max(F.abs(F.col("a") - F.col("b"))).alias("max_difference"))


@query("append_metrics", f"""WITH {JUDGED}, runs AS (SELECT 'rule_a' AS model, y, pred_a AS p FROM judged UNION ALL SELECT 'rule_b', y, pred_b FROM judged),
c AS (SELECT model, {CELLS_SQL} FROM runs GROUP BY 1)
SELECT model, 'flows' AS dataset, 0::BIGINT AS training_samples, tp + fp + fn + tn AS test_samples, 4 AS features, {', '.join(METRIC_TEXTS[:5])},
  1.0::DOUBLE AS training_time_s, 2.0::DOUBLE AS prediction_time_s, round(2000.0::DOUBLE / (tp + fp + fn + tn), 6) AS avg_prediction_ms,
  round((tp + fp + fn + tn) / 2.0::DOUBLE, 6) AS throughput, tp, fp, fn, tn FROM c""")
def append_metrics(spark, sf_dir):
    df, path = judged_flows(spark, sf_dir), scratch_path(spark, "metrics")
    for m in "ab":
        quality = evaluation.binary_metrics(df, "y", f"pred_{m}")
        sinks.append_metrics(sinks.metrics_row(quality, f"rule_{m}", "flows", 0, len(FLOW_FEATURES), 1.0, 2.0), path)
    return rounded(spark.read.parquet(path))


@query("dated_sink", """SELECT strftime(ts, '%Y.%m.%d') AS date, count(*) AS n FROM events
WHERE CAST(ts AS DATE) BETWEEN (SELECT CAST(max(ts) AS DATE) - 6 FROM events) AND (SELECT CAST(max(ts) AS DATE) FROM events) GROUP BY 1""")
def dated_sink(spark, sf_dir):
    path = scratch_path(spark, "dated")
    sinks.dated_sink(event_stream(spark, sf_dir), path, "ts").awaitTermination()
    today: dt.datetime = table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
    return sinks.read_retained(spark, path, today.date()).groupBy("date").agg(F.count("*").alias("n"))


@query("latest_score_sink", """WITH now AS (SELECT max(epoch_us(ts)) AS t FROM events)
SELECT user_id AS src, arg_max(value, ts) AS score, max(epoch_us(ts)) AS ts_us FROM events
GROUP BY 1 HAVING max(epoch_us(ts)) >= (SELECT t FROM now) - 86400000000""")
def latest_score_sink(spark, sf_dir):
    path = scratch_path(spark, "latest")
    scores = event_stream(spark, sf_dir).select("src", "ts_us", F.col("payload").alias("score"))
    sinks.latest_score_sink(scores, path, ["src"], "ts_us", ttl_seconds=86_400).awaitTermination()
    now = table(spark, sf_dir, "events").agg(F.max(micros("ts"))).first()[0]
    return sinks.read_snapshot(spark, path, "ts_us", F.lit(now), 86_400)
