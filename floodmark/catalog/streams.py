"""Streaming operators, run over everything available and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from floodmark.catalog.decisions import replay_sql
from floodmark.catalog.detectors import TWO_D_SQL, SMALL_FOREST, TWO, prepared
from floodmark.catalog.joins import geo_blocks
from floodmark.catalog.registry import query, rounded
from floodmark.catalog.scans import event_stream, run_to_table
from floodmark.catalog.standins import FLOW, FLOW_FEATURES, REQ, flows, row_key, table
from floodmark.catalog.windows import window_sql
from floodmark.functions.scores import sigmoid_score
from floodmark.operators import enrich, ensemble
from floodmark.operators.detect import gmm, iforest, ocsvm
from floodmark.plans.staging import scratch_path
from floodmark.sources import sinks
from floodmark.streaming import adaptive, pipeline

_ENTROPY = """chars AS (SELECT row_id, unnest(string_split(path, '')) AS ch FROM req), c AS (SELECT row_id, ch, count(*)::DOUBLE AS n FROM chars GROUP BY ALL),
e AS (SELECT row_id, round(-sum(n / length(path) * log2(n / length(path))), 6) AS path_entropy FROM c JOIN req USING (row_id) GROUP BY 1)"""


@query("stream_features", f"""WITH w AS (SELECT max(c_custkey) // 25 + 1 AS width FROM customer),
blocks AS (SELECT n_nationkey * width AS s, n_nationkey * width + width - 10 AS e, n_name AS country FROM nation, w), {REQ}, {_ENTROPY}
SELECT req.row_id, country, CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) AS INTEGER) AS day_of_week, CAST(length(path) AS INTEGER) AS path_length, path_entropy,
  CAST(coalesce(contains(lower(user_agent), 'bot'), false) AS INTEGER) AS is_bot, CAST(status // 100 = 5 AS INTEGER) AS status_5xx
FROM req JOIN e USING (row_id) LEFT JOIN blocks ON src BETWEEN s AND blocks.e""")
def stream_features(spark, sf_dir):
    featured = pipeline.stream_features(event_stream(spark, sf_dir))
    located = enrich.geo_enrich(featured, geo_blocks(spark, sf_dir), "src", ["country"], width=64)
    out = run_to_table(located, "stream-features")
    return rounded(out.select("row_id", "country", "hour", "day_of_week", "path_length", "path_entropy", "is_bot", "status_5xx"))


_CLOSED = "HAVING window_start_us + {us} <= (SELECT max(ts_us) - 600000000 FROM req)"


@query("stream_windows", window_sql(10, 10, having=_CLOSED.format(us=10_000_000)))
def stream_windows(spark, sf_dir):
    return rounded(run_to_table(pipeline.stream_windows(event_stream(spark, sf_dir), 10), "stream-windows"))


@query("stream_windows_sliding", window_sql(60, 10, having=_CLOSED.format(us=60_000_000)))
def stream_windows_sliding(spark, sf_dir):
    path = scratch_path(spark, "stream-sliding")
    pipeline.stream_windows(event_stream(spark, sf_dir), 60, 10, table=path).awaitTermination()
    return rounded(spark.read.parquet(path).drop("batch"))


@query("stream_dedup", "SELECT event_id AS row_id, count(*) AS n FROM events GROUP BY 1")
def stream_dedup(spark, sf_dir):
    resent = event_stream(spark, sf_dir).withColumn("attempt", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    once = run_to_table(pipeline.stream_dedup(resent, ["row_id"]), "stream-dedup")
    return once.groupBy("row_id").agg(F.count("*").alias("n"))


def flow_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "lineitem").schema
    raw = spark.readStream.schema(schema).parquet(f"{sf_dir}/lineitem*.parquet")
    return raw.select(
        row_key().alias("row_id"), *FLOW_FEATURES, (F.col("l_returnflag") == "N").alias("verified_normal"), F.col("l_shipdate").cast("timestamp").alias("ts")
    )


@query("stream_score", f"""{TWO_D_SQL}, h AS (SELECT row_id,
  (CASE WHEN l_quantity <= 10 THEN 1.0 WHEN l_discount <= 0.05 THEN 3.0 ELSE 2.0 END + CASE WHEN l_discount <= 0.08 THEN 2.0 ELSE 1.0 END) / 2 AS mean_path FROM flow)
SELECT row_id, strftime(l_shipdate, '%Y.%m.%d') AS date,
  round(0.4 / (1 + exp(score + 1)) + 0.6 * power(2.0, -mean_path / (2.0 * (ln(3.0) + 0.5772156649015329) - 2.0 * 3.0 / 4.0)), 5) AS score
FROM s JOIN h USING (row_id) JOIN flow USING (row_id)""")
def stream_score(spark, sf_dir):
    mixture = gmm.gmm_fit(flows(spark, sf_dir).filter("label = 'Benign'"), TWO)
    path = scratch_path(spark, "anomalies")

    def score(batch):
        df = gmm.gmm_score(batch, mixture).withColumn("gmm_01", sigmoid_score(F.col("score") + 1)).drop("score")
        df = iforest.iforest_score(df, SMALL_FOREST).withColumnRenamed("score", "forest_01")
        return df.withColumn("score", ensemble.weighted_score(["gmm_01", "forest_01"], [0.4, 0.6]))

    def publish(df, batch_id):
        sinks.with_date(df, "ts").select("row_id", "ts", "date", "score").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    pipeline.stream_score(flow_stream(spark, sf_dir), score, publish).awaitTermination()
    return rounded(spark.read.parquet(path).select("row_id", "date", "score"), 5)


@query("ocsvm_online")
def ocsvm_online(spark, sf_dir):
    train, _ = prepared(spark, sf_dir)
    model = ocsvm.ocsvm_fit(train, FLOW_FEATURES, rounds=1)
    query_, current = pipeline.ocsvm_online(flow_stream(spark, sf_dir), model, scratch_path(spark, "online"))
    query_.awaitTermination()
    scored = ocsvm.ocsvm_predict(train, current())
    return rounded(scored.agg(F.count("*").alias("n"), F.avg((F.col("y_pred") == -1).cast("double")).alias("outlier_share")), 3)


@query("ocsvm_online_step", f"""WITH {FLOW}, b AS (SELECT l_quantity AS x, l_discount AS y, 0.02::DOUBLE * l_quantity - 3.0::DOUBLE * l_discount < 0.2513::DOUBLE AS o FROM flow WHERE label = 'Benign'),
g AS (SELECT count(*) * 0.1::DOUBLE AS nu_n, count(*) FILTER (o) AS n_out, sum(x) FILTER (o) AS sx, sum(y) FILTER (o) AS sy FROM b)
SELECT round(0.02::DOUBLE + 0.5 * (sx / nu_n - 0.02::DOUBLE), 6) AS w_quantity, round(-3.0::DOUBLE + 0.5 * (sy / nu_n + 3.0::DOUBLE), 6) AS w_discount,
  round(0.2513::DOUBLE + 0.5 * (1 - n_out / nu_n), 6) AS rho, 1 AS steps FROM g""")
def ocsvm_online_step(spark, sf_dir):
    """The stream's update of a linear boundary equals the gradient step over all verified-normal rows (one file, one batch)."""
    model = ocsvm.OneClassModel(TWO, "linear", 1.0, 0.1, [], [], [0.02, -3.0], 0.2513)
    query_, current = pipeline.ocsvm_online(flow_stream(spark, sf_dir), model, scratch_path(spark, "online-step"))
    query_.awaitTermination()
    m = current()
    return rounded(spark.createDataFrame([(*m.w, m.rho, m.steps)], "w_quantity double, w_discount double, rho double, steps int"))


@query("stream_adaptive_threshold", replay_sql("key"))
def stream_adaptive_threshold(spark, sf_dir):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    scores = event_stream(spark, sf_dir).select(F.col("event_type").alias("deployment"), "row_id", "ts_us", F.col("payload").alias("score"))
    return rounded(run_to_table(adaptive.stream_adaptive_threshold(scores, "deployment", 150.0), "stream-adaptive"))


@query("stream_alert", f"""WITH {REQ}, m AS (SELECT event_type AS deployment, ts_us // 60000000 AS minute, avg(payload) / 100 AS m FROM req GROUP BY 1, 2),
w AS (SELECT deployment, minute - unnest(range(0, 2)) AS s, m FROM m), a AS (SELECT deployment, s, min(m) AS lowest, count(*) AS n FROM w GROUP BY 1, 2)
SELECT deployment, s * 60000000 AS start_us, (s + 2) * 60000000 AS end_us, round(lowest, 6) AS lowest FROM a
WHERE lowest > 0.2 AND n = 2 AND (s + 2) * 60000000 <= (SELECT max(ts_us) - 600000000 FROM req)""")
def stream_alert(spark, sf_dir):
    scores = event_stream(spark, sf_dir).select(F.col("event_type").alias("deployment"), "ts", (F.col("payload") / 100).alias("score"))
    return rounded(run_to_table(pipeline.stream_alert(scores, limit=0.2, minutes=2), "stream-alert"))


@query("stream_alert_documented", """WITH m AS (SELECT epoch_us(ts) // 60000000 AS minute, avg(value / 10) AS m FROM events GROUP BY 1),
w AS (SELECT minute - unnest(range(0, 5)) AS s, m FROM m), a AS (SELECT s, min(m) AS lowest, count(*) AS n FROM w GROUP BY 1)
SELECT 'web' AS deployment, s * 60000000 AS start_us, (s + 5) * 60000000 AS end_us, round(lowest, 6) AS lowest FROM a
WHERE lowest > 0.8 AND n = 5 AND (s + 5) * 60000000 <= (SELECT max(epoch_us(ts)) - 600000000 FROM events)""")
def stream_alert_documented(spark, sf_dir):
    """The documented limit and span (0.8 in each of five minutes) over all requests as one deployment."""
    scores = event_stream(spark, sf_dir).select(F.lit("web").alias("deployment"), "ts", (F.col("payload") / 10).alias("score"))
    return rounded(run_to_table(pipeline.stream_alert(scores), "stream-alert-documented"))
