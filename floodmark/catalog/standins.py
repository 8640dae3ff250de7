"""Traffic tables derived from the driver tables, as DataFrames and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FLOW_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
USER_AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0) Chrome/120.0 Safari/537.36",
    "Mozilla/5.0 (X11; Linux) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (Macintosh) Version/17.1 Safari/605.1",
    "Examplebot/2.1 (+http://bot.example.com)",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts):
    return F.unix_micros(F.col(ts).cast("timestamp")) if isinstance(ts, str) else F.unix_micros(ts.cast("timestamp"))


def shape_requests(events: DataFrame) -> DataFrame:
    """Events read as HTTP requests; works for batch and stream."""
    k = F.get_json_object("props", "$.k").cast("int")
    agents = F
    for i, agent in enumerate(USER_AGENTS):
        agents = agents.when(F.col("user_id") % 5 == i, agent)
    status = (
        F.when((F.col("event_type") == "error") & (k % 2 == 1), 500)
        .when(F.col("event_type") == "error", 404)
        .when(F.col("event_type") == "signup", 201)
        .otherwise(200)
    )
    return events.select(
        F.col("event_id").alias("row_id"),
        F.col("user_id").alias("src"),
        "ts",
        micros("ts").alias("ts_us"),
        "event_type",
        F.when(F.col("event_type").isin("signup", "purchase"), "POST").otherwise("GET").alias("method"),
        status.alias("status"),
        F.concat(F.lit("/"), "event_type", F.lit("/"), k.cast("string")).alias("path"),
        F.concat(F.lit("k="), k.cast("string")).alias("query"),
        F.col("value").alias("payload"),
        agents.alias("user_agent"),
        k.alias("k"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_requests(table(spark, sf_dir, "events"))


_AGENT_CASES = " ".join(f"WHEN {i} THEN '{a}'" for i, a in enumerate(USER_AGENTS))
REQ = f"""
ev AS (SELECT *, CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k FROM events),
req AS (
  SELECT event_id AS row_id, user_id AS src, ts, epoch_us(ts) AS ts_us, event_type,
    CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END AS method,
    CASE WHEN event_type = 'error' AND k % 2 = 1 THEN 500 WHEN event_type = 'error' THEN 404
         WHEN event_type = 'signup' THEN 201 ELSE 200 END AS status,
    '/' || event_type || '/' || k AS path, 'k=' || k AS query, value AS payload,
    CASE user_id % 5 {_AGENT_CASES} END AS user_agent, k
  FROM ev)"""


def row_key():
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", cents)


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines read as labelled flows; the row id is unique."""
    label = F.when(F.col("l_returnflag") == "N", "Benign").when(F.col("l_returnflag") == "R", "Attack").otherwise("Suspicious")
    return table(spark, sf_dir, "lineitem").select(
        row_key().alias("row_id"), "l_orderkey", *FLOW_FEATURES, label.alias("label"), "l_linestatus", "l_shipdate"
    )


FLOW = """
flow AS (
  SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber || '-' || CAST(round(l_extendedprice * 100) AS BIGINT) AS row_id, l_orderkey,
    l_quantity, l_extendedprice, l_discount, l_tax,
    CASE l_returnflag WHEN 'N' THEN 'Benign' WHEN 'R' THEN 'Attack' ELSE 'Suspicious' END AS label,
    l_linestatus, l_shipdate
  FROM lineitem)"""


def dirty_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with missing, NaN and infinite values, leaked header labels and missing labels."""
    key = F.col("l_orderkey")
    return flows(spark, sf_dir).select(
        "row_id",
        F.when(key % 83 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(key % 97 == 0, F.lit(float("inf"))).when(key % 97 == 1, F.lit(float("-inf"))).otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        "l_discount",
        F.when(key % 89 == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"),
        F.when(key % 101 == 0, "Label").when(key % 103 != 0, F.col("label")).alias("Label"),
    )


DIRTY = FLOW + """,
dirty AS (
  SELECT row_id,
    CASE WHEN l_orderkey % 83 <> 0 THEN l_quantity END AS l_quantity,
    CASE l_orderkey % 97 WHEN 0 THEN 'Infinity'::DOUBLE WHEN 1 THEN '-Infinity'::DOUBLE ELSE l_extendedprice END AS l_extendedprice,
    l_discount,
    CASE WHEN l_orderkey % 89 = 0 THEN 'NaN'::DOUBLE ELSE l_tax END AS l_tax,
    CASE WHEN l_orderkey % 101 = 0 THEN 'Label' WHEN l_orderkey % 103 <> 0 THEN label END AS "Label"
  FROM flow)"""


def judged_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with truth y, two rule predictions and a score in [0, 1)."""
    high = F.col("l_quantity") > 40
    price = F.col("l_extendedprice") > 60000
    return flows(spark, sf_dir).select(
        "row_id",
        "label",
        F.when(F.col("label") == "Benign", 1).otherwise(-1).alias("y"),
        F.when(high | (F.col("l_discount") >= 0.09), -1).otherwise(1).alias("pred_a"),
        F.when(price, -1).otherwise(1).alias("pred_b"),
        F.when(F.col("l_tax") > 0.05, -1).otherwise(1).alias("pred_c"),
        (F.col("l_quantity") / 50.0).alias("score_a"),
        (F.col("l_extendedprice") / 120000.0).alias("score_b"),
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("ts_us"),
    )


JUDGED = FLOW + """,
judged AS (
  SELECT row_id, label, CASE WHEN label = 'Benign' THEN 1 ELSE -1 END AS y,
    CASE WHEN l_quantity > 40 OR l_discount >= 0.09 THEN -1 ELSE 1 END AS pred_a,
    CASE WHEN l_extendedprice > 60000 THEN -1 ELSE 1 END AS pred_b,
    CASE WHEN l_tax > 0.05 THEN -1 ELSE 1 END AS pred_c,
    l_quantity / 50.0 AS score_a, l_extendedprice / 120000.0 AS score_b,
    epoch_us(l_shipdate) AS ts_us
  FROM flow)"""


def deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deployment metrics per event type and ten minutes."""
    bucket = F.floor(F.col("ts_us") / 600_000_000).cast("long") * 600_000_000
    grouped = requests(spark, sf_dir).groupBy(F.col("event_type").alias("deployment"), bucket.alias("ts_us"))
    return grouped.agg(
        F.round(F.least(F.lit(100.0), F.avg("payload") * 1.5), 6).alias("cpu_percent"),
        (F.count("*") % 7 + F.floor(F.max("payload")) % 4 + 2).cast("int").alias("replicas"),
        F.round(F.least(F.lit(1.0), F.max("payload") / 60.0), 6).alias("score"),
    )


DEPLOY = REQ + """,
dep AS (
  SELECT event_type AS deployment, ts_us // 600000000 * 600000000 AS ts_us,
    round(least(100.0, avg(payload) * 1.5), 6) AS cpu_percent,
    CAST(count(*) % 7 + CAST(floor(max(payload)) AS BIGINT) % 4 + 2 AS INTEGER) AS replicas,
    round(least(1.0, max(payload) / 60.0), 6) AS score
  FROM req GROUP BY 1, 2)"""


def truth_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxic documents as anomalies, document length as score."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, -1).otherwise(1).alias("y"))
    documents = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    return labels.join(documents, "doc_id")


TRUTH = """
truth AS (
  SELECT l.doc_id, CASE WHEN l.toxic = 1 THEN -1 ELSE 1 END AS y, CAST(d.n_chars AS DOUBLE) AS score
  FROM labels l JOIN documents d USING (doc_id))"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


def hash_sql(seed: str, row_id: str = "row_id") -> str:
    return f"md5('{seed}:' || {row_id})"
