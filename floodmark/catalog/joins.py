"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from floodmark.catalog.registry import query, rounded
from floodmark.catalog.standins import DEPLOY, FLOW, FLOW_FEATURES, JUDGED, REQ, deployments, flows, hash_sql, judged_flows, requests, table
from floodmark.operators import enrich, evaluation
from floodmark.plans.ordering import below_fraction, order_hash


@query("attach_labels", f"WITH {FLOW} SELECT row_id, {', '.join(FLOW_FEATURES)}, label FROM flow")
def attach_labels(spark, sf_dir):
    df = flows(spark, sf_dir)
    return enrich.attach_labels(df.select("row_id", *FLOW_FEATURES), df.select("row_id", "label"))


@query("select_ids", f"WITH {FLOW} SELECT row_id, label FROM flow WHERE substr({hash_sql('7')}, 1, 8) < '19999999'")
def select_ids(spark, sf_dir):
    df = flows(spark, sf_dir).select("row_id", "label")
    ids = df.filter(below_fraction(order_hash(7, "row_id"), 0.1))
    return enrich.select_ids(df, ids)


_BLOCKS = """w AS (SELECT max(c_custkey) // 25 + 1 AS width FROM customer),
blocks AS (SELECT n_nationkey * width AS s, n_nationkey * width + width - 10 AS e, n_name AS country FROM nation, w)"""


def geo_blocks(spark, sf_dir):
    """Customer keys cut in equal ranges, one per nation, with a gap after each."""
    widest = table(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()[0]
    width = widest // 25 + 1
    start = F.col("n_nationkey").cast("long") * width
    return table(spark, sf_dir, "nation").select(
        start.alias("start"), (start + width - 10).alias("end"), F.col("n_name").alias("country")
    )


@query("geo_enrich", f"""WITH {_BLOCKS} SELECT o_orderkey, o_custkey, country FROM orders LEFT JOIN blocks ON o_custkey BETWEEN s AND e""")
def geo_enrich(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return enrich.geo_enrich(orders, geo_blocks(spark, sf_dir), "o_custkey", ["country"], width=64)


@query("blacklist_flag", f"""WITH {REQ} SELECT row_id, src, CAST(substr(md5('bad:' || src), 1, 8) < '0ccccccc' AS INTEGER) AS blacklisted FROM req""")
def blacklist_flag(spark, sf_dir):
    req = requests(spark, sf_dir).select("row_id", "src")
    bad = req.select("src").distinct().filter(below_fraction(order_hash("bad", "src"), 0.05))
    return enrich.blacklist_flag(req, bad, "src")


def _asof_sql(ttl: int) -> str:
    return f"""WITH {DEPLOY}, sc AS (SELECT event_type AS deployment, ts_us, payload AS score FROM req)
SELECT d.deployment, d.ts_us, d.replicas, CASE WHEN d.ts_us - s.ts_us <= {ttl}000000 THEN s.score END AS score,
  CASE WHEN d.ts_us - s.ts_us <= {ttl}000000 THEN s.ts_us END AS score_ts_us
FROM dep d ASOF LEFT JOIN sc s ON d.deployment = s.deployment AND d.ts_us >= s.ts_us"""


def _asof(spark, sf_dir, ttl):
    ticks = deployments(spark, sf_dir).select("deployment", "ts_us", "replicas")
    scores = requests(spark, sf_dir).select(F.col("event_type").alias("deployment"), "ts_us", F.col("payload").alias("score"))
    return enrich.score_asof(ticks, scores, ["deployment"], ttl_seconds=ttl)


@query("score_asof", _asof_sql(60))
def score_asof(spark, sf_dir):
    return _asof(spark, sf_dir, 60)


@query("score_asof_hour", _asof_sql(3600))
def score_asof_hour(spark, sf_dir):
    return _asof(spark, sf_dir, 3600)


@query("model_agreement", f"""WITH {JUDGED} SELECT count(*) AS n, round(avg(CASE WHEN pred_a = pred_b THEN 1.0 ELSE 0.0 END), 6) AS agreement,
  count(*) FILTER (pred_a = -1 AND pred_b = 1) AS model_only, count(*) FILTER (pred_a = 1 AND pred_b = -1) AS baseline_only FROM judged""")
def model_agreement(spark, sf_dir):
    df = judged_flows(spark, sf_dir)
    a, b = (df.select("row_id", F.col(p).alias("y_pred")) for p in ("pred_a", "pred_b"))
    return rounded(enrich.model_agreement(a, b))


@query("compare_generations", f"""WITH {JUDGED}, g AS (
  SELECT row_id, y, label, UNNEST([{{'model': 'a', 'p': pred_a}}, {{'model': 'b', 'p': pred_b}}]) AS m,
    CASE WHEN score_a < 0.34 THEN 'v1' WHEN score_a < 0.67 THEN 'v2' ELSE 'v3' END AS generation FROM judged),
acc AS (SELECT m.model AS model, generation, avg(CASE WHEN y = m.p THEN 1.0 ELSE 0.0 END) AS accuracy FROM g GROUP BY 1, 2),
w AS (SELECT model, max(accuracy) FILTER (generation = 'v1') AS v1, max(accuracy) FILTER (generation = 'v2') AS v2, max(accuracy) FILTER (generation = 'v3') AS v3 FROM acc GROUP BY 1)
SELECT model, round(v1, 6) AS v1, round(v2, 6) AS v2, round(v3, 6) AS v3, round(v2 - v1, 6) AS v2_delta, round(v3 - v1, 6) AS v3_delta FROM w""")
def compare_generations(spark, sf_dir):
    generation = F.when(F.col("score_a") < 0.34, "v1").when(F.col("score_a") < 0.67, "v2").otherwise("v3")
    df = judged_flows(spark, sf_dir).withColumn("generation", generation)
    runs = {m: df.select("y", F.col(f"pred_{m}").alias("y_pred"), "generation") for m in ("a", "b")}
    long = enrich.experiment_union(runs).withColumnRenamed("experiment", "model")
    metrics = evaluation.binary_metrics(long, by=["model", "generation"])
    return rounded(enrich.compare_generations(metrics, ["v1", "v2", "v3"], "accuracy", "v1"))


@query("experiment_union", f"""WITH {JUDGED} SELECT 'a' AS experiment, row_id, pred_a AS y_pred FROM judged UNION ALL SELECT 'b', row_id, pred_b FROM judged""")
def experiment_union(spark, sf_dir):
    df = judged_flows(spark, sf_dir)
    return enrich.experiment_union({m: df.select("row_id", F.col(f"pred_{m}").alias("y_pred")) for m in ("a", "b")})
