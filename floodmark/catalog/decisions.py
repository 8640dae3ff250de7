"""Drift and scaling decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from floodmark.catalog.registry import query, rounded
from floodmark.catalog.standins import DEPLOY, FLOW, FLOW_FEATURES, JUDGED, REQ, deployments, flows, judged_flows, micros, requests, table
from floodmark.operators import drift, enrich, scaling

_HIST = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CAST(least(floor(({c} - a_{c}) / ((b_{c} - a_{c}) / 50)), 49) AS INTEGER) AS bin, recent FROM side, lim WHERE {c} BETWEEN a_{c} AND b_{c}"""
    for c in FLOW_FEATURES
)


@query("kl_drift", f"""WITH {FLOW}, side AS (SELECT *, l_quantity * l_discount > 1.5 AS recent FROM flow),
lim AS (SELECT {', '.join(f'min({c}) AS a_{c}, max({c}) AS b_{c}' for c in FLOW_FEATURES)} FROM side WHERE NOT recent),
hist AS ({_HIST}),
n AS (SELECT feature, bin, count(*) FILTER (NOT recent) AS nt, count(*) FILTER (recent) AS nr FROM hist GROUP BY 1, 2),
grid AS (SELECT feature, bin, coalesce(nt, 0) AS nt, coalesce(nr, 0) AS nr FROM (SELECT unnest(range(0, 50))::INTEGER AS bin) b CROSS JOIN (SELECT DISTINCT feature FROM n) f LEFT JOIN n USING (feature, bin)),
p AS (SELECT feature, (nt::DOUBLE / sum(nt) OVER (PARTITION BY feature) + 1e-10) / (1 + 50e-10) AS p, (nr::DOUBLE / sum(nr) OVER (PARTITION BY feature) + 1e-10) / (1 + 50e-10) AS q FROM grid)
SELECT feature, round(sum(p * ln(p / q)), 5) AS kl, sum(p * ln(p / q)) > 0.5 AS drifted FROM p GROUP BY 1""")
def kl_drift(spark, sf_dir):
    df = flows(spark, sf_dir)
    recent = F.col("l_quantity") * F.col("l_discount") > 1.5
    return rounded(drift.kl_drift(df.filter(~recent), df.filter(recent), FLOW_FEATURES), 5)


@query("retrain_set", f"""WITH {REQ}, now AS (SELECT max(ts_us) AS t FROM req)
SELECT row_id, true AS due FROM req, now WHERE ts_us BETWEEN t - 7 * 86400000000 AND t AND status < 500""")
def retrain_set(spark, sf_dir):
    df = requests(spark, sf_dir).withColumn("y_pred", F.when(F.col("status") >= 500, -1).otherwise(1))
    now = table(spark, sf_dir, "events").agg(F.max(micros("ts"))).first()[0]
    due, rows = drift.retrain_set(df, now, now - 8 * drift.DAY_US)
    return rows.select("row_id", F.lit(due).alias("due"))


def replay_sql(key: str) -> str:
    """The threshold replayed row by row: a recursion over the rank of each key's rows that carries the ring of scores."""
    return f"""WITH RECURSIVE {REQ}, e AS (
  SELECT event_type AS {key}, row_id, ts_us, payload AS score, row_number() OVER (PARTITION BY event_type ORDER BY ts_us, row_id) AS i FROM req
), r AS (
  SELECT {key}, 0::BIGINT AS i, []::DOUBLE[] AS ring, NULL::BIGINT AS row_id, NULL::BIGINT AS ts_us, NULL::DOUBLE AS score, NULL::DOUBLE AS threshold
  FROM (SELECT DISTINCT {key} FROM e)
  UNION ALL
  SELECT {key}, i, CASE WHEN score > threshold THEN ring WHEN len(ring) >= 1000 THEN list_append(ring[2:], score) ELSE list_append(ring, score) END,
    row_id, ts_us, score, threshold
  FROM (SELECT r.{key}, e.i, r.ring, e.row_id, e.ts_us, e.score,
          CASE WHEN len(r.ring) < 100 THEN 150.0::DOUBLE ELSE list_aggregate(r.ring, 'quantile_cont', 0.95) END AS threshold
        FROM r JOIN e ON e.{key} = r.{key} AND e.i = r.i + 1)
)
SELECT {key}, row_id, ts_us, round(score, 6) AS score, round(threshold, 6) AS threshold,
  CAST(CASE WHEN score > threshold THEN -1 ELSE 1 END AS INTEGER) AS y_pred FROM r WHERE i > 0"""


@query("adaptive_threshold", replay_sql("deployment"))
def adaptive_threshold(spark, sf_dir):
    df = requests(spark, sf_dir).select(F.col("event_type").alias("deployment"), "row_id", "ts_us", F.col("payload").alias("score"))
    return rounded(drift.adaptive_threshold(df, "deployment", "ts_us", "score", 150.0))


@query("hpa_replicas", f"""WITH {DEPLOY} SELECT deployment, ts_us, CAST(greatest(2, least(10, ceil(replicas * cpu_percent / 70.0::DOUBLE))) AS INTEGER) AS desired FROM dep""")
def hpa_replicas(spark, sf_dir):
    return deployments(spark, sf_dir).select("deployment", "ts_us", scaling.hpa_replicas("replicas", "cpu_percent").alias("desired"))


THREAT_SQL = """CAST(CASE WHEN score >= 0.7 THEN greatest(2, replicas - 1)
  WHEN score >= 0.3 THEN CASE WHEN cpu_percent > 90 THEN replicas + 1 WHEN cpu_percent < 30 THEN greatest(2, replicas - 1) ELSE replicas END
  ELSE greatest(2, least(10, ceil(replicas * cpu_percent / 70.0::DOUBLE))) END AS INTEGER)"""


@query("threat_aware_replicas", f"WITH {DEPLOY} SELECT deployment, ts_us, {THREAT_SQL} AS desired FROM dep")
def threat_aware_replicas(spark, sf_dir):
    desired = scaling.threat_aware_replicas("replicas", "cpu_percent", "score")
    return deployments(spark, sf_dir).select("deployment", "ts_us", desired.alias("desired"))


@query("simple_policies", f"""WITH {DEPLOY} SELECT deployment, ts_us, NOT score > 0.8 AS scale_up_allowed, CASE WHEN score > 0.8 THEN 10 END AS rate_limit,
  CASE WHEN score > 0.8 THEN CASE WHEN replicas > 2 THEN 'down' ELSE 'hold' END WHEN cpu_percent > 60 THEN 'up' WHEN cpu_percent < 60 THEN 'down' ELSE 'hold' END AS action FROM dep""")
def simple_policies(spark, sf_dir):
    df = deployments(spark, sf_dir).withColumn("y_pred", F.when(F.col("score") > 0.8, -1).otherwise(1))
    return df.select(
        "deployment", "ts_us", scaling.score_gate("score").alias("scale_up_allowed"), *scaling.attack_policy("y_pred", "cpu_percent", 60.0, "replicas")
    )


@query("anomaly_share_gate", f"""WITH {JUDGED} SELECT label, round(avg(CASE WHEN pred_c = -1 THEN 1.0 ELSE 0.0 END), 6) AS anomaly_share,
  avg(CASE WHEN pred_c = -1 THEN 1.0 ELSE 0.0 END) <= 0.5 AS scale_up_allowed FROM judged GROUP BY 1""")
def anomaly_share_gate(spark, sf_dir):
    return rounded(scaling.anomaly_share_gate(judged_flows(spark, sf_dir), ["label"], "pred_c"))


@query("scaling_cost", f"""WITH {DEPLOY}, p AS (SELECT 'standard' AS policy, deployment, ts_us, CAST(greatest(2, least(10, ceil(replicas * cpu_percent / 70.0::DOUBLE))) AS INTEGER) AS r FROM dep
  UNION ALL SELECT 'threat_aware', deployment, ts_us, {THREAT_SQL} FROM dep),
t AS (SELECT policy, r, (coalesce(lead(ts_us) OVER (PARTITION BY policy, deployment ORDER BY ts_us), ts_us) - ts_us) / 1e6 AS s FROM p),
c AS (SELECT policy, sum(s * r) AS pod_seconds FROM t GROUP BY 1), b AS (SELECT *, pod_seconds / 3600.0 * 0.05 AS cost, max(pod_seconds / 3600.0 * 0.05) FILTER (policy = 'standard') OVER () AS base FROM c)
SELECT policy, pod_seconds, round(cost, 4) AS cost, round(base - cost, 4) + 0.0 AS savings, round(100.0 * (base - cost) / base, 4) + 0.0 AS savings_pct FROM b""")
def scaling_cost(spark, sf_dir):
    df = deployments(spark, sf_dir)
    policies = {
        "standard": scaling.hpa_replicas("replicas", "cpu_percent"),
        "threat_aware": scaling.threat_aware_replicas("replicas", "cpu_percent", "score"),
    }
    runs = enrich.experiment_union({n: df.select("deployment", "ts_us", r.alias("replicas")) for n, r in policies.items()})
    return rounded(scaling.scaling_cost(runs.withColumnRenamed("experiment", "policy"), "standard"), 4)


@query("legit_success_rate", f"""WITH {REQ}, lim AS (SELECT min(ts_us) + 86400000000 AS a, min(ts_us) + 10 * 86400000000 AS b FROM req)
SELECT count(*) FILTER (src % 10 <> 0) AS n_legit, count(*) FILTER (src % 10 <> 0 AND status < 400) AS n_success,
  round(100.0 * count(*) FILTER (src % 10 <> 0 AND status < 400) / count(*) FILTER (src % 10 <> 0), 6) AS success_pct FROM req, lim WHERE ts_us BETWEEN a AND b""")
def legit_success_rate(spark, sf_dir):
    first = table(spark, sf_dir, "events").agg(F.min(micros("ts"))).first()[0]
    day = 86_400_000_000
    return rounded(scaling.legit_success_rate(requests(spark, sf_dir), "ts_us", first + day, first + 10 * day, F.col("src") % 10 != 0, F.col("status") < 400))


@query("sustained_alert", f"""WITH {DEPLOY}, f AS (SELECT *, sum(CASE WHEN score > 0.8 THEN 0 ELSE 1 END) OVER (PARTITION BY deployment ORDER BY ts_us) AS island FROM dep),
r AS (SELECT deployment, min(ts_us) AS start_us, max(ts_us) AS end_us, count(*) AS n_samples FROM f WHERE score > 0.8 GROUP BY deployment, island)
SELECT * FROM r WHERE end_us - start_us >= 300000000""")
def sustained_alert(spark, sf_dir):
    return scaling.sustained_alert(deployments(spark, sf_dir))


@query("defensive_scaling_alert", f"""WITH {DEPLOY}, l AS (SELECT *, lag(replicas) OVER (PARTITION BY deployment ORDER BY ts_us) AS replicas_before FROM dep)
SELECT deployment, ts_us, replicas_before, replicas, cpu_percent FROM l WHERE replicas < replicas_before AND cpu_percent > 90""")
def defensive_scaling_alert(spark, sf_dir):
    return scaling.defensive_scaling_alert(deployments(spark, sf_dir))
