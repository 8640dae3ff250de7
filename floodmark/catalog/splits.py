"""Splits, samples, injected anomalies."""

from __future__ import annotations

from pyspark.sql import functions as F

from floodmark.catalog.registry import query, rounded
from floodmark.catalog.standins import FLOW, FLOW_FEATURES, JUDGED, REQ, flows, hash_sql, judged_flows, micros, requests
from floodmark.operators import splitting
from floodmark.operators.traffic import trailing_rate

_HASHED = f"h AS (SELECT *, {hash_sql('42')} AS hash FROM flow)"


@query("benign_split", f"""WITH {FLOW}, {_HASHED} SELECT row_id, label,
  CASE WHEN label = 'Benign' AND substr(hash, 1, 8) >= '33333333' THEN 'train' ELSE 'test' END AS part FROM h""")
def benign_split(spark, sf_dir):
    train, test = splitting.benign_split(flows(spark, sf_dir).select("row_id", "label"), "row_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("benign_split_exact", f"""WITH {FLOW}, {_HASHED},
r AS (SELECT row_id, label, row_number() OVER (ORDER BY hash) AS rn, count(*) OVER () AS n FROM h WHERE label = 'Benign')
SELECT row_id, label, CASE WHEN rn <= ceil(round(0.2 * n, 6)) THEN 'test' ELSE 'train' END AS part FROM r
UNION ALL SELECT row_id, label, 'test' FROM h WHERE label <> 'Benign'""")
def benign_split_exact(spark, sf_dir):
    train, test = splitting.benign_split(flows(spark, sf_dir).select("row_id", "label"), "row_id", exact=True)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("benign_split_by", f"""WITH {FLOW}, {_HASHED}, g AS (SELECT *, l_orderkey % 1500 AS file FROM h),
r AS (SELECT row_id, label, file, row_number() OVER (PARTITION BY file ORDER BY hash) AS rn, count(*) OVER (PARTITION BY file) AS n FROM g WHERE label = 'Benign')
SELECT row_id, label, file, CASE WHEN n > 1 AND rn <= ceil(round(0.2 * n, 6)) THEN 'test' ELSE 'train' END AS part FROM r
UNION ALL SELECT row_id, label, file, 'test' FROM g WHERE label <> 'Benign'""")
def benign_split_by(spark, sf_dir):
    df = flows(spark, sf_dir).select("row_id", "label", (F.col("l_orderkey") % 1500).alias("file"))
    return splitting.benign_split_by(df, "file", "row_id")


@query("balanced_sample", f"""WITH {FLOW}, {_HASHED},
r AS (SELECT row_id, label, row_number() OVER (PARTITION BY label = 'Benign' ORDER BY hash) AS rn FROM h)
SELECT row_id, label FROM r WHERE rn <= least(5000, (SELECT count(*) FROM flow WHERE label = 'Benign'))""")
def balanced_sample(spark, sf_dir):
    return splitting.balanced_sample(flows(spark, sf_dir).select("row_id", "label"), 5000, "row_id")


@query("temporal_split", f"""WITH {REQ}, w AS (SELECT row_id, status, (ts_us - (SELECT min(ts_us) FROM req)) // 604800000000 AS week FROM req)
SELECT row_id, CASE WHEN week < 2 AND status < 400 THEN 'train' WHEN week = 2 THEN 'validation' WHEN week = 3 THEN 'test' END AS part
FROM w WHERE (week < 2 AND status < 400) OR week IN (2, 3)""")
def temporal_split(spark, sf_dir):
    return splitting.temporal_split(requests(spark, sf_dir), "ts_us", F.col("status") < 400).select("row_id", "part")


@query("contaminated_split", f"""WITH {FLOW}, {_HASHED},
t AS (SELECT row_id, label, hash, CASE
  WHEN label = 'Benign' THEN CASE WHEN substr(hash, 1, 8) < '99999998' THEN 'train' WHEN substr(hash, 1, 8) < 'cccccccc' THEN 'validation' ELSE 'test' END
  WHEN substr(hash, 1, 8) < '7fffffff' THEN 'validation' ELSE 'test' END AS part FROM h),
q AS (SELECT part, count(*) // 9 AS quota FROM t WHERE label = 'Benign' GROUP BY 1),
a AS (SELECT row_id, label, part, row_number() OVER (PARTITION BY part ORDER BY hash) AS rn FROM t WHERE label <> 'Benign')
SELECT row_id, label, part FROM t WHERE label = 'Benign' UNION ALL SELECT row_id, label, part FROM a JOIN q USING (part) WHERE rn <= quota""")
def contaminated_split(spark, sf_dir):
    return splitting.contaminated_split(flows(spark, sf_dir).select("row_id", "label"), "row_id")


@query("review_sample", f"""WITH {JUDGED}, r AS (SELECT row_id, pred_a AS y_pred, row_number() OVER (PARTITION BY pred_a ORDER BY {hash_sql('42')}) AS rn FROM judged)
SELECT row_id, y_pred FROM r WHERE rn <= 500""")
def review_sample(spark, sf_dir):
    return splitting.review_sample(judged_flows(spark, sf_dir).select("row_id", F.col("pred_a").alias("y_pred")), "row_id")


@query("hybrid_route", f"""WITH {REQ},
r AS (SELECT row_id, payload, count(*) OVER (PARTITION BY src ORDER BY ts_us RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW) AS recent FROM req),
d AS (SELECT *, substr({hash_sql('42')}, 1, 8) < '19999999' AS chosen FROM r)
SELECT row_id, CASE WHEN chosen THEN CASE WHEN payload > 150 THEN -1 ELSE 1 END WHEN recent > 1 THEN -1 ELSE 1 END AS y_pred,
  CASE WHEN chosen THEN 'detector' ELSE 'rule' END AS decided_by FROM d""")
def hybrid_route(spark, sf_dir):
    rated = trailing_rate(requests(spark, sf_dir), seconds=3600).select("row_id", "payload", "recent_requests")

    def detect(df):
        return df.withColumn("y_pred", F.when(F.col("payload") > 150, -1).otherwise(1))

    routed = splitting.hybrid_route(rated, "row_id", detect, rate="recent_requests", max_rate=1.0)
    return routed.select("row_id", "y_pred", "decided_by")


_D = len(FLOW_FEATURES)


def _uniform(seed: str) -> str:
    return f"((('0x' || substr({hash_sql(seed)}, 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)"


def _inject_sql() -> str:
    noise = ", ".join(
        f"CASE WHEN is_noise = 1 THEN {c} + 3.0::DOUBLE * sqrt(-2.0::DOUBLE * ln({_uniform('42-u-' + c)})) * cos(2 * pi() * {_uniform('42-v-' + c)}) ELSE {c} END AS {c}"
        for c in FLOW_FEATURES
    )
    arr = f"[{', '.join(FLOW_FEATURES)}]"
    swap = ", ".join(
        f"CASE WHEN is_swap = 1 AND i = {k} THEN {arr}[j + 1] WHEN is_swap = 1 AND j = {k} THEN {arr}[i + 1] ELSE {c} END AS {c}"
        for k, c in enumerate(FLOW_FEATURES)
    )
    extreme = ", ".join(
        f"round(CASE WHEN is_extreme = 1 AND x = {k} THEN 10.0::DOUBLE * m_{c} ELSE {c} END, 4) + 0.0 AS {c}" for k, c in enumerate(FLOW_FEATURES)
    )
    ranks = ", ".join(
        f"CAST(row_number() OVER (ORDER BY {hash_sql('42-' + kind)}) <= CAST(floor((SELECT count(*) FROM flow) * 0.1) AS BIGINT) // 3 AS INTEGER) AS is_{kind}"
        for kind in ("noise", "swap", "extreme")
    )
    index = f"CAST(floor({_uniform('42-i')} * {_D}) AS INTEGER)"
    other = f"({index} + 1 + CAST(floor({_uniform('42-j')} * {_D - 1}) AS INTEGER)) % {_D}"
    flags = "row_id, is_noise, is_swap, is_extreme"
    return f"""WITH {FLOW},
m AS (SELECT {', '.join(f'max({c}) AS m_{c}' for c in FLOW_FEATURES)} FROM flow),
f AS (SELECT *, {ranks}, {index} AS i, {other} AS j, CAST(floor({_uniform('42-x')} * {_D}) AS INTEGER) AS x FROM flow),
n AS (SELECT {flags}, i, j, x, {noise} FROM f),
s AS (SELECT {flags}, x, {swap} FROM n)
SELECT {flags}, {extreme}, greatest(is_noise, is_swap, is_extreme) AS injected FROM s, m"""


@query("inject_anomalies", _inject_sql())
def inject_anomalies(spark, sf_dir):
    df = flows(spark, sf_dir).select("row_id", *FLOW_FEATURES)
    return rounded(splitting.inject_anomalies(df, FLOW_FEATURES, "row_id"), 4)
