"""Container logs to decisions in one stream: parsed, deduplicated, with features, scored, into four tables under one batch number."""

from __future__ import annotations

from pyspark.sql import functions as F

from floodmark.catalog.registry import query, rounded
from floodmark.catalog.scans import access_lines
from floodmark.catalog.standins import REQ, requests
from floodmark.operators.detect import gmm
from floodmark.plans.staging import scratch_path
from floodmark.sources import logs
from floodmark.streaming import chain, pipeline

KEY = ["pod", "app", "log_time", "line"]
FEATURES = ["body_bytes_sent", "path_length"]
LIMIT = 8.0


def _container_logs(spark, sf_dir):
    """Requests as container logs, every third one sent twice."""
    req = requests(spark, sf_dir)
    path = scratch_path(spark, "chain-logs")
    times = F.when(F.col("row_id") % 3 == 0, 2).otherwise(1)
    sent = req.withColumn("line", access_lines(req)).withColumn("_again", F.explode(F.sequence(F.lit(1), times)))
    sent.select(
        F.col("line").alias("log"), F.lit("stdout").alias("stream"), F.col("ts").cast("timestamp").alias("time"),
        F.struct(
            F.concat(F.lit("pod-"), F.col("row_id").cast("string")).alias("pod_name"),
            F.lit("default").alias("namespace_name"),
            F.create_map(F.lit("app"), "event_type").alias("labels"),
        ).alias("kubernetes"),
    ).write.json(path)
    return path


def _parsed(lines):
    """Stream and batch alike."""
    parsed = logs.parse_access_log(lines).withColumns({"src": F.col("remote_addr"), "ts_us": F.unix_micros("timestamp"), "ts": F.col("log_time")})
    return pipeline.stream_features(parsed)


def _run(spark, sf_dir):
    path, root = _container_logs(spark, sf_dir), scratch_path(spark, "chain")
    train = _parsed(logs.flatten_container_log(spark.read.schema(logs.CONTAINER_LOG).json(path)).dropDuplicates(KEY))
    model = gmm.gmm_fit(train.filter("not malformed").select(*[F.col(c).cast("double").alias(c) for c in FEATURES]), FEATURES)

    def score(batch):
        scored = gmm.gmm_score(batch.withColumns({c: F.col(c).cast("double") for c in FEATURES}), model)
        return scored.withColumn("score", F.when(~F.col("malformed"), -F.col("score")))

    outputs = [
        chain.Output("windows", lambda rows: chain.window_partials(60)(rows.filter("not malformed").withColumn("payload", F.col("body_bytes_sent")))),
        chain.Output("anomalies", lambda rows: rows.filter(F.col("score") > LIMIT).select("src", "ts", "ts_us", "path", "score"), "ts"),
        chain.Output("rejected", lambda rows: rows.filter("malformed").select("ts", "pod", "app", "line"), "ts"),
    ]
    once = pipeline.stream_dedup(logs.read_log_stream(spark, path), KEY, ts="log_time")
    chain.chained_stream(_parsed(once), score, outputs, root, ["src"]).awaitTermination()
    return root


_LINES = f"""WITH {REQ}, good AS (SELECT *, '10.' || (src // 65536) || '.' || (src // 256 % 256) || '.' || (src % 256) AS address,
  floor(payload) AS bytes, length(path)::DOUBLE AS len, ts_us // 1000000 * 1000000 AS line_us FROM req WHERE k % 13 <> 0),
p AS (SELECT avg(bytes) AS mx, avg(len) AS my, var_pop(bytes) + 1e-6::DOUBLE AS xx, var_pop(len) + 1e-6::DOUBLE AS yy, covar_pop(bytes, len) AS xy FROM good),
s AS (SELECT good.*, ln(2 * pi()) + 0.5 * ln(xx * yy - xy * xy)
  + 0.5 * ((bytes - mx) ** 2 * yy - 2 * (bytes - mx) * (len - my) * xy + (len - my) ** 2 * xx) / (xx * yy - xy * xy) AS score FROM good, p)"""


@query("stream_chain", f"""{_LINES},
a AS (SELECT 'scored' AS "table", strftime(ts, '%Y.%m.%d') AS date, count(*) AS n, (SELECT sum(score) FROM s WHERE strftime(s.ts, '%Y.%m.%d') = strftime(req.ts, '%Y.%m.%d')) AS total FROM req GROUP BY ALL
UNION ALL SELECT 'anomalies', strftime(ts, '%Y.%m.%d'), count(*), sum(score) FROM s WHERE score > {LIMIT} GROUP BY ALL
UNION ALL SELECT 'rejected', strftime(ts, '%Y.%m.%d'), count(*), NULL FROM req WHERE k % 13 = 0 GROUP BY ALL
UNION ALL SELECT 'snapshot', address, 1, max(score) FROM s JOIN (SELECT address, max(line_us) AS line_us FROM s GROUP BY 1) USING (address, line_us) GROUP BY address)
SELECT "table", date AS part, n::BIGINT AS n, round(total, 4) AS total FROM a""")
def stream_chain(spark, sf_dir):
    """Rows and sums of scores per day of the dated tables, and the newest score per address."""
    root = _run(spark, sf_dir)
    tables = []
    for name, total in ((chain.SCORED, F.sum("score")), ("anomalies", F.sum("score")), ("rejected", F.lit(None).cast("double"))):
        tables.append(chain.read_output(spark, root, name).groupBy(F.col("date").alias("part")).agg(F.lit(name).alias("table"), F.count("*").alias("n"), total.alias("total")))
    newest = chain.read_chain_snapshot(spark, root).select(F.lit(chain.SNAPSHOT).alias("table"), F.col("src").alias("part"), F.lit(1).cast("long").alias("n"), F.col("score").alias("total"))
    return rounded(tables[0].unionByName(tables[1]).unionByName(tables[2]).unionByName(newest), 4)


@query("stream_chain_windows", f"""{_LINES} SELECT address AS src, line_us // 60000000 * 60000000 AS window_start_us, count(*) AS request_count,
  round(count(*) / 60.0::DOUBLE, 6) AS request_rate, count(DISTINCT path) AS unique_paths, round(count(*) FILTER (status // 100 = 2) / count(*)::DOUBLE, 6) AS share_2xx,
  round(count(*) FILTER (status // 100 = 4) / count(*)::DOUBLE, 6) AS share_4xx, round(count(*) FILTER (status // 100 = 5) / count(*)::DOUBLE, 6) AS share_5xx,
  round(avg(bytes), 6) AS mean_payload FROM s GROUP BY ALL""")
def stream_chain_windows(spark, sf_dir):
    """Window features from the additive sums the same stream writes."""
    return rounded(chain.read_windows(chain.read_output(spark, _run(spark, sf_dir), "windows"), 60))
