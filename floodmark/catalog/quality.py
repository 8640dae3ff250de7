"""Ensembles and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from floodmark.catalog.registry import query, rounded
from floodmark.catalog.standins import JUDGED, REQ, TRUTH, judged_flows, requests, truth_scores
from floodmark.operators import enrich, ensemble, evaluation, splitting
from floodmark.plans.ordering import below_fraction, order_hash

CELLS_SQL = """count(*) FILTER (y <> -1 AND p <> -1) AS tn, count(*) FILTER (y <> -1 AND p = -1) AS fp,
  count(*) FILTER (y = -1 AND p <> -1) AS fn, count(*) FILTER (y = -1 AND p = -1) AS tp"""


def _safe(a: str, b: str) -> str:
    return f"round(coalesce(({a})::DOUBLE / nullif({b}, 0), 0.0::DOUBLE), 6)"


METRIC_TEXTS = [
    f"{_safe('tp + tn', 'tp + tn + fp + fn')} AS accuracy", f"{_safe('tp', 'tp + fp')} AS precision", f"{_safe('tp', 'tp + fn')} AS recall",
    f"{_safe('2 * tp', '2 * tp + fp + fn')} AS f1", f"{_safe('fp', 'fp + tn')} AS fpr", f"{_safe('tn', 'fp + tn')} AS tnr",
]
METRICS_SQL = ", ".join(METRIC_TEXTS)
# predictions in long form, one row per (row, model)
LONG = JUDGED + """,
long AS (SELECT row_id, label, y, 'a' AS model, pred_a AS p, ts_us FROM judged UNION ALL SELECT row_id, label, y, 'b', pred_b, ts_us FROM judged
  UNION ALL SELECT row_id, label, y, 'c', pred_c, ts_us FROM judged)"""


def long_predictions(spark, sf_dir):
    df = judged_flows(spark, sf_dir)
    runs = {m: df.select("row_id", "label", "y", F.col(f"pred_{m}").alias("y_pred"), "ts_us") for m in "abc"}
    return enrich.experiment_union(runs).withColumnRenamed("experiment", "model")


@query("majority_vote", f"""WITH {JUDGED} SELECT row_id, CASE WHEN pred_a + pred_b > 0 THEN 1 ELSE -1 END AS tie_vote,
  CASE WHEN pred_a + pred_b + pred_c > 0 THEN 1 ELSE -1 END AS vote FROM judged""")
def majority_vote(spark, sf_dir):
    return judged_flows(spark, sf_dir).select(
        "row_id",
        ensemble.majority_vote(["pred_a", "pred_b"]).alias("tie_vote"),
        ensemble.majority_vote(["pred_a", "pred_b", "pred_c"]).alias("vote"),
    )


@query("majority_vote_long", f"""WITH {JUDGED} SELECT row_id, CASE WHEN pred_a + pred_b + pred_c > 0 THEN 1 ELSE -1 END AS y_pred FROM judged""")
def majority_vote_long(spark, sf_dir):
    return ensemble.majority_vote_long(long_predictions(spark, sf_dir))


@query("weighted_score", f"""WITH {JUDGED}, r AS (SELECT min(score_a) AS a0, max(score_a) AS a1, min(score_b) AS b0, max(score_b) AS b1 FROM judged),
s AS (SELECT row_id, (0.6 * (score_a - a0) / (a1 - a0) + 0.4 * (score_b - b0) / (b1 - b0)) AS e, (score_a + score_b) / 2 AS m FROM judged, r)
SELECT row_id, round(e, 9) AS ensemble_score, CASE WHEN e > 0.5001 THEN -1 ELSE 1 END AS y_pred, round(m, 9) AS mean_score FROM s""")
def weighted_score(spark, sf_dir):
    out = ensemble.normalised_ensemble(judged_flows(spark, sf_dir), ["score_a", "score_b"], [0.6, 0.4], limit=0.5001)
    return rounded(out.select("row_id", "ensemble_score", "y_pred", ensemble.weighted_score(["score_a", "score_b"]).alias("mean_score")), 9)


@query("validation_weights", f"""WITH {LONG}, c AS (SELECT model, {CELLS_SQL} FROM long GROUP BY 1), f AS (SELECT model, 2.0 * tp / (2 * tp + fp + fn) AS f1 FROM c)
SELECT model, round(f1, 6) AS f1, round(f1 / sum(f1) OVER (), 6) AS weight FROM f""")
def validation_weights(spark, sf_dir):
    return rounded(ensemble.validation_weights(long_predictions(spark, sf_dir)))


@query("cost_weights", f"""WITH {JUDGED} SELECT row_id, CASE WHEN y = -1 THEN 10.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM judged""")
def cost_weights(spark, sf_dir):
    return judged_flows(spark, sf_dir).select("row_id", ensemble.cost_weights().alias("weight"))


@query("stacking")
def stacking(spark, sf_dir):
    df = judged_flows(spark, sf_dir)
    held_out = below_fraction(order_hash("stacking", "row_id"), 0.2)
    train, test = df.filter(~held_out), df.filter(held_out)
    model = ensemble.stacking_fit(train, ["score_a", "score_b"])
    return rounded(evaluation.binary_metrics(ensemble.stacking_predict(test, model)))


@query("stacking_weighted")
def stacking_weighted(spark, sf_dir):
    df = judged_flows(spark, sf_dir).withColumn("weight", ensemble.cost_weights())
    held_out = below_fraction(order_hash("stacking", "row_id"), 0.2)
    train, test = df.filter(~held_out), df.filter(held_out)
    model = ensemble.stacking_fit(train, ["score_a", "score_b"], weight="weight")
    return rounded(evaluation.binary_metrics(ensemble.stacking_predict(test, model)))


@query("confusion_matrix", f"WITH {LONG} SELECT model, {CELLS_SQL} FROM long GROUP BY 1")
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(long_predictions(spark, sf_dir), by=["model"])


@query("binary_metrics", f"WITH {LONG}, c AS (SELECT model, {CELLS_SQL} FROM long GROUP BY 1) SELECT *, {METRICS_SQL} FROM c")
def binary_metrics(spark, sf_dir):
    return rounded(evaluation.binary_metrics(long_predictions(spark, sf_dir), by=["model"]))


@query("classification_report", f"""WITH {JUDGED}, c AS (SELECT {CELLS_SQL.replace('p ', 'pred_a ')} FROM judged),
k AS (SELECT 'anomaly' AS class, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1, tp + fn AS support FROM c
  UNION ALL SELECT 'normal', tn / (tn + fn), tn / (tn + fp), 2 * tn / (2 * tn + fp + fn), tn + fp FROM c),
a AS (SELECT * FROM k UNION ALL SELECT 'accuracy', (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), tp + tn + fp + fn FROM c
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM k
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)::BIGINT FROM k)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM a""")
def classification_report(spark, sf_dir):
    return rounded(evaluation.classification_report(judged_flows(spark, sf_dir), "y", "pred_a"))


CURVE = TRUTH + """,
per AS (SELECT score AS threshold, count(*) FILTER (y = -1) AS pos, count(*) FILTER (y = 1) AS neg FROM truth GROUP BY 1),
cum AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM per),
curve AS (SELECT threshold, pos, neg, tp, fp, (tp / p)::DOUBLE AS tpr, (fp / n)::DOUBLE AS fpr, (tp / (tp + fp))::DOUBLE AS precision FROM cum)"""


@query("roc_curve", f"WITH {CURVE} SELECT threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM curve")
def roc_curve(spark, sf_dir):
    return rounded(evaluation.roc_curve(truth_scores(spark, sf_dir)))


@query("roc_auc", f"""WITH {CURVE}, steps AS (SELECT tpr, fpr, lag(tpr, 1, 0) OVER (ORDER BY threshold DESC) AS t0, lag(fpr, 1, 0) OVER (ORDER BY threshold DESC) AS f0 FROM curve)
SELECT round(sum((fpr - f0) * (tpr + t0) / 2), 6) AS roc_auc FROM steps""")
def roc_auc(spark, sf_dir):
    return rounded(evaluation.roc_auc(truth_scores(spark, sf_dir)))


@query("pr_curve", f"WITH {CURVE} SELECT threshold, round(precision, 6) AS precision, round(tpr, 6) AS recall FROM curve")
def pr_curve(spark, sf_dir):
    return rounded(evaluation.pr_curve(truth_scores(spark, sf_dir)))


@query("average_precision", f"""WITH {CURVE}, steps AS (SELECT tpr, precision, lag(tpr, 1, 0) OVER (ORDER BY threshold DESC) AS t0 FROM curve)
SELECT round(sum((tpr - t0) * precision), 6) AS average_precision FROM steps""")
def average_precision(spark, sf_dir):
    return rounded(evaluation.average_precision(truth_scores(spark, sf_dir)))


@query("detection_at_fpr", f"""WITH {CURVE} SELECT round(tpr, 6) AS tpr, round(fpr, 6) AS fpr, threshold FROM curve WHERE fpr >= 0.01 ORDER BY threshold DESC LIMIT 1""")
def detection_at_fpr(spark, sf_dir):
    return rounded(evaluation.detection_at_fpr(truth_scores(spark, sf_dir)))


@query("threshold_for_recall", f"""WITH {CURVE} SELECT threshold, round(tpr, 6) AS recall, round(precision, 6) AS precision FROM curve WHERE tpr >= 0.95 ORDER BY threshold DESC LIMIT 1""")
def threshold_for_recall(spark, sf_dir):
    return rounded(evaluation.threshold_for_recall(truth_scores(spark, sf_dir)))


@query("roc_auc_flows", f"""WITH {JUDGED}, truth AS (SELECT y, score_b AS score FROM judged), {CURVE[len(TRUTH) + 1:]},
steps AS (SELECT tpr, fpr, lag(tpr, 1, 0) OVER (ORDER BY threshold DESC) AS t0, lag(fpr, 1, 0) OVER (ORDER BY threshold DESC) AS f0 FROM curve)
SELECT round(sum((fpr - f0) * (tpr + t0) / 2), 6) AS roc_auc FROM steps""")
def roc_auc_flows(spark, sf_dir):
    return rounded(evaluation.roc_auc(judged_flows(spark, sf_dir), score="score_b"))


@query("detection_by_attack", f"""WITH {JUDGED} SELECT label, count(*) AS n, count(*) FILTER (pred_a = -1) AS n_flagged,
  round(avg(CASE WHEN pred_a = -1 THEN 1.0 ELSE 0.0 END), 6) AS flagged_share FROM judged GROUP BY 1""")
def detection_by_attack(spark, sf_dir):
    return rounded(evaluation.detection_by_attack(judged_flows(spark, sf_dir), y_pred="pred_a"))


@query("compare_models", f"""WITH {LONG}, c AS (SELECT model, {CELLS_SQL} FROM long GROUP BY 1), m AS (SELECT *, {METRICS_SQL}, (tp + fp)::DOUBLE AS throughput FROM c)
SELECT *, CAST(rank() OVER (ORDER BY f1 DESC) AS INTEGER) AS rank_f1, CAST(rank() OVER (ORDER BY fpr) AS INTEGER) AS rank_fpr,
  CAST(rank() OVER (ORDER BY recall DESC) AS INTEGER) AS rank_recall, CAST(rank() OVER (ORDER BY throughput DESC) AS INTEGER) AS rank_speed,
  round(10000 * fpr, 6) AS blocked_legit, round(500 * recall, 6) AS avoided_attacks FROM m""")
def compare_models(spark, sf_dir):
    metrics = rounded(evaluation.binary_metrics(long_predictions(spark, sf_dir), by=["model"]))
    metrics = metrics.withColumn("throughput", (F.col("tp") + F.col("fp")).cast("double"))
    return rounded(evaluation.compare_models(metrics, 10000, 500))


@query("latency_summary", f"""WITH {REQ} SELECT event_type AS model, count(*) AS n, round(avg(payload), 6) AS mean_ms, round(1000.0 * count(*) / sum(payload), 6) AS throughput,
  round(quantile_cont(payload, 0.5), 6) AS p50, round(quantile_cont(payload, 0.95), 6) AS p95, round(quantile_cont(payload, 0.99), 6) AS p99 FROM req GROUP BY 1""")
def latency_summary(spark, sf_dir):
    measured = requests(spark, sf_dir).select(F.col("event_type").alias("model"), F.col("payload").alias("latency_ms"))
    return rounded(evaluation.latency_summary(measured))


@query("quality_over_time", f"""WITH {JUDGED}, w AS (SELECT y, pred_a AS p, (ts_us - (SELECT min(ts_us) FROM judged)) // 604800000000 AS week FROM judged),
c AS (SELECT week, {CELLS_SQL} FROM w GROUP BY 1), m AS (SELECT week, {METRICS_SQL}, 2.0::DOUBLE * tp / (2 * tp + fp + fn) AS f FROM c)
SELECT week, precision, recall, f1, round(f - first_value(f) OVER (ORDER BY week), 6) + 0.0 AS f1_change FROM m""")
def quality_over_time(spark, sf_dir):
    return rounded(evaluation.quality_over_time(judged_flows(spark, sf_dir), y_pred="pred_a"))


@query("threshold_sweep", f"""WITH {JUDGED}, s AS (
  SELECT y, 'score_a' AS model, score_a AS s FROM judged UNION ALL SELECT y, 'score_b', score_b FROM judged
  UNION ALL SELECT y, 'ensemble', (score_a + score_b) / 2 FROM judged),
t AS (SELECT model, threshold::DOUBLE AS threshold, y, CASE WHEN s > threshold THEN -1 ELSE 1 END AS p FROM s, (SELECT unnest([0.3003, 0.5003, 0.7003]) AS threshold)),
c AS (SELECT model, threshold, {CELLS_SQL} FROM t GROUP BY 1, 2) SELECT *, {METRICS_SQL} FROM c""")
def threshold_sweep(spark, sf_dir):
    df = judged_flows(spark, sf_dir).withColumn("ensemble", ensemble.weighted_score(["score_a", "score_b"]))
    return rounded(evaluation.threshold_sweep(df, ["score_a", "score_b", "ensemble"], [0.3003, 0.5003, 0.7003]))
