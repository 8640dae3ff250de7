import numpy as np
import pytest
from pyspark.sql import functions as F

from floodmark.operators import drift, ensemble, evaluation, scaling

# published confusion cells (tn, fp, fn, tp) and accuracy, precision, recall, F1, FPR in per cent
GOLDEN = {
    "lof": ((7039, 161, 6765, 18300), (78.53, 99.13, 73.01, 84.09, 2.24)),
    "forest": ((4161, 3039, 5373, 19692), (73.93, 86.63, 78.56, 82.40, 42.21)),
    "svm": ((6512, 688, 13840, 11225), (54.97, 94.22, 44.78, 60.71, 9.56)),
    "mixture": ((6468, 732, 16129, 8936), (47.74, 92.43, 35.65, 51.46, 10.17)),
    "autoencoder": ((6852, 348, 16788, 8277), (46.89, 95.97, 33.02, 49.14, 4.83)),
}


def test_golden_matrices(spark):
    cells = spark.createDataFrame([(m, *c) for m, (c, _) in GOLDEN.items()], "model string, tn long, fp long, fn long, tp long")
    for r in evaluation.with_metrics(cells).collect():
        got = [100 * r[x] for x in ("accuracy", "precision", "recall", "f1", "fpr")]
        assert np.allclose(got, GOLDEN[r.model][1], atol=0.006)
    ranked = evaluation.compare_models(evaluation.with_metrics(cells).withColumn("throughput", F.lit(1.0)), 1000, 100).collect()
    assert [r.model for r in ranked][:2] == ["lof", "forest"] and ranked[0].rank_f1 == 1


def test_matrix_from_rows_and_empty_classes(spark):
    df = spark.createDataFrame([(1, 1), (1, -1), (-1, -1), (-1, 1), (-1, -1)], "y int, y_pred int")
    assert tuple(evaluation.confusion_matrix(df).first()) == (1, 1, 1, 2)
    only_normal = evaluation.binary_metrics(df.filter("y = 1 AND y_pred = 1")).first()
    assert (only_normal.precision, only_normal.recall, only_normal.f1, only_normal.accuracy) == (0.0, 0.0, 0.0, 1.0)
    report = {r["class"]: r for r in evaluation.classification_report(df).collect()}
    assert report["anomaly"].support == 3 and report["weighted avg"].support == 5
    assert np.isclose(report["macro avg"].recall, (2 / 3 + 1 / 2) / 2)


def brute_auc(y, s):
    pos, neg = s[y == -1], s[y == 1]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


def test_curves_with_ties(spark):
    rng = np.random.default_rng(5)
    y = np.where(rng.random(400) < 0.3, -1, 1)
    s = np.round(rng.normal(0, 1, 400) + (y == -1), 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, score double")
    assert np.isclose(evaluation.roc_auc(df).first()[0], brute_auc(y, s))
    order = sorted(set(s), reverse=True)
    recall = [np.mean(s[y == -1] >= t) for t in order]
    precision = [np.mean(y[s >= t] == -1) for t in order]
    ap = sum((r - b) * p for r, b, p in zip(recall, [0, *recall], precision))
    assert np.isclose(evaluation.average_precision(df).first()[0], ap)
    best = max(t for t, r in zip(order, recall) if r >= 0.95)
    assert evaluation.threshold_for_recall(df).first().threshold == best
    assert evaluation.detection_at_fpr(df, 0.1).first().fpr >= 0.1


def test_curve_without_positives(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, score double")
    assert evaluation.roc_auc(df).first()[0] == 0.0
    assert evaluation.average_precision(df).first()[0] == 0.0


def test_votes_and_weights(spark):
    df = spark.createDataFrame([(1, 1, -1, -1), (1, 1, 1, -1), (-1, -1, -1, -1)], "a int, b int, c int, d int")
    assert [r.v for r in df.select(ensemble.majority_vote(list("abcd")).alias("v")).collect()] == [-1, 1, -1]
    s = spark.createDataFrame([(0.15, 0.12, 0.18, 0.20, 0.14)], "a double, b double, c double, d double, e double")
    names = list("abcde")
    assert np.isclose(s.select(ensemble.weighted_score(names)).first()[0], 0.158)
    assert np.isclose(s.select(ensemble.weighted_score(names, ensemble.EXAMPLE_WEIGHTS)).first()[0], np.average([0.15, 0.12, 0.18, 0.20, 0.14], weights=ensemble.EXAMPLE_WEIGHTS))


def test_stacking_separates(spark):
    rows = [(-1 if i % 4 == 0 else 1, (i % 4 == 0) + (i % 7) * 0.05, 0.1) for i in range(400)]
    df = spark.createDataFrame(rows, "y int, s1 double, s2 double").withColumn("w", ensemble.cost_weights())
    for weight in (None, "w"):
        out = ensemble.stacking_predict(df, ensemble.stacking_fit(df, ["s1", "s2"], weight=weight))
        assert evaluation.binary_metrics(out).first().f1 > 0.99
        assert out.columns[-2:] == ["stack_score", "y_pred"]


def test_golden_decisions(spark):
    df = spark.createDataFrame([(5, 80.0, 0.1), (5, 90.0, 0.9), (5, 95.0, 0.5), (5, 75.0, 0.158), (2, 10.0, 0.9), (9, 99.0, 0.0), (5, 20.0, 0.5), (5, 60.0, 0.5)], "r int, cpu double, s double")
    got = [x.n for x in df.select(scaling.threat_aware_replicas("r", "cpu", "s").alias("n")).collect()]
    assert got == [6, 4, 6, 6, 2, 10, 4, 5]
    actions = df.withColumn("y_pred", F.when(F.col("s") >= 0.7, -1).otherwise(1)).select(*scaling.attack_policy("y_pred", "cpu", 80.0, "r")).collect()
    assert [a.action for a in actions][:3] == ["hold", "down", "up"] and actions[1].rate_limit == 10 and actions[4].action == "hold"


def minutes(*scores, start=0):
    return [("d", (start + i) * 60_000_000, s) for i, s in enumerate(scores)]


def test_sustained_alert_across_chunks(spark):
    rows = minutes(*[0.9] * 4, 0.5, *[0.9] * 7, 0.1, *[0.95] * 6)
    df = spark.createDataFrame(rows, "deployment string, ts_us long, score double")
    for chunk in (60_000_000, 180_000_000, 86_400_000_000):
        got = sorted((r.start_us // 60_000_000, r.end_us // 60_000_000, r.n_samples) for r in scaling.sustained_alert(df, chunk_us=chunk).collect())
        assert got == [(5, 11, 7), (13, 18, 6)], chunk


def test_cost_uses_time_to_next_sample(spark):
    rows = [(p, "d", t * 1_000_000, r) for p, rs in {"base": (4, 4, 4), "aware": (4, 2, 9)}.items() for t, r in zip((0, 3600, 7200), rs)]
    df = spark.createDataFrame(rows, "policy string, deployment string, ts_us long, replicas int")
    got = {r.policy: r for r in scaling.scaling_cost(df, "base").collect()}
    assert np.isclose(got["base"].cost, 0.4) and np.isclose(got["aware"].cost, 0.3) and np.isclose(got["aware"].savings_pct, 25.0)


def test_same_distribution_has_no_drift(spark):
    df = spark.range(1000).select((F.col("id") * 0.37 % 11).alias("x"), F.lit(3.0).alias("k"))
    out = {r.feature: r for r in drift.kl_drift(df, df, ["x", "k"]).collect()}
    assert abs(out["x"].kl) < 1e-12 and not out["k"].drifted
    shifted = df.select((F.col("x") * 0.1).alias("x"), "k")
    got = {r.feature: r for r in drift.kl_drift(df, shifted, ["x", "k"]).collect()}
    x = np.arange(1000) * 0.37 % 11
    p, edges = np.histogram(x, bins=50)
    q, _ = np.histogram(x * 0.1, bins=edges)
    p, q = p / p.sum() + 1e-10, q / q.sum() + 1e-10
    p, q = p / p.sum(), q / q.sum()
    assert np.isclose(got["x"].kl, np.sum(p * np.log(p / q)), rtol=1e-6) and got["x"].drifted


def replay(scores, default, size, minimum):
    kept, out = [], []
    for s in scores:
        limit = np.percentile(kept[-size:], 95) if len(kept[-size:]) >= minimum else default
        out.append((limit, -1 if s > limit else 1))
        if s <= limit:
            kept.append(s)
    return out


@pytest.mark.parametrize("batch", ["37", "10000"])
def test_adaptive_threshold_replays(spark, batch):
    rng = np.random.default_rng(9)
    rows = [(k, i, float(s)) for k in ("a", "b", None) for i, s in enumerate(rng.lognormal(0, 1, 600))]
    df = spark.createDataFrame(rows, "k string, t long, s double").repartition(5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = drift.adaptive_threshold(df, "k", "t", "s", default=3.0, size=200, minimum=50).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for key in ("a", "b", None):
        mine = [(r.threshold, r.y_pred) for r in sorted((r for r in got if r.k == key), key=lambda r: r.t)]
        want = replay([r[2] for r in rows if r[0] == key], 3.0, 200, 50)
        assert np.allclose([m[0] for m in mine], [w[0] for w in want]) and [m[1] for m in mine] == [w[1] for w in want]


@pytest.mark.parametrize("shape", ["even", "levels", "rising", "missing", "constant"])
def test_ring_decides_runs_of_flagged_scores_at_once(shape):
    rng = np.random.default_rng(4)
    scores = {
        "even": rng.random(6000),
        "levels": rng.integers(0, 9, 6000) / 2.0,
        "rising": np.arange(6000) / 1000.0,
        "missing": np.where(rng.random(6000) < 0.3, np.nan, rng.random(6000)),
        "constant": np.full(3000, 0.25),
    }[shape]
    want = replay(scores, 0.9, 100, 20)
    ring, limits, flags = drift.ScoreRing(0.9, 100, 95.0, 20), [], []
    for part in np.array_split(scores, 7):  # the ring carries over from batch to batch
        limit, flag = ring.replay(part)
        limits.append(limit)
        flags.append(flag)
    assert np.allclose(np.concatenate(limits), [w[0] for w in want], rtol=0, atol=1e-12)
    assert np.concatenate(flags).tolist() == [w[1] == -1 for w in want]


def test_ring_steps_grow_with_the_logarithm_of_a_key():
    scores = np.random.default_rng(5).random(400_000)
    steps = []
    for n in (100_000, 400_000):
        ring = drift.ScoreRing(0.9, 100, 95.0, 20)
        ring.replay(scores[:n])
        steps.append(ring.steps)
    assert steps[1] < 400_000 / 20 and steps[1] < 1.5 * steps[0]  # four times the rows, hardly more steps
    empty = drift.ScoreRing(0.9).replay(np.array([]))
    assert len(empty[0]) == len(empty[1]) == 0


def test_retraining_is_due_after_a_week(spark):
    day = drift.DAY_US
    df = spark.createDataFrame([(1, 0, 1), (2, 9 * day, 1), (3, 9 * day, -1), (4, 3 * day, 1)], "id int, ts_us long, y_pred int")
    due, rows = drift.retrain_set(df, 10 * day, 3 * day)
    assert due and sorted(r.id for r in rows.collect()) == [2, 4]
    assert not drift.retrain_set(df, 10 * day, 4 * day)[0]
