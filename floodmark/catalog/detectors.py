"""Detectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from floodmark.catalog.quality import CELLS_SQL, METRICS_SQL
from floodmark.catalog.registry import query, rounded
from floodmark.catalog.standins import FLOW, FLOW_FEATURES, JUDGED, REQ, flows, hash_sql, judged_flows, requests, table, vectors
from floodmark.functions.http import path_features
from floodmark.functions.scores import binary_label
from floodmark.operators import cleaning, enrich, evaluation, splitting
from floodmark.operators.detect import autoencoder, deep, gmm, grid, iforest, neighbors, ocsvm, rules, thresholds
from floodmark.operators.traffic import trailing_rate
from floodmark.plans.ordering import below_fraction, order_hash
from floodmark.plans.staging import stage

TWO = ["l_quantity", "l_discount"]


def prepared(spark, sf_dir):
    """Split flows, impute, clip and scale on train statistics: (train, test), both with y.

    The train part is written once: the statistics and fits read it many times.
    """
    train, test = splitting.benign_split(flows(spark, sf_dir).select("row_id", "label", *FLOW_FEATURES), "row_id")
    train = stage(train, "train")
    medians = cleaning.median_fit(train, FLOW_FEATURES)
    filled = cleaning.median_fill(train, medians)
    limits = cleaning.clip_fit(filled, FLOW_FEATURES)
    clipped = cleaning.clip_apply(filled, limits)
    scaler = cleaning.standard_scaler_fit(clipped, FLOW_FEATURES)

    def prepare(df):
        df = cleaning.clip_apply(cleaning.median_fill(df, medians), limits)
        return cleaning.standard_scaler_transform(df, scaler).withColumn("y", binary_label("label"))

    return prepare(train), prepare(test)


def flagship(spark, sf_dir):
    """Benign-only Gaussian detector: split, impute, clip, scale, fit, cut-off, metrics."""
    train, test = prepared(spark, sf_dir)
    model = gmm.gmm_threshold(train, gmm.gmm_fit(train, FLOW_FEATURES))
    return rounded(evaluation.binary_metrics(gmm.gmm_predict(test, model)))


def _flagship_sql() -> str:
    """The whole pipeline in SQL; the covariance is factored one column at a time."""
    cols, d = FLOW_FEATURES, len(FLOW_FEATURES)

    def each(template: str) -> str:
        return ", ".join(template.format(c=c, i=i) for i, c in enumerate(cols))

    ctes = [
        FLOW,
        f"sp AS (SELECT *, label = 'Benign' AND substr({hash_sql('42')}, 1, 8) >= '33333333' AS train FROM flow)",
        "m AS (SELECT " + each("quantile_cont({c}, 0.5) AS m{i}") + " FROM sp WHERE train)",
        "fl AS (SELECT row_id, label, train, " + each("coalesce({c}, m{i}) AS {c}") + " FROM sp, m)",
        "q AS (SELECT " + each("quantile_cont({c}, 0.001) AS a{i}, quantile_cont({c}, 0.999) AS b{i}") + " FROM fl WHERE train)",
        "cl AS (SELECT row_id, label, train, " + each("least(greatest({c}, a{i}), b{i}) AS {c}") + " FROM fl, q)",
        "st AS (SELECT " + each("avg({c}) AS mu{i}, stddev_pop({c}) AS sd{i}") + " FROM cl WHERE train)",
        "z AS (SELECT row_id, label, train, " + each("({c} - mu{i}) / sd{i} AS x{i}") + " FROM cl, st)",
        "cv AS (SELECT " + each("avg(x{i}) AS e{i}") + ", "
        + ", ".join(f"covar_pop(x{i}, x{j}){' + 1e-6::DOUBLE' if i == j else ''} AS c{i}{j}" for j in range(d) for i in range(j, d)) + " FROM z WHERE train)",
    ]
    previous = "cv"
    for j in range(d):
        below = " ".join(f"- l{j}{k} * l{j}{k}" for k in range(j))
        ctes.append(f"d{j} AS (SELECT *, sqrt(c{j}{j} {below}) AS l{j}{j} FROM {previous})")
        rest = ", ".join(
            f"(c{i}{j} " + " ".join(f"- l{i}{k} * l{j}{k}" for k in range(j)) + f") / l{j}{j} AS l{i}{j}" for i in range(j + 1, d)
        )
        ctes.append(f"k{j} AS (SELECT *{', ' + rest if rest else ''} FROM d{j})")
        previous = f"k{j}"
    source = f"z, {previous}"
    for i in range(d):
        minus = " ".join(f"- l{i}{k} * w{k}" for k in range(i))
        ctes.append(f"w{i}s AS (SELECT *, (x{i} - e{i} {minus}) / l{i}{i} AS w{i} FROM {source})")
        source = f"w{i}s"
    squares, logs = " + ".join(f"w{i} * w{i}" for i in range(d)), " + ".join(f"ln(l{i}{i})" for i in range(d))
    ctes += [
        f"s AS (SELECT label, train, -0.5::DOUBLE * ({squares}) - ({logs}) AS score FROM {source})",
        "t AS (SELECT quantile_cont(score, 0.05) AS cut FROM s WHERE train)",
        "j AS (SELECT CASE WHEN label = 'Benign' THEN 1 ELSE -1 END AS y, CASE WHEN score < cut THEN -1 ELSE 1 END AS p FROM s, t WHERE NOT train)",
        f"c AS (SELECT {CELLS_SQL} FROM j)",
    ]
    return f"WITH {', '.join(ctes)} SELECT *, {METRICS_SQL} FROM c"


@query("gaussian_detector_metrics", _flagship_sql())
def gaussian_detector_metrics(spark, sf_dir):
    return flagship(spark, sf_dir)


def _cov_sql(ridge: str = "1e-6") -> str:
    parts = []
    for a in FLOW_FEATURES:
        for b in FLOW_FEATURES:
            extra = f" + {ridge}::DOUBLE" if a == b else ""
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(avg({a}), 4) AS mean_a, round(covar_pop({a}, {b}){extra}, 4) + 0.0 AS covariance FROM b")
    return f"WITH {FLOW}, b AS (SELECT * REPLACE (l_extendedprice / 1000 AS l_extendedprice) FROM flow WHERE label = 'Benign') " + " UNION ALL ".join(parts)


@query("gmm_fit", _cov_sql())
def gmm_fit(spark, sf_dir):
    train = flows(spark, sf_dir).filter("label = 'Benign'").withColumn("l_extendedprice", F.col("l_extendedprice") / 1000)
    model = gmm.gmm_fit(train, FLOW_FEATURES)
    factor = np.linalg.inv(np.array(model.whitening[0]))
    cov = factor @ factor.T
    rows = [
        (a, b, model.means[0][i], float(cov[i, j]))
        for i, a in enumerate(FLOW_FEATURES)
        for j, b in enumerate(FLOW_FEATURES)
    ]
    return rounded(spark.createDataFrame(rows, "feature_a string, feature_b string, mean_a double, covariance double"), 4)


@query("gmm_fit_components")
def gmm_fit_components(spark, sf_dir):
    train, _ = prepared(spark, sf_dir)
    model = gmm.gmm_fit(train, FLOW_FEATURES, k=3, n_init=10)
    rows = [(i, w, *m) for i, (w, m) in enumerate(zip(model.weights, model.means))]
    return rounded(spark.createDataFrame(rows, "component int, weight double, " + ", ".join(f"{c} double" for c in FLOW_FEATURES)))


@query("gmm_fit_parted", f"""WITH {FLOW}, p AS (
  SELECT c, l_quantity / 50 + 100 * c AS x, l_discount + 10 * c AS y
  FROM (SELECT *, CASE label WHEN 'Benign' THEN 0 WHEN 'Attack' THEN 1 ELSE 2 END AS c FROM flow))
SELECT CAST(c AS INTEGER) AS component, round(count(*) / sum(count(*)) OVER (), 6) AS weight, round(avg(x), 6) AS mean_x, round(avg(y), 6) AS mean_y,
  round(var_pop(x) + 1e-6::DOUBLE, 6) AS var_x, round(covar_pop(x, y), 6) + 0.0 AS cov_xy, round(var_pop(y) + 1e-6::DOUBLE, 6) AS var_y FROM p GROUP BY c""")
def gmm_fit_parted(spark, sf_dir):
    """Three groups far apart: the fit's components are the groups, with their shares, means and covariances."""
    group = F.when(F.col("label") == "Benign", 0).when(F.col("label") == "Attack", 1).otherwise(2)
    rows = flows(spark, sf_dir).select((F.col("l_quantity") / 50 + 100 * group).alias("x"), (F.col("l_discount") + 10 * group).alias("y"))
    model = gmm.gmm_fit(rows, ["x", "y"], k=3)
    out = []
    for i in sorted(range(3), key=lambda i: model.means[i][0]):
        factor = np.linalg.inv(np.array(model.whitening[i]))
        cov = factor @ factor.T
        out.append((len(out), model.weights[i], *model.means[i], float(cov[0, 0]), float(cov[0, 1]), float(cov[1, 1])))
    return rounded(spark.createDataFrame(out, "component int, weight double, mean_x double, mean_y double, var_x double, cov_xy double, var_y double"))


TWO_D_SQL = f"""WITH {FLOW}, b AS (SELECT * FROM flow WHERE label = 'Benign'),
p AS (SELECT avg(l_quantity) AS mx, avg(l_discount) AS my, var_pop(l_quantity) + 1e-6::DOUBLE AS xx, var_pop(l_discount) + 1e-6::DOUBLE AS yy, covar_pop(l_quantity, l_discount) AS xy FROM b),
s AS (SELECT row_id, label, -ln(2 * pi()) - 0.5 * ln(xx * yy - xy * xy)
  - 0.5 * ((l_quantity - mx) ** 2 * yy - 2 * (l_quantity - mx) * (l_discount - my) * xy + (l_discount - my) ** 2 * xx) / (xx * yy - xy * xy) AS score FROM flow, p)"""


@query("gmm_score", f"{TWO_D_SQL} SELECT row_id, round(score, 5) AS score FROM s")
def gmm_score(spark, sf_dir):
    df = flows(spark, sf_dir)
    model = gmm.gmm_fit(df.filter("label = 'Benign'"), TWO)
    return rounded(gmm.gmm_score(df, model).select("row_id", "score"), 5)


@query("gmm_predict", f"""{TWO_D_SQL}, t AS (SELECT quantile_cont(score, 0.05) AS cut FROM s WHERE label = 'Benign')
SELECT label, count(*) AS n, count(*) FILTER (score < cut - 1e-9) AS n_below, round(any_value(cut), 5) AS threshold FROM s, t GROUP BY 1""")
def gmm_predict(spark, sf_dir):
    df = flows(spark, sf_dir)
    train = df.filter("label = 'Benign'")
    model = gmm.gmm_threshold(train, gmm.gmm_fit(train, TWO))
    below = F.col("score") < F.lit(model.threshold - 1e-9)
    scored = gmm.gmm_predict(df, model).groupBy("label").agg(F.count("*").alias("n"), F.count_if(below).alias("n_below"))
    return rounded(scored.withColumn("threshold", F.lit(model.threshold)), 5)


@query("gmm_bic", f"""{TWO_D_SQL}, l AS (SELECT sum(score) AS ll, count(*) AS n FROM s WHERE label = 'Benign')
SELECT 5 AS n_parameters, round(ll, 2) AS log_likelihood, round(10 - 2 * ll, 2) AS aic, round(5 * ln(n) - 2 * ll, 2) AS bic FROM l""")
def gmm_bic(spark, sf_dir):
    train = flows(spark, sf_dir).filter("label = 'Benign'")
    _, report = gmm.gmm_select(train, TWO, k_range=[1], kinds=["full"])
    return rounded(report.select("n_parameters", "log_likelihood", "aic", "bic"), 2)


@query("gmm_select")
def gmm_select(spark, sf_dir):
    train, _ = prepared(spark, sf_dir)
    _, report = gmm.gmm_select(train, FLOW_FEATURES)
    return rounded(report, 2)


@query("iforest_fit")
def iforest_fit(spark, sf_dir):
    train, _ = prepared(spark, sf_dir)
    model = iforest.iforest_fit(train, FLOW_FEATURES, "row_id")
    return iforest.node_table(train, model).groupBy("tree_id").agg(
        F.count("*").alias("n_nodes"), F.count_if(F.col("feature") < 0).alias("n_leaves"), F.max("path").alias("longest")
    )


# a fixed two-tree forest over (l_quantity, l_discount): [feature, split, left, right, path]
SMALL_FOREST = iforest.ForestModel(
    TWO,
    4,
    [
        [[0, 10.0, 1, 2, 0.0], [-1, 0.0, 1, 1, 1.0], [1, 0.05, 3, 4, 0.0], [-1, 0.0, 3, 3, 3.0], [-1, 0.0, 4, 4, 2.0]],
        [[1, 0.08, 1, 2, 0.0], [-1, 0.0, 1, 1, 2.0], [-1, 0.0, 2, 2, 1.0]],
    ],
)


@query("iforest_score", f"""WITH {FLOW}, h AS (SELECT row_id,
  (CASE WHEN l_quantity <= 10 THEN 1.0 WHEN l_discount <= 0.05 THEN 3.0 ELSE 2.0 END + CASE WHEN l_discount <= 0.08 THEN 2.0 ELSE 1.0 END) / 2 AS mean_path FROM flow)
SELECT row_id, round(power(2.0, -mean_path / (2.0 * (ln(3.0) + 0.5772156649015329) - 2.0 * 3.0 / 4.0)), 6) AS score FROM h""")
def iforest_score(spark, sf_dir):
    return rounded(iforest.iforest_score(flows(spark, sf_dir), SMALL_FOREST).select("row_id", "score"))


@query("iforest_predict")
def iforest_predict(spark, sf_dir):
    train, test = prepared(spark, sf_dir)
    model = iforest.iforest_threshold(train, iforest.iforest_fit(train, FLOW_FEATURES, "row_id"), contamination=0.05)
    return rounded(evaluation.binary_metrics(iforest.iforest_predict(test, model)))


_V = "v AS (SELECT vec_id, embedding::DOUBLE[] AS x, label FROM embeddings)"
_SQL_DISTANCE = {
    "euclidean": "sqrt(list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) ** 2)))",
    "manhattan": "list_sum(list_transform(list_zip(a.x, b.x), lambda z: abs(z[1] - z[2])))",
    "cosine": "1 - list_cosine_similarity(a.x, b.x)",
    "hamming": "list_avg(list_transform(list_zip(a.x, b.x), lambda z: CASE WHEN sign(z[1]) <> sign(z[2]) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END))",
}


def near_sql(k: int, metric: str, query_side: str = "true", ref_side: str = "true") -> str:
    """Neighbours by comparing all pairs: ``near(vec_id, n_id, dist, rank)``."""
    return f"""{_V}, pairs AS (SELECT a.vec_id, b.vec_id AS n_id, {_SQL_DISTANCE[metric]} AS dist
  FROM v a, v b WHERE a.vec_id <> b.vec_id AND (a.{query_side}) AND (b.{ref_side})),
near AS (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY round(dist, 12), n_id) AS INTEGER) AS rank FROM pairs QUALIFY rank <= {k})""".replace(
        "a.true", "true"
    ).replace("b.true", "true")


def _self_neighbours(metric, **options):
    def run(spark, sf_dir):
        v = vectors(spark, sf_dir)
        if metric == "hamming":
            v = v.withColumn("embedding", F.transform("embedding", lambda x: F.signum(x)))
        near = neighbors.knn_join(v, v, 5, "vec_id", "vec_id", "embedding", metric, exclude_self=True, **options)
        return rounded(near, 5)

    return run


for _metric in ("euclidean", "manhattan", "cosine", "hamming"):
    _name = "knn_join" if _metric == "euclidean" else f"knn_join_{_metric}"
    query(_name, f"WITH {near_sql(5, _metric)} SELECT vec_id, n_id, round(dist, 5) AS dist, rank FROM near")(_self_neighbours(_metric))
    # the path of references that are too big for a broadcast, against the same SQL
    query(f"knn_join_cells_{_metric}", f"WITH {near_sql(5, _metric)} SELECT vec_id, n_id, round(dist, 5) AS dist, rank FROM near")(
        _self_neighbours(_metric, broadcast_values=0)
    )


@query("knn_join_mahalanobis", f"""WITH {FLOW}, v AS (SELECT l_orderkey AS id, avg(l_quantity) AS x, avg(l_discount) AS y FROM flow WHERE label = 'Benign' GROUP BY 1),
q AS (SELECT l_orderkey AS id, avg(l_quantity) AS x, avg(l_discount) AS y FROM flow WHERE label = 'Attack' GROUP BY 1),
s AS (SELECT var_pop(x) AS xx, var_pop(y) AS yy, covar_pop(x, y) AS xy FROM v),
pairs AS (SELECT q.id AS q_id, v.id AS n_id, sqrt(((q.x - v.x) ** 2 * yy - 2 * (q.x - v.x) * (q.y - v.y) * xy + (q.y - v.y) ** 2 * xx) / (xx * yy - xy * xy)) AS dist FROM q, v, s)
SELECT q_id, round(list_sum(min(dist, 3)), 4) AS total_dist FROM pairs GROUP BY 1""")
def knn_join_mahalanobis(spark, sf_dir):
    def means(label):
        grouped = flows(spark, sf_dir).filter(F.col("label") == label).groupBy("l_orderkey").agg(F.avg("l_quantity").alias("x"), F.avg("l_discount").alias("y"))
        return grouped.select(F.col("l_orderkey").alias("id"), F.array("x", "y").alias("vector"))

    asking = means("Attack").withColumnRenamed("id", "q_id")
    near = neighbors.knn_join(asking, means("Benign"), 3, "q_id", "id", metric="mahalanobis")
    return rounded(near.groupBy("q_id").agg(F.sum("dist").alias("total_dist")), 4)


@query("knn_approx")
def knn_approx(spark, sf_dir):
    v = vectors(spark, sf_dir)
    exact = neighbors.knn_join(v, v, 5, "vec_id", "vec_id", "embedding", exclude_self=True)
    approx = neighbors.knn_approx(v, v, 5, "vec_id", "vec_id", "embedding", probes=4, exclude_self=True)
    return rounded(neighbors.recall(approx, exact, "vec_id"))


_TRAIN, _ASK = "label <> 3", "label = 3"


@query("knn_distance_detector", f"""WITH {near_sql(5, 'euclidean', _TRAIN, _TRAIN)}, tr AS (SELECT quantile_cont(d, 0.95) AS cut FROM (SELECT avg(dist) AS d FROM near GROUP BY vec_id)),
qp AS (SELECT a.vec_id, {_SQL_DISTANCE['euclidean']} AS dist, b.vec_id AS n_id FROM v a, v b WHERE a.{_ASK} AND b.{_TRAIN}),
qn AS (SELECT vec_id, avg(dist) AS d FROM (SELECT * FROM qp QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, n_id) <= 5) GROUP BY 1)
SELECT vec_id, round(d, 5) AS mean_dist, round(d / (cut + 1e-10), 5) AS score, CASE WHEN d > cut THEN -1 ELSE 1 END AS y_pred FROM qn, tr""")
def knn_distance_detector(spark, sf_dir):
    v = vectors(spark, sf_dir)
    model = neighbors.knn_distance_fit(v.filter(_TRAIN), "vec_id", "embedding")
    return rounded(neighbors.knn_distance_predict(v.filter(_ASK), model, "vec_id"), 5)


_LOF = f"""{near_sql(20, 'euclidean', _TRAIN, _TRAIN)}, kd AS (SELECT vec_id, max(dist) AS k_dist FROM near GROUP BY 1),
lrd AS (SELECT near.vec_id, 1 / (avg(greatest(dist, k_dist)) + 1e-10) AS lrd FROM near JOIN kd ON near.n_id = kd.vec_id GROUP BY 1)"""


@query("lof_fit", f"""WITH {_LOF}, f AS (SELECT near.vec_id, avg(l.lrd) AS m FROM near JOIN lrd l ON near.n_id = l.vec_id GROUP BY 1)
SELECT vec_id, round(k_dist, 5) AS k_dist, round(lrd, 5) AS lrd, round(m / lrd, 5) AS score FROM kd JOIN lrd USING (vec_id) JOIN f USING (vec_id)""")
def lof_fit(spark, sf_dir):
    model = neighbors.lof_fit(vectors(spark, sf_dir).filter(_TRAIN), "vec_id", "embedding")
    return rounded(model.density.withColumnRenamed("row_id", "vec_id").join(model.scores, "vec_id"), 5)


@query("lof_score", f"""WITH {_LOF},
qp AS (SELECT a.vec_id, {_SQL_DISTANCE['euclidean']} AS dist, b.vec_id AS n_id FROM v a, v b WHERE a.{_ASK} AND b.{_TRAIN}),
qn AS (SELECT * FROM qp QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, n_id) <= 20),
own AS (SELECT qn.vec_id, 1 / (avg(greatest(dist, k_dist)) + 1e-10) AS o, avg(lrd.lrd) AS m FROM qn JOIN kd ON qn.n_id = kd.vec_id JOIN lrd ON qn.n_id = lrd.vec_id GROUP BY 1)
SELECT vec_id, round(m / o, 5) AS score, CASE WHEN m / o > 1.5 THEN -1 ELSE 1 END AS y_pred FROM own""")
def lof_score(spark, sf_dir):
    v = vectors(spark, sf_dir)
    model = neighbors.lof_fit(v.filter(_TRAIN), "vec_id", "embedding")
    return rounded(neighbors.lof_predict(v.filter(_ASK), model, "vec_id"), 5)


@query("ocsvm_fit")
def ocsvm_fit(spark, sf_dir):
    train, _ = prepared(spark, sf_dir)
    model = ocsvm.ocsvm_fit(train, FLOW_FEATURES, nu=0.1)
    out = ocsvm.ocsvm_predict(train, model)
    return rounded(out.agg(F.avg((F.col("y_pred") == -1).cast("double")).alias("outlier_share"), F.count("*").alias("n")), 4)


@query("ocsvm_score", f"""WITH {FLOW} SELECT row_id, round(0.02::DOUBLE * l_quantity - 3.0::DOUBLE * l_discount - 0.25::DOUBLE, 6) + 0.0 AS score,
  round(1 / (1 + exp(0.02::DOUBLE * l_quantity - 3.0::DOUBLE * l_discount - 0.25::DOUBLE)), 6) AS score_01 FROM flow""")
def ocsvm_score(spark, sf_dir):
    from floodmark.functions.scores import sigmoid_score

    model = ocsvm.OneClassModel(TWO, "linear", 1.0, 0.1, [], [], [0.02, -3.0], 0.25)
    scored = ocsvm.ocsvm_score(flows(spark, sf_dir), model)
    return rounded(scored.select("row_id", "score", sigmoid_score("score").alias("score_01")))


@query("ocsvm_predict")
def ocsvm_predict(spark, sf_dir):
    train, test = prepared(spark, sf_dir)
    model = ocsvm.ocsvm_fit(train, FLOW_FEATURES, nu=0.05)
    return rounded(evaluation.binary_metrics(ocsvm.ocsvm_predict(test, model)))


@query("autoencoder_fit")
def autoencoder_fit(spark, sf_dir):
    train, test = prepared(spark, sf_dir)
    model, history = autoencoder.autoencoder_fit(train, FLOW_FEATURES, "row_id", autoencoder.layer_sizes(len(FLOW_FEATURES), "v2"))
    model = autoencoder.autoencoder_threshold(train, model)
    metrics = evaluation.binary_metrics(autoencoder.autoencoder_predict(test, model))
    return rounded(metrics.withColumn("first_loss", F.lit(history[0][1])).withColumn("best_loss", F.lit(min(h[1] for h in history))))


@query("autoencoder_score", f"""WITH {FLOW}, h AS (SELECT row_id, l_quantity AS x, l_discount AS y, greatest(0.5 * l_quantity - 2.0 * l_discount - 1.0, 0) AS h FROM flow)
SELECT row_id, round(((1.5 * h + 2.0 - x) ** 2 + (-0.25 * h + 0.5 - y) ** 2) / 2, 6) AS mse FROM h""")
def autoencoder_score(spark, sf_dir):
    model = autoencoder.AutoencoderModel(TWO, [2, 1, 2], [0.5, -2.0, -1.0, 1.5, -0.25, 2.0, 0.5])
    return rounded(autoencoder.autoencoder_score(flows(spark, sf_dir), model).select("row_id", "mse"))


@query("deep_score", f"""WITH {FLOW}, h AS (SELECT row_id, l_quantity AS x, l_discount AS y, greatest(0.5 * l_quantity - 2.0 * l_discount - 1.0, 0) AS h FROM flow),
p AS (SELECT avg(h) AS m, var_pop(h) AS v FROM h), u AS (SELECT *, 1.25 * (h - m) / sqrt(v + 1e-3) - 0.5 AS u FROM h, p)
SELECT row_id, round(((1.5 * u + 2.0 - x) ** 2 + (-0.25 * u + 0.5 - y) ** 2) / 2, 6) AS mse FROM u""")
def deep_score(spark, sf_dir):
    """Given weights, moments of the normalised layer over all rows."""
    df, sizes = flows(spark, sf_dir), [2, 1, 2]
    flat = [0.5, -2.0, -1.0, 1.5, -0.25, 2.0, 0.5, 1.25, -0.5]
    ((mean, variance),) = deep.layer_moments(df, TWO, np.array(flat), sizes, [0])
    model = deep.DeepModel(TWO, sizes, flat, [0], [mean.tolist()], [variance.tolist()], None, False)
    return rounded(deep.deep_score(df, model).select("row_id", "mse"))


@query("percentile_threshold", f"""WITH {JUDGED} SELECT round(quantile_cont(score_b, 0.95), 6) AS high, round(quantile_cont(score_b, 0.05), 6) AS low,
  (SELECT count(*) FROM judged WHERE score_b > (SELECT quantile_cont(score_b, 0.95) FROM judged WHERE y = 1)) AS n_flagged FROM judged WHERE y = 1""")
def percentile_threshold(spark, sf_dir):
    df = judged_flows(spark, sf_dir)
    train = df.filter("y = 1")
    high = thresholds.percentile_threshold(train, 95.0, "score_b")
    low = thresholds.percentile_threshold(train, 95.0, "score_b", side="low")
    flagged = thresholds.apply_threshold(df, high, "score_b").agg(F.count_if(F.col("y_pred") == -1).alias("n_flagged"))
    return rounded(flagged.withColumn("high", F.lit(high)).withColumn("low", F.lit(low)))


RATED = REQ + """,
rated AS (SELECT *, count(*) OVER (PARTITION BY src ORDER BY ts_us RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) * 10.0 AS rate,
  CASE src % 4 WHEN 0 THEN 'CN' WHEN 1 THEN 'US' WHEN 2 THEN 'RU' END AS country, CASE WHEN status >= 500 THEN 0.2 ELSE 0.0 END AS share_5xx FROM req)"""


def rated_requests(spark, sf_dir):
    rated = trailing_rate(requests(spark, sf_dir), seconds=86400)
    return rated.select(
        "*",
        *[c for c in path_features("path", "query") if "entropy" in str(c)],
        F.when(F.col("src") % 4 == 0, "CN").when(F.col("src") % 4 == 1, "US").when(F.col("src") % 4 == 2, "RU").alias("country"),
        F.when(F.col("status") >= 500, 0.2).otherwise(0.0).alias("share_5xx"),
    ).withColumn("rate", F.col("recent_requests") * 10.0)


def _reasons(named: dict[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in named.items())
    return f"array_to_string(list_filter([{cases}], lambda r: r IS NOT NULL), ',') AS reasons"


def _rule_sql(named: dict[str, str]) -> str:
    return f"WITH {RATED}, r AS (SELECT row_id, {_reasons(named)} FROM rated) SELECT row_id, reasons, CASE WHEN reasons <> '' THEN -1 ELSE 1 END AS y_pred FROM r"


def _ruled(spark, sf_dir, named):
    out = rules.rule_baseline(rated_requests(spark, sf_dir), named)
    return out.select("row_id", F.array_join("reasons", ",").alias("reasons"), "y_pred")


@query("rules_basic", _rule_sql({"rate_over_50": "rate > 50", "status_5xx": "status // 100 = 5"}))
def rules_basic(spark, sf_dir):
    return _ruled(spark, sf_dir, rules.rules_basic())


@query("rules_traffic", _rule_sql({"rate_over_100": "rate > 100", "share_5xx_over_10pct": "share_5xx > 0.1", "watched_country": "country IN ('CN', 'RU', 'KP')",
                                   "bot_agent": "contains(lower(user_agent), 'bot')"}))
def rules_traffic(spark, sf_dir):
    return _ruled(spark, sf_dir, rules.rules_traffic())


# the entropy of a path in bits, from the counts of its characters
_PATH_ENTROPY = """(SELECT -sum(n * 1.0 / length(path) * log2(n * 1.0 / length(path)))
  FROM (SELECT count(*) AS n FROM (SELECT unnest(string_split(path, '')) AS c) GROUP BY c))"""


@query("rules_patterns", _rule_sql({"flood_rate": "rate * 20 >= 1000", "large_payload": "payload * 10000 > 1048576", "random_path": f"{_PATH_ENTROPY} > 4.0",
                                    "scripted_agent": "user_agent IS NULL OR regexp_matches(lower(user_agent), 'curl|wget|python|scrapy|httpclient|bot')"}))
def rules_patterns(spark, sf_dir):
    df = rated_requests(spark, sf_dir).withColumn("rate", F.col("rate") * 20).withColumn("payload", F.col("payload") * 10000)
    out = rules.rule_baseline(df, rules.rules_patterns())
    return out.select("row_id", F.array_join("reasons", ",").alias("reasons"), "y_pred")


@query("proxy_labels", f"""WITH {RATED} SELECT row_id, CAST(status >= 400 OR substr(md5('bad:' || src), 1, 8) < '0ccccccc' OR rate > 100
  OR coalesce(contains(lower(user_agent), 'bot'), false) AS INTEGER) AS proxy_label FROM rated""")
def proxy_labels(spark, sf_dir):
    df = rated_requests(spark, sf_dir)
    bad = df.select("src").distinct().filter(below_fraction(order_hash("bad", "src"), 0.05))
    return rules.proxy_labels(enrich.blacklist_flag(df, bad, "src")).select("row_id", "proxy_label")


@query("grid_search")
def grid_search(spark, sf_dir):
    """Chosen on a validation half of the labelled rows; the other half is never looked at while choosing."""
    train, held = prepared(spark, sf_dir)
    validation = held.filter(below_fraction(order_hash("validation", "row_id"), 0.5))

    def fit(df, percentile, k):
        model = gmm.gmm_threshold(df, gmm.gmm_fit(df, FLOW_FEATURES, k=k), percentile)
        return model, evaluation.binary_metrics(gmm.gmm_predict(validation, model)).first()["f1"]

    _, report = grid.grid_search(train, fit, {"percentile": [2.0, 5.0, 10.0], "k": [1, 2, 3]}, smallest=False)
    return rounded(report)
