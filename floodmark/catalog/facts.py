"""Facts about fitted models that SQL can state from the tables alone.

A fit has no SQL, but what must hold for it has: sizes of trees, shares outside a boundary, sums of variances, vanishing
gradients. Each query fits on whole tables and returns such facts next to counts.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from floodmark.catalog.registry import query, rounded
from floodmark.catalog.standins import FLOW, FLOW_FEATURES, JUDGED, flows, judged_flows, vectors
from floodmark.operators import cleaning, ensemble, evaluation, selection
from floodmark.operators.detect import autoencoder, deep, gmm, grid, iforest, neighbors, ocsvm
from floodmark.plans.ordering import below_fraction, order_hash
from floodmark.plans.staging import stage

BENIGN = f"""WITH {FLOW}, b AS (SELECT * FROM flow WHERE label = 'Benign')"""


def benign(spark, sf_dir):
    """Scaled benign flows, staged: the fits read them many times."""
    train = flows(spark, sf_dir).filter("label = 'Benign'")
    scaled = cleaning.standard_scaler_transform(train, cleaning.standard_scaler_fit(train, FLOW_FEATURES))
    return stage(scaled.select("row_id", *FLOW_FEATURES), "benign")


@query("iforest_fit_facts", f"""{BENIGN} SELECT CAST(range AS INTEGER) AS tree_id, (SELECT least(256, count(*)) FROM b) AS psi,
  1::BIGINT AS leaves_over_splits, true AS depth_holds, true AS children_hold FROM range(100)""")
def iforest_fit_facts(spark, sf_dir):
    train = benign(spark, sf_dir)
    model = iforest.iforest_fit(train, FLOW_FEATURES, "row_id")
    nodes = iforest.node_table(train, model)
    leaf = F.col("feature") < 0
    inside = leaf | ((F.col("left") > F.col("node_id")) & (F.col("right") > F.col("node_id")) & (F.col("left") != F.col("right")))
    deepest = int(np.ceil(np.log2(max(model.psi, 2)))) + iforest.average_path(model.psi)
    return nodes.groupBy("tree_id").agg(
        F.lit(model.psi).cast("long").alias("psi"),
        (F.count_if(leaf) - F.count_if(~leaf)).alias("leaves_over_splits"),
        (F.max("path") <= deepest).alias("depth_holds"),
        F.bool_and(inside).alias("children_hold"),
    )


@query("iforest_predict_facts", f"""{BENIGN} SELECT count(*) AS n, true AS share_holds, true AS scores_hold FROM b""")
def iforest_predict_facts(spark, sf_dir):
    """With a contamination of 5 % no more than that share of the train rows lies above the cut-off."""
    train = benign(spark, sf_dir)
    model = iforest.iforest_threshold(train, iforest.iforest_fit(train, FLOW_FEATURES, "row_id"), contamination=0.05)
    flagged = F.count_if(F.col("y_pred") == -1)
    return iforest.iforest_predict(train, model).agg(
        F.count("*").alias("n"),
        ((flagged <= 0.05 * F.count("*") + 1) & (F.count_if(F.col("score") >= model.threshold - 1e-12) >= 0.05 * F.count("*") - 1)).alias("share_holds"),
        F.bool_and(F.col("score").between(0.0, 1.0)).alias("scores_hold"),
    )


@query("gmm_fit_components_facts", f"""{BENIGN} SELECT count(*) AS n, 3 AS components, 1.0::DOUBLE AS total_weight, true AS likelihood_rises, true AS components_differ FROM b""")
def gmm_fit_components_facts(spark, sf_dir):
    train = benign(spark, sf_dir)
    short, long = (gmm.em_fit(train.select(*FLOW_FEATURES), FLOW_FEATURES, 3, max_iter=i, tol=0.0) for i in (1, 8))
    apart = min(float(np.linalg.norm(np.subtract(a, b))) for i, a in enumerate(long[0].means) for b in long[0].means[:i])
    row = (long[2], len(long[0].weights), float(sum(long[0].weights)), bool(long[1] >= short[1] - 1e-6 * abs(short[1])), apart > 0.1)
    return rounded(spark.createDataFrame([row], "n long, components int, total_weight double, likelihood_rises boolean, components_differ boolean"))


_SHAPES = {"full": "k * 10", "tied": "10", "diag": "k * 4", "spherical": "k"}
_SHAPES_SQL = " UNION ALL ".join(f"SELECT '{kind}' AS covariance, k, {size} + k * 4 + k - 1 AS n_parameters FROM k" for kind, size in _SHAPES.items())


@query("gmm_select_facts", f"""{BENIGN}, k AS (SELECT CAST(unnest(range(1, 10)) AS INTEGER) AS k), p AS ({_SHAPES_SQL})
SELECT covariance, k, CAST(n_parameters AS INTEGER) AS n_parameters, (SELECT count(*) FROM b) AS n, true AS criteria_hold, true AS likelihood_holds FROM p""")
def gmm_select_facts(spark, sf_dir):
    """Every k from 1 to 9 and every shape, until convergence; both criteria follow from the likelihood and the number of free
    parameters, and the chosen model's likelihood from scoring all rows with it."""
    train = benign(spark, sf_dir)
    best, report = gmm.gmm_select(train, FLOW_FEATURES)
    scored = gmm.gmm_score(train, best).agg(F.count("*").alias("n"), F.sum("score").alias("total")).first()
    n = scored["n"]
    penalty = F.col("n_parameters") * F.log(F.lit(float(n))) - 2 * F.col("log_likelihood")
    holds = (F.abs(F.col("bic") - penalty) < 1e-6 * F.abs(penalty)) & (F.abs(F.col("aic") - (2 * F.col("n_parameters") - 2 * F.col("log_likelihood"))) < 1e-3)
    chosen = report.orderBy("bic").first()["log_likelihood"]
    return report.select(
        "covariance", "k", "n_parameters", F.lit(n).cast("long").alias("n"), holds.alias("criteria_hold"),
        F.lit(bool(abs(scored["total"] - chosen) <= 2e-3 * n)).alias("likelihood_holds"),
    )


@query("knn_approx_recall", "SELECT count(*) AS n, true AS recall_holds FROM embeddings")
def knn_approx_recall(spark, sf_dir):
    v = vectors(spark, sf_dir)
    exact = neighbors.knn_join(v, v, 5, "vec_id", "vec_id", "embedding", exclude_self=True)
    rows = max(1, v.count() // 100)  # a hundred cells, many more than the default probes
    approx = neighbors.knn_approx(v, v, 5, "vec_id", "vec_id", "embedding", exclude_self=True, block_rows=rows)
    share = neighbors.recall(approx, exact, "vec_id").first()[0]
    return v.agg(F.count("*").alias("n"), F.lit(bool(share >= 0.9)).alias("recall_holds"))


@query("knn_tree_recall", "SELECT count(*) AS n, true AS recall_holds, true AS ranks_hold FROM embeddings")
def knn_tree_recall(spark, sf_dir):
    """Neighbours of every vector through pivot trees whose leaves are far smaller than the table, against the exact ones."""
    v = vectors(spark, sf_dir)
    exact = neighbors.knn_join(v, v, 5, "vec_id", "vec_id", "embedding", exclude_self=True)
    index = neighbors.tree_index(v, "vec_id", "embedding", k=5, trees=1, leaf_rows=64)
    found = stage(neighbors.tree_join(v, index, 5, "vec_id", "embedding", exclude_self=True), "tree-join")
    share = neighbors.recall(found, exact, "vec_id").first()["recall"]
    ranks = found.groupBy("vec_id").agg(F.sort_array(F.collect_list("rank")).alias("r")).agg(F.bool_and(F.col("r") == F.array(*map(F.lit, range(1, 6))))).first()[0]
    return v.agg(F.count("*").alias("n"), F.lit(bool(share >= 0.9)).alias("recall_holds"), F.lit(bool(ranks)).alias("ranks_hold"))


@query("ocsvm_fit_facts", f"""{BENIGN} SELECT kernel, count(*) AS n, true AS share_holds FROM b, (SELECT unnest(['rbf', 'linear', 'poly']) AS kernel) GROUP BY 1""")
def ocsvm_fit_facts(spark, sf_dir):
    """The offset is the nu-quantile of the train scores: the share outside is nu, but for one row."""
    train = benign(spark, sf_dir)
    out = []
    for kernel in ("rbf", "linear", "poly"):
        scored = ocsvm.ocsvm_predict(train, ocsvm.ocsvm_fit(train, FLOW_FEATURES, nu=0.1, kernel=kernel))
        outside = F.count_if(F.col("score") < -1e-9)
        within = (outside <= 0.1 * F.count("*") + 1) & (F.count_if(F.col("score") <= 1e-9) >= 0.1 * F.count("*") - 1)
        out.append(scored.agg(F.lit(kernel).alias("kernel"), F.count("*").alias("n"), within.alias("share_holds")))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("autoencoder_fit_facts", f"""{BENIGN} SELECT count(*) AS n, 4 * 8 + 8 + 8 * 4 + 4 + 4 * 8 + 8 + 8 * 4 + 4 AS n_weights, true AS loss_falls, true AS share_holds FROM b""")
def autoencoder_fit_facts(spark, sf_dir):
    train = benign(spark, sf_dir)
    model, history = autoencoder.autoencoder_fit(train, FLOW_FEATURES, "row_id", autoencoder.layer_sizes(4, "v1"))
    model = autoencoder.autoencoder_threshold(train, model)
    flagged = F.count_if(F.col("y_pred") == -1)
    return autoencoder.autoencoder_predict(train, model).agg(
        F.count("*").alias("n"),
        F.lit(len(model.weights)).alias("n_weights"),
        F.lit(bool(min(h[1] for h in history) < history[0][1])).alias("loss_falls"),
        ((flagged <= 0.05 * F.count("*") + 1) & (F.count_if(F.col("mse") >= model.threshold - 1e-12) >= 0.05 * F.count("*") - 1)).alias("share_holds"),
    )


@query("deep_fit_facts", f"""{BENIGN} SELECT count(*) AS n, 4 * 30 + 30 + 30 * 20 + 20 + 20 * 10 + 10 + 10 * 20 + 20 + 20 * 30 + 30 + 30 * 4 + 4 + 60 AS n_weights,
  true AS means_hold, true AS variances_hold, true AS loss_falls, true AS share_holds FROM b""")
def deep_fit_facts(spark, sf_dir):
    """The deep network at its defaults: the moments it keeps are those of its first layer over the train rows, worked out again as expressions."""
    train = flows(spark, sf_dir).filter("label = 'Benign'")
    ends = train.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in FLOW_FEATURES for f in (F.min, F.max)]).first()
    unit = {c: (F.col(c) - ends[f"min_{c}"]) / (ends[f"max_{c}"] - ends[f"min_{c}"]) for c in FLOW_FEATURES}
    train = stage(train.select("row_id", *[unit[c].alias(c) for c in FLOW_FEATURES]), "unit-flows")
    model, history = deep.deep_fit(train, FLOW_FEATURES, "row_id")
    width, flat = model.sizes[1], np.asarray(model.weights)
    w, b = flat[: 4 * width].reshape(4, width), flat[4 * width : 5 * width]
    layer = [F.greatest(F.lit(0.0), sum((F.col(c) * F.lit(float(w[i, j])) for i, c in enumerate(FLOW_FEATURES)), F.lit(float(b[j])))) for j in range(width)]
    trained = train.filter(~below_fraction(order_hash("42-validation", "row_id"), 0.2))
    moments = trained.agg(*[F.avg(h).alias(f"m{j}") for j, h in enumerate(layer)], *[F.var_pop(h).alias(f"v{j}") for j, h in enumerate(layer)]).first()
    means = all(abs(moments[f"m{j}"] - model.means[0][j]) < 1e-9 for j in range(width))
    variances = all(abs(moments[f"v{j}"] - model.variances[0][j]) < 1e-9 for j in range(width))
    model = deep.deep_threshold(train, model)
    flagged = F.count_if(F.col("y_pred") == -1)
    return deep.deep_predict(train, model).agg(
        F.count("*").alias("n"),
        F.lit(len(flat)).alias("n_weights"),
        F.lit(means).alias("means_hold"),
        F.lit(variances).alias("variances_hold"),
        F.lit(bool(min(h[1] for h in history) < history[0][1])).alias("loss_falls"),
        ((flagged <= 0.05 * F.count("*") + 1) & (F.count_if(F.col("score") >= 1 - 1e-12) >= 0.05 * F.count("*") - 1)).alias("share_holds"),
    )


@query("stacking_facts", f"""WITH {JUDGED} SELECT 'plain' AS kind, count(*) AS n, count(*) FILTER (y = -1) AS n_attacks, true AS gradient_vanishes FROM judged
UNION ALL SELECT 'weighted', count(*), count(*) FILTER (y = -1), true FROM judged""")
def stacking_facts(spark, sf_dir):
    """At the optimum the weighted residuals are orthogonal to the scores and to the constant."""
    df = stage(judged_flows(spark, sf_dir).withColumn("weight", ensemble.cost_weights()), "judged")
    out = []
    for kind, weight in (("plain", None), ("weighted", "weight")):
        fitted = ensemble.stacking_predict(df, ensemble.stacking_fit(df, ["score_a", "score_b"], weight=weight))
        w = F.col(weight) if weight else F.lit(1.0)
        gap = w * (F.col("stack_score") - (F.col("y") == -1).cast("double"))
        terms = [F.abs(F.sum(gap * x) / F.sum(w)) < 1e-3 for x in (F.lit(1.0), F.col("score_a"), F.col("score_b"))]
        out.append(
            fitted.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"), F.count_if(F.col("y") == -1).alias("n_attacks"), (terms[0] & terms[1] & terms[2]).alias("gradient_vanishes"))
        )
    return out[0].unionByName(out[1])


_CORR = ", ".join(f"corr({a}, {b}) AS c{i}_{j}" for i, a in enumerate(FLOW_FEATURES) for j, b in enumerate(FLOW_FEATURES) if i < j)
_SQUARES = " + ".join(f"2 * c{i}_{j} ** 2" for i in range(len(FLOW_FEATURES)) for j in range(len(FLOW_FEATURES)) if i < j)


@query("pca_spectrum", f"""WITH {FLOW}, c AS (SELECT count(*) AS n, {_CORR} FROM flow)
SELECT n, {len(FLOW_FEATURES)}.0::DOUBLE AS total_variance, round({len(FLOW_FEATURES)} + {_SQUARES}, 6) AS squared_variances, 0.0::DOUBLE AS largest_covariance FROM c""")
def pca_spectrum(spark, sf_dir):
    """All components of the scaled features: their variances add up to the number of features, the squares to those of
    the correlations, and they are uncorrelated."""
    df = flows(spark, sf_dir)
    scaled = cleaning.standard_scaler_transform(df, cleaning.standard_scaler_fit(df, FLOW_FEATURES))
    d = len(FLOW_FEATURES)
    parts = selection.pca_reduce(scaled, selection.pca_fit(scaled, FLOW_FEATURES, d)).select(*[vector_to_array("pca")[i].alias(f"p{i}") for i in range(d)])
    variances = [F.var_pop(f"p{i}") for i in range(d)]
    mixed = [F.abs(F.covar_pop(f"p{i}", f"p{j}")) for i in range(d) for j in range(i)]
    return rounded(parts.agg(
        F.count("*").alias("n"),
        sum(variances[1:], variances[0]).alias("total_variance"),
        sum([v * v for v in variances[1:]], variances[0] * variances[0]).alias("squared_variances"),
        F.greatest(*mixed).alias("largest_covariance"),
    ))


@query("grid_search_facts", """SELECT unnest(['{"k": 1, "percentile": 2.0}', '{"k": 1, "percentile": 5.0}', '{"k": 1, "percentile": 10.0}']) AS params, true AS best_holds""")
def grid_search_facts(spark, sf_dir):
    """All combinations are tried, judged on validation rows, and the best of them is returned."""
    df = flows(spark, sf_dir)
    train = df.filter("label = 'Benign'")
    validation = df.filter(below_fraction(order_hash("validation", "row_id"), 0.5)).withColumn("y", F.when(F.col("label") == "Benign", 1).otherwise(-1))

    def fit(rows, percentile, k):
        model = gmm.gmm_threshold(rows, gmm.gmm_fit(rows, FLOW_FEATURES, k=k), percentile)
        return model, evaluation.binary_metrics(gmm.gmm_predict(validation, model)).first()["f1"]

    best, report = grid.grid_search(train, fit, {"percentile": [2.0, 5.0, 10.0], "k": [1]}, smallest=False)
    quality = evaluation.binary_metrics(gmm.gmm_predict(validation, best)).first()["f1"]
    return report.select("params", (F.col("quality") <= F.lit(quality)).alias("best_holds"))
