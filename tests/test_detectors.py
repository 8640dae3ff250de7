import numpy as np
import pytest
from pyspark.sql import functions as F

from floodmark.operators.detect import autoencoder, gmm, grid, iforest, neighbors, ocsvm, rules, thresholds
from floodmark.sources import models


def frame(spark, x, names=None):
    names = names or [f"x{i}" for i in range(x.shape[1])]
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "row_id long, " + ", ".join(f"{n} double" for n in names)).repartition(4), names


def vector_frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "row_id long, vector array<double>").repartition(4)


@pytest.fixture(scope="module")
def blob(spark):
    x = np.random.default_rng(0).multivariate_normal([1, -2, 0], [[2, 0.5, 0], [0.5, 1, 0.1], [0, 0.1, 0.5]], 2000)
    return x, *frame(spark, x)


def log_density(x, mean, cov):
    d = x - mean
    q = np.einsum("ni,ij,nj->n", d, np.linalg.inv(cov), d)
    return -0.5 * (q + np.linalg.slogdet(cov)[1] + x.shape[1] * np.log(2 * np.pi))


def test_single_gaussian(spark, blob):
    x, df, names = blob
    model = gmm.gmm_threshold(df, gmm.gmm_fit(df, names), 5.0)
    want = log_density(x, x.mean(axis=0), np.cov(x.T, ddof=0) + 1e-6 * np.eye(3))
    got = np.array([r.score for r in gmm.gmm_score(df, model).orderBy("row_id").collect()])
    assert np.allclose(got, want)
    assert np.isclose(model.threshold, np.percentile(want, 5))
    assert gmm.gmm_predict(df, model).filter("y_pred = -1").count() == 100


def test_wide_model_scores_like_the_expression(spark, blob, monkeypatch):
    _, df, names = blob
    model = gmm.gmm_fit(df, names, k=2, max_iter=5)
    a = [r.score for r in gmm.gmm_score(df, model).orderBy("row_id").collect()]
    monkeypatch.setattr(gmm, "EXPRESSION_TERMS", 0)
    b = [r.score for r in gmm.gmm_score(df, model).orderBy("row_id").collect()]
    assert np.allclose(a, b)


def test_singular_covariance_is_ridged(spark):
    df, names = frame(spark, np.column_stack([np.arange(50), np.arange(50), np.ones(50)]))
    assert np.isfinite(gmm.gmm_score(df, gmm.gmm_fit(df, names)).agg(F.sum("score")).first()[0])


def test_selection_finds_two_clusters(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 1, (400, 2)), rng.normal(12, 1, (400, 2))])
    df, names = frame(spark, x)
    best, report = gmm.gmm_select(df, names, k_range=[1, 2], max_iter=20)
    assert len(best.weights) == 2 and report.count() == 8
    assert np.allclose(sorted(m[0] for m in best.means), [0, 12], atol=0.3)
    one = {r.covariance: r for r in report.filter("k = 1").collect()}
    ll = log_density(x, x.mean(axis=0), np.cov(x.T, ddof=0) + 1e-6 * np.eye(2)).sum()
    assert np.isclose(one["full"].bic, 5 * np.log(800) - 2 * ll) and one["spherical"].n_parameters == 3
    full = {r.k: r.log_likelihood for r in report.filter("covariance = 'full'").collect()}
    assert full[2] > full[1]


def test_forest_ranks_planted_outliers_first(spark):
    x = np.random.default_rng(1).normal(size=(3000, 3))
    x[:15] += 9
    df, names = frame(spark, x)
    model = iforest.iforest_fit(df, names, "row_id", n_trees=50, psi=64)
    assert len(model.nodes) == 50 and model.psi == 64
    top = iforest.iforest_score(df, model).orderBy(F.desc("score")).limit(15).collect()
    assert {r.row_id for r in top} == set(range(15))
    cut = iforest.iforest_threshold(df, model, contamination=0.05)
    assert iforest.iforest_predict(df, cut).filter("y_pred = -1").count() == 150
    assert iforest.iforest_threshold(df, model).threshold == 0.5


def test_forest_walks_level_by_level_as_node_by_node(spark):
    """all rows take the same steps in fixed arrays; leaves of every depth, missing and infinite values end where they did."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 2))
    x[::7, 0], x[::11, 1], x[::13, 0] = np.nan, np.inf, -np.inf
    uneven = [[0, 0.0, 1, 4, 0.0], [1, -0.5, 2, 3, 0.0], [-1, 0.0, 2, 2, 2.5], [-1, 0.0, 3, 3, 3.0], [0, 1.0, 6, 5, 0.0],
              [1, 0.1, 7, 8, 0.0], [-1, 0.0, 6, 6, 2.0], [-1, 0.0, 7, 7, 4.0], [-1, 0.0, 8, 8, 3.5]]
    trees = [uneven, [[-1, 0.0, 0, 0, 1.25]]]

    def path(tree, row):
        node = tree[0]
        while node[0] >= 0:
            node = tree[node[3] if row[node[0]] > node[1] else node[2]]
        return node[4]

    want = [sum(path(t, r) for t in trees) for r in x]
    assert iforest.path_sums(x, [iforest._walk(t) for t in trees]).tolist() == want
    df, names = frame(spark, x)
    got = iforest.iforest_score(df, iforest.ForestModel(names, 4, trees)).orderBy("row_id").collect()
    np.testing.assert_allclose([r.score for r in got], np.power(2.0, -np.array(want) / 2 / iforest.average_path(4)), rtol=1e-12)


def test_forest_samples_are_drawn_in_compiled_code(spark):
    """a lambda over the trees of a row is interpreted, a hundred hashes for every row of the table."""
    df, names = frame(spark, np.random.default_rng(1).normal(size=(300, 2)))
    rows = iforest.tree_samples(df, names, "row_id", 10, 20, 1)[1]
    assert "lambda" not in rows._jdf.queryExecution().executedPlan().toString().lower()
    assert {r["count"] for r in rows.groupBy("tree_id").count().collect()} == {20}


def test_forest_samples_small_and_large_tables(spark):
    df, names = frame(spark, np.random.default_rng(1).normal(size=(500, 2)))
    for trees, psi in ((4, 100), (20, 100)):
        size, rows = iforest.tree_samples(df, names, "row_id", trees, psi, 1)
        counts = rows.groupBy("tree_id").agg(F.count("*").alias("n"), F.count_distinct("row_id").alias("d")).collect()
        assert size == 100 and len(counts) == trees and all(r.n == r.d == 100 for r in counts)


def test_identical_rows_make_leaf_trees(spark):
    df, names = frame(spark, np.ones((40, 2)))
    assert all(len(t) == 1 for t in iforest.iforest_fit(df, names, "row_id", n_trees=3).nodes)


def brute(q, r, k, metric, own):
    if metric == "euclidean":
        d = np.sqrt(((q[:, None] - r[None]) ** 2).sum(axis=2))
    elif metric == "manhattan":
        d = np.abs(q[:, None] - r[None]).sum(axis=2)
    elif metric == "hamming":
        d = (q[:, None] != r[None]).mean(axis=2)
    elif metric == "cosine":
        d = 1 - (q @ r.T) / np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(r, axis=1))
    else:
        inv = np.linalg.inv(np.cov(r.T, ddof=0))
        z = q[:, None] - r[None]
        d = np.sqrt(np.einsum("nmi,ij,nmj->nm", z, inv, z))
    if own:
        np.fill_diagonal(d, np.inf)
    return np.sort(d, axis=1)[:, :k]


@pytest.mark.parametrize("metric", neighbors.METRICS)
@pytest.mark.parametrize("own", [True, False])
@pytest.mark.parametrize("small", [True, False])
def test_neighbours_equal_brute_force(spark, metric, own, small):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(0, 1, (300, 4)), rng.normal(8, 0.1, (200, 4)), np.repeat([[1.0, 2.0, 3.0, 4.0]], 250, axis=0)])
    x = np.round(x) if metric == "hamming" else x
    df = vector_frame(spark, x)
    near = neighbors.knn_join(df, df, 6, "row_id", "row_id", metric=metric, exclude_self=own, block_rows=60, query_rows=70, **({} if small else {"broadcast_values": 0}))
    got = np.full((len(x), 6), np.nan)
    seen = set()
    for r in near.collect():
        got[r.row_id, r["rank"] - 1] = r.dist
        seen.add((r.row_id, r.n_id))
    assert np.allclose(got, brute(x, x, 6, metric, own), atol=1e-6)
    assert len(seen) == 6 * len(x) and not (own and any(a == b for a, b in seen))


@pytest.mark.parametrize("limit", [0, 1000])
def test_fewer_references_than_k(spark, limit):
    df = vector_frame(spark, np.array([[0.0], [1.0], [5.0]]))
    near = neighbors.knn_join(df, df, 5, "row_id", "row_id", exclude_self=True, broadcast_values=limit)
    assert sorted((r.row_id, r.n_id, r.dist) for r in near.collect()) == [(0, 1, 1.0), (0, 2, 5.0), (1, 0, 1.0), (1, 2, 4.0), (2, 0, 5.0), (2, 1, 4.0)]


def test_approximate_neighbours(spark):
    rng = np.random.default_rng(8)
    df = vector_frame(spark, np.concatenate([rng.normal(c, 0.5, (300, 3)) for c in (0, 10, 20, 30)]))
    exact = neighbors.knn_join(df, df, 5, "row_id", "row_id", exclude_self=True)
    approx = neighbors.knn_approx(df, df, 5, "row_id", "row_id", probes=2, exclude_self=True)
    assert approx.count() == exact.count()
    assert neighbors.recall(approx, exact, "row_id").first().recall > 0.6


def test_approximate_neighbours_of_many_cells(spark):
    """The default reaches its recall with 100 cells in evenly filled dimensions, and few probes do where they are enough."""
    rng = np.random.default_rng(9)
    df = vector_frame(spark, rng.normal(0, 1, (2000, 8)))
    exact = neighbors.knn_join(df, df, 5, "row_id", "row_id", exclude_self=True)
    approx = neighbors.knn_approx(df, df, 5, "row_id", "row_id", exclude_self=True, block_rows=20)
    fixed = neighbors.knn_approx(df, df, 5, "row_id", "row_id", exclude_self=True, block_rows=20, least_recall=None)
    assert approx.count() == exact.count()
    assert neighbors.recall(fixed, exact, "row_id").first().recall < 0.9 <= neighbors.recall(approx, exact, "row_id").first().recall < 1


def lof_reference(train, query, k):
    d = np.sqrt(((train[:, None] - train[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, :k]
    kd = np.take_along_axis(d, near, 1)[:, -1]
    lrd = 1 / (np.maximum(np.take_along_axis(d, near, 1), kd[near]).mean(axis=1) + 1e-10)
    own = lrd[near].mean(axis=1) / lrd
    e = np.sqrt(((query[:, None] - train[None]) ** 2).sum(axis=2))
    nq = np.argsort(e, axis=1, kind="stable")[:, :k]
    lq = 1 / (np.maximum(np.take_along_axis(e, nq, 1), kd[nq]).mean(axis=1) + 1e-10)
    return own, lrd[nq].mean(axis=1) / lq


def test_lof_equals_numpy(spark):
    rng = np.random.default_rng(11)
    train, query = rng.normal(size=(300, 3)), np.concatenate([rng.normal(size=(40, 3)), [[9.0, 9.0, 9.0]]])
    model = neighbors.lof_fit(vector_frame(spark, train), "row_id", k=10, contamination=0.05)
    own, novel = lof_reference(train, query, 10)
    assert np.allclose([r.score for r in model.scores.orderBy("row_id").collect()], own)
    out = neighbors.lof_predict(vector_frame(spark, query), model, "row_id").orderBy("row_id").collect()
    assert np.allclose([r.score for r in out], novel)
    assert np.isclose(model.threshold, np.percentile(own, 95)) and out[-1].y_pred == -1


def test_lof_is_about_one_on_a_grid_and_survives_duplicates(spark, no_broadcast):
    grid_points = np.array([[i, j] for i in range(12) for j in range(12)], dtype=float)
    scores = neighbors.lof_fit(vector_frame(spark, grid_points), "row_id", k=8).scores
    assert 0.9 < scores.agg(F.expr("percentile(score, 0.5)")).first()[0] < 1.1
    same = neighbors.lof_fit(vector_frame(spark, np.ones((60, 2))), "row_id", k=5).scores
    assert np.allclose([r.score for r in same.collect()], 1.0)


def test_distance_detector(spark):
    rng = np.random.default_rng(12)
    train = vector_frame(spark, rng.normal(size=(400, 2)))
    model = neighbors.knn_distance_fit(train, "row_id")
    out = neighbors.knn_distance_predict(vector_frame(spark, np.array([[0.0, 0.0], [8.0, 8.0]])), model, "row_id").orderBy("row_id").collect()
    assert [r.y_pred for r in out] == [1, -1] and out[1].score > 1
    with_self = neighbors.knn_distance_fit(train, "row_id", include_self=True)
    assert with_self.threshold < model.threshold


@pytest.mark.parametrize("kernel", ocsvm.KERNELS)
def test_one_class_boundary(spark, blob, kernel):
    x, df, names = blob
    model = ocsvm.ocsvm_fit(df, names, nu=0.1, kernel=kernel, n_features=64, rounds=3)
    share = ocsvm.ocsvm_predict(df, model).agg(F.avg((F.col("y_pred") == -1).cast("double"))).first()[0]
    assert abs(share - 0.1) < 0.005
    if kernel == "rbf":
        assert np.isclose(model.gamma, 1 / (3 * x.var()), rtol=1e-6)
        far, _ = frame(spark, np.full((5, 3), 30.0))
        assert ocsvm.ocsvm_predict(far, model).filter("y_pred = -1").count() == 5


def test_online_step_counts_and_ignores_empty_batches(spark, blob):
    _, df, names = blob
    model = ocsvm.ocsvm_fit(df, names, n_features=16, rounds=1)
    assert ocsvm.ocsvm_update(df.limit(0), model) == model
    assert ocsvm.ocsvm_update(df, model).steps == model.steps + 1


def test_network_shapes():
    assert autoencoder.parameter_count(autoencoder.layer_sizes(11, "v1")) == 271
    assert autoencoder.layer_sizes(40, "v3") == [40, 128, 64, 20, 64, 128, 40]


def test_gradient_is_the_numerical_one():
    sizes = [3, 4, 2, 4, 3]
    flat = autoencoder.initial_weights(sizes, 1) + 0.01
    x = np.random.default_rng(0).normal(size=(6, 3))
    _, g = autoencoder.loss_gradient(x, flat, sizes)
    for i in range(0, len(flat), 5):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        slope = (autoencoder.loss_gradient(x, flat + step, sizes)[0] - autoencoder.loss_gradient(x, flat - step, sizes)[0]) / 2e-6
        assert np.isclose(g[i], slope, atol=1e-6)


def test_autoencoder_learns_and_flags(spark):
    rng = np.random.default_rng(3)
    t = rng.normal(size=(4000, 1))
    df, names = frame(spark, np.hstack([t, -t, 2 * t]) + rng.normal(0, 0.05, (4000, 3)))
    model, history = autoencoder.autoencoder_fit(df, names, "row_id", [3, 8, 2, 8, 3], epochs=15, learning_rate=5e-3, rows_per_partition=1000)
    assert min(h[1] for h in history) < 0.5 * history[0][1]
    model = autoencoder.autoencoder_threshold(df, model)
    assert autoencoder.autoencoder_predict(df, model).filter("y_pred = -1").count() == 200
    odd, _ = frame(spark, np.array([[4.0, 4.0, -4.0]]))
    assert autoencoder.autoencoder_predict(odd, model).first().score > 1


def test_models_survive_saving(spark, blob, tmp_path):
    _, df, names = blob
    kinds = [gmm.MixtureModel, iforest.ForestModel, ocsvm.OneClassModel, autoencoder.AutoencoderModel]
    fitted = [
        (gmm.gmm_threshold(df, gmm.gmm_fit(df, names)), gmm.gmm_predict),
        (iforest.iforest_fit(df, names, "row_id", n_trees=5, psi=32), iforest.iforest_predict),
        (ocsvm.ocsvm_fit(df, names, n_features=16, rounds=1), ocsvm.ocsvm_predict),
        (autoencoder.AutoencoderModel(names, [3, 2, 3], autoencoder.initial_weights([3, 2, 3]).tolist(), 0.5), autoencoder.autoencoder_predict),
    ]
    for i, (model, predict) in enumerate(fitted):
        models.save_model(spark, model, str(tmp_path / str(i)))
        again = models.load_model(spark, str(tmp_path / str(i)), kinds)
        a, b = ([tuple(r) for r in predict(df, m).orderBy("row_id").collect()] for m in (model, again))
        assert a == b


def test_rules_and_thresholds(spark):
    df = spark.createDataFrame([(10.0, 200, None), (60.0, 200, "Chrome"), (1.0, 503, "GoogleBot")], "rate double, status int, user_agent string")
    basic = rules.rule_baseline(df, rules.rules_basic()).collect()
    assert [r.y_pred for r in basic] == [1, -1, -1] and basic[2].reasons == ["status_5xx"]
    labelled = rules.proxy_labels(df.withColumn("blacklisted", F.lit(0))).collect()
    assert [r.proxy_label for r in labelled] == [0, 0, 1]
    scores = spark.range(101).select(F.col("id").cast("double").alias("score"))
    assert thresholds.percentile_threshold(scores, 95) == 95.0 and thresholds.percentile_threshold(scores, 95, side="low") == 5.0


def test_grid_keeps_the_best(spark):
    df = spark.range(10)
    best, table = grid.grid_search(df, lambda d, a, b: ((a, b), a * b + d.count()), {"a": [3, 1, 2], "b": [5, 4]})
    assert best == (1, 4) and table.count() == 6
    best, _ = grid.grid_search(df, lambda d, a: (a, a), {"a": [3, 1, 2]}, smallest=False)
    assert best == 3


def test_cells_are_met_in_bundles(spark, monkeypatch):
    """Evenly spread queries need every cell, and still travel once per bundle; the neighbours stay exact."""
    from floodmark.operators.detect import neighbors

    rng = np.random.default_rng(5)
    x = rng.normal(size=(1_200, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>")
    gaps = np.sqrt(np.square(x[:, None, :] - x).sum(axis=2))
    np.fill_diagonal(gaps, np.inf)
    want = np.argsort(gaps, axis=1)[:, :3]
    for values in (neighbors.BUNDLE_VALUES, 8 * 300):  # all cells in one bundle; several bundles
        monkeypatch.setattr(neighbors, "BUNDLE_VALUES", values)
        near = neighbors.knn_join(df, df, 3, "id", "id", exclude_self=True, broadcast_values=0, block_rows=500).collect()
        assert {(r["id"], r["rank"]): r["n_id"] for r in near} == {(i, j + 1): int(n) for i, row in enumerate(want) for j, n in enumerate(row)}
    counts = np.array([250, 200, 90, 700, 30, 10])
    index = neighbors.CellIndex(np.zeros((6, 8)), counts, np.zeros(6), np.zeros(6), np.array([1, 1, 1, 2, 1, 1]))
    assert neighbors._bundles(index).tolist() == [0, 1, 1, 2, 3, 3]


def test_neighbours_in_few_dimensions_meet_boxes(spark):
    """Beyond FEW_ROWS rows: the same neighbours as brute force, copies and rows without a place among them."""
    from floodmark.operators.detect import boxes

    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(0, 1, (9_000, 3)), np.repeat([[0.5, 0.5, 0.5]], 3_000, axis=0), np.round(rng.normal(5, 1, (3_000, 3)))])
    assert len(x) > boxes.FEW_ROWS
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(-1, [1.0, float("nan"), 0.0]), (-2, None), (-3, [1.0, None, 0.0])], "id long, vector array<double>")
    near = neighbors.knn_join(df, df, 4, "id", "id", exclude_self=True).toPandas()
    assert len(near) == 4 * len(x) and near["id"].min() == 0 and near["n_id"].min() == 0
    asked = list(range(0, len(x), 101))
    got = near[near["id"].isin(asked)].sort_values(["id", "rank"])
    for i, rows in got.groupby("id"):
        gaps = np.sqrt(np.square(x - x[i]).sum(axis=1))
        gaps[i] = np.inf
        assert rows["n_id"].tolist() == np.lexsort((np.arange(len(x)), np.round(gaps, 12)))[:4].tolist()
    twice = spark.createDataFrame([(1, [0.0, 0.0, 0.0])] * 2 + [(None, [5.0, 5.0, 5.0])], "id long, vector array<double>")
    counts = {r["id"]: r["count"] for r in neighbors.knn_join(twice, df, 4, "id", "id").groupBy("id").count().collect()}
    assert counts == {1: 8, None: 4}


def test_boxes_met_by_a_query_do_not_grow_with_the_table():
    from floodmark.operators.detect import boxes

    met = []
    for n in (8_000, 128_000):
        x = np.random.default_rng(3).normal(0, 1, (n, 3))
        found = boxes.draw(x[: n // 32], 3)
        box = found.place(x)
        for b in np.unique(box):
            found.low[b], found.high[b] = x[box == b].min(axis=0), x[box == b].max(axis=0)
        for node in range(len(found.axis) - 1, -1, -1):
            if found.axis[node] >= 0:
                two = [found.left[node], found.right[node]]
                found.low[node], found.high[node] = found.low[two].min(axis=0), found.high[two].max(axis=0)
        gaps = [np.sort(np.square(x - q).sum(axis=1))[5] ** 0.5 for q in x[:200]]
        row, node = found.within(x[:200], np.array(gaps), "euclidean")
        assert set(zip(range(200), box[:200])) <= set(zip(row, node))
        met.append(len(row) / 200 * n / len(np.unique(box)))
    assert met[1] < 1.5 * met[0] < 1.5 * 6 * 2048


def test_outlier_factors_in_few_dimensions_are_exact_at_any_size(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "BROADCAST_VALUES", 100)
    rng = np.random.default_rng(12)
    train = rng.normal(0, 1, (400, 4))
    model = neighbors.lof_fit(vector_frame(spark, train), "row_id", k=10)
    assert model.index is None
    own, _ = lof_reference(train, train[:2], 10)
    assert np.allclose([r["score"] for r in model.scores.orderBy("row_id").collect()], own, atol=1e-6)


@pytest.mark.parametrize("metric", ["manhattan", "hamming"])
def test_screens_in_small_numbers_lose_no_neighbour(metric):
    """The screen's pairs hold the neighbours, and far fewer pairs than all are measured."""
    rng = np.random.default_rng(13)
    x = rng.normal(size=(1_500, 24))
    x = np.sign(x) if metric == "hamming" else x
    x[:40] = x[40:80]
    gaps = np.abs(x[:200, None] - x).sum(axis=2) if metric == "manhattan" else (x[:200, None] != x).mean(axis=2)
    gaps[np.arange(200), np.arange(200)] = np.inf
    want = [np.lexsort((np.arange(1_500), np.round(g, 12)))[:5].tolist() for g in gaps]
    q, n, _, _ = neighbors.top_k(x[:200], x, np.arange(1_500), 5, metric, np.arange(200))
    assert [n[q == i].tolist() for i in range(200)] == want
    sides = neighbors._levels(x[:200], x) if metric == "manhattan" else neighbors._codes(x[:200], x)
    rows, cols = neighbors._screened(x[:200], x, 5, metric, np.arange(200)[:, None] == np.arange(1_500), None, sides)
    assert {(i, j) for i, row in enumerate(want) for j in row} <= set(zip(rows.tolist(), cols.tolist())) and len(rows) < 200 * 1_500 / 4
    reach = gaps.min(axis=1) + 1e-9
    q, n, _, _ = neighbors.top_k(x[:200], x, np.arange(1_500), 5, metric, np.arange(200), reach)
    assert all(set(n[q == i]) == set(np.flatnonzero(gaps[i] <= reach[i])[:5]) for i in range(200))
    assert neighbors._levels(np.array([[np.nan]]), x[:, :1]) is None and neighbors._codes(np.zeros((2, 300)), np.zeros((2, 300))) is None


def test_cells_that_fit_a_bundle_stay_whole(spark):
    df = spark.range(3_000).select(F.col("id").alias("r_id"), F.array(*[F.rand(i) for i in range(8)]).alias("v"))
    index, _ = neighbors._index(df, 3_000, "euclidean", 1, 20, probed=True)
    assert index.counts.sum() == 3_000 and index.counts.max() > 20 and index.slots.max() == 1 and neighbors._bundles(index).max() == 0
