"""Fits and cuts depend on rows, seed and parameters, not on partitions, cores or table size."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from floodmark.operators import evaluation, traffic
from floodmark.operators.detect import autoencoder, gmm, iforest, neighbors, ocsvm
from floodmark.plans.ordering import order_hash, take_in_hash_order


@pytest.fixture(scope="module")
def rows(spark):
    x = F.col("id")
    noise = [(F.pmod(F.xxhash64(F.lit(k), x), F.lit(1000)) / 1000.0) for k in range(3)]
    return spark.range(9000).select(
        "id", (noise[0] + F.when(x % 3 == 0, 3.0).otherwise(0.0)).alias("a"), (noise[1] + noise[0]).alias("b"), noise[2].alias("c")
    ).cache()


COLUMNS = ["a", "b", "c"]


def both(rows, fit):
    return fit(rows.repartition(2, "id")), fit(rows.repartition(7, "c"))


def test_boundary_and_autoencoder_do_not_depend_on_partitions(rows):
    one, two = both(rows, lambda df: ocsvm.ocsvm_fit(df, COLUMNS, n_features=32, rounds=2))
    assert np.allclose(one.w, two.w, atol=1e-9) and one.rho == pytest.approx(two.rho, abs=1e-9)
    one, two = both(rows, lambda df: autoencoder.autoencoder_fit(df, COLUMNS, "id", [3, 4, 3], epochs=2)[0])
    assert np.allclose(one.weights, two.weights, atol=1e-9)


def test_mixture_does_not_depend_on_partitions(rows):
    one, two = both(rows, lambda df: gmm.gmm_fit(df, COLUMNS, k=2, max_iter=20))
    assert np.allclose(one.means, two.means, atol=1e-6) and np.allclose(one.weights, two.weights, atol=1e-6)


def test_forest_samples_follow_one_rule(rows):
    for n_trees, psi in ((5, 16), (200, 64)):  # below and above n_trees * psi rows
        one, two = both(rows, lambda df: iforest.tree_samples(df, COLUMNS, "id", n_trees, psi, 7)[1])
        picked = [{(r["tree_id"], r["id"]) for r in x.select("tree_id", "id").collect()} for x in (one, two)]
        assert picked[0] == picked[1] and len(picked[0]) == n_trees * psi
    few = iforest.tree_samples(rows, COLUMNS, "id", 5, 16, 7)[1].select("tree_id", "id")
    many = iforest.tree_samples(rows, COLUMNS, "id", 200, 16, 7)[1].filter("tree_id < 5").select("tree_id", "id")
    assert {tuple(r) for r in few.collect()} == {tuple(r) for r in many.collect()}


def test_neighbour_ties_are_the_same_in_both_paths(spark):
    rows = [(i, [1.0 + (i % 3) * 1e-13, 0.0]) for i in range(40)] + [(100 + i, [50.0 + i, 9.0]) for i in range(40)]
    ref = spark.createDataFrame(rows, "id long, v array<double>")
    query = spark.createDataFrame([(1000, [0.0, 0.0]), (1001, [52.0, 9.0])], "id long, v array<double>")
    found = []
    for limit in (4_000_000, 0):
        out = neighbors.knn_join(query, ref, 5, broadcast_values=limit, q_id="id", r_id="id", vector="v")
        found.append(sorted((r["id"], r["rank"], r["n_id"]) for r in out.collect()))
    assert found[0] == found[1]
    assert [n for q, _, n in found[0] if q == 1000] == [0, 1, 2, 3, 4]


def test_repeated_ids_cannot_be_cut(spark):
    same = spark.range(20_001).select(F.lit(1).alias("id"))
    with pytest.raises(ValueError, match="share one id"):
        take_in_hash_order(same, order_hash(1, "id"), 5)
    assert take_in_hash_order(same, order_hash(1, "id"), 20_001).count() == 20_001


def test_uneven_windows(spark):
    events = [(1, t * 1_000_000, "/a", 200, 1.0) for t in range(0, 120, 3)]
    df = spark.createDataFrame(events, "src long, ts_us long, path string, status int, payload double")
    for size, slide in ((60, 25), (60, 20), (10, 25)):
        got = {(r["window_start_us"], r["request_count"]) for r in traffic.traffic_window(df, size, slide).collect()}
        starts = {s for e in events for s in range(-100, 200) if s * slide <= e[1] // 1_000_000 < s * slide + size}
        want = {(s * slide * 1_000_000, sum(s * slide <= e[1] // 1_000_000 < s * slide + size for e in events)) for s in starts}
        assert got == want


def test_latency_of_a_null_model_is_kept(spark):
    df = spark.createDataFrame([("m", 1.0), ("m", 3.0), (None, 5.0)], "model string, latency_ms double")
    out = {r["model"]: (r["n"], r["p50"]) for r in evaluation.latency_summary(df).collect()}
    assert out == {"m": (2, 2.0), None: (1, 5.0)}


def test_deep_network_ends_in_a_sigmoid():
    assert autoencoder.layer_sizes(50, "deep") == [50, 30, 20, 10, 20, 30, 50]
    sizes, rng = [3, 2, 3], np.random.default_rng(0)
    flat, x = autoencoder.initial_weights(sizes), rng.uniform(size=(5, 3))
    _, gradient = autoencoder.loss_gradient(x, flat, sizes, True)
    for k in range(len(flat)):
        step = np.zeros(len(flat))
        step[k] = 1e-6
        up, down = (autoencoder.loss_gradient(x, flat + s, sizes, True)[0] for s in (step, -step))
        assert math.isclose((up - down) / 2e-6, gradient[k], abs_tol=1e-6)


def test_candidates_per_query_stay_flat(spark):
    sizes = []
    for n in (2_000, 20_000):
        points = [(F.pmod(F.xxhash64(F.lit(k), F.col("id")), F.lit(10_000)) / 10_000.0) for k in range(4)]
        ref = spark.range(n).select(F.col("id").alias("r_id"), F.array(*points).alias("v"))
        index, _ = neighbors._index(ref, n, "euclidean", 1, 64, probed=True)
        sizes.append(index.counts[index.counts > 0].mean())
    assert sizes[1] < 1.5 * sizes[0] and sizes[1] < 2 * 64
