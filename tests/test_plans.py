import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from floodmark.plans.chunks import lag_in_key, overlap_chunks
from floodmark.plans.moments import mean_and_covariance
from floodmark.plans.ordering import grouped_hash_rank, hash_cuts, order_hash, take_in_hash_order
from floodmark.plans.quantiles import exact_quantiles
from floodmark.plans.running import running_totals
from floodmark.plans.sizing import fits_broadcast, size_in_bytes, skew_join
from floodmark.plans.staging import purge_staged, stage, staged

PROBS = [0.0, 0.001, 0.05, 0.25, 0.5, 0.95, 0.999, 1.0]


def columns_of(name, n):
    rng = np.random.default_rng(3)
    return {
        "smooth": rng.normal(size=n),
        "skewed": rng.lognormal(0, 6, n),
        "third_equal": np.where(rng.random(n) < 0.34, 7.0, rng.normal(7.0, 1.0, n)),
        "constant": np.full(n, 3.5),
        "two_values": rng.integers(0, 2, n).astype(float),
    }[name]


@pytest.mark.parametrize("name", ["smooth", "skewed", "third_equal", "constant", "two_values"])
def test_bracketed_quantiles_equal_numpy(spark, name):
    values = columns_of(name, 5000)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double").repartition(8)
    got = exact_quantiles(df, {"x": F.col("x")}, PROBS, small_bytes=0, small_rows=0, resolve_rows=20)["x"]
    assert np.allclose(got, np.quantile(values, PROBS), rtol=1e-12, atol=1e-12)


def test_quantiles_of_several_columns_and_infinities(spark):
    rows = [(float(i), float("inf") if i > 90 else float(-i), None) for i in range(100)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    for limits in ({}, {"small_bytes": 0, "small_rows": 0, "resolve_rows": 5}):
        got = exact_quantiles(df, {"a": F.col("a"), "b": F.col("b"), "c": F.col("c")}, [0.5, 1.0], **limits)
        assert got["a"] == [49.5, 99.0]
        assert got["b"][1] == float("inf") and got["b"][0] == np.quantile([r[1] for r in rows], 0.5)
        assert got["c"] == [None, None]


def test_hash_cuts_take_exactly_n(spark):
    df = spark.range(20_000).withColumn("g", F.col("id") % 3)
    hashed = order_hash(42, "id")
    expected = sorted(r.h for r in df.select(hashed.alias("h")).collect())
    for n in (0, 1, 777, 19_999, 20_000, 20_001):
        assert take_in_hash_order(df, hashed, n).count() == min(n, 20_000)
    draws = {"all": hashed, "odd": F.when(F.col("id") % 2 == 1, hashed), "none": F.lit(None).cast("string")}
    cuts = hash_cuts(df, draws, lambda n: {"all": n["all"] // 4, "odd": n["odd"], "none": 5})
    assert cuts == {"all": expected[4_999], "odd": None, "none": None}


def test_hash_cuts_descend_prefixes(spark, monkeypatch):
    import floodmark.plans.ordering as ordering

    monkeypatch.setattr(ordering, "RESOLVE_ROWS", 1)
    monkeypatch.setattr(ordering, "DIGITS", 1)
    df = spark.range(500)
    draws = {"a": order_hash(1, "id"), "b": order_hash(2, "id")}
    expected = {n: sorted(r.h for r in df.select(h.alias("h")).collect()) for n, h in draws.items()}
    assert hash_cuts(df, draws, lambda _: {"a": 250, "b": 17}) == {"a": expected["a"][249], "b": expected["b"][16]}


@pytest.mark.parametrize("rank_rows", [100, 1_000_000])
def test_grouped_rank_with_null_and_hot_group(spark, rank_rows):
    df = spark.range(3000).withColumn("g", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, (F.col("id") % 50).cast("string")))
    df = df.withColumn("h", order_hash(1, "id"))
    got = {r.id: (r._rank, r._size) for r in grouped_hash_rank(df, ["g"], "h", rank_rows).collect()}
    w = Window.partitionBy("g")
    want = df.select("id", F.row_number().over(w.orderBy("h")).alias("r"), F.count("*").over(w).alias("n")).collect()
    assert got == {r.id: (r.r, r.n) for r in want}


@pytest.mark.parametrize("descending", [True, False])
def test_running_totals_over_buckets(spark, descending):
    df = spark.range(1000).select((F.col("id") * 0.5).alias("t"), (F.col("id") % 7).alias("a"), F.lit(1).cast("long").alias("b"))
    out, totals = running_totals(df, "t", ["a", "b"], buckets=16, descending=descending)
    got = sorted((r.t, r.cum_a, r.cum_b) for r in out.collect())
    assert totals == {"a": sum(i % 7 for i in range(1000)), "b": 1000}
    a = np.arange(1000) % 7
    sums = a[::-1].cumsum()[::-1] if descending else a.cumsum()
    ones = np.arange(1000, 0, -1) if descending else np.arange(1, 1001)
    assert got == [(i * 0.5, sums[i], ones[i]) for i in range(1000)]


def test_overlap_chunks_give_whole_frames(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5).alias("k"), (F.col("id") * 37 % 5000).alias("t"), "id")
    frame = Window.partitionBy("k", "_chunk").orderBy("t").rangeBetween(-100, 0)
    got = {r.id: r.n for r in overlap_chunks(df, "t", 100, ratio=2).withColumn("n", F.count("*").over(frame)).filter(~F.col("_copy")).collect()}
    want = {r.id: r.n for r in df.withColumn("n", F.count("*").over(Window.partitionBy("k").orderBy("t").rangeBetween(-100, 0))).collect()}
    assert got == want


@pytest.mark.parametrize("forward", [False, True])
def test_lag_crosses_empty_chunks(spark, forward):
    df = spark.createDataFrame([("a", t, t * 2) for t in (1, 5, 12, 95, 96, 300)] + [(None, 7, 1), (None, 250, 2)], "k string, t long, v long")
    name = "_next_v" if forward else "_prev_v"
    got = {(r.k, r.t): r[name] for r in lag_in_key(df, ["k"], "t", ["v"], forward=forward, chunk_us=10).collect()}
    fn = F.lead if forward else F.lag
    want = {(r.k, r.t): r.p for r in df.withColumn("p", fn("v").over(Window.partitionBy("k").orderBy("t"))).collect()}
    assert got == want


def test_salted_join_equals_broadcast_join(spark):
    left = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).alias("k"), "id")
    right = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    small = {tuple(r) for r in skew_join(left, right, ["k"]).collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not fits_broadcast(right)
        joined = skew_join(left, right, ["k"])
        assert joined.columns == ["k", "id", "v"]
        assert {tuple(r) for r in joined.collect()} == small and joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


@pytest.mark.parametrize("d", [3, 24])
def test_moments_equal_numpy(spark, d):
    x = np.random.default_rng(0).normal(size=(500, d)) * 3 + 100
    names = [f"x{i}" for i in range(d)]
    n, mean, cov = mean_and_covariance(spark.createDataFrame(x.tolist(), names).repartition(4), names)
    assert n == 500
    assert np.allclose(mean, x.mean(axis=0))
    assert np.allclose(cov, np.cov(x.T, ddof=0))


def test_staged_table_is_removed(spark):
    df = spark.range(10).withColumn("x", F.lit("a"))
    assert stage(df).count() == 10
    with staged(df) as t:
        path = t.inputFiles()[0]
        assert t.filter("id < 3").count() == 3
    import os

    assert not os.path.exists(path.replace("file://", ""))
    kept = stage(df).inputFiles()[0].replace("file://", "")
    assert os.path.exists(kept)
    purge_staged(spark)
    assert not os.path.exists(kept)
    assert size_in_bytes(df) > 0
