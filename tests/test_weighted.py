"""Weighted rows, spread-out starts and evenly dealt copies."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from floodmark.operators.detect import averaging, gmm
from floodmark.plans import weighted


@pytest.fixture(scope="module")
def parted(spark):
    """A million rows in two clusters of ten distinct rows each."""
    step, side = F.floor(F.col("id") / 2) % 10, F.col("id") % 2
    return spark.range(1_000_000).select((side * 100 + step * 0.1).alias("a"), (side * 50 + step * 0.01).alias("b"))


@pytest.mark.parametrize("seed", [42, 43, 44])
def test_two_clusters_of_few_distinct_rows_are_found(parted, seed):
    model = gmm.gmm_fit(parted, ["a", "b"], k=2, seed=seed)
    assert np.allclose(model.weights, [0.5, 0.5])
    assert np.allclose(sorted(model.means), [[0.45, 0.045], [100.45, 50.045]])


def test_passes_over_a_table_and_in_a_task_agree(spark):
    x = F.col("id")
    noise = [F.pmod(F.xxhash64(F.lit(k), x), F.lit(500)) / 500.0 for k in range(2)]
    rows = spark.range(12_000).select((noise[0] + F.when(x % 3 == 0, 4.0).otherwise(0.0)).alias("a"), (noise[1] - noise[0]).alias("b"))
    for kind in ("full", "tied", "diag", "spherical"):
        one, two, three = (
            gmm.em_fits(df, ["a", "b"], [(3, kind, 5)], start_rows=start, local_numbers=limit)[0]
            for df, start, limit in ((rows, 500, 10**9), (rows.repartition(2, "a"), 500, 0), (rows.repartition(8), 500, 0))
        )
        for other in (two, three):
            assert np.allclose(one[0].means, other[0].means, atol=1e-6) and np.allclose(one[0].weights, other[0].weights, atol=1e-6)
            assert one[1] == pytest.approx(other[1], rel=1e-9) and one[2] == other[2] == 12_000


def test_fits_of_one_call_equal_single_fits(spark, parted):
    wanted = [(k, kind, 42) for k in (1, 2) for kind in ("full", "diag")]
    for got, (k, kind, seed) in zip(gmm.em_fits(parted, ["a", "b"], wanted), wanted):
        alone = gmm.em_fit(parted, ["a", "b"], k, kind, seed=seed)
        assert got[1] == pytest.approx(alone[1]) and np.allclose(got[0].means, alone[0].means)


def test_fewer_distinct_rows_than_components(spark):
    rows = spark.createDataFrame([(1.0, 2.0)] * 30 + [(5.0, 1.0)] * 10, "a double, b double")
    model = gmm.gmm_fit(rows, ["a", "b"], k=5)
    assert sorted(model.weights) == pytest.approx([0.25, 0.75])
    with pytest.raises(ValueError, match="needs rows"):
        gmm.gmm_fit(rows.limit(0), ["a", "b"], k=2)


def test_start_finds_small_far_clusters():
    """Nine far clusters of very different sizes all get a centre."""
    rng = np.random.default_rng(3)
    sizes = [20_000, 5_000, 1_000, 300, 100, 50, 30, 20, 10]
    x = np.concatenate([rng.normal(0, 0.2, (n, 2)) + [30 * (i % 3), 30 * (i // 3)] for i, n in enumerate(sizes)])
    passes = weighted.LocalPasses(x, np.ones(len(x)))
    centres = weighted.spread_centres(passes, 9, x.mean(axis=0), x.std(axis=0), float(len(x)), 1)
    want = np.array([[30 * (i % 3), 30 * (i // 3)] for i in range(9)])
    assert np.sqrt(weighted.gaps(want.astype(float), centres)).min(axis=1).max() < 1.0


def test_hash_depends_on_values_alone():
    x = np.random.default_rng(1).normal(size=(5000, 3))
    one = weighted.unit_hash(x, 7)
    assert (one[::-1] == weighted.unit_hash(x[::-1], 7)).all() and (one != weighted.unit_hash(x, 8)).any()
    assert abs(one.mean() - 0.5) < 0.02 and len(np.unique(one)) == 5000
    assert weighted.unit_hash(np.array([[0.0]]), 1) == weighted.unit_hash(np.array([[-0.0]]), 1)


def test_copies_of_a_row_are_dealt_to_all_parts(spark):
    """A third of 300,000 rows are equal, and every part still has its share of all rows and of the copies."""
    x = F.col("id")
    rows = spark.range(300_000).select(F.when(x % 3 == 0, 1.5).otherwise(x.cast("double")).alias("a"), F.lit(2.0).alias("b"))
    dealt = averaging.in_parts(rows, 64, 42)
    sizes = dealt.groupBy(averaging.PART).agg(F.count("*").alias("n"), F.count_if(F.col("a") == 1.5).alias("copies")).collect()
    assert len(sizes) == 64 and sum(r["n"] for r in sizes) == 300_000
    assert max(r["n"] for r in sizes) < 1.2 * 300_000 / 64 and max(r["copies"] for r in sizes) < 1.3 * 100_000 / 64
    again = averaging.in_parts(rows.repartition(5, "a"), 64, 42).groupBy(averaging.PART).agg(F.sum("a").alias("s"))
    first = dealt.groupBy(averaging.PART).agg(F.sum("a").alias("s"))
    assert {r[0]: r[1] for r in again.collect()} == {r[0]: r[1] for r in first.collect()}


def test_fits_over_a_table_share_their_passes(spark, monkeypatch):
    """Eight fits read the table hardly more often than the longest of them alone."""
    x = F.col("id")
    rows = spark.range(6_000).select(
        (F.pmod(F.xxhash64(x), F.lit(997)) / 997.0 + F.when(x % 3 == 0, 4.0).otherwise(0.0)).alias("a"), (F.pmod(F.xxhash64(F.lit(1), x), F.lit(991)) / 991.0).alias("b")
    )
    jobs, sum_vectors = [], weighted.sum_vectors
    monkeypatch.setattr(weighted, "sum_vectors", lambda *a: jobs.append(1) or sum_vectors(*a))
    wanted = [(k, kind, 42) for kind in ("full", "tied", "diag", "spherical") for k in (2, 3)]
    alone = []
    for one in wanted:
        jobs.clear()
        fit = gmm.em_fits(rows, ["a", "b"], [one], local_numbers=0, max_iter=6)[0]
        alone.append((len(jobs), fit))
    jobs.clear()
    together = gmm.em_fits(rows, ["a", "b"], wanted, local_numbers=0, max_iter=6)
    assert len(jobs) <= 1.5 * max(n for n, _ in alone) < sum(n for n, _ in alone)
    for got, (_, one) in zip(together, alone):
        assert got[1] == pytest.approx(one[1], rel=1e-9) and np.allclose(got[0].means, one[0].means, atol=1e-6)


def test_a_failing_pass_ends_all_fits(spark):
    table = weighted.weighted_rows(spark.range(10).select(F.col("id").cast("double").alias("a")), ["a"])
    passes = weighted.SharedPasses(weighted.TablePasses(table, ["a"], 10))

    def wrong(x, w):
        raise ValueError("no such step")

    with pytest.raises(Exception, match="no such step"):
        passes.run([lambda: passes.sums(wrong, 1), lambda: passes.sums(lambda x, w: np.array([w.sum()]), 1)])


def test_packed_blocks_hold_the_rows_of_their_part_in_order(spark):
    """the rounds of a fit read one row of bytes per block; a round over them gives what a round over the rows gives."""
    rows = spark.range(9000).select((F.col("id") % 700).cast("double").alias("a"), F.when(F.col("id") % 50 != 0, F.sqrt("id")).alias("b"), (F.col("id") % 7 == 0).alias("out"))
    dealt = averaging.in_parts(rows, 2, 42).localCheckpoint()
    blocks = averaging.packed(dealt, ["a", "b"], "out").localCheckpoint()
    assert blocks.count() <= 9000 // averaging.BLOCK_ROWS + 2
    for part in range(2):
        want = dealt.filter(F.col(averaging.PART) == part).select("a", "b", "out").collect()
        got = [averaging._unpacked(r["_values"], r["_marks"]) for r in blocks.filter(F.col(averaging.PART) == part).collect()]
        values, marks = np.concatenate([v for v, _ in got]), np.concatenate([m for _, m in got])
        np.testing.assert_array_equal(values, np.array([[r.a, np.nan if r.b is None else r.b] for r in want]))
        assert marks.tolist() == [r.out for r in want]

    def step(state, pairs):
        n, held = 0, 0
        for x, out in pairs:
            n, held, state = n + len(x), held + int(out.sum()), state + np.nansum(x[~out], axis=0)
        return state, n, [held]

    def of_rows(state, frames):
        return step(state, ((f[["a", "b"]].to_numpy(dtype=float), f["out"].to_numpy(dtype=bool)) for f in frames))

    one, two = averaging.packed_round(blocks, np.ones(2), step, 2), averaging.averaging_round(dealt, np.ones(2), of_rows, 2)
    np.testing.assert_allclose(one[0], two[0], rtol=1e-12)
    assert one[1].tolist() == two[1].tolist() == [rows.filter("out").count()]
