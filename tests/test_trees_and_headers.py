"""Pivot trees against exact neighbours, and first lines of files."""

import gzip
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from floodmark.operators.detect import neighbors, pivot_tree
from floodmark.plans.staging import stage
from floodmark.sources import flows, headers


def clustered(spark, n, d=6):
    """Clusters of about 100 rows; their number grows with the table."""
    group = F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(n // 100))
    place = [F.pmod(F.xxhash64(F.lit(j), group), F.lit(1000)) / 10.0 + F.pmod(F.xxhash64(F.lit(50 + j), "id"), F.lit(1000)) / 1000.0 for j in range(d)]
    return stage(spark.range(n).select("id", F.array(*place).alias("vector")), "clustered")


def test_work_of_a_query_does_not_grow_with_the_table(spark):
    met = []
    for n in (2_000, 20_000):
        rows = clustered(spark, n)
        tree = pivot_tree.build_tree(rows.select(F.col("id").alias("r_id"), F.col("vector").alias("v")), leaf_rows=64)
        assert tree.leaves.count() == n and tree.leaves.select("r_id").distinct().count() == n
        assert tree.leaves.groupBy("node").count().agg(F.max("count")).first()[0] <= 64
        queries = stage(rows.filter(F.col("id") % (n // 200) == 0).select(F.col("id").alias("q_id"), F.col("vector").alias("v")), "queries")
        found, seen = pivot_tree.search(queries, [tree], 5, True, beam=8)
        exact = neighbors.knn_join(queries.select(F.col("q_id").alias("id"), F.col("v").alias("vector")), rows, 5, "id", "id", exclude_self=True)
        best = neighbors._best(found, 5).withColumnRenamed("q_id", "id")
        assert neighbors.recall(best, exact, "id").first()["recall"] >= 0.9
        most = seen.agg(F.avg("met"), F.max("met")).first()
        assert most[1] <= 8 * 64
        met.append(most[0])
    assert met[1] <= 1.5 * met[0]


@pytest.mark.parametrize("metric", ["cosine", "manhattan"])
def test_wide_beam_is_exact(spark, metric):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4)).tolist()
    rows = spark.createDataFrame(list(enumerate(x)), "id long, vector array<double>")
    index = neighbors.tree_index(rows, "id", metric=metric, k=4, least_recall=None, trees=1, beam=1000, leaf_rows=16)
    got = {(r["id"], r["rank"]): (r["n_id"], round(r["dist"], 9)) for r in neighbors.tree_join(rows, index, 4, "id", exclude_self=True).collect()}
    want = {(r["id"], r["rank"]): (r["n_id"], round(r["dist"], 9)) for r in neighbors.knn_join(rows, rows, 4, "id", "id", metric=metric, exclude_self=True).collect()}
    assert got == want


def test_tree_of_equal_rows_and_of_none(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(90)] + [(100 + i, [float(i), 9.0]) for i in range(30)], "id long, vector array<double>")
    index = neighbors.tree_index(same, "id", least_recall=None, trees=1, leaf_rows=16, beam=64)
    got = neighbors.tree_join(same.filter("id < 3"), index, 3, "id", exclude_self=True).orderBy("id", "rank").collect()
    assert [(r["id"], r["n_id"], r["dist"]) for r in got] == [(0, 1, 0.0), (0, 2, 0.0), (0, 3, 0.0), (1, 0, 0.0), (1, 2, 0.0), (1, 3, 0.0), (2, 0, 0.0), (2, 1, 0.0), (2, 3, 0.0)]
    nothing = neighbors.tree_index(same.limit(0), "id", trees=1)
    assert neighbors.tree_join(same, nothing, 3, "id").count() == 0


def test_outlier_factors_through_trees(spark):
    """Beyond ``exact_values`` the model keeps an index; its factors stay near the exact ones and rank the planted rows first."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(600, 3)), [[9, 9, 9], [-9, 9, 0]]]).tolist()
    rows = spark.createDataFrame(list(enumerate(x)), "id long, vector array<double>")
    exact = neighbors.lof_fit(rows, "id", k=10)
    model = neighbors.lof_fit(rows, "id", k=10, exact_values=0, trees=2, leaf_rows=64)
    assert exact.index is None and model.index is not None and model.index.recall >= 0.9
    a, b = ({r["id"]: r["score"] for r in m.scores.collect()} for m in (exact, model))
    assert np.corrcoef([a[i] for i in range(600)], [b[i] for i in range(600)])[0, 1] > 0.9
    new = spark.createDataFrame([(0, [0.1, 0.0, 0.1]), (1, [20.0, 0.0, 0.0])], "id long, vector array<double>")
    scores = {r["id"]: r["score"] for r in neighbors.lof_score(new, model, "id").collect()}
    assert scores[0] < 1.5 < scores[1] and sorted(b, key=b.get)[-2:] in ([600, 601], [601, 600])


# ---- first lines


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "skipped").mkdir()
    body = "1,2\n" * 200_000
    (tmp_path / "a b.csv").write_text("x,y\n" + body)
    (tmp_path / "c.csv").write_text("x,y\r\n" + body)
    with gzip.open(tmp_path / "d.csv.gz", "wt") as out:
        out.write("x,z\n" + body)
    (tmp_path / "e.csv.gz").write_bytes(b"\x1f\x8bbroken")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "long.csv").write_text(",".join(f"column{i}" for i in range(3000)) + "\n1")
    (tmp_path / "_hidden.csv").write_text("no\n")
    (tmp_path / "skipped" / "f.csv").write_text("no\n")
    return tmp_path


def test_first_lines_read_a_few_kilobytes(spark, folder):
    found = {os.path.basename(r["source_path"]): r for r in headers.first_lines(spark, str(folder)).collect()}
    assert set(found) == {"a%20b.csv", "c.csv", "d.csv.gz", "e.csv.gz", "empty.csv", "long.csv"}
    assert found["a%20b.csv"]["header"] == "x,y" and found["c.csv"]["header"] == "x,y" and found["d.csv.gz"]["header"] == "x,z"
    assert found["long.csv"]["header"].endswith("column2999") and found["empty.csv"]["header"] is None
    assert found["e.csv.gz"]["loss"] and not found["a%20b.csv"]["loss"]
    assert all(r["bytes_read"] <= 10 * headers.STEP_BYTES for r in found.values())
    assert found["a%20b.csv"]["source_bytes"] == os.path.getsize(folder / "a b.csv")
    # paths are those of Spark's own metadata
    own = {r[0] for r in spark.read.option("ignoreCorruptFiles", True).text(str(folder)).select("_metadata.file_path").distinct().collect()}
    assert {r["source_path"] for r in found.values() if r["header"]} <= own


def test_layouts_of_a_folder_and_of_a_pattern(spark, folder):
    for path in (str(folder), f"file://{folder}", f"{folder}/*.csv*"):
        layouts = {r["header"]: len(r["files"]) for r in flows.file_headers(spark, path).collect()}
        assert layouts["x,z"] == 1 and layouts["x,y"] == 2


def test_folders_named_like_partitions_are_entered(spark, tmp_path):
    for day in (1, 2):
        (tmp_path / f"day={day}").mkdir()
        (tmp_path / f"day={day}" / "part.csv").write_text(f"x,y{day}\n")
    found = headers.first_lines(spark, str(tmp_path)).collect()
    assert {r["header"] for r in found} == {"x,y1", "x,y2"}
    assert {r["source_path"] for r in found} == {r[0] for r in spark.read.text(str(tmp_path)).select("_metadata.file_path").collect()}


def test_folder_of_one_layout_is_read_as_a_folder(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(f"x,y\n{i},a\n")
    table = flows.read_flow_csv(spark, str(tmp_path))
    assert sorted((r["x"], r["y"], r["source_file"]) for r in table.collect()) == [(str(i), "a", f"{i}.csv") for i in range(3)]
    assert table.columns == ["x", "y", "source_file", "source_path", "source_bytes"]


def test_wide_searches_cut_trees_back(spark, monkeypatch):
    """Evenly filled dimensions: fewer, bigger leaves are met rather than a beam of thousands, and the recall asked for is reached."""
    rng = np.random.default_rng(4)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(3_000, 24)))], "id long, vector array<double>")
    index = neighbors.tree_index(rows, "id", k=4, trees=1, leaf_rows=8)
    assert index.beam <= pivot_tree.MAX_BEAM and index.recall >= 0.9
    tree = index.trees[0]
    assert tree.leaves.count() == 3_000 and tree.leaves.select("r_id").distinct().count() == 3_000
    assert tree.leaves.select("node").distinct().count() <= 16**tree.levels
    exact = neighbors.knn_join(rows, rows, 4, "id", "id", exclude_self=True)
    assert neighbors.recall(neighbors.tree_join(rows, index, 4, "id", exclude_self=True), exact, "id").first()["recall"] >= 0.9
