import numpy as np
import pytest
from pyspark.sql import functions as F

from floodmark.operators import cleaning, enrich, profiling, selection, splitting
from floodmark.sources import flows as flow_source
from floodmark.sources import logs

INF, NAN = float("inf"), float("nan")


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [(1, 1.0, 5.0, "Benign"), (2, INF, 5.0, "Attack"), (3, -INF, 5.0, None), (4, NAN, 5.0, "Label"), (5, None, 5.0, "Benign"), (6, 3.0, 5.0, "DoS")]
    return spark.createDataFrame(rows, "row_id long, x double, c double, Label string")


def test_cleaning_rules(dirty):
    assert [r.x for r in cleaning.clean_zero(dirty, ["x"]).orderBy("row_id").collect()] == [1.0, 0.0, 0.0, 0.0, 0.0, 3.0]
    assert [r.x for r in cleaning.impute_median(dirty, dirty, ["x"]).orderBy("row_id").collect()] == [1.0, 2.0, 2.0, 2.0, 2.0, 3.0]
    own = dirty.filter("row_id > 1")
    assert {r.x for r in cleaning.impute_median(dirty, own, ["x"], mode="own").collect()} == {3.0}
    assert cleaning.drop_leaked_headers(dirty).count() == 5
    assert cleaning.count_leaked_headers(dirty).first().n_leaked == 1


def test_scaler_uses_population_deviation_and_guards_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "a double, b double")
    scaler = cleaning.standard_scaler_fit(df, ["a", "b"])
    assert scaler.std == [1.0, 1.0]
    assert [tuple(r) for r in cleaning.standard_scaler_transform(df, scaler).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_profiles(dirty):
    missing = profiling.missing_profile(dirty, ["row_id", "x", "c"]).collect()
    assert [(r.feature, r.n_missing) for r in missing] == [("x", 2)]
    assert [(r.feature, r.n_infinite) for r in profiling.infinite_profile(dirty, ["row_id", "x", "c"]).collect()] == [("x", 2)]
    balance = profiling.class_balance(dirty, "Label").first()
    assert (balance.n_total, balance.n_benign, balance.n_attack, balance.n_attack_types) == (6, 2, 4, 3)
    order = [r.Label for r in profiling.label_distribution(dirty, "Label").collect()]
    assert order[0] == "Benign" and len(order) == 5


def test_feature_selection_rules(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=300)
    rows = [(float(x), float(2 * x), float(-x), float(y), 1.0) for x, y in zip(a, rng.normal(size=300))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, k double")
    kept = {r.feature: r.kept for r in selection.correlation_filter(df, ["a", "b", "c", "d", "k"]).collect()}
    assert kept == {"a": True, "b": False, "c": False, "d": True, "k": True}
    assert selection.kept_columns(selection.variance_filter(df, ["a", "k"])) == ["a"]
    assert selection.kept_columns(selection.variance_filter(df, ["a", "k"], "near_zero")) == ["a"]
    model = selection.pca_fit(df, ["a", "b", "d"], 2)
    components = model[1].pc.toArray()
    assert np.allclose(components.T @ components, np.eye(2), atol=1e-9)
    assert selection.explained_variance(spark, model).count() == 2
    projected = np.array([r.pca.toArray() for r in selection.pca_reduce(df, model).collect()])
    assert np.allclose(projected.mean(axis=0), 0, atol=1e-9)


def test_anova_equals_the_textbook_ratio(spark):
    rng = np.random.default_rng(2)
    y = np.arange(300) % 3
    x = rng.normal(0.5 * y, 1)
    df = spark.createDataFrame([(float(v), int(g)) for v, g in zip(x, y)], "a double, y int")
    groups = [x[y == g] for g in range(3)]
    between = sum(len(g) * (g.mean() - x.mean()) ** 2 for g in groups) / 2
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / 297
    assert np.isclose(selection.select_k_best(df, ["a"], "y").first().f_value, between / within)


def test_exact_split_sizes(spark):
    df = spark.range(61_065).select(F.col("id").cast("string").alias("row_id"), F.when(F.col("id") < 36_000, "Benign").otherwise("Attack").alias("label"))
    train, test = splitting.benign_split(df, "row_id", exact=True)
    assert train.count() == 28_800
    assert test.filter("label = 'Benign'").count() == 7_200
    assert test.count() == 32_265
    loose, rest = splitting.benign_split(df, "row_id")
    assert loose.count() + rest.count() == 61_065 and abs(loose.count() - 28_800) < 400


def test_group_split_and_balanced_sample(spark):
    df = spark.createDataFrame([(f"r{i}", "f1" if i < 10 else "f2" if i < 11 else "f3", "Benign" if i != 12 else "DoS") for i in range(13)], "row_id string, file string, label string")
    parts = {(r.file, r.part): r["count"] for r in splitting.benign_split_by(df, "file", "row_id").groupBy("file", "part").count().collect()}
    assert parts == {("f1", "train"): 8, ("f1", "test"): 2, ("f2", "train"): 1, ("f3", "train"): 1, ("f3", "test"): 1}
    sample = splitting.balanced_sample(df, 5, "row_id").collect()
    assert len(sample) == 2 and {r.label for r in sample} == {"Benign", "DoS"}
    assert splitting.balanced_sample(df.filter("label = 'Benign'"), 5, "row_id").count() == 0


def test_injected_parts(spark):
    df = spark.range(900).select("id", (F.col("id") * 1.0).alias("a"), (F.col("id") * 0.5 + 1000).alias("b"))
    out = splitting.inject_anomalies(df, ["a", "b"], "id", ratio=0.3)
    counts = out.agg(*[F.sum(f"is_{k}").alias(k) for k in ("noise", "swap", "extreme")]).first()
    assert tuple(counts) == (90, 90, 90)
    assert out.filter("injected = 0").join(df.withColumnsRenamed({"a": "a0", "b": "b0"}), "id").filter("a <> a0 OR b <> b0").count() == 0
    extreme = out.filter("is_extreme = 1").collect()
    assert all(r.a == 8990.0 or r.b == 14495.0 for r in extreme)


def test_csv_layouts_are_merged_by_name(spark, tmp_path):
    narrow, wide = tmp_path / "narrow.csv", tmp_path / "wide.csv"
    narrow.write_text("Dst Port,Flow Duration,Label\n80,1.5,Benign\nDst Port,Flow Duration,Label\n")
    wide.write_text("Flow ID,Dst Port,Flow Duration,Label\nf1,443,Infinity,DoS\n")
    frames = [flow_source.read_flow_csv(spark, str(p)).drop("source_file", "source_path", "source_bytes") for p in (narrow, wide)]
    merged = cleaning.union_standard(frames, cleaning.STANDARD_COLUMNS)
    assert merged.columns == ["Dst Port", "Flow Duration", "Label"]
    clean = cleaning.to_numeric(cleaning.drop_leaked_headers(merged), ["Flow Duration"])
    assert {(r["Dst Port"], r["Flow Duration"], r.Label) for r in clean.collect()} == {("80", 1.5, "Benign"), ("443", INF, "DoS")}
    assert cleaning.feature_columns(clean) == ["Flow Duration"]
    assert len(cleaning.STANDARD_COLUMNS) == 80


def test_unreadable_files_are_skipped_and_reported(spark, tmp_path):
    (tmp_path / "ok.csv").write_text("a,Label\n1,Benign\n")
    (tmp_path / "bad.csv.gz").write_bytes(b"not a gzip file")
    table = flow_source.read_flow_csv(spark, str(tmp_path), ["a", "Label"])
    assert table.count() == 1
    assert [r[0].split("/")[-1] for r in flow_source.unreadable_files(spark, str(tmp_path), table).collect()] == ["bad.csv.gz"]
    assert profiling.profile_files(table).first().n_columns == 2


def test_folder_of_mixed_layouts_is_read_by_name(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b,Label\n1,2,Benign\n")
    (tmp_path / "two x.csv").write_text("extra,a,b,Label\n9,3,4,DoS\n8,5,6,DoS\n")
    table = flow_source.read_flow_csv(spark, str(tmp_path))
    assert {(r.a, r.b, r.Label, r.extra) for r in table.collect()} == {("1", "2", "Benign", None), ("3", "4", "DoS", "9"), ("5", "6", "DoS", "8")}
    assert flow_source.read_flow_csv(spark, str(tmp_path), ["b", "none"]).columns[:2] == ["b", "none"]


def test_truncated_files_are_reported(spark, tmp_path):
    import gzip

    whole = gzip.compress(("a,Label\n" + "".join(f"{i * 7919 % 100003},Benign\n" for i in range(50_000))).encode())
    (tmp_path / "cut.csv.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "ok.csv").write_text("a,Label\n1,Benign\n")
    damaged = flow_source.damaged_files(spark, str(tmp_path)).collect()
    assert [r.source_path.split("/")[-1] for r in damaged] == ["cut.csv.gz"] and damaged[0].reason
    assert flow_source.read_flow_csv(spark, str(tmp_path), ["a"]).count() > 1


def test_access_log_lines(spark):
    lines = [
        '203.0.113.9 - - [17/Mar/2031:04:05:06 +0000] "GET /shop/cart?item=88 HTTP/1.1" 206 977 "agent/7 (test)"',
        '10.0.0.1 - - [01/Jan/2024:12:34:56 +0200] "POST / HTTP/1.0" 500 -',
        "garbage",
        None,
    ]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    a, b, c, d = logs.parse_access_log(df).orderBy("i").collect()
    assert (a.remote_addr, a.method, a.path, a.query, a.status, a.body_bytes_sent, a.user_agent, a.malformed) == (
        "203.0.113.9", "GET", "/shop/cart", "item=88", 206, 977, "agent/7 (test)", False)
    assert str(a.timestamp) != str(b.timestamp) and b.query == "" and b.body_bytes_sent is None and b.user_agent is None
    assert c.malformed and d.malformed and c.path is None


def test_geo_ranges_and_salted_form(spark, no_broadcast):
    blocks = spark.createDataFrame([(0, 99, "A"), (100, 100, "B"), (150, 5000, "C")], "start long, end long, country string")
    df = spark.createDataFrame([(i, x) for i, x in enumerate([0, 99, 100, 101, 150, 5000, 5001, None])], "i long, ip long")
    out = enrich.geo_enrich(df, blocks, "ip", ["country"], width=64).orderBy("i").collect()
    assert [r.country for r in out] == ["A", "A", "B", None, "C", "C", None, None]


def test_asof_respects_order_and_ttl(spark):
    s = 1_000_000
    scores = spark.createDataFrame([("a", 10 * s, 0.1), ("a", 20 * s, 0.2), ("b", 599 * s, 0.9)], "k string, ts_us long, score double")
    ticks = spark.createDataFrame([("a", 9 * s, 1), ("a", 20 * s, 2), ("a", 80 * s, 3), ("a", 81 * s, 4), ("b", 601 * s, 5), ("c", 1, 6)], "k string, ts_us long, n int")
    got = {r.n: r.score for r in enrich.score_asof(ticks, scores, ["k"]).collect()}
    assert got == {1: None, 2: 0.2, 3: 0.2, 4: None, 5: 0.9, 6: None}


def test_agreement_and_generations(spark):
    a = spark.createDataFrame([(1, 1), (2, -1), (3, -1)], "row_id int, y_pred int")
    b = spark.createDataFrame([(1, 1), (2, 1), (3, -1)], "row_id int, y_pred int")
    r = enrich.model_agreement(a, b).first()
    assert (r.n, round(r.agreement, 4), r.model_only, r.baseline_only) == (3, 0.6667, 1, 0)
    m = spark.createDataFrame([("lof", "v1", 78.53), ("lof", "v2", 66.35)], "model string, generation string, accuracy double")
    out = enrich.compare_generations(m, ["v1", "v2"], "accuracy", "v1").first()
    assert round(out.v2_delta, 2) == -12.18
