"""Profiling and cleaning."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from floodmark.catalog.registry import query, rounded
from floodmark.catalog.standins import DIRTY, FLOW, FLOW_FEATURES, dirty_flows, flows, table
from floodmark.operators import cleaning, profiling, selection
from floodmark.sources import flows as flow_source

def per_feature_sql(cte: str, source: str, stats: dict[str, str], where: str = "") -> str:
    """One row per feature; ``{c}`` in a statistic is the feature."""
    parts = [
        f"SELECT '{c}' AS feature, " + ", ".join(f"{e.format(c=c)} AS {n}" for n, e in stats.items()) + f" FROM {source}"
        for c in FLOW_FEATURES
    ]
    return f"WITH {cte}, long AS ({' UNION ALL '.join(parts)}) SELECT * FROM long {where}"


@query("profile_files", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def profile_files(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        "*", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_size").alias("source_bytes")
    )
    return profiling.profile_files(raw).agg(F.sum("n_rows").alias("n_rows"), F.max("n_columns").alias("n_columns"))


@query("dtype_census", """SELECT CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS dtype, count(*) AS n
FROM information_schema.columns WHERE table_name = 'lineitem' GROUP BY 1""")
def dtype_census(spark, sf_dir):
    census = profiling.dtype_census(table(spark, sf_dir, "lineitem"))
    return spark.createDataFrame(sorted(census.items()), "dtype string, n long")


@query("label_distribution", f"""WITH {FLOW}, c AS (
  SELECT CASE WHEN grouping(l_linestatus) = 1 THEN 'all' ELSE l_linestatus END AS scope, label, count(*) AS n
  FROM flow GROUP BY GROUPING SETS ((l_linestatus, label), (label)))
SELECT scope, label, n, round(100.0 * n / sum(n) OVER (PARTITION BY scope), 6) AS pct FROM c""")
def label_distribution(spark, sf_dir):
    return rounded(profiling.label_distribution(flows(spark, sf_dir), "label", "l_linestatus"))


@query("class_balance", f"""WITH {DIRTY}, x AS (SELECT "Label" IS NOT DISTINCT FROM 'Benign' AS b, "Label" AS l FROM dirty)
SELECT count(*) AS n_total, count(*) FILTER (b) AS n_benign, count(*) FILTER (NOT b) AS n_attack,
  round(100.0 * count(*) FILTER (b) / count(*), 6) AS benign_pct, round(100.0 * count(*) FILTER (NOT b) / count(*), 6) AS attack_pct,
  count(DISTINCT CASE WHEN NOT b THEN l END) AS n_attack_types FROM x""")
def class_balance(spark, sf_dir):
    return rounded(profiling.class_balance(dirty_flows(spark, sf_dir), "Label"))


@query("missing_profile", per_feature_sql(DIRTY, "dirty", {
    "n_missing": "count(*) FILTER ({c} IS NULL OR isnan({c}))",
    "missing_pct": "round(100.0 * count(*) FILTER ({c} IS NULL OR isnan({c})) / count(*), 6)"}, "WHERE n_missing > 0"))
def missing_profile(spark, sf_dir):
    return rounded(profiling.missing_profile(dirty_flows(spark, sf_dir), FLOW_FEATURES))


@query("infinite_profile", per_feature_sql(DIRTY, "dirty", {"n_infinite": "count(*) FILTER (isinf({c}))"}, "WHERE n_infinite > 0"))
def infinite_profile(spark, sf_dir):
    return profiling.infinite_profile(dirty_flows(spark, sf_dir), FLOW_FEATURES)


@query("describe_features", per_feature_sql(FLOW, "flow", {
    "count": "count({c})", "mean": "round(avg({c}), 4)", "std": "round(stddev_samp({c}), 4)", "min": "round(min({c}), 4)", "max": "round(max({c}), 4)",
    "p25": "round(quantile_cont({c}, 0.25), 4)", "p50": "round(quantile_cont({c}, 0.5), 4)", "p75": "round(quantile_cont({c}, 0.75), 4)"}))
def describe_features(spark, sf_dir):
    return rounded(profiling.describe_features(flows(spark, sf_dir), FLOW_FEATURES, full=True), 4)


@query("label_coverage", f"""WITH {FLOW}, f AS (SELECT l_orderkey % 997 || label AS label FROM flow),
s AS (SELECT label FROM (SELECT l_orderkey % 997 || label AS label, row_id FROM flow ORDER BY row_id LIMIT 500))
SELECT f.label, f.n AS full_n, coalesce(s.n, 0) AS sample_n, s.n IS NULL AS missing, true AS is_attack
FROM (SELECT label, count(*) AS n FROM f GROUP BY 1) f LEFT JOIN (SELECT label, count(*) AS n FROM s GROUP BY 1) s USING (label)""")
def label_coverage(spark, sf_dir):
    full = flows(spark, sf_dir).select("row_id", F.concat((F.col("l_orderkey") % 997).cast("string"), "label").alias("label"))
    sample = flow_source.head_sample(full, 500, ["row_id"])
    return profiling.label_coverage(sample, full)


@query("missing_labels", f"""WITH {FLOW}, f AS (SELECT l_orderkey % 997 || label AS label FROM flow),
s AS (SELECT label FROM (SELECT l_orderkey % 997 || label AS label, row_id FROM flow ORDER BY row_id LIMIT 500))
SELECT DISTINCT label FROM f WHERE label NOT IN (SELECT label FROM s)""")
def missing_labels(spark, sf_dir):
    full = flows(spark, sf_dir).select("row_id", F.concat((F.col("l_orderkey") % 997).cast("string"), "label").alias("label"))
    return profiling.missing_labels(flow_source.head_sample(full, 500, ["row_id"]), full)


@query("top_labels", f"""WITH {DIRTY} SELECT "Label", count(*) AS n FROM dirty WHERE "Label" IS DISTINCT FROM 'Benign' GROUP BY 1 ORDER BY n DESC, 1""")
def top_labels(spark, sf_dir):
    return profiling.top_labels(dirty_flows(spark, sf_dir), "Label")


@query("drop_leaked_headers", f"""WITH {DIRTY} SELECT "Label", count(*) AS n FROM dirty WHERE "Label" IS DISTINCT FROM 'Label' GROUP BY 1""")
def drop_leaked_headers(spark, sf_dir):
    return cleaning.drop_leaked_headers(dirty_flows(spark, sf_dir)).groupBy("Label").agg(F.count("*").alias("n"))


@query("count_leaked_headers", f"""WITH {DIRTY} SELECT count(*) FILTER ("Label" = 'Label') AS n_leaked FROM dirty""")
def count_leaked_headers(spark, sf_dir):
    return cleaning.count_leaked_headers(dirty_flows(spark, sf_dir))


@query("union_standard", f"""WITH {FLOW}
SELECT row_id, CASE WHEN l_linestatus = 'O' THEN l_tax END AS l_tax, l_quantity, label FROM flow""")
def union_standard(spark, sf_dir):
    df = flows(spark, sf_dir)
    wide = df.filter("l_linestatus = 'O'")
    narrow = df.filter("l_linestatus <> 'O'").drop("l_tax", "l_shipdate")
    return cleaning.union_standard([narrow, wide], ["row_id", "no_such_column", "l_tax", "l_quantity", "label"])


@query("feature_columns", """SELECT unnest(['l_orderkey', 'l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS feature,
  (SELECT count(*) FROM lineitem) AS n""")
def feature_columns(spark, sf_dir):
    df = flows(spark, sf_dir).withColumnRenamed("label", "Label")
    kept = cleaning.feature_columns(df)
    return profiling.per_feature(df, kept, {"n": F.count})


@query("clean_zero", f"""WITH {DIRTY} SELECT row_id, coalesce(l_quantity, 0) AS l_quantity,
  CASE WHEN isfinite(l_extendedprice) THEN l_extendedprice ELSE 0 END AS l_extendedprice, l_discount,
  CASE WHEN isfinite(l_tax) THEN l_tax ELSE 0 END AS l_tax FROM dirty""")
def clean_zero(spark, sf_dir):
    return cleaning.clean_zero(dirty_flows(spark, sf_dir), FLOW_FEATURES).drop("Label")


_FINITE = "CASE WHEN isfinite({c}) THEN {c} END"
_FINITES = ", ".join(f"{_FINITE.format(c=c)} AS {c}" for c in FLOW_FEATURES)


@query("impute_median", f"""WITH {DIRTY}, fin AS (SELECT row_id, "Label" AS l, {_FINITES} FROM dirty),
med AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}' for c in FLOW_FEATURES)} FROM fin WHERE l IS NOT DISTINCT FROM 'Benign')
SELECT row_id, {', '.join(f'round(coalesce({c}, m_{c}), 6) AS {c}' for c in FLOW_FEATURES)} FROM fin, med""")
def impute_median(spark, sf_dir):
    df = dirty_flows(spark, sf_dir)
    train = df.filter(profiling.is_benign("Label"))
    return rounded(cleaning.impute_median(train, df, FLOW_FEATURES).drop("Label"))


@query("clip_quantiles", f"""WITH {FLOW},
q AS (SELECT {', '.join(f'quantile_cont({c}, 0.001) AS a_{c}, quantile_cont({c}, 0.999) AS b_{c}' for c in FLOW_FEATURES)} FROM flow WHERE label = 'Benign')
SELECT row_id, {', '.join(f'round(least(greatest({c}, a_{c}), b_{c}), 6) AS {c}' for c in FLOW_FEATURES)} FROM flow, q""")
def clip_quantiles(spark, sf_dir):
    df = flows(spark, sf_dir)
    clipped = cleaning.clip_quantiles(df.filter("label = 'Benign'"), df, FLOW_FEATURES)
    return rounded(clipped.select("row_id", *FLOW_FEATURES))


@query("standard_scaler", f"""WITH {FLOW},
s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in FLOW_FEATURES)} FROM flow WHERE label = 'Benign')
SELECT row_id, {', '.join(f'round(({c} - m_{c}) / s_{c}, 6) + 0.0 AS {c}' for c in FLOW_FEATURES)} FROM flow, s""")
def standard_scaler(spark, sf_dir):
    df = flows(spark, sf_dir)
    scaler = cleaning.standard_scaler_fit(df.filter("label = 'Benign'"), FLOW_FEATURES)
    return rounded(cleaning.standard_scaler_transform(df, scaler).select("row_id", *FLOW_FEATURES))


_VARIANCE_SQL = f"""WITH {FLOW}, v AS (SELECT l_quantity, l_extendedprice / 1000 AS l_extendedprice, l_discount, l_tax, 7.0 AS constant FROM flow), long AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round({{f}}({c}), 4) AS variance FROM v" for c in [*FLOW_FEATURES, "constant"]
) + ") SELECT *, variance {t} AS kept FROM long"


@query("variance_filter", _VARIANCE_SQL.format(f="var_pop", t="> 0"))
def variance_filter(spark, sf_dir):
    df = flows(spark, sf_dir).withColumns({"l_extendedprice": F.col("l_extendedprice") / 1000, "constant": F.lit(7.0)})
    return rounded(selection.variance_filter(df, [*FLOW_FEATURES, "constant"]), 4)


@query("variance_filter_near_zero", _VARIANCE_SQL.format(f="var_samp", t=">= 1e-10"))
def variance_filter_near_zero(spark, sf_dir):
    df = flows(spark, sf_dir).withColumns({"l_extendedprice": F.col("l_extendedprice") / 1000, "constant": F.lit(7.0)})
    return rounded(selection.variance_filter(df, [*FLOW_FEATURES, "constant"], "near_zero"), 4)


_CORRELATED = [*FLOW_FEATURES, "net", "constant"]
_CORR = f"""WITH {FLOW}, v AS (SELECT *, l_extendedprice * (1 - l_discount) AS net, 7.0::DOUBLE AS constant FROM flow)"""


def _with_net(spark, sf_dir):
    df = flows(spark, sf_dir)
    return df.withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount"))).withColumn("constant", F.lit(7.0))


def _corr_sql(a: str, b: str) -> str:
    return "NULL::DOUBLE" if "constant" in (a, b) else f"round(abs(corr({a}, {b})), 6)"


@query("correlation_matrix", _CORR + " " + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {_corr_sql(a, b)} AS abs_corr FROM v" + (" LIMIT 1" if "constant" in (a, b) else "")
    for a in _CORRELATED for b in _CORRELATED
).replace(" FROM v LIMIT 1", ""))
def correlation_matrix(spark, sf_dir):
    return rounded(selection.correlation_matrix(_with_net(spark, sf_dir), _CORRELATED))


def _corr_filter_sql() -> str:
    parts = []
    for j, c in enumerate(_CORRELATED):
        earlier = [_corr_sql(a, c) for a in _CORRELATED[:j] if "constant" not in (a, c)]
        top = f"greatest({', '.join(earlier)})" if earlier else "NULL::DOUBLE"
        parts.append(f"SELECT '{c}' AS feature, {top} AS max_earlier_corr" + (" FROM v" if earlier else ""))
    return f"{_CORR}, t AS ({' UNION ALL '.join(parts)}) SELECT *, coalesce(max_earlier_corr <= 0.95, true) AS kept FROM t"


@query("correlation_filter", _corr_filter_sql())
def correlation_filter(spark, sf_dir):
    return rounded(selection.correlation_filter(_with_net(spark, sf_dir), _CORRELATED))


@query("select_k_best", f"""WITH {FLOW}, long AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, label, count(*) AS n, avg({c}) AS m, var_pop({c}) AS v FROM flow GROUP BY label" for c in FLOW_FEATURES
) + """), g AS (SELECT feature, sum(n * m) / sum(n) AS gm, sum(n) AS total, count(*) AS k FROM long GROUP BY 1)
SELECT feature, round((sum(n * (m - gm) * (m - gm)) / (any_value(k) - 1)) / (sum(n * v) / (any_value(total) - any_value(k))), 4) AS f_value
FROM long JOIN g USING (feature) GROUP BY feature ORDER BY f_value DESC LIMIT 3""")
def select_k_best(spark, sf_dir):
    return rounded(selection.select_k_best(flows(spark, sf_dir), FLOW_FEATURES, "label", 3), 4)


@query("pca_reduce_two", f"""WITH {FLOW}, s AS (SELECT avg(l_quantity) AS mx, stddev_pop(l_quantity) AS sx, avg(l_extendedprice) AS my, stddev_pop(l_extendedprice) AS sy,
  CASE WHEN corr(l_quantity, l_extendedprice) < 0 THEN -1.0 ELSE 1.0 END AS side FROM flow),
z AS (SELECT row_id, (l_quantity - mx) / sx AS x, side * (l_extendedprice - my) / sy AS y FROM flow, s)
SELECT row_id, round(abs(x + y) / sqrt(2), 5) AS pc0, round(abs(x - y) / sqrt(2), 5) AS pc1 FROM z""")
def pca_reduce_two(spark, sf_dir):
    """Two scaled features: the components are the diagonals, the one along the correlation first, up to sign."""
    two = ["l_quantity", "l_extendedprice"]
    df = flows(spark, sf_dir)
    scaled = cleaning.standard_scaler_transform(df, cleaning.standard_scaler_fit(df, two))
    reduced = selection.pca_reduce(scaled, selection.pca_fit(scaled, two, 2))
    return rounded(reduced.select("row_id", *[F.abs(vector_to_array("pca")[i]).alias(f"pc{i}") for i in range(2)]), 5)


@query("pca_reduce")
def pca_reduce(spark, sf_dir):
    df = flows(spark, sf_dir)
    scaler = cleaning.standard_scaler_fit(df, FLOW_FEATURES)
    scaled = cleaning.standard_scaler_transform(df, scaler)
    model = selection.pca_fit(scaled, FLOW_FEATURES, 2)
    return rounded(selection.pca_reduce(scaled, model).select("row_id", *[vector_to_array("pca")[i].alias(f"pc{i}") for i in range(2)]))
