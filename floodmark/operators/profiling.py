"""Profiling aggregations: files, labels, missing and infinite values, feature statistics, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floodmark.plans.quantiles import exact_quantiles

BENIGN = "Benign"


def is_benign(label: str) -> Column:
    return F.col(label).eqNullSafe(F.lit(BENIGN))


def per_feature(df: DataFrame, features: list[str], stats: dict[str, callable]) -> DataFrame:
    """One aggregation pass over all features, one output row per feature with the named statistics."""
    wide = df.agg(*[make(f).alias(f"{name}_{i}") for i, f in enumerate(features) for name, make in stats.items()])
    rows = [
        F.struct(F.lit(f).alias("feature"), *[F.col(f"{name}_{i}").alias(name) for name in stats])
        for i, f in enumerate(features)
    ]
    return wide.select(F.inline(F.array(*rows)))


def profile_files(df: DataFrame) -> DataFrame:
    """Rows and bytes per source file, with the number of columns of the table."""
    n_columns = len([c for c in df.columns if c not in ("source_file", "source_path", "source_bytes")])
    return df.groupBy("source_file").agg(
        F.count("*").alias("n_rows"),
        F.max("source_bytes").alias("n_bytes"),
        F.lit(n_columns).alias("n_columns"),
    )


def dtype_census(df: DataFrame) -> dict[str, int]:
    census: dict[str, int] = {}
    for _, dtype in df.dtypes:
        census[dtype] = census.get(dtype, 0) + 1
    return census


def label_distribution(df: DataFrame, label: str = "label", group: str | None = None) -> DataFrame:
    """Count and percent per label, overall and (with ``group``) per group; Benign first, then by name."""
    if group is None:
        counts = df.groupBy(label).agg(F.count("*").alias("n")).withColumn("scope", F.lit("all"))
    else:
        counts = (
            df.groupingSets([[group, label], [label]], group, label)
            .agg(F.count("*").alias("n"), F.grouping(group).alias("g"))
            .withColumn("scope", F.when(F.col("g") == 1, "all").otherwise(F.col(group)))
        )
    share = 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("scope"))
    return counts.select("scope", F.col(label), "n", share.alias("pct")).orderBy("scope", ~is_benign(label), label)


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Benign and attack counts and shares, and the number of distinct attack labels."""
    benign = is_benign(label)
    return df.agg(
        F.count("*").alias("n_total"),
        F.count_if(benign).alias("n_benign"),
        F.count_if(~benign).alias("n_attack"),
        F.try_divide(100.0 * F.count_if(benign), F.count("*")).alias("benign_pct"),
        F.try_divide(100.0 * F.count_if(~benign), F.count("*")).alias("attack_pct"),
        F.count_distinct(F.when(~benign, F.col(label))).alias("n_attack_types"),
    )


def missing_profile(df: DataFrame, features: list[str]) -> DataFrame:
    """Null or NaN values per column (only columns that have any)."""
    types = dict(df.dtypes)

    def missing(c: str) -> Column:
        null = F.col(c).isNull()
        return F.count_if(null | F.isnan(c)) if types[c] in ("double", "float") else F.count_if(null)

    table = per_feature(df, features, {"n_missing": missing, "n_rows": lambda _: F.count("*")})
    return table.filter("n_missing > 0").select(
        "feature", "n_missing", (100.0 * F.col("n_missing") / F.col("n_rows")).alias("missing_pct")
    )


def infinite_profile(df: DataFrame, features: list[str]) -> DataFrame:
    """Positive or negative infinities per column (only columns that have any)."""
    infinite = {"n_infinite": lambda c: F.count_if(F.abs(F.col(c).cast("double")) == F.lit(float("inf")))}
    return per_feature(df, features, infinite).filter("n_infinite > 0")


def describe_features(df: DataFrame, features: list[str], full: bool = False) -> DataFrame:
    """Mean, sample deviation, minimum and maximum; ``full`` adds count and quartiles."""
    stats = {
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": lambda c: F.min(F.col(c).cast("double")),
        "max": lambda c: F.max(F.col(c).cast("double")),
    }
    if not full:
        return per_feature(df, features, stats)
    quartiles = exact_quantiles(df, {f: F.col(f) for f in features}, [0.25, 0.5, 0.75])
    stats = {"count": F.count, **stats}
    for i, name in enumerate(("p25", "p50", "p75")):
        stats[name] = lambda c, i=i: F.max(F.lit(quartiles[c][i]).cast("double"))
    return per_feature(df, features, stats)


def label_coverage(sample: DataFrame, full: DataFrame, label: str = "label") -> DataFrame:
    """Label counts of a sample beside the full set; ``missing`` marks labels the sample lost."""
    in_full = full.groupBy(label).agg(F.count("*").alias("full_n"))
    in_sample = sample.groupBy(F.col(label).alias("s_label")).agg(F.count("*").alias("sample_n"))
    joined = in_full.join(in_sample, F.col(label).eqNullSafe(F.col("s_label")), "left")
    return joined.select(
        label,
        "full_n",
        F.coalesce("sample_n", F.lit(0)).alias("sample_n"),
        F.col("sample_n").isNull().alias("missing"),
        (~is_benign(label)).alias("is_attack"),
    )


def missing_labels(sample: DataFrame, full: DataFrame, label: str = "label") -> DataFrame:
    """Labels of the full set that the sample does not contain."""
    return full.select(label).distinct().join(sample.select(label).distinct(), label, "left_anti")


def top_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """Attack labels by descending frequency."""
    counts = df.filter(~is_benign(label)).groupBy(label).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), label)
