"""Feature selection and reduction."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.operators.cleaning import Scaler, standard_scaler_fit
from floodmark.operators.profiling import per_feature
from floodmark.plans.moments import mean_and_covariance


def variance_filter(df: DataFrame, columns: list[str], mode: str = "zero", near_zero: float = 1e-10) -> DataFrame:
    """Variance per feature and whether it is kept.

    ``zero`` drops a zero population variance; ``near_zero`` drops a sample variance below the bound.
    Pass a ``head_sample`` as ``df`` for statistics of the first rows only.
    """
    spread = F.var_pop if mode == "zero" else F.var_samp
    table = per_feature(df, columns, {"variance": spread})
    kept = F.col("variance") > 0 if mode == "zero" else F.col("variance") >= near_zero
    return table.withColumn("kept", F.coalesce(kept, F.lit(False)))


def kept_columns(report: DataFrame) -> list[str]:
    return [r["feature"] for r in report.filter("kept").collect()]


def correlation_pairs(df: DataFrame, columns: list[str]) -> dict[tuple[int, int], float]:
    _, _, cov = mean_and_covariance(df, columns)
    std = np.sqrt(np.diag(cov))
    pairs = {}
    for i in range(len(columns)):
        for j in range(len(columns)):
            scale = std[i] * std[j]
            pairs[i, j] = abs(float(cov[i, j] / scale)) if scale > 0 else None
    return pairs


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Absolute Pearson correlation of all feature pairs in long form; null for a constant feature."""
    rows = [(columns[i], columns[j], r) for (i, j), r in correlation_pairs(df, columns).items()]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, abs_corr double")


def correlation_filter(df: DataFrame, columns: list[str], limit: float = 0.95) -> DataFrame:
    """Drop a column that correlates above ``limit`` with any earlier column, dropped or not."""
    pairs = correlation_pairs(df, columns)
    rows = []
    for j, c in enumerate(columns):
        earlier = [pairs[i, j] for i in range(j) if pairs[i, j] is not None]
        highest = max(earlier, default=None)
        rows.append((c, highest, highest is None or highest <= limit))
    return df.sparkSession.createDataFrame(rows, "feature string, max_earlier_corr double, kept boolean")


def select_k_best(df: DataFrame, columns: list[str], label: str, k: int = 20) -> DataFrame:
    """The ``k`` features with the largest one-way ANOVA F against the label."""
    groups = df.groupBy(label).agg(
        F.count("*").alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(columns)],
    )
    entries = [
        F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("m"), F.col(f"v{i}").alias("v"))
        for i, c in enumerate(columns)
    ]
    long = groups.select("n", F.inline(F.array(*entries)))
    sums = long.groupBy("feature").agg(
        F.count("*").alias("groups"),
        F.sum("n").alias("total"),
        F.sum(F.col("n") * F.col("m")).alias("s1"),
        F.sum(F.col("n") * F.col("m") * F.col("m")).alias("s2"),
        F.sum(F.col("n") * F.col("v")).alias("within"),
    )
    between = F.col("s2") - F.col("s1") * F.col("s1") / F.col("total")
    f_value = F.try_divide(between / (F.col("groups") - 1), F.col("within") / (F.col("total") - F.col("groups")))
    return sums.select("feature", f_value.alias("f_value")).orderBy(F.desc_nulls_last("f_value"), "feature").limit(k)


def pca_fit(df: DataFrame, columns: list[str], k: int = 20) -> tuple[Scaler, PCAModel]:
    """Centre on the train means, then fit principal components."""
    centre = standard_scaler_fit(df, columns)
    return centre, PCA(k=min(k, len(columns)), inputCol="_x", outputCol="pca").fit(_centred(df, centre))


def _centred(df: DataFrame, centre: Scaler) -> DataFrame:
    shifted = df.withColumns({f"_c_{i}": F.col(c) - F.lit(m) for i, (c, m) in enumerate(zip(centre.columns, centre.mean))})
    inputs = [f"_c_{i}" for i in range(len(centre.columns))]
    return VectorAssembler(inputCols=inputs, outputCol="_x").transform(shifted).drop(*inputs)


def pca_reduce(df: DataFrame, model: tuple[Scaler, PCAModel]) -> DataFrame:
    """Project on the fitted components; adds the vector column ``pca``."""
    centre, pca = model
    return pca.transform(_centred(df, centre)).drop("_x")


def explained_variance(spark: SparkSession, model: tuple[Scaler, PCAModel]) -> DataFrame:
    shares = [(i + 1, float(v)) for i, v in enumerate(model[1].explainedVariance)]
    return spark.createDataFrame(shares, "component int, share double")
