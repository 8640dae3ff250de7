"""Means and covariances of many columns in one pass, and sums of executor-made vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CODEGEN_COLUMNS = 8
DIRECT_NUMBERS = 2_000_000
#: Tasks of each level of a tree of sums.
TREE_LEVELS = (256, 8)


def sum_vectors(df: DataFrame, column: str, numbers: int | None = None) -> np.ndarray:
    """Element-wise sum of an array column.

    ``numbers`` is the known total length of all vectors; a small total is summed without a shuffle. Otherwise whole
    vectors are added in a tree, so what is shuffled is one row per vector and not one per number, and the driver
    gets the few vectors of the last level.
    """
    vectors = df.select(F.col(column).alias("s"))
    if numbers is None or numbers > DIRECT_NUMBERS:

        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for batch in batches:
                for v in batch["s"]:
                    total = np.array(v, dtype=float) if total is None else total + v
            if total is not None:
                yield pd.DataFrame({"s": [total]})

        for width in TREE_LEVELS:
            vectors = vectors.repartition(width).mapInPandas(add, "s array<double>")
    rows = [r[0] for r in vectors.collect()]
    return np.sum(rows, axis=0) if rows else np.zeros(0)


def mean_and_covariance(df: DataFrame, columns: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Row count, mean vector and population covariance. Only d + d*d numbers reach the driver."""
    d = len(columns)
    if d <= CODEGEN_COLUMNS:
        pairs = [(i, j) for i in range(d) for j in range(i, d)]
        row = df.agg(
            F.count("*").alias("n"),
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.covar_pop(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in pairs],
        ).first()
        mean = np.array([row[f"m{i}"] for i in range(d)], dtype=float)
        cov = np.zeros((d, d))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = row[f"c{i}_{j}"]
        return row["n"], mean, cov

    first = df.agg(F.count("*").alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    mean = np.array([first[f"m{i}"] for i in range(d)], dtype=float)

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((d, d))
        for batch in batches:
            x = batch.to_numpy(dtype=float) - mean
            total += x.T @ x
        yield pd.DataFrame({"p": [total.ravel()]})

    summed = sum_vectors(df.select(*columns).mapInPandas(products, "p array<double>"), "p")
    return first["n"], mean, summed.reshape(d, d) / first["n"]
