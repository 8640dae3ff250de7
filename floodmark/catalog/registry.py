"""Query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where one exists, its SQL."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column so that the order of summation does not show; -0.0 becomes 0.0."""
    return df.select(
        *[(F.round(c, digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )
