"""Reliable staging: cut lineage by writing a table to the shared checkpoint folder.

A staged table survives the loss of any executor, is columnar, and is read back with pruning
and push-down, so iterative fits and multi-pass statistics read it instead of re-running the plan.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from floodmark.plans.sizing import spread

CHECKPOINT_KEY = "spark.checkpoint.dir"
_kept: list[str] = []
#: Of a thread: paths staged within its innermost ``scratch``.
_own = threading.local()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a local folder only for a local master."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    root = tempfile.mkdtemp(prefix="floodmark-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and return the written table; small tables are spread over all cores."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    spread(df).write.parquet(path)
    _kept.append(path)
    if getattr(_own, "paths", None) is not None:
        _own.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """``stage`` for the length of a block (partitioned as given); for fits whose result does not depend on it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Deletes what this thread stages in a block, and the shuffle files that nothing refers to any more; the function given is a ``stage`` that lasts."""
    outer, mine = getattr(_own, "paths", None), []
    _own.paths = mine

    def keep(df: DataFrame, name: str = "stage") -> DataFrame:
        _own.paths = outer
        try:
            return stage(df, name)
        finally:
            _own.paths = mine

    try:
        yield keep
    finally:
        _own.paths = outer
        for path in mine:
            _kept.remove(path)
            _delete(spark, path)
        spark._jvm.System.gc()  # Spark's cleaner deletes the shuffle files of plans that were collected


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def purge_staged(spark: SparkSession) -> None:
    """Delete the tables this process staged; results that still read them must have been written before."""
    while _kept:
        _delete(spark, _kept.pop())
