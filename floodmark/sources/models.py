"""Model tables: every fitted model is one small Parquet table with its scaler, threshold and columns."""

from __future__ import annotations

import json
from dataclasses import asdict, fields, is_dataclass

from pyspark.sql import SparkSession


def save_model(spark: SparkSession, model, path: str) -> None:
    """Write a model dataclass as (part, value) rows; bounded by the size of the model, never by the data."""
    assert is_dataclass(model)
    rows = [("kind", json.dumps(type(model).__name__))] + [(k, json.dumps(v)) for k, v in asdict(model).items()]
    spark.createDataFrame(rows, "part string, value string").coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str, kinds: list[type]):
    """Read a model table back into the matching dataclass of ``kinds``."""
    parts = {r["part"]: json.loads(r["value"]) for r in spark.read.parquet(path).collect()}
    kind = next(k for k in kinds if k.__name__ == parts["kind"])
    return kind(**{f.name: parts[f.name] for f in fields(kind)})


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def model_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions ``v=<number>`` under ``path``."""
    files, target = _folder(spark, path)
    if not files.exists(target):
        return []
    names = [(s.getPath(), s.getPath().getName()) for s in files.listStatus(target)]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(n[2:]) for p, n in names if n.startswith("v=") and files.exists(done(p, "_SUCCESS")))


def drop_versions(spark: SparkSession, path: str, below: int) -> None:
    files, target = _folder(spark, path)
    for v in model_versions(spark, path):
        if v < below:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(target, f"v={v}"), True)
