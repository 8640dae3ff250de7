"""Make the package importable in Python workers of a running session."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors (once per application)."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "floodmark"), "zip", ROOT, "floodmark")
        context.addPyFile(archive)
        # the driver-side worker of stateful Python streams reads PYTHONPATH only
        known = context.environment.get("PYTHONPATH")
        context.environment["PYTHONPATH"] = os.pathsep.join([archive, known] if known else [archive])
        _shipped.add(context.applicationId)
