"""Span lists of scanned texts and the digests of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:int,end:int>>"
Span = tuple[str, int, int]


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def digest(found: DataFrame, kinds: tuple[str, ...], base: Column, spans: Column) -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans as text; ``base`` and ``spans`` are sorted."""
    named = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(named) - F.size(F.array_remove(named, k))).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select(
        F.col("_id").alias("doc_id"), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans")
    )
