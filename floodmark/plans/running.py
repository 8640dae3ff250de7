"""Running totals over a global order, computed by range buckets instead of one task."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floodmark.plans.staging import stage

#: Distinct values of one window task.
ROWS_PER_BUCKET = 1_000_000


def running_totals(
    df: DataFrame, order: str, sums: list[str], buckets: int | None = None, descending: bool = True
) -> tuple[DataFrame, dict[str, float]]:
    """Add ``cum_<c>`` for each column of ``sums``, accumulated along ``order`` (a distinct double).

    Also returns the grand totals.

    The table is cut into about equal ranges of ``order``; each range is accumulated by its own task and
    shifted by the totals of the ranges before it. ``buckets`` follows the number of rows: ROWS_PER_BUCKET of
    them in each, at least 16 and at most 8192 ranges (rows of totals on the driver).
    """
    table = stage(df, "running")
    if buckets is None:
        buckets = int(min(8192, max(16, table.count() // ROWS_PER_BUCKET)))
    cuts = table.agg(
        F.percentile_approx(
            order, F.array(*[F.lit(i / buckets) for i in range(1, buckets)]), F.lit(max(10_000, 8 * buckets))
        ).alias("c")
    ).first()["c"]
    splits = [float("-inf"), *sorted({float(c) for c in cuts or []} - {float("-inf"), float("inf")}), float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol=order, outputCol="_bucket").transform(table)
    bucketed = bucketed.withColumn("_bucket", F.col("_bucket").cast("int"))
    totals = {
        row["_bucket"]: row
        for row in bucketed.groupBy("_bucket").agg(*[F.sum(c).alias(c) for c in sums]).collect()
    }
    sequence = range(len(splits) - 1)
    offsets: dict[str, list[float]] = {c: [0] * len(sequence) for c in sums}
    carry = dict.fromkeys(sums, 0)
    for b in reversed(sequence) if descending else sequence:
        for c in sums:
            offsets[c][b] = carry[c]
            if b in totals:
                carry[c] += totals[b][c]
    ordering = F.col(order).desc() if descending else F.col(order).asc()
    within = Window.partitionBy("_bucket").orderBy(ordering).rowsBetween(Window.unboundedPreceding, 0)
    shifted = [
        (F.sum(c).over(within) + F.element_at(F.array(*map(F.lit, offsets[c])), F.col("_bucket") + 1)).alias(f"cum_{c}")
        for c in sums
    ]
    return bucketed.select(*df.columns, *shifted), carry
