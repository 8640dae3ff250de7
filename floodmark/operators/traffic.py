"""Windowed traffic aggregations. Times are epoch microseconds; batch and stream share the aggregates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floodmark.plans.chunks import overlap_chunks

SECOND_US = 1_000_000
#: Slots of a look-back; divides a second's microseconds.
SLOTS = 100
#: Windows of a source that one task sums up together, as a multiple of the windows that hold one pane.
CHUNK = 16


def trailing_rate(df: DataFrame, source: str = "src", ts_us: str = "ts_us", seconds: int = 60) -> DataFrame:
    """Per event: requests of the same source in the preceding ``seconds`` (inclusive) and the per-second rate.

    The look-back is cut into slots. Whole slots come from counts per (source, slot); only in its own slot and in
    the slot where its look-back begins is an event compared with other events. So a flood from one source is counted by
    as many tasks as it has slots, whatever number of rows a second of it holds.
    """
    span = seconds * SECOND_US
    size = span // SLOTS
    own_slot, begin = F.floor(F.col(ts_us) / F.lit(size)).cast("long"), F.col(ts_us) - F.lit(span)
    in_slot = Window.partitionBy(source, "_slot")
    so_far = in_slot.orderBy(ts_us).rangeBetween(Window.unboundedPreceding, 0)
    own = df.withColumn("_slot", own_slot).withColumn("_own", F.count("*").over(so_far))
    counts = own.groupBy(source, "_slot").agg(F.count("*").alias("_n")).withColumn("_start", F.col("_slot") * F.lit(size))
    # an event stands in its own slot to be counted, and in the slot where its look-back begins to ask
    places = F.array(
        F.struct(F.col("_slot").alias("slot"), F.col(ts_us).alias("t"), F.lit(1).alias("real")),
        F.struct((F.col("_slot") - F.lit(SLOTS)).alias("slot"), begin.alias("t"), F.lit(0).alias("real")),
    )
    both = own.withColumn("_e", F.explode(places)).withColumn("_home", F.col("_slot")).withColumns({"_slot": F.col("_e.slot"), "_t": F.col("_e.t")})
    later = in_slot.orderBy("_t").rangeBetween(0, Window.unboundedFollowing)
    edged = both.withColumn("_edge", F.sum("_e.real").over(later)).filter("_e.real = 0")
    between = Window.partitionBy(source, "_chunk").orderBy("_slot").rangeBetween(1 - SLOTS, -1)
    filled = overlap_chunks(counts, "_start", span).withColumn("_between", F.coalesce(F.sum("_n").over(between), F.lit(0)))
    filled = filled.filter(~F.col("_copy")).select(F.col(source).alias("_f_source"), F.col("_slot").alias("_f_slot"), "_between")
    joined = edged.join(filled, F.col(source).eqNullSafe(F.col("_f_source")) & (F.col("_home") == F.col("_f_slot")))
    recent = F.col("_own") + F.col("_edge") + F.col("_between")
    return joined.select(*df.columns, recent.alias("recent_requests"), (recent / F.lit(float(seconds))).alias("rate"))


def request_partials(payload: str = "payload", status: str = "status") -> list[Column]:
    """Additive pieces of the window features, mergeable across panes and paths."""
    hundred = F.floor(F.col(status) / 100)
    return [
        F.count("*").alias("n"),
        F.count_if(hundred == 2).alias("n_2xx"),
        F.count_if(hundred == 4).alias("n_4xx"),
        F.count_if(hundred == 5).alias("n_5xx"),
        F.sum(payload).alias("payload_sum"),
        F.count(payload).alias("payload_n"),
    ]


PARTIALS = ["n", "n_2xx", "n_4xx", "n_5xx", "payload_sum", "payload_n"]


def window_ratios(size_seconds: int) -> list[Column]:
    """The final window features over summed partials."""
    return [
        F.col("n").alias("request_count"),
        (F.col("n") / F.lit(float(size_seconds))).alias("request_rate"),
        "unique_paths",
        *[(F.col(f"n_{k}xx") / F.col("n")).alias(f"share_{k}xx") for k in (2, 4, 5)],
        F.try_divide("payload_sum", "payload_n").alias("mean_payload"),
    ]


def traffic_window(
    df: DataFrame, size_seconds: int, slide_seconds: int | None = None, source: str = "src",
    ts_us: str = "ts_us", path: str = "path",
) -> DataFrame:
    """Per source and window: count, rate, unique paths, status shares, mean payload.

    Events are first merged per (pane, source, path), pane = greatest common divisor of size and slide; only those
    merged rows are repeated over the windows that hold the pane, so a busy source is reduced before any shuffle by source.
    """
    slide = (slide_seconds or size_seconds) * SECOND_US
    size = size_seconds * SECOND_US
    step = math.gcd(size, slide)
    pane = F.floor(F.col(ts_us) / F.lit(step)).cast("long")
    merged = df.groupBy(source, path, pane.alias("_pane")).agg(*request_partials())
    start = F.col("_pane") * F.lit(step)
    first = F.ceil((start + F.lit(step - size)) / F.lit(slide)).cast("long")
    last = F.floor(start / F.lit(slide)).cast("long")
    windows = F.filter(F.sequence(first, F.greatest(first, last)), lambda w: w <= last)  # none where windows leave gaps
    spread = merged.withColumn("window_start_us", F.explode(F.transform(windows, lambda w: w * F.lit(slide))))
    sums = [F.sum(c).alias(c) for c in PARTIALS]
    if step != size or step != slide:
        spread = spread.groupBy(source, "window_start_us", path).agg(*sums)
    totals = spread.groupBy(source, "window_start_us").agg(*sums, F.count(path).alias("unique_paths"))
    return totals.select(source, "window_start_us", *window_ratios(size_seconds))


def pane_us(size_seconds: int, slide_seconds: int) -> int:
    return math.gcd(size_seconds, slide_seconds) * SECOND_US


def pane_windows(size_seconds: int, slide_seconds: int) -> tuple[Column, Column]:
    """Numbers of the first and the last window that hold ``_pane``; window k starts at k times the slide. First > last where windows leave gaps."""
    step, size, slide = pane_us(size_seconds, slide_seconds), size_seconds * SECOND_US, slide_seconds * SECOND_US
    start = F.col("_pane") * F.lit(step)
    first = F.ceil((start + F.lit(step - size)) / F.lit(slide)).cast("long")
    return first, F.floor(start / F.lit(slide)).cast("long")


def windows_of_panes(
    panes: DataFrame, size_seconds: int, slide_seconds: int, after_us: int, until_us: int, source: str = "src", path: str = "path",
) -> DataFrame:
    """The windows of ``traffic_window`` that end after ``after_us`` and not after ``until_us``, from one row per (source, path, ``_pane``).

    A path counts once in a window, at its first pane there, so every row is told from which window on its path is new. Rows of
    alike panes and news are summed over the paths; only then is a row repeated over its windows, in the task that holds all
    rows of the source for a chunk of windows, so no row per window is shuffled and a busy source is reduced before it meets.
    """
    size, slide = size_seconds * SECOND_US, slide_seconds * SECOND_US
    chunk = CHUNK * -(-size // slide)
    first, last = pane_windows(size_seconds, slide_seconds)
    open_first, open_last = F.lit((after_us - size) // slide + 1).cast("long"), F.lit((until_us - size) // slide).cast("long")
    held = panes.withColumns({"_first": F.greatest(first, open_first), "_last": F.least(last, open_last)}).filter("_first <= _last")
    chunks = F.sequence(F.floor(F.col("_first") / chunk).cast("long"), F.floor(F.col("_last") / chunk).cast("long"))
    parts = held.withColumn("_chunk", F.explode(chunks)).withColumns({
        "_first": F.greatest("_first", F.col("_chunk") * chunk), "_last": F.least("_last", (F.col("_chunk") + 1) * chunk - 1),
    })
    before = F.lag("_last").over(Window.partitionBy(source, path, "_chunk").orderBy("_pane"))
    told = parts.withColumn("_new", F.least(F.greatest("_first", before + 1), F.col("_last") + 1))
    sums = [F.sum(c).alias(c) for c in PARTIALS]
    alike = told.groupBy(source, "_chunk", "_first", "_last", "_new").agg(*sums, F.count(path).alias("_paths"))
    spread = alike.repartition(source, "_chunk").withColumn("_w", F.explode(F.sequence("_first", "_last")))
    unique = F.sum(F.when(F.col("_w") >= F.col("_new"), F.col("_paths")).otherwise(0)).alias("unique_paths")
    totals = spread.groupBy(source, "_chunk", "_w").agg(*sums, unique)
    return totals.select(source, (F.col("_w") * F.lit(slide)).alias("window_start_us"), *window_ratios(size_seconds))


def temporal_profile(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Requests by hour and weekday (Sunday = 0) and the deviation from the usual count of that hour."""
    counts = df.groupBy(F.hour(ts).alias("hour"), (F.dayofweek(ts) - 1).alias("day_of_week")).agg(
        F.count("*").alias("n")
    )
    by_hour = Window.partitionBy("hour")
    usual = F.avg("n").over(by_hour)
    spread = F.stddev_pop("n").over(by_hour)
    return counts.select(
        "hour",
        "day_of_week",
        "n",
        usual.alias("usual_n"),
        F.coalesce(F.try_divide(F.col("n") - usual, spread), F.lit(0.0)).alias("deviation"),
    )
