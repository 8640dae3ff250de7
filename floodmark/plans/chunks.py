"""Time chunks: window functions over a hot key, cut into bounded pieces of time.

``overlap_chunks`` serves frames with a bounded look-back; ``lag_in_key`` serves previous-row look-ups
with no bound. Both give the result of a window partitioned by the key alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlap_chunks(df: DataFrame, ts_us: str, look_back_us: int, context: Column | None = None, ratio: int = 10) -> DataFrame:
    """Add ``_chunk`` and ``_copy``: rows near the end of a chunk are repeated as context of the next.

    Chunks last ``ratio`` look-backs, so about 1/ratio of the rows (those where ``context`` holds) are
    repeated. Windows partitioned by (key, _chunk) see their whole frame; drop ``_copy`` rows after.
    """
    size = F.lit(look_back_us * ratio)
    chunk = F.floor(F.col(ts_us) / size).cast("long")
    in_tail = (F.col(ts_us) - chunk * size) >= size - F.lit(look_back_us)
    repeat = in_tail if context is None else in_tail & context
    own, next_one = F.struct(chunk.alias("c"), F.lit(False).alias("k")), F.struct((chunk + 1).alias("c"), F.lit(True).alias("k"))
    spread = F.when(repeat, F.array(own, next_one)).otherwise(F.array(own))
    return df.withColumn("_e", F.explode(spread)).select(
        *df.columns, F.col("_e.c").alias("_chunk"), F.col("_e.k").alias("_copy")
    )


def lag_in_key(
    df: DataFrame, keys: list[str], ts_us: str, values: list[str], forward: bool = False, chunk_us: int = 86_400_000_000
) -> DataFrame:
    """Add ``_prev_<v>`` (or ``_next_<v>``): the values of the neighbouring row of the same key by time.

    Neighbours are found inside (key, chunk); only the edge row of each chunk crosses over, through a
    table of one row per key and chunk. Times must be unique within a key.
    """
    word = "next" if forward else "prev"
    chunked = df.withColumn("_chunk", F.floor(F.col(ts_us) / F.lit(chunk_us)).cast("long"))
    pick = F.min_by if forward else F.max_by
    edges = chunked.groupBy(*keys, "_chunk").agg(pick(F.struct(*values), F.col(ts_us)).alias("_edge"))
    by_key = Window.partitionBy(*keys).orderBy(F.col("_chunk").desc() if forward else F.col("_chunk"))
    edges = edges.select(
        *[F.col(k).alias(f"_e_{k}") for k in keys],
        F.col("_chunk").alias("_e_chunk"),
        F.lag("_edge").over(by_key).alias("_edge"),
    )
    same = F.col("_chunk") == F.col("_e_chunk")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_e_{k}"))
    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy(F.col(ts_us).desc() if forward else F.col(ts_us))
    joined = chunked.join(edges, same)
    neighbour = F.coalesce(F.lag(F.struct(*values)).over(in_chunk), F.col("_edge"))
    return joined.withColumn("_n", neighbour).select(
        *df.columns, *[F.col(f"_n.{v}").alias(f"_{word}_{v}") for v in values]
    )
