"""Seeded hash order: the distributed stand-in for a seeded shuffle.

Every row gets ``md5(seed:row_id)``; taking rows in that order is a uniform draw without replacement
that does not depend on partitioning. Cuts are found from histograms of hash prefixes, so no sort of
the table and no single-task limit is needed.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floodmark.plans.sizing import SPREAD_BYTES, size_in_bytes, spread

DIGITS = 3
RESOLVE_ROWS = 10_000
RANK_ROWS = 1_000_000


def order_hash(seed: int | str, row_id: Column | str) -> Column:
    row_id = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")).cast("binary"))


def fraction_bound(fraction: float) -> str:
    """Eight hex digits ``b`` such that ``hash[:8] < b`` holds for ``fraction`` of all hashes."""
    return format(int(fraction * 0xFFFFFFFF), "08x")


def below_fraction(hashed: Column, fraction: float) -> Column:
    return F.substring(hashed, 1, 8) < F.lit(fraction_bound(fraction))


def hash_cuts(
    df: DataFrame, draws: dict[str, Column], sizes: Callable[[dict[str, int]], dict[str, int]]
) -> dict[str, str | None]:
    """For several draws at once: the hash of the last drawn row, "" to draw none, None to draw all.

    A draw is a hash column, null where the row does not take part. ``sizes`` maps the number of rows of
    each draw to the number wanted. One pass counts rows per prefix (at most 16**3 counters per draw);
    further passes descend into the prefixes holding the cuts until few rows share them. The hashes of a
    small table are kept between passes, those of a big one are computed again.
    """
    long = spread(df).select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("draw"), h.alias("h")) for n, h in draws.items()]))
    ).filter("h is not null")
    if size_in_bytes(df) >= SPREAD_BYTES:
        return _search_cuts(long, list(draws), sizes)
    long = long.persist()
    try:
        return _search_cuts(long, list(draws), sizes)
    finally:
        long.unpersist()


def _search_cuts(long: DataFrame, names: list[str], sizes: Callable[[dict[str, int]], dict[str, int]]) -> dict[str, str | None]:
    """``hash_cuts`` over rows (draw, h)."""
    prefix = dict.fromkeys(names, "")
    rank: dict[str, int] = {}
    cuts: dict[str, str | None] = {}
    width, first = 0, True
    searching = names
    while searching:
        width += DIGITS
        sought = F.lit(False)
        for n in searching:
            sought = sought | ((F.col("draw") == n) & F.col("h").startswith(prefix[n]))
        counted = long.filter(sought).groupBy("draw", F.substring("h", 1, width).alias("p")).count().collect()
        by_draw: dict[str, list[tuple[str, int]]] = {n: [] for n in searching}
        for r in counted:
            by_draw[r["draw"]].append((r["p"], r["count"]))
        if first:
            totals = {n: sum(c for _, c in by_draw[n]) for n in names}
            for n, wanted in sizes(totals).items():
                rank[n] = wanted
                if wanted <= 0:
                    cuts[n] = ""
                elif wanted >= totals[n]:
                    cuts[n] = None
            first = False
        few = []
        for n in [n for n in searching if n not in cuts]:
            for p, c in sorted(by_draw[n]):
                if rank[n] <= c:
                    prefix[n] = p
                    if len(p) >= 32:  # whole hashes: what is left are rows with one id, which no cut can part
                        if rank[n] != c:
                            raise ValueError(f"{c} rows share one id: a draw of an exact size needs distinct row ids")
                        cuts[n] = p
                    elif c <= RESOLVE_ROWS:
                        few.append(n)
                    break
                rank[n] -= c
        if few:
            inside = F.lit(False)
            for n in few:
                inside = inside | ((F.col("draw") == n) & F.col("h").startswith(prefix[n]))
            rows = long.filter(inside).groupBy("draw").agg(F.sort_array(F.collect_list("h")).alias("hs")).collect()
            cuts.update({r["draw"]: r["hs"][rank[r["draw"]] - 1] for r in rows})
        searching = [n for n in searching if n not in cuts]
    return cuts


def drawn(hashed: Column, cut: str | None) -> Column:
    """Rows that a cut of ``hash_cuts`` draws."""
    if cut is None:
        return hashed.isNotNull()
    return F.lit(False) if cut == "" else hashed <= F.lit(cut)


def take_in_hash_order(df: DataFrame, hashed: Column, n: int) -> DataFrame:
    """The ``n`` rows that come first in hash order (all rows when there are fewer)."""
    return df.filter(drawn(hashed, hash_cuts(df, {"all": hashed}, lambda _: {"all": n})["all"]))


def grouped_hash_rank(df: DataFrame, group: list[str], hashed: str, rank_rows: int = RANK_ROWS) -> DataFrame:
    """Add ``_rank`` (1-based, by hash within the group) and ``_size`` (rows of the group).

    When the largest group exceeds ``rank_rows`` all groups are split by hash prefix, so that one big
    group is ranked by many tasks.
    """
    largest = df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
    digits = max(0, math.ceil(math.log(max(largest, 1) / rank_rows, 16)))
    by_group = Window.partitionBy(*group)
    if digits == 0:
        return df.withColumns({"_rank": F.row_number().over(by_group.orderBy(hashed)), "_size": F.count("*").over(by_group)})
    pre = df.withColumn("_prefix", F.substring(hashed, 1, digits))
    counts = pre.groupBy(*group, "_prefix").agg(F.count("*").alias("_n"))
    running = by_group.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(g).alias(f"_o_{g}") for g in group],
        F.col("_prefix").alias("_o_prefix"),
        F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"),
        F.sum("_n").over(by_group).alias("_size"),
    )
    same = F.col("_prefix") == F.col("_o_prefix")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_o_{g}"))
    inner = Window.partitionBy(*group, "_prefix").orderBy(hashed)
    ranked = pre.join(offsets, same).withColumn("_rank", F.row_number().over(inner) + F.col("_before"))
    return ranked.drop("_prefix", "_before", "_o_prefix", *[f"_o_{g}" for g in group])
