"""Splits and samples in seeded hash order. No operator here sorts the table or limits it in one task."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.functions.scores import ANOMALY, NORMAL, flag_above
from floodmark.operators.profiling import is_benign
from floodmark.plans.ordering import (
    below_fraction,
    drawn,
    fraction_bound,
    grouped_hash_rank,
    hash_cuts,
    order_hash,
)

WEEK_US = 7 * 86_400_000_000


def benign_split(
    df: DataFrame, row_id: str, label: str = "label", test_fraction: float = 0.2, seed: int = 42, exact: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Train = benign rows; test = the held-out benign share plus all attacks.

    By default each row is decided by its own hash (a filter, no shuffle). ``exact`` holds out exactly
    ceil(test_fraction * n) benign rows; row ids must then be unique.
    """
    hashed, benign = order_hash(seed, row_id), is_benign(label)
    held_out = below_fraction(hashed, test_fraction)
    if exact:
        share = {"test": F.when(benign, hashed)}
        cuts = hash_cuts(df, share, lambda n: {"test": math.ceil(round(test_fraction * n["test"], 6))})
        held_out = drawn(hashed, cuts["test"])
    return df.filter(benign & ~held_out), df.filter(~benign | held_out)


def benign_split_by(
    df: DataFrame, group: str, row_id: str, label: str = "label", test_fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """Exact split inside each group (file); adds ``part``. A group with one benign row trains on it."""
    hashed = df.withColumn("_hash", order_hash(seed, row_id))
    ranked = grouped_hash_rank(hashed.filter(is_benign(label)), [group], "_hash")
    n_test = F.when(F.col("_size") > 1, F.ceil(F.round(F.col("_size") * test_fraction, 6))).otherwise(0)
    benign = ranked.withColumn("part", F.when(F.col("_rank") <= n_test, "test").otherwise("train"))
    attacks = hashed.filter(~is_benign(label)).withColumn("part", F.lit("test"))
    return benign.drop("_rank", "_size").unionByName(attacks).drop("_hash")


def balanced_sample(
    df: DataFrame, n: int, row_id: str, label: str = "label", seed: int = 42, ordered: bool = True
) -> DataFrame:
    """``n`` benign and ``n`` other rows without replacement; n shrinks to the smaller class."""
    benign, hashed = is_benign(label), order_hash(seed, row_id)
    sides = {"benign": F.when(benign, hashed), "other": F.when(~benign, hashed)}
    cuts = hash_cuts(df, sides, lambda sizes: dict.fromkeys(sizes, min(n, *sizes.values())))
    picked = df.filter((benign & drawn(hashed, cuts["benign"])) | (~benign & drawn(hashed, cuts["other"])))
    return picked.orderBy(row_id) if ordered else picked


def temporal_split(df: DataFrame, ts_us: str, normal: Column) -> DataFrame:
    """Weeks 1-2 train (normal rows only), week 3 validation, week 4 test, counted from the first row."""
    start = df.agg(F.min(ts_us)).first()[0]
    if start is None:
        return df.withColumn("part", F.lit(None).cast("string"))
    week = F.floor((F.col(ts_us) - F.lit(start)) / F.lit(WEEK_US))
    part = F.when((week < 2) & normal, "train").when(week == 2, "validation").when(week == 3, "test")
    return df.withColumn("part", part).filter("part is not null")


def contaminated_split(df: DataFrame, row_id: str, label: str = "label", seed: int = 42) -> DataFrame:
    """60/20/20 over normal rows; attacks make up 10 % of validation and of test, none of train."""
    hashed, benign = order_hash(seed, row_id), is_benign(label)
    eight = F.substring(hashed, 1, 8)
    normal_part = (
        F.when(eight < fraction_bound(0.6), "train").when(eight < fraction_bound(0.8), "validation").otherwise("test")
    )
    attack_side = F.when(eight < fraction_bound(0.5), "validation").otherwise("test")
    tagged = df.withColumn("part", F.when(benign, normal_part).otherwise(attack_side))
    parts = ("validation", "test")
    in_part = {p: F.col("part") == p for p in parts}
    draws = {f"normal {p}": F.when(benign & in_part[p], hashed) for p in parts}
    draws |= {p: F.when(~benign & in_part[p], hashed) for p in parts}
    cuts = hash_cuts(tagged, draws, lambda n: {p: n[f"normal {p}"] // 9 for p in parts} | {f"normal {p}": 0 for p in parts})
    keep = benign
    for p in parts:
        keep = keep | (~benign & in_part[p] & drawn(hashed, cuts[p]))
    return tagged.filter(keep)


def review_sample(scored: DataFrame, row_id: str, n_anomalies: int = 500, n_normals: int = 500, seed: int = 42) -> DataFrame:
    """Rows for hand labelling: predicted anomalies and predicted normals in hash order."""
    hashed, wanted = order_hash(seed, row_id), {ANOMALY: n_anomalies, NORMAL: n_normals}
    draws = {str(side): F.when(F.col("y_pred") == side, hashed) for side in wanted}
    cuts = hash_cuts(scored, draws, lambda _: {str(side): n for side, n in wanted.items()})
    keep = [(F.col("y_pred") == side) & drawn(hashed, cuts[str(side)]) for side in wanted]
    return scored.filter(keep[0] | keep[1])


def hybrid_route(
    df: DataFrame,
    row_id: str,
    detect: Callable[[DataFrame], DataFrame],
    rate: str = "rate",
    share: float = 0.1,
    max_rate: float = 100.0,
    seed: int = 42,
) -> DataFrame:
    """A hash share of the rows goes through ``detect`` (adds y_pred), the rest through the rate rule."""
    chosen = below_fraction(order_hash(seed, row_id), share)
    detected = detect(df.filter(chosen)).withColumn("decided_by", F.lit("detector"))
    ruled = df.filter(~chosen).withColumn("y_pred", flag_above(rate, max_rate)).withColumn("decided_by", F.lit("rule"))
    return detected.select(*df.columns, "y_pred", "decided_by").unionByName(ruled)


def _uniform(seed: str, row_id: str) -> Column:
    """A number in (0, 1) from the first 32 bits of the hash."""
    return (F.conv(F.substring(order_hash(seed, row_id), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(2.0**32)


def _index(seed: str, row_id: str, n: int) -> Column:
    return F.floor(_uniform(seed, row_id) * n).cast("int")


def inject_anomalies(
    df: DataFrame, columns: list[str], row_id: str, ratio: float = 0.1, sigma: float = 3.0, seed: int = 42
) -> DataFrame:
    """Turn three equal hash-drawn parts into anomalies: noise, two swapped features, one extreme feature.

    Parts may overlap and are applied in this order. Adds ``injected`` (0/1) and one flag per kind.
    """
    stats = df.agg(*[F.max(c).alias(c) for c in columns]).first()
    d = len(columns)
    hashes = {kind: order_hash(f"{seed}-{kind}", row_id) for kind in ("noise", "swap", "extreme")}
    cuts = hash_cuts(df, hashes, lambda n: {kind: int(rows * ratio) // 3 for kind, rows in n.items()})
    out = df.withColumns({f"is_{kind}": drawn(h, cuts[kind]).cast("int") for kind, h in hashes.items()})

    def gaussian(c: str) -> Column:
        radius = F.sqrt(-2.0 * F.log(_uniform(f"{seed}-u-{c}", row_id)))
        return F.lit(sigma) * radius * F.cos(F.lit(2 * math.pi) * _uniform(f"{seed}-v-{c}", row_id))

    out = out.withColumns(
        {c: F.when(F.col("is_noise") == 1, F.col(c) + gaussian(c)).otherwise(F.col(c).cast("double")) for c in columns}
    )
    if d > 1:
        swapped = F.col("is_swap") == 1
        out = out.withColumn("_i", F.when(swapped, _index(f"{seed}-i", row_id, d)))
        out = out.withColumn("_j", F.when(swapped, F.pmod(F.col("_i") + 1 + _index(f"{seed}-j", row_id, d - 1), F.lit(d))))
        values = F.array(*columns)
        out = out.withColumns(
            {
                c: F.when(F.col("_i") == k, F.get(values, F.col("_j")))
                .when(F.col("_j") == k, F.get(values, F.col("_i")))
                .otherwise(F.col(c))
                for k, c in enumerate(columns)
            }
        ).drop("_i", "_j")
    which = _index(f"{seed}-x", row_id, d)
    out = out.withColumns(
        {
            c: F.when((F.col("is_extreme") == 1) & (which == k), F.lit(10.0 * float(stats[c]))).otherwise(F.col(c))
            for k, c in enumerate(columns)
        }
    )
    return out.withColumn("injected", F.greatest("is_noise", "is_swap", "is_extreme"))
