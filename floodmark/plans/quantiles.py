"""Exact quantiles (linear interpolation) without a per-value map of a whole column.

Small inputs use the built-in ``percentile``. Bigger ones bracket each order statistic with
``percentile_approx`` and count the rows around the bracket; every pass shrinks the bracket by a factor
of about a thousand and peels heavy ties off at its ends. One pass serves all columns together.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.plans.sizing import size_in_bytes

SMALL_BYTES = 64 << 20
SMALL_ROWS = 1_000_000
RESOLVE_ROWS = 20_000
ACCURACY = 10_000


@dataclass
class _Target:
    column: str
    rank: int
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    inside: int = 0
    value: float | None = None

    def interior(self) -> Column:
        c = F.col(self.column)
        return F.when((c > F.lit(self.low)) & (c < F.lit(self.high)), c)


def _order_statistics(df: DataFrame, targets: list[_Target], resolve_rows: int) -> None:
    while True:
        open_targets = [t for t in targets if t.value is None and t.inside > resolve_rows]
        if not open_targets:
            break
        brackets = []
        for i, t in enumerate(open_targets):
            q = (t.rank - t.below) / max(t.inside - 1, 1)
            step = 2.0 / ACCURACY
            probes = [max(0.0, q - step), min(1.0, q + step)]
            brackets.append(
                F.percentile_approx(t.interior(), F.array(*map(F.lit, probes)), F.lit(ACCURACY)).alias(f"b{i}")
            )
        bounds = df.agg(*brackets).first()
        counts = []
        for i, t in enumerate(open_targets):
            a, b = (F.lit(float(v)) for v in bounds[f"b{i}"])
            c = t.interior()
            counts += [
                F.count_if(c < a).alias(f"l{i}"),
                F.count_if(c == a).alias(f"a{i}"),
                F.count_if((c > a) & (c < b)).alias(f"m{i}"),
                F.count_if((c == b) & (a != b)).alias(f"e{i}"),
                F.count_if(c > b).alias(f"h{i}"),
            ]
        seen = df.agg(*counts).first()
        for i, t in enumerate(open_targets):
            a, b = (float(v) for v in bounds[f"b{i}"])
            left = t.rank - t.below
            for size, low, high, value in (
                (seen[f"l{i}"], t.low, a, None),
                (seen[f"a{i}"], a, a, a),
                (seen[f"m{i}"], a, b, None),
                (seen[f"e{i}"], b, b, b),
                (seen[f"h{i}"], b, t.high, None),
            ):
                if left < size:
                    t.value = value
                    t.low, t.high, t.inside = low, high, size
                    break
                left -= size
                t.below += size
    rest = [t for t in targets if t.value is None]
    if rest:
        picks = [
            F.element_at(F.sort_array(F.collect_list(t.interior())), t.rank - t.below + 1).alias(f"v{i}")
            for i, t in enumerate(rest)
        ]
        row = df.agg(*picks).first()
        for i, t in enumerate(rest):
            t.value = row[f"v{i}"]


def exact_quantiles(
    df: DataFrame,
    columns: dict[str, Column],
    probs: list[float],
    small_bytes: int = SMALL_BYTES,
    small_rows: int = SMALL_ROWS,
    resolve_rows: int = RESOLVE_ROWS,
) -> dict[str, list[float | None]]:
    """Quantiles of finite-or-infinite doubles per named column; null and NaN are ignored."""
    names = {name: f"q{i}" for i, name in enumerate(columns)}
    values = df.select(
        *[F.when(~F.isnan(e.cast("double")), e.cast("double")).alias(names[n]) for n, e in columns.items()]
    )
    direct = size_in_bytes(values) <= small_bytes
    sizes = None
    if not direct:
        sizes = values.agg(*[F.count(c).alias(c) for c in names.values()]).first()
        direct = max(sizes) <= small_rows
    if direct:
        row = values.agg(
            *[F.percentile(c, F.array(*[F.lit(float(p)) for p in probs])).alias(c) for c in names.values()]
        ).first()
        return {n: list(row[c]) if row[c] is not None else [None] * len(probs) for n, c in names.items()}

    # +-inf lies outside every open bracket, so it is counted apart and resolved by rank
    edges = values.agg(
        *[F.count_if(F.col(c) == F.lit(-math.inf)).alias(f"n_{c}") for c in names.values()],
        *[F.count_if(F.col(c) == F.lit(math.inf)).alias(f"p_{c}") for c in names.values()],
    ).first()
    targets: dict[tuple[str, int], _Target] = {}
    for c in names.values():
        n, minus, plus = sizes[c], edges[f"n_{c}"], edges[f"p_{c}"]
        for p in probs:
            for rank in {math.floor((n - 1) * p), math.ceil((n - 1) * p)} if n else ():
                t = _Target(c, rank, below=minus, inside=n - minus - plus)
                if rank < minus:
                    t.value = -math.inf
                elif rank >= n - plus:
                    t.value = math.inf
                targets[c, rank] = t
    _order_statistics(values, list(targets.values()), resolve_rows)
    result: dict[str, list[float | None]] = {}
    for name, c in names.items():
        n = sizes[c]
        picked: list[float | None] = []
        for p in probs:
            if not n:
                picked.append(None)
                continue
            at = (n - 1) * p
            low, high = targets[c, math.floor(at)].value, targets[c, math.ceil(at)].value
            picked.append(low if low == high else low + (high - low) * (at - math.floor(at)))
        result[name] = picked
    return result


def exact_quantile(df: DataFrame, column: Column | str, prob: float) -> float | None:
    column = F.col(column) if isinstance(column, str) else column
    return exact_quantiles(df, {"x": column}, [prob])["x"][0]
