"""Cleaning, imputation, clipping and scaling. Statistics come from one pass over all columns."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.plans.quantiles import exact_quantiles
from floodmark.plans.sketches import stored_quantiles

# Columns that identify a flow rather than describe its behaviour.
NON_FEATURES = ["Label", "Timestamp", "Dst Port", "Protocol"]
# The public flow layout, in column order.
STANDARD_COLUMNS = [
    "Dst Port", "Protocol", "Timestamp", "Flow Duration", "Tot Fwd Pkts", "Tot Bwd Pkts",
    "TotLen Fwd Pkts", "TotLen Bwd Pkts", "Fwd Pkt Len Max", "Fwd Pkt Len Min", "Fwd Pkt Len Mean",
    "Fwd Pkt Len Std", "Bwd Pkt Len Max", "Bwd Pkt Len Min", "Bwd Pkt Len Mean", "Bwd Pkt Len Std",
    "Flow Byts/s", "Flow Pkts/s", "Flow IAT Mean", "Flow IAT Std", "Flow IAT Max", "Flow IAT Min",
    "Fwd IAT Tot", "Fwd IAT Mean", "Fwd IAT Std", "Fwd IAT Max", "Fwd IAT Min", "Bwd IAT Tot",
    "Bwd IAT Mean", "Bwd IAT Std", "Bwd IAT Max", "Bwd IAT Min", "Fwd PSH Flags", "Bwd PSH Flags",
    "Fwd URG Flags", "Bwd URG Flags", "Fwd Header Len", "Bwd Header Len", "Fwd Pkts/s", "Bwd Pkts/s",
    "Pkt Len Min", "Pkt Len Max", "Pkt Len Mean", "Pkt Len Std", "Pkt Len Var", "FIN Flag Cnt",
    "SYN Flag Cnt", "RST Flag Cnt", "PSH Flag Cnt", "ACK Flag Cnt", "URG Flag Cnt", "CWE Flag Count",
    "ECE Flag Cnt", "Down/Up Ratio", "Pkt Size Avg", "Fwd Seg Size Avg", "Bwd Seg Size Avg",
    "Fwd Byts/b Avg", "Fwd Pkts/b Avg", "Fwd Blk Rate Avg", "Bwd Byts/b Avg", "Bwd Pkts/b Avg",
    "Bwd Blk Rate Avg", "Subflow Fwd Pkts", "Subflow Fwd Byts", "Subflow Bwd Pkts", "Subflow Bwd Byts",
    "Init Fwd Win Byts", "Init Bwd Win Byts", "Fwd Act Data Pkts", "Fwd Seg Size Min", "Active Mean",
    "Active Std", "Active Max", "Active Min", "Idle Mean", "Idle Std", "Idle Max", "Idle Min", "Label",
]


def drop_leaked_headers(df: DataFrame, label: str = "Label") -> DataFrame:
    """Remove header lines that leaked into the data; a missing label is kept."""
    return df.filter(~F.col(label).eqNullSafe(F.lit(label)))


def count_leaked_headers(df: DataFrame, label: str = "Label") -> DataFrame:
    return df.agg(F.count_if(F.col(label) == label).alias("n_leaked"))


def union_standard(frames: list[DataFrame], columns: list[str]) -> DataFrame:
    """Concatenate files of differing layouts and keep the standard columns that exist, in list order."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.select(*[F.col(f"`{c}`") for c in columns if c in merged.columns])


def to_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast text columns to double; text that is no number becomes null."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast("double") for c in columns})


def feature_columns(df: DataFrame, drop: list[str] = NON_FEATURES) -> list[str]:
    """Numeric columns that are features. Freeze the list at train time and reuse it for scoring."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in drop]


def finite_or_null(c: Column | str) -> Column:
    c = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def clean_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Infinite, NaN and null values become 0."""
    return df.withColumns({c: F.coalesce(finite_or_null(c), F.lit(0.0)) for c in columns})


@dataclass
class Medians:
    columns: list[str]
    values: list[float]


def median_fit(df: DataFrame, columns: list[str]) -> Medians:
    found = exact_quantiles(df, {c: finite_or_null(c) for c in columns}, [0.5])
    return Medians(list(columns), [found[c][0] for c in columns])


def median_refresh(sketches: DataFrame, columns: list[str]) -> Medians:
    """``median_fit`` from stored sketches of ``finite_or_null`` columns: merges days, reads no row again."""
    return Medians(list(columns), [q[0] for q in stored_quantiles(sketches, columns, [0.5])])


def median_fill(df: DataFrame, medians: Medians) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(finite_or_null(c), F.lit(v)) for c, v in zip(medians.columns, medians.values)}
    )


def impute_median(fit_df: DataFrame, df: DataFrame, columns: list[str], mode: str = "train") -> DataFrame:
    """Infinite, NaN and null values become the column median of ``fit_df``; ``mode='own'`` uses ``df``."""
    return median_fill(df, median_fit(df if mode == "own" else fit_df, columns))


@dataclass
class ClipRange:
    columns: list[str]
    low: list[float]
    high: list[float]


def clip_fit(df: DataFrame, columns: list[str], low: float = 0.001, high: float = 0.999) -> ClipRange:
    found = exact_quantiles(df, {c: F.col(c) for c in columns}, [low, high])
    return ClipRange(list(columns), [found[c][0] for c in columns], [found[c][1] for c in columns])


def clip_refresh(sketches: DataFrame, columns: list[str], low: float = 0.001, high: float = 0.999) -> ClipRange:
    """``clip_fit`` from stored sketches."""
    found = stored_quantiles(sketches, columns, [low, high])
    return ClipRange(list(columns), [q[0] for q in found], [q[1] for q in found])


def clip_apply(df: DataFrame, limits: ClipRange) -> DataFrame:
    def cut(c: str, a: float, b: float) -> Column:
        return F.when(F.col(c) < F.lit(a), F.lit(a)).when(F.col(c) > F.lit(b), F.lit(b)).otherwise(F.col(c))

    return df.withColumns({c: cut(c, a, b) for c, a, b in zip(limits.columns, limits.low, limits.high)})


def clip_quantiles(fit_df: DataFrame, df: DataFrame, columns: list[str], low: float = 0.001, high: float = 0.999) -> DataFrame:
    """Cap every column at quantiles of ``fit_df`` (the train rows, or ``df`` itself)."""
    return clip_apply(df, clip_fit(fit_df, columns, low, high))


@dataclass
class Scaler:
    columns: list[str]
    mean: list[float]
    std: list[float]


def standard_scaler_fit(df: DataFrame, columns: list[str]) -> Scaler:
    """Mean and population deviation per column in one pass; a zero deviation divides by 1."""
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    mean = [row[f"m{i}"] or 0.0 for i in range(len(columns))]
    return Scaler(list(columns), mean, [row[f"s{i}"] or 1.0 for i in range(len(columns))])


def standard_scaler_transform(df: DataFrame, scaler: Scaler) -> DataFrame:
    return df.withColumns(
        {c: (F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in zip(scaler.columns, scaler.mean, scaler.std)}
    )
