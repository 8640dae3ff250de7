"""Evaluation. The positive class is the anomaly (-1); scores are high for anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floodmark.functions.scores import ANOMALY, NORMAL
from floodmark.plans.quantiles import exact_quantiles
from floodmark.plans.running import running_totals

CELLS = ["tn", "fp", "fn", "tp"]


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion_matrix(df: DataFrame, y: str = "y", y_pred: str = "y_pred", by: list[str] = ()) -> DataFrame:
    """The four cells, per ``by`` group if given."""
    truth, guess = F.col(y) == ANOMALY, F.col(y_pred) == ANOMALY
    cells = [
        F.count_if(~truth & ~guess).alias("tn"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"),
        F.count_if(truth & guess).alias("tp"),
    ]
    return df.groupBy(*by).agg(*cells) if by else df.agg(*cells)


def metric_columns() -> list[Column]:
    """Metrics over the cells; a zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in CELLS)
    return [
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio(fp, fp + tn).alias("fpr"),
        _ratio(tn, fp + tn).alias("tnr"),
    ]


def with_metrics(cells: DataFrame) -> DataFrame:
    return cells.select("*", *metric_columns())


def binary_metrics(df: DataFrame, y: str = "y", y_pred: str = "y_pred", by: list[str] = ()) -> DataFrame:
    return with_metrics(confusion_matrix(df, y, y_pred, by))


def classification_report(df: DataFrame, y: str = "y", y_pred: str = "y_pred") -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted averages in long form."""
    tn, fp, fn, tp = (F.col(c) for c in CELLS)
    total = tn + fp + fn + tp

    def line(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    a = (_ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(2 * tp, 2 * tp + fp + fn), tp + fn)
    n = (_ratio(tn, tn + fn), _ratio(tn, tn + fp), _ratio(2 * tn, 2 * tn + fp + fn), tn + fp)
    accuracy = _ratio(tp + tn, total)
    macro = [(x + z) / 2 for x, z in zip(a[:3], n[:3])]
    weighted = [_ratio(x * a[3] + z * n[3], total) for x, z in zip(a[:3], n[:3])]
    lines = F.array(
        line("anomaly", *a),
        line("normal", *n),
        line("accuracy", accuracy, accuracy, accuracy, total),
        line("macro avg", *macro, total),
        line("weighted avg", *weighted, total),
    )
    return confusion_matrix(df, y, y_pred).select(F.inline(lines))


def score_curve(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """Per distinct threshold (flag when score >= threshold): tp, fp, tpr, fpr, precision, recall."""
    per_score = df.filter(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(y) == ANOMALY).alias("pos"), F.count_if(F.col(y) == NORMAL).alias("neg")
    )
    curve, totals = running_totals(per_score, "threshold", ["pos", "neg"])
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    recall = _ratio(tp, F.lit(totals["pos"]))
    return curve.select(
        "threshold",
        "pos",
        "neg",
        tp.alias("tp"),
        fp.alias("fp"),
        recall.alias("tpr"),
        _ratio(fp, F.lit(totals["neg"])).alias("fpr"),
        _ratio(tp, tp + fp).alias("precision"),
        recall.alias("recall"),
    )


def roc_curve(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    return score_curve(df, y, score).select("threshold", "fpr", "tpr")


def pr_curve(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    return score_curve(df, y, score).select("threshold", "precision", "recall")


def roc_auc(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """Trapezoid area: each threshold adds neg * (tp before + pos / 2), so no neighbour row is needed."""
    curve = score_curve(df, y, score)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    return curve.agg(_ratio(area, F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))


def average_precision(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """Step-wise sum of recall gain times precision."""
    curve = score_curve(df, y, score)
    gain = F.sum(F.col("pos") * F.col("precision"))
    return curve.agg(_ratio(gain, F.sum("pos").cast("double")).alias("average_precision"))


def detection_at_fpr(df: DataFrame, limit: float = 0.01, y: str = "y", score: str = "score") -> DataFrame:
    """True-positive rate at the first curve point whose false-positive rate reaches ``limit``."""
    reached = score_curve(df, y, score).filter(F.col("fpr") >= limit)
    return reached.agg(
        F.max_by("tpr", "threshold").alias("tpr"),
        F.max_by("fpr", "threshold").alias("fpr"),
        F.max("threshold").alias("threshold"),
    )


def threshold_for_recall(df: DataFrame, target: float = 0.95, y: str = "y", score: str = "score") -> DataFrame:
    """The highest threshold whose recall reaches ``target``."""
    reached = score_curve(df, y, score).filter(F.col("recall") >= target)
    return reached.agg(
        F.max("threshold").alias("threshold"),
        F.max_by("recall", "threshold").alias("recall"),
        F.max_by("precision", "threshold").alias("precision"),
    )


def detection_by_attack(df: DataFrame, label: str = "label", y_pred: str = "y_pred") -> DataFrame:
    """Rows, flagged rows and flagged share per label (for Benign the share is the false-positive rate)."""
    flagged = F.col(y_pred) == ANOMALY
    return df.groupBy(label).agg(
        F.count("*").alias("n"),
        F.count_if(flagged).alias("n_flagged"),
        F.avg(flagged.cast("double")).alias("flagged_share"),
    )


def compare_models(metrics: DataFrame, requests: int = 0, attacks: int = 0) -> DataFrame:
    """Metrics table by descending F1 with ranks per metric, and the expected impact at a given load.

    ``blocked_legit`` = requests * FPR; ``avoided_attacks`` = attacks * recall.
    """
    # one row per model: a table bounded by the number of models
    def rank(column: Column) -> Column:
        return F.rank().over(Window.orderBy(column))

    return metrics.select(
        "*",
        rank(F.desc("f1")).alias("rank_f1"),
        rank(F.asc("fpr")).alias("rank_fpr"),
        rank(F.desc("recall")).alias("rank_recall"),
        rank(F.desc("throughput")).alias("rank_speed"),
        (F.lit(requests) * F.col("fpr")).alias("blocked_legit"),
        (F.lit(attacks) * F.col("recall")).alias("avoided_attacks"),
    ).orderBy(F.desc("f1"), "model")


def latency_summary(df: DataFrame, model: str = "model", latency_ms: str = "latency_ms") -> DataFrame:
    """Mean, p50/p95/p99 latency and rows per second for each model."""
    # one group per model, a null name included; equal latencies are counted, not listed
    ranks = F.percentile(latency_ms, F.array(*[F.lit(p) for p in (0.5, 0.95, 0.99)]))
    summed = df.groupBy(model).agg(
        F.count("*").alias("n"),
        F.avg(latency_ms).alias("mean_ms"),
        F.try_divide(1000.0 * F.count("*"), F.sum(latency_ms)).alias("throughput"),
        ranks.alias("_ranks"),
    )
    return summed.select("*", *[F.col("_ranks")[i].alias(p) for i, p in enumerate(("p50", "p95", "p99"))]).drop("_ranks")


def quality_over_time(df: DataFrame, ts_us: str = "ts_us", y: str = "y", y_pred: str = "y_pred", days: int = 7) -> DataFrame:
    """F1 per week and its change against the first week."""
    start = df.agg(F.min(ts_us)).first()[0] or 0
    week = F.floor((F.col(ts_us) - F.lit(start)) / F.lit(days * 86_400_000_000)).cast("long")
    weekly = binary_metrics(df.withColumn("week", week), y, y_pred, ["week"])
    # one row per week
    first = F.first("f1").over(Window.orderBy("week").rowsBetween(Window.unboundedPreceding, 0))
    return weekly.select("week", "precision", "recall", "f1", (F.col("f1") - first).alias("f1_change"))


def threshold_sweep(df: DataFrame, scores: list[str], thresholds: list[float], y: str = "y") -> DataFrame:
    """Metrics of every score column at every threshold, in one pass over the rows."""
    truth = F.col(y) == ANOMALY
    cells, lines = [], []
    for i, s in enumerate(scores):
        for k, t in enumerate(thresholds):
            guess = F.coalesce(F.col(s) > F.lit(t), F.lit(False))
            for cell, condition in zip(CELLS, (~truth & ~guess, ~truth & guess, truth & ~guess, truth & guess)):
                cells.append(F.count_if(condition).alias(f"{cell}_{i}_{k}"))
            lines.append(
                F.struct(
                    F.lit(s).alias("model"),
                    F.lit(float(t)).alias("threshold"),
                    *[F.col(f"{c}_{i}_{k}").alias(c) for c in CELLS],
                )
            )
    return with_metrics(df.agg(*cells).select(F.inline(F.array(*lines))))
