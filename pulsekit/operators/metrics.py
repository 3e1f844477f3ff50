"""Evaluation metrics as aggregates.

Each metric is one aggregate (optionally grouped with ``by``): partial
aggregation per task, so they scale with the data. Rank AUC uses the
running sums of ``ordered`` (exact, ties counted as 1/2), never a
binned approximation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.functions import round_half_up, safe_ratio
from pulsekit.operators.ordered import quantile_columns, ranged, running_totals, value_totals


def _label(c: str):
    """Labels as doubles: only 0 and 1 themselves are classes, so 0.9, NaN or NULL is neither."""
    return F.col(c).cast("double")


def confusion(df: DataFrame, y_true: str, y_pred: str, by: list[str] | None = None) -> DataFrame:
    """Tn, fp, fn, tp over labels {0, 1}; rows with other labels are ignored."""
    by = by or []
    t, p = _label(y_true), _label(y_pred)
    aggs = [
        F.count_if((t == 0) & (p == 0)).alias("true_negatives"),
        F.count_if((t == 0) & (p == 1)).alias("false_positives"),
        F.count_if((t == 1) & (p == 0)).alias("false_negatives"),
        F.count_if((t == 1) & (p == 1)).alias("true_positives"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def classification_metrics(df: DataFrame, y_true: str, y_pred: str, by: list[str] | None = None) -> DataFrame:
    """Recall, precision, specificity, FPR, F1 (4 dp) plus the confusion counts."""
    by = by or []
    c = confusion(df, y_true, y_pred, by)
    tp, fp, fn, tn = (F.col(x) for x in ("true_positives", "false_positives", "false_negatives", "true_negatives"))
    recall = safe_ratio(tp, tp + fn)
    precision = safe_ratio(tp, tp + fp)
    f1 = safe_ratio(2 * precision * recall, precision + recall)
    return c.select(
        *by,
        round_half_up(recall, 4).alias("recall"),
        round_half_up(precision, 4).alias("precision"),
        round_half_up(safe_ratio(tn, tn + fp), 4).alias("specificity"),
        round_half_up(safe_ratio(fp, fp + tn), 4).alias("false_positive_rate"),
        round_half_up(f1, 4).alias("f1_score"),
        "true_positives",
        "false_positives",
        "true_negatives",
        "false_negatives",
    )


def accuracy(df: DataFrame, y_true: str, y_pred: str, by: list[str] | None = None) -> DataFrame:
    """Fraction of equal labels (4 dp) among the rows that have both, and ``n_samples``, their number."""
    by = by or []
    same = (F.col(y_true) == F.col(y_pred)).cast("double")  # NULL unless both are there
    aggs = [F.avg(same).alias("__acc"), F.count(same).alias("n_samples")]
    out = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return out.select(*by, round_half_up("__acc", 4).alias("accuracy"), "n_samples")


def regression_metrics(df: DataFrame, y_true: str, y_pred: str, by: list[str] | None = None) -> DataFrame:
    """MSE, R2, RMSE (4 dp). Constant target: R2 = 1 when predictions are exact, else 0.

    Every term is over the same rows, those with both values; ``n_samples`` is their number.
    NaN or an infinite value among them makes the metrics NaN or infinite: it is not hidden.
    """
    by = by or []
    y, p = F.col(y_true).cast("double"), F.col(y_pred).cast("double")
    both = y.isNotNull() & p.isNotNull()
    y = F.when(both, y)
    err = (y - p) * (y - p)
    aggs = [
        F.avg(err).alias("__mse"),
        F.sum(err).alias("__ssr"),
        (F.var_pop(y) * F.count(y)).alias("__sst"),
        F.count(y).alias("n_samples"),
    ]
    out = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    r2 = (
        F.when(F.isnan("__ssr"), F.col("__ssr")).when(F.col("__sst") == 0, F.when(F.col("__ssr") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(F.lit(1.0) - F.col("__ssr") / F.col("__sst"))
    )
    return out.select(
        *by,
        round_half_up("__mse", 4).alias("mse"),
        round_half_up(r2, 4).alias("r2_score"),
        round_half_up(F.sqrt("__mse"), 4).alias("rmse"),
        "n_samples",
    )


def rank_auc(
    df: DataFrame, y_true: str, score: str, by: list[str] | None = None, n_ranges: int | None = None
) -> DataFrame:
    """P(score of a positive > score of a negative), ties count 1/2 (exact).

    Rows are first reduced to one row per (group, score) with positive and
    negative counts; the running negative count then comes from
    ``ordered.running_totals``. AUC is NULL (omitted) unless both classes occur.
    """
    by = by or []
    t = _label(y_true)
    s = F.col(score).cast("double")
    per_score = (
        df.where(s.isNotNull() & ~F.isnan(s) & t.isin(0.0, 1.0))
        .groupBy(*by, s.alias("__s"))
        .agg(F.count_if(t == 1).alias("__pos"), F.count_if(t == 0).alias("__neg"))
    )
    cum = running_totals(ranged(per_score, by, ["__s"], n_ranges), by, ["__s"], ["__neg"])
    # 2 * pos * (neg strictly below + neg tied / 2), kept in exact integers.
    twice = F.col("__pos") * (2 * (F.col("cum___neg") - F.col("__neg")) + F.col("__neg"))
    agg = cum.groupBy(*by).agg(
        F.sum(twice.cast("decimal(38,0)")).alias("__num2"),
        F.sum("__pos").alias("n_pos"),
        F.sum("__neg").alias("n_neg"),
    )
    auc = F.when(
        (F.col("n_pos") > 0) & (F.col("n_neg") > 0),
        F.col("__num2").cast("double") / (F.lit(2.0) * F.col("n_pos").cast("double") * F.col("n_neg").cast("double")),
    )
    return agg.select(*by, round_half_up(auc, 4).alias("auc_roc"), "n_pos", "n_neg")


def latency_summary(df: DataFrame, ms_col: str, by: list[str] | None = None) -> DataFrame:
    """Mean, p95, p99, min, max of timing rows (ms, 3 dp, exact percentiles; NULL and NaN left out)."""
    by = by or []
    v, n = F.col("__v"), F.col("__n")
    out = value_totals(df, ms_col, by).groupBy(*by).agg(
        F.try_divide(F.sum(v * n), F.sum(n)).alias("__mean"),
        F.array(*quantile_columns("__v", "__n", [0.95, 0.99])).alias("__p"),
        F.min(v).alias("__min"),
        F.max(v).alias("__max"),
    )
    return out.select(
        *by,
        round_half_up("__mean", 3).alias("latency_mean_ms"),
        round_half_up(F.col("__p")[0], 3).alias("latency_p95_ms"),
        round_half_up(F.col("__p")[1], 3).alias("latency_p99_ms"),
        round_half_up("__min", 3).alias("latency_min_ms"),
        round_half_up("__max", 3).alias("latency_max_ms"),
    )


def anomaly_fraction(df: DataFrame, label: str, lo: float = 0.04, hi: float = 0.12) -> DataFrame:
    """Mean of the label clamped to [lo, hi] (the contamination estimate)."""
    return df.agg(F.least(F.greatest(F.avg(F.col(label).cast("double")), F.lit(lo)), F.lit(hi)).alias("contamination"))


def run_counts(df: DataFrame, id_col: str = "patient_id") -> DataFrame:
    """Distinct patients and sample count."""
    return df.agg(F.count_distinct(id_col).alias("patient_count"), F.count(F.lit(1)).alias("sample_count"))
