"""Approval gates and registry status rules (G1-G6) over a metrics table.

A metrics table has one row per evaluated model (or group) and one column
per metric. Gates are row-local expressions (no shuffle): the reasons array
is built with ``array_compact(array(when(...)))`` and ``approved`` is an
empty reasons array. Missing metrics read as 0.0, so a missing FPR, latency
or size passes, exactly as the original rules do. A metric that is NaN fails
its rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.functions import round_half_up
from pulsekit.schema import (
    ACTIVITY_GATE,
    ALERT_MODEL_TYPES,
    GLUCOSE_GATE,
    REGRESSION_MODEL_TYPES,
    RISK_GATE,
    SLEEP_GATE,
    STATUS_DEFAULT_FPR,
    STATUS_DEFAULT_MAE,
    STATUS_MAX_FPR,
    STATUS_MAX_MAE,
    STATUS_MIN_ACCURACY,
    STATUS_MIN_R2,
    STATUS_MIN_RECALL,
    GATE_MAX_FPR,
    GATE_MAX_LATENCY_P95_MS,
    GATE_MAX_SIZE_MB,
    GATE_MIN_PRECISION,
    GATE_MIN_RECALL,
)


class ClinicalThresholdViolation(Exception):
    """Raised by strict gates."""


def metric(df: DataFrame, *names: str, default: float | None = 0.0) -> Column:
    """First present, non-NULL metric among ``names`` (aliases), else ``default``."""
    cols = [F.col(n).cast("double") for n in names if n in df.columns]
    if default is not None:
        cols.append(F.lit(float(default)))
    if not cols:
        return F.lit(None).cast("double")
    return F.coalesce(*cols) if len(cols) > 1 else cols[0]


def at_least(value: Column, bound: float) -> Column:
    """Whether a metric reaches its bound. NaN never does (Spark itself ranks NaN above every number)."""
    return ~F.isnan(value) & (value >= bound)


def _fmt(x: Column, k: int) -> Column:
    return F.format_string(f"%.{k}f", round_half_up(x, k))


def approval_gate(df: DataFrame, on_device: bool = True) -> DataFrame:
    """G1: adds ``rejection_reasons`` (array<string>) and ``approved``."""
    recall = metric(df, "recall", "sensitivity")
    fpr = metric(df, "false_positive_rate", "fpr")
    precision = metric(df, "precision")
    checks = [
        F.when(~at_least(recall, GATE_MIN_RECALL), F.concat(F.lit("Recall ("), _fmt(recall, 3),
                                                   F.lit(f") is below the minimum of {GATE_MIN_RECALL:.2f}."))),
        F.when(fpr > GATE_MAX_FPR, F.concat(F.lit("False positive rate ("), _fmt(fpr, 3),
                                             F.lit(f") exceeds the maximum of {GATE_MAX_FPR:.2f}."))),
        F.when(~at_least(precision, GATE_MIN_PRECISION), F.concat(F.lit("Precision ("), _fmt(precision, 3),
                                                         F.lit(f") is below the minimum of {GATE_MIN_PRECISION:.2f}."))),
    ]
    if on_device:
        p95 = metric(df, "latency_p95_ms")
        size = metric(df, "size_mb")
        checks += [
            F.when(p95 > GATE_MAX_LATENCY_P95_MS, F.concat(F.lit("Latency p95 ("), _fmt(p95, 2),
                                                            F.lit(f" ms) exceeds the on-device budget of {GATE_MAX_LATENCY_P95_MS:.1f} ms."))),
            F.when(size > GATE_MAX_SIZE_MB, F.concat(F.lit("Model size ("), _fmt(size, 2),
                                                      F.lit(f" MB) exceeds the mobile limit of {GATE_MAX_SIZE_MB:.1f} MB."))),
        ]
    reasons = F.array_compact(F.array(*checks))
    return df.withColumn("rejection_reasons", reasons).withColumn("approved", F.size("rejection_reasons") == 0)


def require_approval(gated: DataFrame, key_cols: list[str]) -> None:
    """Strict mode: raise when any row is rejected.

    The message tells how many rows are rejected and shows the first 20 by key;
    all of them stay in ``gated``.
    """
    rejected = gated.where(~F.col("approved"))
    n = rejected.count()
    if n:
        first = rejected.select(*key_cols, "rejection_reasons").orderBy(*key_cols).limit(20).collect()
        lines = [f"{[r[k] for k in key_cols]}: " + "; ".join(r.rejection_reasons) for r in first]
        raise ClinicalThresholdViolation(f"{n} row(s) fail the approval gate:\n - " + "\n - ".join(lines))


# Per-model gates (thresholds in ``schema``).
def _device_gate(df: DataFrame, g: dict, accuracy_col: str) -> Column:
    return (at_least(metric(df, accuracy_col), g["min_accuracy"]) & (metric(df, "latency_p95_ms") < g["max_latency_p95_ms"])
            & (metric(df, "size_mb") < g["max_size_mb"]))


def sleep_gate(df: DataFrame, accuracy_col: str = "accuracy") -> Column:
    return _device_gate(df, SLEEP_GATE, accuracy_col)


def activity_gate(df: DataFrame, accuracy_col: str = "accuracy") -> Column:
    return _device_gate(df, ACTIVITY_GATE, accuracy_col)


def glucose_gate(df: DataFrame) -> Column:
    return (at_least(metric(df, "recall", "sensitivity"), GLUCOSE_GATE["min_recall"])
            & (metric(df, "false_positive_rate", "fpr") <= GLUCOSE_GATE["max_fpr"]))


def risk_gate(df: DataFrame) -> Column:
    return at_least(metric(df, "r2_score", "r2"), RISK_GATE["min_r2"])


METRIC_COLUMNS = ["recall", "sensitivity", "false_positive_rate", "fpr", "precision", "accuracy", "r2_score", "r2", "mae"]


def registry_status(df: DataFrame, type_col: str = "model_type", compat: bool = False) -> Column:
    """Staged / production / rejected from the model type and metrics.

    Default resolves metric aliases (false_positive_rate -> fpr, r2_score -> r2).
    ``compat=True`` reads only the literal keys fpr / r2 / mae, which makes
    every alert model without an 'fpr' key and every regressor rejected.
    """
    present = [c for c in METRIC_COLUMNS if c in df.columns]
    empty = F.lit(True)
    for c in present:
        empty = empty & F.col(c).isNull()
    recall = metric(df, "recall") if compat else metric(df, "recall", "sensitivity")
    fpr = (metric(df, "fpr", default=STATUS_DEFAULT_FPR) if compat
           else metric(df, "false_positive_rate", "fpr", default=STATUS_DEFAULT_FPR))
    acc = metric(df, "accuracy")
    r2 = metric(df, "r2") if compat else metric(df, "r2_score", "r2")
    mae = metric(df, "mae", default=STATUS_DEFAULT_MAE)
    t = F.col(type_col)
    alert_ok = (at_least(recall, STATUS_MIN_RECALL) & (fpr <= STATUS_MAX_FPR)) | at_least(acc, STATUS_MIN_ACCURACY)
    regression_ok = at_least(r2, STATUS_MIN_R2) | (mae <= STATUS_MAX_MAE)
    return (
        F.when(empty, F.lit("staged"))
        .when(t.isin(ALERT_MODEL_TYPES), F.when(alert_ok, F.lit("production")).otherwise("rejected"))
        .when(t.isin(REGRESSION_MODEL_TYPES), F.when(regression_ok, F.lit("production")).otherwise("rejected"))
        .otherwise(F.lit("staged"))
    )


def model_gate(df: DataFrame, rule: str) -> DataFrame:
    """One model's own gate in G1's form: adds ``rejection_reasons`` and ``approved``.

    ``rule``: ``on_device`` and ``backend`` (G1 with and without latency and size), ``sleep``,
    ``activity``, ``glucose`` or ``risk`` (G2-G5, whose reason is one sentence).
    """
    if rule in ("on_device", "backend"):
        return approval_gate(df, on_device=rule == "on_device")
    passed, reason = {
        "sleep": (sleep_gate(df), F.lit("Accuracy, latency or size of the sleep model is outside its budget.")),
        "activity": (activity_gate(df), F.lit("Accuracy, latency or size of the activity model is outside its budget.")),
        "glucose": (glucose_gate(df), F.lit("Recall or false positive rate of the glucose model is outside its budget.")),
        "risk": (risk_gate(df), F.concat(F.lit("R2 ("), _fmt(metric(df, "r2_score", "r2"), 3),
                                         F.lit(f") is below the minimum of {RISK_GATE['min_r2']:.2f}."))),
    }[rule]
    return df.withColumn("approved", passed).withColumn(
        "rejection_reasons", F.when(F.col("approved"), F.array().cast("array<string>")).otherwise(F.array(reason)))
