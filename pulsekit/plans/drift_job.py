"""Drift job -- read reference and current tables, compare, write the report, return the verdict."""

from __future__ import annotations

from pyspark.sql import SparkSession

from pulsekit.operators import drift
from pulsekit.sources.io import read_measurements, write_json


def run_drift_check(
    spark: SparkSession,
    reference_path: str,
    current_path: str,
    report_output: str,
    features: list[str] | None = None,
    alerts_output: str | None = None,
) -> dict:
    """Compare two measurement tables; write per-feature rows and the summary as JSON.

    Missing inputs raise when Spark resolves the path, on whichever file system it is
    (the original silently compared simulated data).
    Outputs are tiny (one row per feature), so they are written as single files.
    """
    ref = read_measurements(spark, reference_path)
    cur = read_measurements(spark, current_path)
    per, summary = drift.check_drift(ref, cur, features)
    per = per.cache()
    try:
        write_json(per.coalesce(1), f"{report_output.rstrip('/')}/features")
        write_json(summary.coalesce(1), f"{report_output.rstrip('/')}/summary")
        if alerts_output:
            write_json(drift.alert_rows(summary).coalesce(1), alerts_output, mode="append")
        out = summary.first().asDict()
        out["feature_metrics"] = {r.feature: {"ks_statistic": r.ks_statistic, "p_value": r.p_value, "psi": r.psi,
                                              "drift_detected": r.drift_detected} for r in per.collect()}
        return out
    finally:
        per.unpersist()
