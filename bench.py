"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is fully materialised with the ``noop`` sink (every row computed,
nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulsekit import get_spark  # noqa: E402
from pulsekit.plans.catalog import load_all  # noqa: E402

HEADLINE = [
    "quality_report",
    "quarantine",
    "anonymized",
    "audit_counts",
    "derived_labels",
    "scaler_robust",
    "scaled_robust",
    "patient_split",
    "split_rows",
    "auc_vitals",
    "binary_metrics_rule",
    "latency_summary",
    "drift_report_shifted",
    "resample_15min_linear",
    "approval_gate",
    "registry_latest",
    "dataset_fingerprint",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", app_name="pulsekit-bench", shuffle_partitions=int(cpus) * 2,
                      extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load_all()
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_time",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "input_rows": n_events,
        "rows_per_sec": round(n_events * len(names) / total, 1) if total else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
