"""Adapter view ``vitals`` over the ``events`` table.

No test table holds vitals, so every registered query starts from this
deterministic mapping (one narrow projection, no shuffle). The same mapping is
written in DuckDB SQL in ``pulsekit.plans.oracles.VITALS_CTE``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed mapping of event types to activity intensity (4 is invalid on purpose).
EVENT_INTENSITY = {"view": 0, "click": 1, "purchase": 2, "signup": 3, "error": 4}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _intensity_sql() -> str:
    whens = " ".join(f"WHEN '{name}' THEN {code}" for name, code in EVENT_INTENSITY.items())
    return f"CAST(CASE event_type {whens} END AS INT)"


def vitals_from_events(events: DataFrame, risk_offset: float = 0.0) -> DataFrame:
    """The adapter as Spark SQL expressions (parsed JVM-side in one call per projection).

    Two narrow projections, no shuffle; risk, glucose and desaturation labels
    follow the rules of ``operators.features`` (P15, P17, P18).
    """
    asleep = "CASE WHEN hour(ts) >= 23 OR hour(ts) <= 6 THEN 1 ELSE 0 END"
    base = events.selectExpr(
        "concat('PAT-', CAST(user_id AS STRING)) AS patient_id",
        "ts AS timestamp",
        "50 + value / 2 AS hr_bpm",
        "60 - value / 4 AS hrv_ms",
        "100 - value / 20 AS spo2_percent",
        "CAST((user_id * 37) % 1200 AS DOUBLE) AS elevation_meters",
        f"{asleep} AS is_sleeping",
        f"{_intensity_sql()} AS activity_intensity",
        "12 + value / 20 AS resp_rate",
        "36.5D + value / 200 AS temp_c",
        "110 + value / 4 AS bp_sys",
        "70 + value / 8 AS bp_dia",
        "value / 1000 AS movement_variance",
        "(event_id % 7) / 10 AS accel_x",
        "(event_id % 11) / 10 AS accel_y",
        "(event_id % 13) / 10 AS accel_z",
        "(event_id % 5) / 10 AS gyro_x",
        "(event_id % 3) / 10 AS gyro_y",
        "(event_id % 17) / 10 AS gyro_z",
        f"CAST(CASE WHEN {asleep} = 0 THEN 0 ELSE 1 + event_id % 4 END AS INT) AS sleep_stage",
        f"least({_intensity_sql()}, 3) AS activity_class",
        "CAST(value > 150 AS INT) AS is_hr_anomaly",
        "user_id % 10 <> 0 AS consent_for_ml_training",
        "concat('n', CAST(user_id AS STRING)) AS name",
        "concat('u', CAST(user_id AS STRING), '@example.org') AS email",
        "event_id",
    )
    risk_raw = (
        "greatest(0D, (100D - hrv_ms) / 80D) * 22D"
        " + pow(greatest(0D, (96D - spo2_percent) / 10D), 1.6D) * 35D"
        " + (greatest(0D, (bp_sys - 130D) / 40D) + greatest(0D, (bp_dia - 85D) / 25D)) * 18D"
        f" + CAST(is_hr_anomaly AS DOUBLE) * 20D + {float(risk_offset)!r}D"
    )
    return base.selectExpr(
        "*",
        "CAST(spo2_percent < 90D AS INT) AS critical_spo2_drop",
        "CAST((hrv_ms < 24D AND hr_bpm > 85D AND activity_intensity = 0 AND is_sleeping = 0) OR event_id % 50 = 0 "
        "AS INT) AS glucose_pattern_flag",
        f"CAST(floor(least(greatest({risk_raw}, 0D), 100D) * 100D + 0.5D) AS DOUBLE) / 100D AS risk_score_30d",
    ).drop("event_id")


def load_vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vitals_from_events(read_table(spark, sf_dir, "events"))
