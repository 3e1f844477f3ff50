"""Measurement schema and the fixed values the operators must reproduce."""

from __future__ import annotations

from pyspark.sql import types as T

FEATURE_SCHEMA_VERSION = "1.0.0"

MEASUREMENT_SCHEMA = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("hr_bpm", T.DoubleType()),
        T.StructField("hrv_ms", T.DoubleType()),
        T.StructField("spo2_percent", T.DoubleType()),
        T.StructField("elevation_meters", T.DoubleType()),
        T.StructField("is_sleeping", T.IntegerType()),
        T.StructField("activity_intensity", T.IntegerType()),
        T.StructField("resp_rate", T.DoubleType()),
        T.StructField("temp_c", T.DoubleType()),
        T.StructField("bp_sys", T.DoubleType()),
        T.StructField("bp_dia", T.DoubleType()),
        T.StructField("movement_variance", T.DoubleType()),
        T.StructField("accel_x", T.DoubleType()),
        T.StructField("accel_y", T.DoubleType()),
        T.StructField("accel_z", T.DoubleType()),
        T.StructField("gyro_x", T.DoubleType()),
        T.StructField("gyro_y", T.DoubleType()),
        T.StructField("gyro_z", T.DoubleType()),
        T.StructField("sleep_stage", T.IntegerType()),
        T.StructField("activity_class", T.IntegerType()),
        T.StructField("is_hr_anomaly", T.IntegerType()),
        T.StructField("critical_spo2_drop", T.IntegerType()),
        T.StructField("glucose_pattern_flag", T.IntegerType()),
        T.StructField("risk_score_30d", T.DoubleType()),
        T.StructField("consent_for_ml_training", T.BooleanType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("device_mac", T.StringType()),
    ]
)

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference behaviour for right results).
# ---------------------------------------------------------------------------

# Column names removed as personal data.
PII_COLUMNS = [
    "name", "email", "phone", "ssn", "national_id", "ip_address",
    "device_mac", "address", "zip_code", "doctor_name", "hospital_id",
]

# Quality rules: column -> (min, max, required); bounds are inclusive.
RANGE_RULES = {
    "hr_bpm": (30.0, 240.0, True),
    "hrv_ms": (0.0, 300.0, True),
    "spo2_percent": (60.0, 100.0, True),
    "resp_rate": (4.0, 60.0, False),
    "temp_c": (30.0, 45.0, False),
    "bp_sys": (50.0, 260.0, False),
    "bp_dia": (30.0, 160.0, False),
}
# Allowed-set rule: column -> (allowed values, required).
ALLOWED_RULES = {
    "activity_intensity": ([0, 1, 2, 3], True),
}

# Physiological clip bounds applied to generated vitals.
PHYSIO_CLIP = {
    "hr_bpm": (32.0, 220.0),
    "hrv_ms": (2.0, 250.0),
    "spo2_percent": (65.0, 100.0),
    "resp_rate": (6.0, 50.0),
    "temp_c": (34.0, 42.0),
    "bp_sys": (70.0, 240.0),
    "bp_dia": (40.0, 150.0),
}

# Approval gate thresholds.
GATE_MIN_RECALL = 0.95
GATE_MAX_FPR = 0.05
GATE_MIN_PRECISION = 0.80
GATE_MAX_LATENCY_P95_MS = 5.0
GATE_MAX_SIZE_MB = 2.0

# Per-model gates: minimums use >=; latency and size maxima are strict (<); the glucose FPR maximum uses <=.
SLEEP_GATE = {"min_accuracy": 0.60, "max_latency_p95_ms": 10.0, "max_size_mb": 2.0}  # strict < for latency, size
ACTIVITY_GATE = {"min_accuracy": 0.85, "max_latency_p95_ms": 5.0, "max_size_mb": 2.0}  # strict < for latency, size
GLUCOSE_GATE = {"min_recall": 0.85, "max_fpr": 0.10}
RISK_GATE = {"min_r2": 0.75}

# Registry status rules.
ALERT_MODEL_TYPES = ["anomaly_detection", "critical_alert", "classifier"]
REGRESSION_MODEL_TYPES = ["regression", "risk_scoring", "continuous_prediction"]
STATUS_MIN_RECALL = 0.95
STATUS_MAX_FPR = 0.05
STATUS_MIN_ACCURACY = 0.85
STATUS_MIN_R2 = 0.80
STATUS_MAX_MAE = 10.0
STATUS_DEFAULT_FPR = 1.0
STATUS_DEFAULT_MAE = 999.0

# Drift thresholds.
DRIFT_P_VALUE = 0.05
DRIFT_PSI = 0.20
PSI_BUCKETS = 10
PSI_FLOOR = 1e-4

# Class names.
ACTIVITY_CLASSES = ["REST", "WALKING", "RUNNING", "HIGH_INTENSITY"]
SLEEP_STAGES = ["N1_LIGHT", "N2_CORE", "N3_DEEP", "REM"]

# Default dataset hash stored when none is given (SHA-256 of the empty string).
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"

# Artifact size budget in KB (inclusive).
ARTIFACT_BUDGET_KB = 2048.0

# Numeric vitals used by the feature projections.
HR_FEATURES = ["hr_bpm", "hrv_ms", "activity_intensity"]
SPO2_FEATURES = ["spo2_percent", "elevation_meters", "is_sleeping"]
COMBINED_FEATURES = ["hr_bpm", "spo2_percent", "resp_rate", "temp_c", "bp_sys", "bp_dia"]
IMU_AXES = ["accel_x", "accel_y", "accel_z", "gyro_x", "gyro_y", "gyro_z"]
RISK_FEATURES = [
    "hr_bpm", "hrv_ms", "spo2_percent", "resp_rate", "temp_c", "bp_sys", "bp_dia", "activity_intensity",
]
GLUCOSE_FEATURES = ["hr_bpm", "hrv_ms", "movement_variance", "temp_c"]
