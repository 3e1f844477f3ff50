"""Feature projections (P5-P12) and rule-derived labels.

All operators are narrow projections: no shuffle, fully inside whole-stage
codegen, and Catalyst prunes the parquet scan to the columns they touch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.functions import as_col, clip_keep_null, round_half_up
from pulsekit.schema import (
    ACTIVITY_CLASSES,
    COMBINED_FEATURES,
    GLUCOSE_FEATURES,
    HR_FEATURES,
    IMU_AXES,
    PHYSIO_CLIP,
    RISK_FEATURES,
    SPO2_FEATURES,
)


def _require(df: DataFrame, cols: list[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"Missing required feature column: {missing[0]}")


def _float_projection(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    _require(df, cols)
    keep = [c for c in (keep or []) if c in df.columns]
    return df.select(*keep, *[F.col(c).cast("float").alias(c) for c in cols])


def heart_rate_features(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P5: hr_bpm, hrv_ms, activity_intensity as float."""
    return _float_projection(df, HR_FEATURES, keep)


def spo2_features(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """spo2_percent, elevation_meters, is_sleeping as float."""
    return _float_projection(df, SPO2_FEATURES, keep)


def combined_vitals_features(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Six vitals as float."""
    return _float_projection(df, COMBINED_FEATURES, keep)


def sleep_features(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Per-row sleep features (names say 'avg' but values are per row)."""
    _require(df, ["hr_bpm", "hrv_ms"])
    keep = [c for c in (keep or []) if c in df.columns]
    mv = F.col("movement_variance").cast("float") if "movement_variance" in df.columns else F.lit(0.02).cast("float")
    return df.select(
        *keep,
        mv.alias("movement_variance"),
        F.col("hr_bpm").cast("float").alias("hr_avg"),
        F.col("hrv_ms").cast("float").alias("hrv_avg"),
        F.lit(480.0).cast("float").alias("duration_mins"),
    )


def activity_features(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Six IMU axes (absent -> 0.0) plus the acceleration magnitude."""
    keep = [c for c in (keep or []) if c in df.columns]
    axes = {
        c: (F.col(c).cast("float") if c in df.columns else F.lit(0.0).cast("float")) for c in IMU_AXES
    }
    ax, ay, az = (axes[c].cast("double") for c in ("accel_x", "accel_y", "accel_z"))
    mag = F.sqrt(ax * ax + ay * ay + az * az).cast("float")
    return df.select(*keep, *[v.alias(k) for k, v in axes.items()], mag.alias("accel_magnitude"))


def risk_features(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P10: eight vitals as float (a row projection, not a 30-day aggregate)."""
    return _float_projection(df, RISK_FEATURES, keep)


def glucose_features(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Four columns, types unchanged."""
    _require(df, GLUCOSE_FEATURES)
    keep = [c for c in (keep or []) if c in df.columns]
    return df.select(*keep, *GLUCOSE_FEATURES)


FEATURE_SETS = {
    "heart_rate": heart_rate_features,
    "spo2": spo2_features,
    "combined": combined_vitals_features,
    "sleep": sleep_features,
    "activity": activity_features,
    "risk": risk_features,
    "glucose": glucose_features,
}


def sleep_rows(df: DataFrame, min_rows: int = 50) -> DataFrame:
    """Keep sleeping rows; if fewer than ``min_rows`` exist, keep all rows.

    The probe reads at most ``min_rows`` matching rows (``limit`` stops early).
    """
    sleeping = df.filter(F.col("is_sleeping") == 1)
    if sleeping.limit(min_rows).count() < min_rows:
        return df
    return sleeping


# --- rule-derived columns ---------------------------------------------------

def physio_clip(df: DataFrame) -> DataFrame:
    """Clamp vitals into physiological bounds, NULL preserved."""
    return df.withColumns(
        {c: clip_keep_null(c, lo, hi) for c, (lo, hi) in PHYSIO_CLIP.items() if c in df.columns}
    )


def sleep_hour_flag(ts: str | Column) -> Column:
    """1 when the UTC hour is >= 23 or <= 6."""
    h = F.hour(as_col(ts))
    return F.when((h >= 23) | (h <= 6), 1).otherwise(0).cast("int")


def critical_spo2(spo2: str | Column = "spo2_percent") -> Column:
    """Desaturation label."""
    return (as_col(spo2) < 90.0).cast("int")


def autonomic_stress(hrv: str | Column = "hrv_ms") -> Column:
    return F.greatest(F.lit(0.0), (F.lit(100.0) - as_col(hrv)) / 80.0)


def hypoxia_factor(spo2: str | Column = "spo2_percent") -> Column:
    return F.pow(F.greatest(F.lit(0.0), (F.lit(96.0) - as_col(spo2)) / 10.0), F.lit(1.6))


def hemodynamic_stress(sys: str | Column = "bp_sys", dia: str | Column = "bp_dia") -> Column:
    return F.greatest(F.lit(0.0), (as_col(sys) - 130.0) / 40.0) + F.greatest(
        F.lit(0.0), (as_col(dia) - 85.0) / 25.0
    )


def risk_score_raw(offset: float = 0.0) -> Column:
    """P17 without rounding: weighted stress components plus a fixed offset."""
    return (
        autonomic_stress() * 22.0
        + hypoxia_factor() * 35.0
        + hemodynamic_stress() * 18.0
        + F.col("is_hr_anomaly").cast("double") * 20.0
        + F.lit(float(offset))
    )


def risk_score(offset: float = 0.0) -> Column:
    """Clipped to [0, 100], 2 dp (half-up rule)."""
    return round_half_up(clip_keep_null(risk_score_raw(offset), 0.0, 100.0), 2)


def glucose_rule() -> Column:
    """P18 (rule part): low HRV, raised HR, at rest and awake."""
    return (
        (F.col("hrv_ms") < 24.0)
        & (F.col("hr_bpm") > 85.0)
        & (F.col("activity_intensity") == 0)
        & (F.col("is_sleeping") == 0)
    )


def clip_prediction(c: str | Column, lo: float = 0.0, hi: float = 100.0) -> Column:
    """Regression output clipped to [0, 100]."""
    return clip_keep_null(c, lo, hi)


def threshold_positive(prob_col: str | Column, threshold: float = 0.35) -> Column:
    """P20: class 1 when p(1) >= threshold (``probability`` vector or a double)."""
    from pyspark.ml.functions import vector_to_array

    c = as_col(prob_col)
    return (vector_to_array(c)[1] >= threshold).cast("int")


def activity_name(idx: str | Column) -> Column:
    """Class index -> name (NULL outside 0..3)."""
    names = F.array(*[F.lit(n) for n in ACTIVITY_CLASSES])
    i = as_col(idx).cast("int")
    return F.when((i >= 0) & (i < len(ACTIVITY_CLASSES)), F.element_at(names, i + 1))


def derived_labels(df: DataFrame, offset: float = 0.0) -> DataFrame:
    """P13-P18 applied to a measurement table (after clipping)."""
    clipped = physio_clip(df)
    return clipped.select(
        "patient_id",
        "timestamp",
        sleep_hour_flag("timestamp").alias("sleep_flag"),
        critical_spo2().alias("critical_spo2"),
        round_half_up(autonomic_stress(), 6).alias("autonomic_stress"),
        round_half_up(hypoxia_factor(), 6).alias("hypoxia_factor"),
        round_half_up(hemodynamic_stress(), 6).alias("hemodynamic_stress"),
        risk_score(offset).alias("risk_score"),
        glucose_rule().cast("int").alias("glucose_rule"),
    )
