"""Independent DuckDB SQL for every registered query.

Written from the operator semantics (SURVEY §2), not from the Spark code.
Doubles are rounded with floor(x*10^k + 0.5)/10^k in both engines.
"""

from __future__ import annotations

VITALS_CTE = """
vitals AS (
  SELECT
    'PAT-' || CAST(user_id AS VARCHAR) AS patient_id,
    ts AS timestamp,
    50 + value / 2 AS hr_bpm,
    60 - value / 4 AS hrv_ms,
    100 - value / 20 AS spo2_percent,
    CAST((user_id * 37) % 1200 AS DOUBLE) AS elevation_meters,
    CAST(CASE WHEN hour(ts) >= 23 OR hour(ts) <= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_sleeping,
    CAST(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2
         WHEN 'signup' THEN 3 WHEN 'error' THEN 4 END AS INTEGER) AS activity_intensity,
    12 + value / 20 AS resp_rate,
    36.5 + value / 200 AS temp_c,
    110 + value / 4 AS bp_sys,
    70 + value / 8 AS bp_dia,
    value / 1000 AS movement_variance,
    (event_id % 7) / 10 AS accel_x,
    (event_id % 11) / 10 AS accel_y,
    (event_id % 13) / 10 AS accel_z,
    (event_id % 5) / 10 AS gyro_x,
    (event_id % 3) / 10 AS gyro_y,
    (event_id % 17) / 10 AS gyro_z,
    CAST(CASE WHEN hour(ts) >= 23 OR hour(ts) <= 6 THEN 1 + event_id % 4 ELSE 0 END AS INTEGER) AS sleep_stage,
    CAST(least(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2
         WHEN 'signup' THEN 3 WHEN 'error' THEN 4 END, 3) AS INTEGER) AS activity_class,
    CAST(value > 150 AS INTEGER) AS is_hr_anomaly,
    CAST(100 - value / 20 < 90 AS INTEGER) AS critical_spo2_drop,
    CAST(((60 - value / 4) < 24 AND (50 + value / 2) > 85 AND event_type = 'view'
          AND NOT (hour(ts) >= 23 OR hour(ts) <= 6)) OR event_id % 50 = 0 AS INTEGER) AS glucose_pattern_flag,
    floor(least(greatest(
        22 * greatest(0, (100 - (60 - value / 4)) / 80)
      + 35 * pow(greatest(0, (96 - (100 - value / 20)) / 10), 1.6)
      + 18 * (greatest(0, ((110 + value / 4) - 130) / 40) + greatest(0, ((70 + value / 8) - 85) / 25))
      + 20 * CAST(value > 150 AS INTEGER), 0), 100) * 100 + 0.5) / 100 AS risk_score_30d,
    user_id % 10 <> 0 AS consent_for_ml_training,
    'n' || CAST(user_id AS VARCHAR) AS name,
    'u' || CAST(user_id AS VARCHAR) || '@example.org' AS email
  FROM events
)"""


def R(expr: str, k: int) -> str:
    """Half-up rounding in SQL."""
    return f"floor(({expr}) * {10**k}.0 + 0.5) / {10**k}.0"


def R_any(expr: str, k: int) -> str:
    """The same for expressions that may be NaN, infinite or beyond 2^52 / 10^k, which stay as they are."""
    return f"CASE WHEN isnan({expr}) OR abs({expr}) >= {2.0**52 / 10**k!r} THEN {expr} ELSE {R(expr, k)} END"


def with_vitals(body: str, *extra_ctes: str) -> str:
    ctes = ",\n".join([VITALS_CTE, *extra_ctes])
    return f"WITH {ctes}\n{body}"
