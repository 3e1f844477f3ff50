"""Registered queries (Spark) and their DuckDB oracles.

Every query reads the driver tables (through the ``vitals`` adapter over
``events``, or ``labels`` / ``documents`` directly) so its work grows with the
data. Each callable takes (spark, sf_dir) and returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsekit.functions import round_half_up
from pulsekit.operators import features as fx
from pulsekit.operators import privacy, quality
from pulsekit.plans.catalog import register
from pulsekit.plans.oracles import R, with_vitals
from pulsekit.schema import ALLOWED_RULES, PHYSIO_CLIP, RANGE_RULES
from pulsekit.sources.adapter import load_vitals, read_table

# Fixed salt so the pseudonymised output is comparable with the oracle.
QUERY_SALT = "pulsekit-fixed-salt:"

DOUBLE_VITALS = [
    "hr_bpm", "hrv_ms", "spo2_percent", "elevation_meters", "resp_rate", "temp_c", "bp_sys", "bp_dia",
    "movement_variance", "accel_x", "accel_y", "accel_z", "gyro_x", "gyro_y", "gyro_z", "risk_score_30d",
]


# ---------------------------------------------------------------------------
# Quality (A1-A7)
# ---------------------------------------------------------------------------

def _quality_oracle_body(by: str = "") -> tuple[str, str]:
    k = f"{by}, " if by else ""
    aggs = ["count(*) FILTER (WHERE patient_id IS NULL) AS id_nulls"]
    rows = [f"SELECT {k}'patient_id' AS column_name, 'not_null' AS check_name, "
            "CASE WHEN id_nulls > 0 THEN 'error' ELSE 'ok' END AS severity, id_nulls AS violations, '' AS detail FROM a"]
    for i, (c, (lo, hi, _r)) in enumerate(RANGE_RULES.items()):
        miss = f"({c} IS NULL OR isnan({c}))"
        aggs += [
            f"count(*) FILTER (WHERE {miss}) AS r{i}_null",
            f"count(*) FILTER (WHERE NOT {miss} AND {c} < {lo}) AS r{i}_lo",
            f"count(*) FILTER (WHERE NOT {miss} AND {c} > {hi}) AS r{i}_hi",
        ]
        for chk, alias, sev in ((f"nulls", f"r{i}_null", "warning"), (f"below_min_{lo:g}", f"r{i}_lo", "error"),
                                (f"above_max_{hi:g}", f"r{i}_hi", "error")):
            rows.append(f"SELECT {k}'{c}', '{chk}', CASE WHEN {alias} > 0 THEN '{sev}' ELSE 'ok' END, {alias}, '' FROM a")
    for j, (c, (allowed, _r)) in enumerate(ALLOWED_RULES.items()):
        allowed_sql = ", ".join(str(a) for a in allowed)
        aggs += [
            f"count(*) FILTER (WHERE {c} IS NULL) AS s{j}_null",
            f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({allowed_sql})) AS s{j}_bad",
            f"coalesce(array_to_string(list_sort(list_distinct(list({c}) FILTER (WHERE {c} NOT IN ({allowed_sql})))), ','), '') AS s{j}_vals",
        ]
        rows.append(f"SELECT {k}'{c}', 'nulls', CASE WHEN s{j}_null > 0 THEN 'warning' ELSE 'ok' END, s{j}_null, '' FROM a")
        rows.append(f"SELECT {k}'{c}', 'allowed_set', CASE WHEN s{j}_bad > 0 THEN 'error' ELSE 'ok' END, s{j}_bad, "
                    f"s{j}_vals FROM a")
    group = f" GROUP BY {by}" if by else ""
    cte = "a AS (SELECT " + k + ",\n  ".join(aggs) + " FROM vitals" + group + ")"
    return cte, "\nUNION ALL\n".join(rows)


_QCTE, _QBODY = _quality_oracle_body()


@register("quality_report", with_vitals(_QBODY, _QCTE))
def q_quality_report(spark, sf_dir):
    return quality.quality_report(load_vitals(spark, sf_dir))


_QCTE_BY, _QBODY_BY = _quality_oracle_body("patient_id")


@register("quality_report_by_patient", with_vitals(_QBODY_BY, _QCTE_BY))
def q_quality_report_by_patient(spark, sf_dir):
    return quality.quality_report(load_vitals(spark, sf_dir), by=["patient_id"])


@register(
    "quality_verdict",
    with_vitals(
        "SELECT count(*) FILTER (WHERE severity = 'error') AS error_count, "
        "count(*) FILTER (WHERE severity = 'warning') AS warning_count, "
        "count(*) FILTER (WHERE severity = 'error') = 0 AS success FROM r",
        _QCTE,
        f"r AS ({_QBODY})",
    ),
)
def q_quality_verdict(spark, sf_dir):
    return quality.quality_verdict(quality.quality_report(load_vitals(spark, sf_dir)))


_VITAL_COLS = [
    "patient_id", "timestamp", "hr_bpm", "hrv_ms", "spo2_percent", "elevation_meters", "is_sleeping",
    "activity_intensity", "resp_rate", "temp_c", "bp_sys", "bp_dia", "movement_variance", "accel_x", "accel_y",
    "accel_z", "gyro_x", "gyro_y", "gyro_z", "sleep_stage", "activity_class", "is_hr_anomaly",
    "consent_for_ml_training", "name", "email", "critical_spo2_drop", "glucose_pattern_flag", "risk_score_30d",
]


def _null_counts_oracle() -> str:
    parts = []
    for c in _VITAL_COLS:
        cond = f"{c} IS NULL OR isnan({c})" if c in DOUBLE_VITALS else f"{c} IS NULL"
        parts.append(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {cond}) AS null_count, "
                     f"count(*) AS total_records FROM vitals")
    return with_vitals("\nUNION ALL\n".join(parts))


@register("null_counts", _null_counts_oracle())
def q_null_counts(spark, sf_dir):
    return quality.null_counts(load_vitals(spark, sf_dir))


@register("invalid_values", with_vitals(" UNION ALL ".join(
    f"SELECT patient_id, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM vitals "
    f"WHERE {c} NOT IN ({', '.join(map(str, allowed))}) GROUP BY ALL" for c, (allowed, _r) in ALLOWED_RULES.items())))
def q_invalid_values(spark, sf_dir):
    return quality.invalid_values(load_vitals(spark, sf_dir), by=["patient_id"]).drop("place")


def _quarantine_oracle() -> str:
    reasons = []
    for c, (lo, hi, _r) in RANGE_RULES.items():
        reasons.append(f"CASE WHEN {c} < {lo} THEN '{c}_below_min' END")
        reasons.append(f"CASE WHEN {c} > {hi} THEN '{c}_above_max' END")
    for c, (allowed, _r) in ALLOWED_RULES.items():
        reasons.append(f"CASE WHEN {c} IS NOT NULL AND {c} NOT IN ({', '.join(map(str, allowed))}) "
                       f"THEN '{c}_not_allowed' END")
    return with_vitals(
        f"SELECT patient_id, timestamp, reasons, reasons = '' AS is_valid FROM "
        f"(SELECT patient_id, timestamp, concat_ws(',', {', '.join(reasons)}) AS reasons FROM vitals)"
    )


@register("quarantine", _quarantine_oracle())
def q_quarantine(spark, sf_dir):
    q = quality.quarantine(load_vitals(spark, sf_dir))
    return q.select("patient_id", "timestamp", F.array_join("reasons", ",").alias("reasons"), "is_valid")


# ---------------------------------------------------------------------------
# Privacy (P1-P4)
# ---------------------------------------------------------------------------

@register(
    "anonymized",
    with_vitals(
        f"SELECT 'anon-' || substr(sha256('{QUERY_SALT}' || patient_id), 1, {privacy.TOKEN_LEN}) AS patient_id, "
        "* EXCLUDE (patient_id, name, email) FROM vitals WHERE consent_for_ml_training"
    ),
)
def q_anonymized(spark, sf_dir):
    v = load_vitals(spark, sf_dir)
    return privacy.pseudonymize(privacy.drop_pii(privacy.consent_filter(v)), QUERY_SALT)


@register(
    "audit_counts",
    with_vitals(
        "SELECT 'ml_dataset_read' AS action, count(*) AS records_total, "
        "count(*) FILTER (WHERE consent_for_ml_training) AS records_consented_processed, "
        "count(DISTINCT patient_id) FILTER (WHERE consent_for_ml_training) AS patients_count, "
        "'health_measurements' AS dataset, 'model_training' AS purpose FROM vitals"
    ),
)
def q_audit_counts(spark, sf_dir):
    return privacy.audit_counts(load_vitals(spark, sf_dir))


# ---------------------------------------------------------------------------
# Feature projections
# ---------------------------------------------------------------------------

def _f(c: str) -> str:
    return f"CAST({c} AS FLOAT) AS {c}"


_FEATURE_ORACLES = {
    "features_hr": ", ".join(_f(c) for c in ["hr_bpm", "hrv_ms", "activity_intensity"]),
    "features_spo2": ", ".join(_f(c) for c in ["spo2_percent", "elevation_meters", "is_sleeping"]),
    "features_combined": ", ".join(_f(c) for c in ["hr_bpm", "spo2_percent", "resp_rate", "temp_c", "bp_sys", "bp_dia"]),
    "features_sleep": "CAST(movement_variance AS FLOAT) AS movement_variance, CAST(hr_bpm AS FLOAT) AS hr_avg, "
                      "CAST(hrv_ms AS FLOAT) AS hrv_avg, CAST(480.0 AS FLOAT) AS duration_mins",
    "features_activity": ", ".join(_f(c) for c in ["accel_x", "accel_y", "accel_z", "gyro_x", "gyro_y", "gyro_z"])
    + ", CAST(sqrt(CAST(CAST(accel_x AS FLOAT) AS DOUBLE) ^ 2 + CAST(CAST(accel_y AS FLOAT) AS DOUBLE) ^ 2 "
      "+ CAST(CAST(accel_z AS FLOAT) AS DOUBLE) ^ 2) AS FLOAT) AS accel_magnitude",
    "features_risk": ", ".join(_f(c) for c in ["hr_bpm", "hrv_ms", "spo2_percent", "resp_rate", "temp_c", "bp_sys",
                                               "bp_dia", "activity_intensity"]),
    "features_glucose": "hr_bpm, hrv_ms, movement_variance, temp_c",
}
_FEATURE_FNS = {
    "features_hr": fx.heart_rate_features,
    "features_spo2": fx.spo2_features,
    "features_combined": fx.combined_vitals_features,
    "features_sleep": fx.sleep_features,
    "features_activity": fx.activity_features,
    "features_risk": fx.risk_features,
    "features_glucose": fx.glucose_features,
}


def _make_feature_query(fn):
    def q(spark, sf_dir):
        return fn(load_vitals(spark, sf_dir), keep=["patient_id", "timestamp"])

    return q


for _name, _fn in _FEATURE_FNS.items():
    register(_name, with_vitals(f"SELECT patient_id, timestamp, {_FEATURE_ORACLES[_name]} FROM vitals"))(
        _make_feature_query(_fn)
    )


@register(
    "sleep_rows",
    with_vitals(
        "SELECT patient_id, timestamp, sleep_stage, CAST(movement_variance AS FLOAT) AS movement_variance, "
        "CAST(hr_bpm AS FLOAT) AS hr_avg, CAST(hrv_ms AS FLOAT) AS hrv_avg, CAST(480.0 AS FLOAT) AS duration_mins "
        "FROM vitals WHERE is_sleeping = 1 OR (SELECT count(*) FROM vitals WHERE is_sleeping = 1) < 50"
    ),
)
def q_sleep_rows(spark, sf_dir):
    rows = fx.sleep_rows(load_vitals(spark, sf_dir))
    return fx.sleep_features(rows, keep=["patient_id", "timestamp", "sleep_stage"])


def _clip_sql(c: str) -> str:
    lo, hi = PHYSIO_CLIP[c]
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, {lo}), {hi}) END AS {c}"


@register(
    "derived_labels",
    with_vitals(
        "SELECT patient_id, timestamp, "
        "CAST(CASE WHEN hour(timestamp) >= 23 OR hour(timestamp) <= 6 THEN 1 ELSE 0 END AS INTEGER) AS sleep_flag, "
        "CAST(spo2_percent < 90 AS INTEGER) AS critical_spo2, "
        f"{R('greatest(0, (100 - hrv_ms) / 80)', 6)} AS autonomic_stress, "
        f"{R('pow(greatest(0, (96 - spo2_percent) / 10), 1.6)', 6)} AS hypoxia_factor, "
        f"{R('greatest(0, (bp_sys - 130) / 40) + greatest(0, (bp_dia - 85) / 25)', 6)} AS hemodynamic_stress, "
        + R(
            "least(greatest(22 * greatest(0, (100 - hrv_ms) / 80) + 35 * pow(greatest(0, (96 - spo2_percent) / 10), 1.6)"
            " + 18 * (greatest(0, (bp_sys - 130) / 40) + greatest(0, (bp_dia - 85) / 25)) + 20 * is_hr_anomaly, 0), 100)",
            2,
        )
        + " AS risk_score, "
        "CAST(hrv_ms < 24 AND hr_bpm > 85 AND activity_intensity = 0 AND is_sleeping = 0 AS INTEGER) AS glucose_rule "
        "FROM c",
        "c AS (SELECT patient_id, timestamp, is_hr_anomaly, activity_intensity, is_sleeping, "
        + ", ".join(_clip_sql(c) for c in PHYSIO_CLIP)
        + " FROM vitals)",
    ),
)
def q_derived_labels(spark, sf_dir):
    return fx.derived_labels(load_vitals(spark, sf_dir))
