import pytest
from pyspark.sql import functions as F

from pulsekit.operators import privacy, quality
from pulsekit.sources.adapter import load_vitals
from tests.conftest import SF


def test_missing_consent_column(spark):
    df = spark.createDataFrame([("p1", 70), ("p2", 80)], "patient_id string, hr_bpm int")
    with pytest.raises(privacy.ConsentError):
        privacy.anonymize(df)


def test_zero_consent(spark):
    df = spark.createDataFrame([("p1", 70, False), ("p2", 80, False)], "patient_id string, hr_bpm int, consent_for_ml_training boolean")
    with pytest.raises(privacy.ConsentError):
        privacy.anonymize(df)


def test_non_boolean_consent(spark):
    df = spark.createDataFrame([("p1", 1)], "patient_id string, consent_for_ml_training int")
    with pytest.raises(TypeError):
        privacy.consent_filter(df)


def test_pii_dropped_tokens_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", "x@y", True), ("a", "x@y", True), ("b", "z@y", None), (None, "q", True)],
        "patient_id string, email string, consent_for_ml_training boolean",
    )
    out, audit = privacy.anonymize(df, salt="s")
    rows = out.collect()
    assert "email" not in out.columns
    assert len(rows) == 3  # NULL consent is no consent
    tokens = [r.patient_id for r in rows]
    assert tokens.count(None) == 1  # NULL id stays NULL
    real = [t for t in tokens if t]
    assert len(set(real)) == 1 and real[0].startswith("anon-") and len(real[0]) == 5 + privacy.TOKEN_LEN
    assert audit["records_total"] == 4 and audit["records_consented_processed"] == 3 and audit["patients_count"] == 1


def test_salt_changes_tokens(spark):
    df = spark.createDataFrame([("a", True)], "patient_id string, consent_for_ml_training boolean")
    t1 = privacy.pseudonymize(df, "s1").first().patient_id
    t2 = privacy.pseudonymize(df, "s2").first().patient_id
    assert t1 != t2


def test_out_of_range_fails_and_valid_passes(spark):
    base = [("p1", 70.0, 40.0, 98.0, 1), ("p2", 72.0, 41.0, 97.0, 0)]
    schema = "patient_id string, hr_bpm double, hrv_ms double, spo2_percent double, activity_intensity int"
    assert quality.validate(spark.createDataFrame(base, schema))["success"]
    bad = spark.createDataFrame([("p1", 350.0, 40.0, 98.0, 1)] + base[1:], schema)
    res = quality.validate(bad)
    assert not res["success"]
    assert any("above_max_240" in e for e in res["errors"])
    with pytest.raises(quality.DataQualityError):
        quality.require_valid(bad)


def test_missing_id_and_required_columns(spark):
    df = spark.createDataFrame([(70.0,)], "hr_bpm double")
    res = quality.validate(df)
    errs = " ".join(res["errors"])
    assert "patient_id: present" in errs and "hrv_ms: present" in errs and "activity_intensity: present" in errs


def test_nulls_are_warnings_and_nan_counts_as_null(spark):
    df = spark.createDataFrame(
        [("p1", float("nan"), 40.0, 98.0, 1), ("p2", None, 41.0, 97.0, 5)],
        "patient_id string, hr_bpm double, hrv_ms double, spo2_percent double, activity_intensity int",
    )
    rep = {(r.column_name, r.check_name): r for r in quality.quality_report(df).collect()}
    assert rep[("hr_bpm", "nulls")].severity == "warning" and rep[("hr_bpm", "nulls")].violations == 2
    assert rep[("activity_intensity", "allowed_set")].detail == "5"
    q = quality.quarantine(df).orderBy("patient_id").collect()
    assert q[0].is_valid and q[1].reasons == ["activity_intensity_not_allowed"]


def test_quality_report_on_vitals_counts(spark):
    rep = {(r.column_name, r.check_name): r.violations for r in
           quality.quality_report(load_vitals(spark, SF)).collect()}
    assert rep[("patient_id", "not_null")] == 0
    n = load_vitals(spark, SF).where(F.col("activity_intensity") > 3).count()
    assert rep[("activity_intensity", "allowed_set")] == n
