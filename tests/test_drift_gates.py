import math
import random

import pytest
from pyspark.sql import functions as F

from pulsekit.functions import ks_pvalue
from pulsekit.operators import drift, gates, registry


def _ks_brute(a, b):
    vals = sorted(set(a) | set(b))
    return max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in vals)


def test_ks_and_psi_against_brute_force(spark):
    rng = random.Random(3)
    a = [float(rng.randint(0, 30)) for _ in range(300)]
    b = [float(rng.randint(5, 40)) for _ in range(250)]
    ref = spark.createDataFrame([(x,) for x in a], "x double")
    cur = spark.createDataFrame([(x,) for x in b], "x double")
    r = drift.feature_drift(ref, cur, ["x"]).first()
    assert r.ks_statistic == pytest.approx(round(_ks_brute(a, b), 4))
    assert r.drift_detected


def test_psi_binary_rare_feature_is_zero(spark):
    ref = spark.createDataFrame([(1.0 if i < 5 else 0.0,) for i in range(100)], "x double")
    cur = spark.createDataFrame([(1.0 if i < 50 else 0.0,) for i in range(100)], "x double")
    r = drift.feature_drift(ref, cur, ["x"]).first()
    assert r.psi == 0.0  # every value lands in the last bin when ones are under 10 %


def test_empty_side_skipped_but_counted(spark):
    ref = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double")
    cur = spark.createDataFrame([(1.0, 3.0), (2.0, 4.0)], "x double, y double")
    per, summ = drift.check_drift(ref, cur, ["x", "y"])
    assert [r.feature for r in per.collect()] == ["x"]
    s = summ.first()
    assert s.n_features == 2 and s.drifted_features_count == 0 and s.drift_share == 0.0


def test_shift_detected(spark):
    rng = random.Random(1)
    ref = spark.createDataFrame([(rng.gauss(70, 5),) for _ in range(500)], "hr_bpm double")
    cur = ref.withColumn("hr_bpm", F.col("hr_bpm") + 45)
    per, summ = drift.check_drift(ref, cur)
    s = summ.first()
    assert s.dataset_drift and s.drifted_features == "hr_bpm"
    alerts = drift.alert_rows(summ).collect()
    assert any("100.0%" in a.message for a in alerts) and all(a.deliver for a in alerts)


def test_ks_pvalue_series(spark):
    df = spark.createDataFrame([(0.0, 100, 100), (0.5, 100, 100), (0.15, 100, 100)], "d double, n long, m long")
    p = [r[0] for r in df.select(ks_pvalue("d", "n", "m")).collect()]
    assert p[0] == 1.0 and p[1] < 1e-9
    lam = 0.15 * math.sqrt(50)
    exact = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    assert p[2] == pytest.approx(exact)


GATE_ROWS = [
    (0.96, 0.03, 0.85, 3.0, 1.0),
    (0.90, 0.03, 0.85, 3.0, 1.0),
    (0.96, 0.08, 0.85, 3.0, 1.0),
    (0.80, 0.10, 0.70, 3.0, 1.0),
]


def test_approval_gate_fixture(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(GATE_ROWS)],
                               "id int, recall double, false_positive_rate double, precision double, "
                               "latency_p95_ms double, size_mb double")
    out = {r.id: r for r in gates.approval_gate(df).collect()}
    assert out[0].approved and out[0].rejection_reasons == []
    assert [x.split(" ")[0] for x in out[1].rejection_reasons] == ["Recall"]
    assert [x.split(" ")[0] for x in out[2].rejection_reasons] == ["False"]
    assert len(out[3].rejection_reasons) == 3
    with pytest.raises(gates.ClinicalThresholdViolation):
        gates.require_approval(gates.approval_gate(df), ["id"])


def test_gate_boundaries_and_missing(spark):
    df = spark.createDataFrame([(0.95, 0.8)], "sensitivity double, precision double")
    r = gates.approval_gate(df).first()
    assert r.approved  # equality passes, missing FPR / latency / size read as 0.0


def test_registry_status_default_and_compat(spark):
    df = spark.createDataFrame(
        [("a", "anomaly_detection", 1.0, 0.0, None), ("b", "risk_scoring", None, None, 0.94),
         ("c", "other", 1.0, 0.0, None), ("d", "classifier", None, None, None)],
        "id string, model_type string, recall double, false_positive_rate double, r2_score double")
    d = {r.id: r.s for r in df.select("id", gates.registry_status(df).alias("s")).collect()}
    c = {r.id: r.s for r in df.select("id", gates.registry_status(df, compat=True).alias("s")).collect()}
    assert d == {"a": "production", "b": "production", "c": "staged", "d": "staged"}
    assert c["a"] == "rejected" and c["b"] == "rejected"


def test_latest_version_semver_and_compat(spark):
    df = spark.createDataFrame([("m", "9.0.0"), ("m", "10.0.0"), ("m", "10.0.1")], "model_id string, version string")
    assert registry.latest_version(df).first().latest_version == "10.0.1"
    assert registry.latest_version(df, compat=True).first().latest_version == "9.0.0"


def test_artifact_cleanup(spark):
    df = spark.createDataFrame([({"a": "C:\\tmp\\x\\model-registry\\m\\model.bin", "b": "", "c": "rel/x.json"},)],
                               "m map<string,string>")
    out = df.select(registry.clean_artifacts("m").alias("m")).first().m
    assert out == {"a": "model-registry/m/model.bin", "c": "rel/x.json"}


def test_registry_upsert_roundtrip(spark, tmp_path):
    reg = registry.ModelRegistry(spark, str(tmp_path / "reg"))
    reg.register("spo2", "1.0.0", "anomaly_detection", "spo2", ["android"], "RF", {"n": 40},
                 {"recall": 1.0, "false_positive_rate": 0.0}, {"m": "x\\model-registry\\a"}, "1.0.0")
    e = reg.register("spo2", "1.0.0", "anomaly_detection", "spo2", ["android"], "RF", {"n": 40},
                     {"recall": 0.5, "false_positive_rate": 0.0}, {}, "1.0.0")
    assert e["status"] == "rejected"
    reg.register("spo2", "1.10.0", "anomaly_detection", "spo2", [], "RF", {}, {}, {}, "1.0.0", force_status="staged")
    rows = reg.entries().collect()
    assert len(rows) == 2
    latest = reg.get_latest_model("spo2")
    assert latest["version"] == "1.10.0" and latest["status"] == "staged"
    assert reg.get_latest_model("nope") is None


def test_drift_and_tokens_invariant_to_partitioning(spark):
    from pulsekit.operators import privacy

    rng = random.Random(11)
    ref = spark.createDataFrame([(float(rng.randint(0, 50)), rng.random()) for _ in range(400)], "a double, b double")
    cur = spark.createDataFrame([(float(rng.randint(3, 60)), rng.random()) for _ in range(300)], "a double, b double")
    base = sorted(tuple(r) for r in drift.feature_drift(ref, cur).collect())
    for n in (1, 7, 64):
        got = sorted(tuple(r) for r in drift.feature_drift(ref.repartition(n), cur.repartition(n)).collect())
        assert got == base
    ids = spark.createDataFrame([(f"P{i}", True) for i in range(50)], "patient_id string, consent_for_ml_training boolean")
    t1 = sorted(r.patient_id for r in privacy.pseudonymize(ids, "s").collect())
    t2 = sorted(r.patient_id for r in privacy.pseudonymize(ids.repartition(13), "s").collect())
    assert t1 == t2 and len(set(t1)) == 50


def test_exact_equal_size_pvalue(spark):
    # values of the stored two-sample report (n = m = 2000)
    assert round(drift.ks_pvalue_exact_equal(0.075, 2000), 5) == 3e-05
    assert round(drift.ks_pvalue_exact_equal(0.0385, 2000), 5) == 0.10316
    ref = spark.createDataFrame([(float(i),) for i in range(50)], "x double")
    cur = spark.createDataFrame([(float(i) + 10,) for i in range(50)], "x double")
    r = drift.feature_drift(ref, cur, ["x"], p_method="exact").first()
    assert r.ks_statistic == 0.2 and r.p_value == round(drift.ks_pvalue_exact_equal(0.2, 50), 5)


def test_exact_pvalue_of_all_small_samples():
    import itertools
    from fractions import Fraction

    for n in range(1, 8):
        for m in range(1, 9):
            seen = []
            for first in itertools.combinations(range(n + m), n):
                i = j = 0
                most = Fraction(0)
                for at in range(n + m):
                    i, j = (i + 1, j) if at in first else (i, j + 1)
                    most = max(most, abs(Fraction(i, n) - Fraction(j, m)))
                seen.append(most)
            for d in set(seen):
                want = sum(x >= d for x in seen) / len(seen)
                assert drift.ks_pvalue_exact(float(d), n, m) == pytest.approx(want, abs=1e-12), (n, m, d)


def test_exact_pvalue_is_chosen_by_size(spark):
    ref = spark.createDataFrame([(float(i),) for i in range(60)], "x double")
    cur = spark.createDataFrame([(i + 12.5,) for i in range(25)], "x double")
    r = drift.feature_drift(ref, cur, ["x"]).first()
    assert r.p_value == pytest.approx(drift.ks_pvalue_exact(r.ks_statistic, 60, 25), abs=1e-4)
    series = drift.feature_drift(ref, cur, ["x"], exact_max_n=10).first()
    assert series.p_value == drift.feature_drift(ref, cur, ["x"], p_method="asymptotic").first().p_value != r.p_value
    # about where the series holds well, both agree; a large unequal pair stays within range
    assert drift.ks_pvalue_exact(0.03, 9000, 7000) == pytest.approx(0.00163, abs=1e-4)
    assert drift.ks_pvalue_exact(0.0, 10, 7) == 1.0 and drift.ks_pvalue_exact(1.0, 10, 7) == pytest.approx(2 / 19448)
