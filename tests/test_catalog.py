"""The catalogue's gates and the sampling of isolation trees."""

import pytest

from pulsekit.models.isolation_forest import fit_isolation_forest
from pulsekit.operators import gates
from pulsekit.plans.training import TRAINERS

GOOD = {"recall": 0.97, "false_positive_rate": 0.02, "precision": 0.9, "accuracy": 0.9, "r2_score": 0.99,
        "latency_p95_ms": 1.0, "size_mb": 0.5}


@pytest.mark.parametrize("model_id,change", [
    ("heart_rate_anomaly", {"size_mb": 3.0}), ("spo2_critical", {"latency_p95_ms": 6.0}),
    ("combined_vitals", {"recall": 0.5}), ("sleep_quality", {"accuracy": 0.5}), ("activity_recognition", {"accuracy": 0.8}),
    ("glucose_patterns", {"recall": 0.8}), ("risk_score", {"r2_score": 0.7}),
])
def test_every_model_has_its_own_gate(spark, model_id, change):
    rule = TRAINERS[model_id].gate
    good = gates.model_gate(spark.createDataFrame([GOOD]), rule).first()
    assert good.approved and good.rejection_reasons == []
    bad = gates.model_gate(spark.createDataFrame([{**GOOD, **change}]), rule).first()
    assert not bad.approved and len(bad.rejection_reasons) == 1


def test_gates_read_only_their_own_metrics(spark):
    risk = spark.createDataFrame([{"r2_score": 0.9944}])
    assert gates.model_gate(risk, TRAINERS["risk_score"].gate).first().approved
    slow = spark.createDataFrame([{**GOOD, "latency_p95_ms": 50.0, "size_mb": 50.0}])
    assert gates.model_gate(slow, TRAINERS["combined_vitals"].gate).first().approved


def test_strict_gate_counts_every_row(spark):
    rows = gates.approval_gate(spark.createDataFrame([(i, 0.1) for i in range(50)], "id int, recall double"))
    with pytest.raises(gates.ClinicalThresholdViolation, match="50 row"):
        gates.require_approval(rows, ["id"])


@pytest.mark.parametrize("n", [5, 100, 300, 600, 3000])
def test_trees_hold_the_rows_their_scores_assume(spark, n):
    df = spark.range(n).selectExpr("id", "CAST(id * 7919 % 1000 AS DOUBLE) AS x", "CAST(id % 37 AS DOUBLE) AS y")
    model = fit_isolation_forest(df, ["x", "y"], n_trees=20, key_cols=["id"])
    assert model.max_samples == min(256, n) and model.nodes.shape[0] == 20
    assert (model.nodes[:, 0, 4] == model.max_samples).all()
