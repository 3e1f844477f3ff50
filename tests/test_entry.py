import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50 and len(o) >= 50


def test_scan_is_pruned(spark):
    from pulsekit.operators.features import heart_rate_features
    from pulsekit.sources.adapter import load_vitals

    plan = heart_rate_features(load_vitals(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    # only the columns the projection needs reach the parquet reader
    assert "ReadSchema: struct<event_type:string,value:double>" in plan


def test_no_single_partition_exchange_in_rankings(spark):
    from pulsekit.operators import metrics, split
    from pulsekit.sources.adapter import load_vitals

    v = load_vitals(spark, "/root/testdata/sf0.001")
    for df in (metrics.rank_auc(v, "glucose_pattern_flag", "risk_score_30d"), split.rank_ids(v)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
        windows = [ln for ln in plan.splitlines() if "Window [" in ln]
        assert windows and all("], [], [" not in ln for ln in windows)  # every window is partitioned


def test_registry_json_document(spark, tmp_path):
    import json

    from pulsekit.operators import registry

    doc = {"registry_version": "1.0.0", "updated_at": "2026-01-01T00:00:00+00:00", "models": {
        "m1": {"1.0.0": {"modelId": "m1", "version": "1.0.0", "status": "staged", "type": "classifier",
                         "target": "t", "deployedTo": ["android"], "training": {"date": "2026-01-01T00:00:00+00:00",
                         "datasetHash": "h", "patientCount": 3, "sampleCount": 9, "algorithm": "RF"},
                         "evaluation": {"accuracy": 0.9}, "artifacts": {"a": "x"},
                         "deployment": {"requiredFeatureSchema": "1.0.0", "changelog": ""}},
               "10.0.0": {"modelId": "m1", "version": "10.0.0", "status": "production", "type": "classifier",
                          "target": "t", "deployedTo": [], "training": {"algorithm": "RF"}, "evaluation": {},
                          "artifacts": {}, "deployment": {}}}}}
    p = tmp_path / "registry.json"
    p.write_text(json.dumps(doc, indent=2))
    flat = registry.read_registry_json(spark, str(p))
    assert flat.count() == 2
    assert registry.latest_version(flat).first().latest_version == "10.0.0"
    assert flat.where("version = '1.0.0'").first().metrics == {"accuracy": 0.9}
    bad = tmp_path / "bad.json"
    bad.write_text("{not json")
    import pytest
    with pytest.raises(Exception):
        registry.read_registry_json(spark, str(bad)).collect()
