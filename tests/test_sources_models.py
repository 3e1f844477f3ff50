import random

import pytest
from pyspark.sql import functions as F

from pulsekit.models import anomaly, mllib_models
from pulsekit.models.common import SingleClassError
from pulsekit.models.isolation_forest import fit_isolation_forest
from pulsekit.operators import metrics, split
from pulsekit.sources import io


def test_csv_parquet_and_guard(spark, tmp_path):
    df = spark.createDataFrame([("p1", 70.0, float("nan"))], "patient_id string, hr_bpm double, hrv_ms double")
    io.write_measurements(df, str(tmp_path / "m.parquet"))
    back = io.read_measurements(spark, str(tmp_path / "m.parquet")).first()
    assert back.hr_bpm == 70.0 and back.hrv_ms is None  # NaN -> NULL on ingestion
    df.write.option("header", True).csv(str(tmp_path / "m.csv"))
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("patient_id", T.StringType()), T.StructField("hr_bpm", T.DoubleType()),
                           T.StructField("hrv_ms", T.DoubleType())])
    assert io.read_measurements(spark, str(tmp_path / "m.csv"), schema=schema).count() == 1
    with pytest.raises(ValueError):
        io.read_measurements(spark, str(tmp_path / "m.json"))


def test_fingerprint_order_insensitive(spark):
    df = spark.createDataFrame([(i, f"u{i % 7}") for i in range(200)], "a long, b string")
    f1 = io.dataset_fingerprint(df, ["a", "b"]).first()
    f2 = io.dataset_fingerprint(df.repartition(9).orderBy(F.rand(1)), ["a", "b"]).first()
    assert f1 == f2 and f1.n_rows == 200
    f3 = io.dataset_fingerprint(df.where("a > 0"), ["a", "b"]).first()
    assert f3.fingerprint != f1.fingerprint


def test_aes_gcm_layout_and_roundtrip(spark):
    df = spark.createDataFrame([("hello",)], "s string")
    enc = df.select(io.encrypt_column("s", "secret").alias("c"))
    assert enc.select(F.length("c")).first()[0] == 12 + 5 + 16
    assert enc.select(io.decrypt_column("c", "secret")).first()[0] == "hello"
    with pytest.raises(ValueError):
        io.encrypt_column("s", "")


def test_file_manifest(spark, tmp_path):
    p = tmp_path / "art"
    p.mkdir()
    (p / "a.bin").write_bytes(b"x" * 2048)
    (p / "b.bin").write_bytes(b"x" * 2048)
    m = io.file_manifest(spark, str(p / "*.bin"), expected=["a.bin", "b.bin", "missing.bin"])
    rows = {r.file: r for r in m.collect()}
    assert rows["a.bin"].size_kb == 2.0 and rows["missing.bin"].size_bytes == 0 and rows["missing.bin"].sha256 is None
    audit = {r.file: r for r in io.manifest_audit(m).collect()}
    assert audit["a.bin"].duplicate_checksum and audit["a.bin"].is_within_budget


def _synthetic(spark, n_patients=30, rows=40, seed=5):
    rng = random.Random(seed)
    data = []
    for p in range(n_patients):
        for r in range(rows):
            anomaly_ = 1 if rng.random() < 0.08 else 0
            hr = rng.gauss(72, 4) + (45 if anomaly_ else 0)
            spo2 = rng.gauss(97, 1) - (9 if anomaly_ else 0)
            data.append((f"anon-{p}", float(r), hr, rng.gauss(45, 5), rng.randint(0, 3), spo2, float(rng.randint(0, 1000)),
                         rng.randint(0, 1), anomaly_, int(spo2 < 90)))
    return spark.createDataFrame(
        data, "patient_id string, timestamp double, hr_bpm double, hrv_ms double, activity_intensity int, "
              "spo2_percent double, elevation_meters double, is_sleeping int, is_hr_anomaly int, critical_spo2_drop int")


def test_isolation_forest_separates(spark):
    df = _synthetic(spark)
    forest = fit_isolation_forest(df, ["hr_bpm", "hrv_ms"], n_trees=30, seed=1)
    scored = forest.score_column(df)
    auc = metrics.rank_auc(scored, "is_hr_anomaly", "anomaly_score").first().auc_roc
    assert auc > 0.9
    # deterministic under repartitioning
    f2 = fit_isolation_forest(df.repartition(7), ["hr_bpm", "hrv_ms"], n_trees=30, seed=1)
    assert (forest.nodes == f2.nodes).all()


def test_heart_rate_pipeline_and_spo2(spark):
    tagged = split.split_by_patient(_synthetic(spark)).cache()
    res = anomaly.train_heart_rate(tagged, n_trees=30, split="val")
    assert res.metrics["recall"] > 0 and res.metrics.get("auc_roc", 0) > 0.9
    res2 = mllib_models.train_spo2(tagged, num_trees=10)
    assert res2.metrics["recall"] > 0.5
    tagged.unpersist()


def test_autoencoder_runs_and_single_class_error(spark):
    df = _synthetic(spark, n_patients=10, rows=30)
    for c in ("resp_rate", "temp_c", "bp_sys", "bp_dia"):
        df = df.withColumn(c, F.col("hr_bpm") / 5 + F.lit(1.0))
    tagged = split.split_by_patient(df)
    res = anomaly.train_combined(tagged, max_iter=5, split="val")
    assert "recall" in res.metrics
    with pytest.raises(SingleClassError):
        mllib_models.train_glucose(tagged.withColumn("glucose_pattern_flag", F.lit(0)).withColumn("movement_variance", F.lit(0.1))
                                   .withColumn("temp_c", F.lit(36.6)))


def test_glucose_gbt_separable(spark):
    rng = random.Random(9)
    rows = []
    for p in range(20):
        for r in range(30):
            y = 1 if rng.random() < 0.2 else 0
            rows.append((f"anon-{p}", rng.gauss(70 + 30 * y, 3), rng.gauss(40 - 20 * y, 3), rng.random(), 36.6, y))
    df = spark.createDataFrame(rows, "patient_id string, hr_bpm double, hrv_ms double, movement_variance double, "
                                     "temp_c double, glucose_pattern_flag int")
    res = mllib_models.train_glucose(split.split_by_patient(df), max_iter=10)
    assert res.metrics["auc_roc"] > 0.9 and res.metrics["recall"] > 0.8
