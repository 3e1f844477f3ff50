import shutil

from pyspark.sql import functions as F

from pulsekit.operators import privacy, timeseries
from pulsekit.sources.adapter import vitals_from_events
from pulsekit.streaming import anonymize_stream, bucket_means_stream, quarantine_stream, read_stream, start
from tests.conftest import SF


def test_stream_matches_batch(spark, tmp_path):
    src = tmp_path / "events"
    src.mkdir()
    shutil.copy(f"{SF}/events.parquet", src / "part-0.parquet")
    batch_events = spark.read.parquet(str(src))
    stream = read_stream(spark, str(src), batch_events.schema)
    anon = quarantine_stream(anonymize_stream(vitals_from_events(stream), "salt"))
    q = start(anon.select("patient_id", "is_valid"), "anon_test", sink="memory", checkpoint_location=str(tmp_path / "c1"))
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT count(*) AS n, count_if(is_valid) AS v FROM anon_test").first()
    ref = privacy.pseudonymize(privacy.drop_pii(privacy.consent_filter(vitals_from_events(batch_events))), "salt")
    assert got.n == ref.count() and got.v <= got.n

    means = bucket_means_stream(vitals_from_events(stream), ["hr_bpm"], freq="15 minutes", watermark="1 hour")
    q2 = start(means, "means_test", sink="memory", output_mode="update", checkpoint_location=str(tmp_path / "c2"))
    q2.processAllAvailable()
    q2.stop()
    streamed = spark.sql("SELECT patient_id, timestamp, hr_bpm FROM means_test")
    batch = (vitals_from_events(batch_events)
             .withColumn("b", timeseries.epoch_seconds("timestamp"))
             .groupBy("patient_id", (F.floor(F.col("b") / 900) * 900).alias("s"))
             .agg(F.avg("hr_bpm").alias("hr_bpm")))
    assert streamed.count() == batch.count()


def test_drift_job_and_catalog(spark, tmp_path):
    from pulsekit.plans.drift_job import run_drift_check
    from pulsekit.plans.training import run_catalog
    from pulsekit.sources.adapter import load_vitals

    v = load_vitals(spark, SF)
    ref = v.where(F.col("timestamp") < F.lit("2024-01-16").cast("timestamp_ntz"))
    cur = v.where(F.col("timestamp") >= F.lit("2024-01-16").cast("timestamp_ntz")).withColumn("hr_bpm", F.col("hr_bpm") + 45)
    ref.write.parquet(str(tmp_path / "ref.parquet"))
    cur.write.parquet(str(tmp_path / "cur.parquet"))
    out = run_drift_check(spark, str(tmp_path / "ref.parquet"), str(tmp_path / "cur.parquet"), str(tmp_path / "report"),
                          features=["hr_bpm", "spo2_percent"], alerts_output=str(tmp_path / "alerts"))
    assert out["feature_metrics"]["hr_bpm"]["drift_detected"] and out["requires_retraining"]
    assert spark.read.json(str(tmp_path / "alerts")).count() == 2

    res = run_catalog(spark, v, str(tmp_path / "registry"), models=["spo2_critical", "sleep_quality"],
                      trainer_kw={"spo2_critical": {"num_trees": 5}, "sleep_quality": {"num_trees": 5}})
    assert set(res["models"]) == {"spo2_critical", "sleep_quality"}
    assert {r["model_id"] for r in res["registry"]} == {"spo2_critical", "sleep_quality"}
    assert res["facts"]["audit"]["records_consented_processed"] > 0
    sleep = res["models"]["sleep_quality"]
    assert sleep["metrics"]["size_mb"] > 0 and spark.read.parquet(sleep["artifacts"]["normalizer"]).count() == 4
    assert spark.read.json(sleep["artifacts"]["evaluation_report"]).first().status == sleep["gate_status"]


def test_streaming_model_scoring(spark, tmp_path):
    from pulsekit.models.isolation_forest import fit_isolation_forest

    src = tmp_path / "ev"
    src.mkdir()
    shutil.copy(f"{SF}/events.parquet", src / "part-0.parquet")
    batch = vitals_from_events(spark.read.parquet(str(src)))
    forest = fit_isolation_forest(batch, ["hr_bpm", "hrv_ms"], n_trees=10, seed=3)
    stream = vitals_from_events(read_stream(spark, str(src), spark.read.parquet(str(src)).schema))
    q = start(forest.score_column(stream).select("patient_id", "anomaly_score"), "score_test", sink="memory",
              checkpoint_location=str(tmp_path / "c3"))
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT count(*) AS n, min(anomaly_score) AS lo, max(anomaly_score) AS hi FROM score_test").first()
    assert got.n == batch.count() and 0 < got.lo <= got.hi <= 1
