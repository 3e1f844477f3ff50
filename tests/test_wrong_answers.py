"""Cases that once gave wrong answers: column order in CSV, NaN and NULL."""

from pyspark.sql import functions as F

from pulsekit.functions import clip_keep_null
from pulsekit.operators import metrics, timeseries
from pulsekit.sources.io import read_measurements


def test_csv_is_read_by_name(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("hr_bpm,note,patient_id,timestamp\n71.5,x,p1,2024-01-01 00:00:00\n")
    row = read_measurements(spark, str(path)).first()
    assert row["patient_id"] == "p1" and row["hr_bpm"] == 71.5 and row["spo2_percent"] is None
    assert "note" not in row.asDict()


def test_nan_is_no_bound(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (300.0,), (10.0,)], "x double")
    assert [r[0] for r in df.select(clip_keep_null("x", 30.0, 220.0)).collect()] == [None, None, 220.0, 30.0]


def test_clock_drift_ignores_pairs_without_a_difference(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 2.0), (None, 1.0)], "d double, s double")
    assert tuple(timeseries.clock_drift(df, "d", "s").first()) == (1.0, 1.0, False)


def test_regression_terms_share_their_rows(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (100.0, None), (None, 5.0)], "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    assert row["n_samples"] == 2 and row["mse"] == 0.5 and row["r2_score"] == -1.0


def test_package_reaches_the_workers(spark, monkeypatch, tmp_path):
    from pulsekit.session import ship_package

    ship_package(spark)
    monkeypatch.chdir(tmp_path)

    def place(batches):
        import pulsekit

        for b in batches:
            yield b.assign(at=pulsekit.__name__)

    assert spark.range(2).mapInPandas(place, "id long, at string").filter(F.col("at") == "pulsekit").count() == 2
