"""Models read back from their saved tables score as the fitted ones did."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from pulsekit.models import anomaly, mllib_models
from pulsekit.models.autoencoder import AutoencoderModel
from pulsekit.models.isolation_forest import IsolationForestModel
from pulsekit.operators import split
from pulsekit.plans.scoring import load_run
from pulsekit.plans.training import save_run
from pulsekit.sources.adapter import load_vitals


@pytest.fixture(scope="module")
def tagged(spark):
    rows = split.split_by_patient(load_vitals(spark, SF)).cache()
    yield rows
    rows.unpersist()


@pytest.mark.parametrize("train,kw,score", [
    (anomaly.train_heart_rate, {"n_trees": 7}, "anomaly_score"), (anomaly.train_combined, {"max_iter": 3}, "recon_error"),
    (mllib_models.train_spo2, {"num_trees": 3}, "score"), (mllib_models.train_sleep, {"num_trees": 3}, "prediction"),
    (mllib_models.train_activity, {"max_iter": 3}, "prediction"), (mllib_models.train_glucose, {"max_iter": 2}, "score"),
    (mllib_models.train_risk, {"max_iter": 2}, "pred"),
])
def test_saved_runs_score_alike(spark, tagged, tmp_path, train, kw, score):
    res = train(tagged, **kw)
    save_run(spark, res, str(tmp_path / "run"))
    rows = tagged if res.cohort is None else res.cohort
    again = load_run(spark, str(tmp_path / "run")).score(rows.where("split = 'val'"), ["split", "hr_bpm", "accel_x"])
    assert again.columns == ["split", "hr_bpm", "accel_x", "score", "pred"]
    pred = "pred" if "pred" in res.scored.columns else "prediction"
    want = res.scored.select(F.col(score).cast("double").alias("s"), F.col(pred).cast("double").alias("p")).toPandas()
    got = again.select(F.col("score").cast("double").alias("s"), F.col("pred").cast("double").alias("p")).toPandas()
    assert len(got) == len(want) > 0
    assert np.array_equal(np.sort(got.s), np.sort(want.s), equal_nan=True) and sorted(got.p) == sorted(want.p)


def test_forest_with_empty_leaves_and_odd_sizes(spark, tmp_path):
    nodes = np.zeros((2, 3, 5))
    nodes[:, :, 0] = -1
    nodes[0, 0], nodes[0, 2] = (0, 1.5, 1, 2, 4), (-1, 0, -1, -1, 4)  # its left child holds no row
    nodes[1, 0] = (-1, 0, -1, -1, 4)
    model = IsolationForestModel(["a"], 4, nodes)
    model.save(spark, str(tmp_path / "f"))
    again = IsolationForestModel.load(spark, str(tmp_path / "f"))
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "a double")
    first, second = (m.score_column(df).toPandas().anomaly_score for m in (model, again))
    assert again.features == ["a"] and again.max_samples == 4 and np.array_equal(first, second)
    spark.createDataFrame([(0, 0, 1.0)], "tree int, node int, size double").write.parquet(str(tmp_path / "old"))
    with pytest.raises(ValueError, match="before models"):
        IsolationForestModel.load(spark, str(tmp_path / "old"))


def test_autoencoder_shapes_and_missing_threshold(spark, tmp_path):
    model = AutoencoderModel(["a", "b"], [np.arange(6.0).reshape(2, 3), np.ones(3), np.arange(6.0).reshape(3, 2), np.zeros(2)])
    model.save(spark, str(tmp_path / "a"))
    again = AutoencoderModel.load(spark, str(tmp_path / "a"))
    assert again.threshold is None and [p.shape for p in again.params] == [(2, 3), (3,), (3, 2), (2,)]
    assert all(np.array_equal(x, y) for x, y in zip(model.params, again.params))


def test_columns_that_clash(spark, tagged, tmp_path):
    save_run(spark, anomaly.train_heart_rate(tagged, n_trees=2), str(tmp_path / "run"))
    saved, rows = load_run(spark, str(tmp_path / "run")), tagged.withColumn("score", F.lit("x"))
    assert saved.score(rows, []).columns == ["score", "pred"] and saved.score(rows.limit(0), []).count() == 0
    with pytest.raises(ValueError, match="cannot keep"):
        saved.score(rows, ["Score"])
