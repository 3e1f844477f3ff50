"""The activity network: its gradient, its steps and its scores."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from pulsekit.models import mllib_models
from pulsekit.models.autoencoder import _flatten, _init, _unflatten
from pulsekit.models.relu_network import _batch_gradient, fit_relu_network, gradient
from pulsekit.operators import split


def _rings(spark, n=600, seed=3):
    """Three classes by the distance from the centre: no line parts them."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k, turn = i % 3, rng.random() * 2 * math.pi
        r = 0.5 + k + rng.uniform(-0.3, 0.3)
        rows.append((r * math.cos(turn), r * math.sin(turn), k))
    return spark.createDataFrame(rows, "a double, b double, k int")


def _share_right(df):
    return df.agg(F.avg((F.col("prediction") == F.col("k")).cast("double"))).first()[0]


def test_gradient_equals_differences():
    rng = np.random.default_rng(0)
    layers = [3, 5, 4, 3]
    vec = _flatten(_init(layers, 1)) + rng.normal(0, 0.1, sum(a * b + b for a, b in zip(layers, layers[1:])))
    x, y = rng.normal(size=(20, 3)), rng.integers(0, 3, 20)
    grad = _flatten(gradient(_unflatten(vec, layers), x, y)[0])
    for i in range(len(vec)):
        up, down = vec.copy(), vec.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        slope = (gradient(_unflatten(up, layers), x, y)[1] - gradient(_unflatten(down, layers), x, y)[1]) / 2e-6
        assert grad[i] == pytest.approx(slope, abs=1e-4)


def test_tasks_add_up_to_one_pass(spark):
    df = _rings(spark).select(F.col("a").alias("x0"), F.col("b").alias("x1"), F.col("k").alias("y")).repartition(7)
    params = _init([2, 8, 3], 5)
    pdf = df.toPandas()
    want, loss = gradient(params, pdf[["x0", "x1"]].to_numpy(), pdf.y.to_numpy())
    got, total = _batch_gradient(df, ["x0", "x1"], params, len(pdf))
    assert np.allclose(got, _flatten(want) / len(pdf), atol=1e-11) and total == pytest.approx(loss, rel=1e-9)


def test_learns_rings_as_well_as_the_sigmoid_network(spark):
    df = _rings(spark).coalesce(2).cache()
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    other = MultilayerPerceptronClassifier(featuresCol="features", labelCol="k", layers=[2, 32, 16, 3], maxIter=120, seed=42).fit(rows)
    right = _share_right(fit_relu_network(df, ["a", "b"], "k", 3, epochs=120).transform(df))
    assert right > 0.97 and right >= _share_right(other.transform(rows))


def test_batches_learn_and_again_alike(spark):
    df = _rings(spark).repartition(3).cache()
    assert _share_right(fit_relu_network(df, ["a", "b"], "k", 3, epochs=25, batches=4).transform(df)) > 0.97
    one, two = (fit_relu_network(df, ["a", "b"], "k", 3, epochs=3, batches=4) for _ in range(2))
    assert all(np.array_equal(p, q) for p, q in zip(one.params, two.params))


def test_odd_rows(spark, tmp_path):
    df = _rings(spark, 60)
    odd = spark.createDataFrame([(float("nan"), 1.0, 0), (None, 1.0, 1), (float("inf"), 0.0, 2), (1.0, 1.0, 9), (1.0, 1.0, None)],
                                "a double, b double, k int")
    plain, mixed = (fit_relu_network(d.coalesce(1), ["a", "b"], "k", 3, epochs=3) for d in (df, df.union(odd)))
    assert all(np.allclose(p, q, atol=1e-9) for p, q in zip(plain.params, mixed.params))
    scored = mixed.transform(odd.withColumn("prediction", F.lit("x"))).collect()
    assert [r.prediction is None for r in scored] == [True, True, True, False, False]
    assert all(r.probability is None or abs(sum(r.probability) - 1) < 1e-9 for r in scored)
    with pytest.raises(ValueError, match="no rows"):
        fit_relu_network(odd.limit(0), ["a", "b"], "k", 3)
    assert mixed.transform(odd.limit(0)).count() == 0
    mixed.save(spark, str(tmp_path / "n"))
    again = type(mixed).load(spark, str(tmp_path / "n"))
    assert again.features == ["a", "b"] and all(np.array_equal(p, q) for p, q in zip(mixed.params, again.params))


def test_activity_from_movement(spark):
    rng = random.Random(7)
    rows = []
    for i in range(1200):
        k = rng.randrange(4)
        spread = (0.05, 0.5, 1.2, 2.5)[k]
        rows.append((f"p{i % 40}", *[rng.choice((-1, 1)) * spread * rng.uniform(0.8, 1.2) for _ in range(6)], k))
    df = spark.createDataFrame(rows, "patient_id string, accel_x double, accel_y double, accel_z double, gyro_x double, "
                                     "gyro_y double, gyro_z double, activity_class int")
    res = mllib_models.train_activity(split.split_by_patient(df), max_iter=40)
    assert res.metrics["accuracy"] > 0.95 and res.algorithm == "ReluNetwork"
