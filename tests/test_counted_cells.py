"""Tree fits over counted cells: as many rows as cells, and the trees of the rows themselves."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array

from pulsekit.models import cells, mllib_models
from pulsekit.models.common import assemble
from pulsekit.operators import split
from pulsekit.schema import GLUCOSE_FEATURES

SCHEMA = "patient_id string, hr_bpm double, hrv_ms double, movement_variance double, temp_c double, glucose_pattern_flag int"


def _rows(spark, n: int, kinds: int, seed: int):
    rng, rows = random.Random(seed), []
    for k in range(n):
        a, b, c, d = (rng.randrange(kinds) for _ in range(4))
        y = int(3 * a - 2 * b + c + rng.gauss(0, 1.5) > kinds)
        rows.append((f"anon-{k % 25}", 60.0 + a * a, 20.0 + b / 3, c / 7.0, 36.5 + d, y))
    return split.split_by_patient(spark.createDataFrame(rows, SCHEMA))


@pytest.fixture
def fitted_on(monkeypatch):
    """The tables that boosting was fitted on."""
    seen, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df, *a: (seen.append(df), fit(self, df, *a))[1])
    return seen


def test_passes_do_not_grow_with_the_rows(spark, fitted_on):
    tagged = _rows(spark, 900, 2, 3)
    n_train = tagged.where("split = 'train'").count()
    mllib_models.train_glucose(tagged, max_iter=1)
    table = fitted_on[0].toPandas()
    assert len(table) <= 2 * 2**4 < n_train and table[cells.WEIGHT].sum() == n_train


def test_trees_are_those_of_the_rows(spark):
    tagged = _rows(spark, 900, 9, 5)
    res = mllib_models.train_glucose(tagged, max_iter=6)
    label, train = "glucose_pattern_flag", tagged.where("split = 'train'")
    plain = GBTClassifier(featuresCol="features", labelCol=label, maxIter=6, maxDepth=4, stepSize=0.1, seed=42).fit(
        assemble(train, GLUCOSE_FEATURES, res.scaler))
    want = plain.transform(assemble(tagged.where("split = 'val'"), GLUCOSE_FEATURES, res.scaler)).select(
        vector_to_array("probability")[1].alias("p")).toPandas().p
    got = res.scored.select("score").toPandas().score
    assert len(set(np.round(want, 6))) > 10 and np.allclose(np.sort(got), np.sort(want), atol=1e-9)


def test_many_values_and_a_missing_one(spark):
    rng = random.Random(8)
    rows = [(rng.random(), math.nan if k == 5 else float(k), 3.0, 0.0 if k % 4 else float(k), k % 2) for k in range(4000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y int").dropna()
    buckets = cells.fit_bucketizer(df, ["a", "b", "c", "d"], 32)
    per_bin = buckets.transform(df).groupBy("__bin_a").count().toPandas()["count"]
    assert len(per_bin) == 32 and per_bin.min() > 100 and per_bin.max() < 150
    table = cells.count_cells(df, buckets, "y").toPandas()
    assert table[cells.WEIGHT].sum() == 3999 and set(table.y) == {0, 1}


def test_thresholds():
    assert cells.thresholds(np.array([]), 32) == [] == cells.thresholds(np.full(9, 36.6), 32)
    assert cells.thresholds(np.array([1.0, 4.0, 4.0, 2.0]), 3) == [1.5, 3.0]
    for heavy in (-1.0, 50.5, 1e6):  # before, among and after the others
        v = np.concatenate([np.full(99_000, heavy), np.arange(1000) / 10.0])
        cuts = cells.thresholds(v, 32)
        sizes = np.unique(np.digitize(v, cuts), return_counts=True)[1]
        assert 29 <= len(cuts) <= 31 and sorted(sizes)[-1] <= 99_001 and sorted(sizes)[-2] < 60
    close = np.array([1.0, np.nextafter(1.0, 2.0), -math.inf, math.inf])
    cuts = cells.thresholds(close, 32)
    assert len(cuts) == 3 and np.isfinite(cuts).all() and len(set(np.digitize(close, cuts))) == 4
