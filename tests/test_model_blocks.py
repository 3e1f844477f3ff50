"""Fits that pass over blocks of numbers: rows lie in few blocks on all cores, and a pass is one job."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pulsekit.models import blocks
from pulsekit.models import hist_boosting as hb
from pulsekit.models.autoencoder import fit_autoencoder
from pulsekit.models.relu_network import fit_relu_network


def _jobs(spark, run):
    """How many Spark jobs ``run`` starts, by the job group's ids."""
    sc = spark.sparkContext
    sc.setJobGroup("counted", "")
    try:
        before = len(sc.statusTracker().getJobIdsForGroup("counted"))
        run()
        return len(sc.statusTracker().getJobIdsForGroup("counted")) - before
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def _rows(spark, n=900):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, 2))
    pdf = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "k": (x[:, 0] > 0).astype(int), "y": 3 * x[:, 0] + x[:, 1] ** 2})
    return spark.createDataFrame(pdf)


def test_rows_are_gathered_whole():
    parts = [pd.DataFrame({"i": range(a, b)}) for a, b in ((0, 3), (3, 3), (3, 14), (14, 15))]
    got = list(blocks.gathered(iter(parts), 5))
    assert [len(g) for g in got] == [5, 5, 5] and [i for g in got for i in g.i] == list(range(15))
    assert list(blocks.gathered(iter([parts[1]]), 5)) == []


def test_blocks_hold_every_row_once(spark):
    df = _rows(spark).coalesce(1)
    made = blocks.number_blocks(df.withColumn("part", F.col("k")), ["a", "k"], "part")
    assert made.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    got = np.concatenate([np.frombuffer(r.x).reshape(-1, 2) for r in made.collect()])
    want = df.select("a", F.col("k").cast("double")).toPandas().to_numpy()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert all((np.frombuffer(r.x).reshape(-1, 2)[:, 1] == r.by).all() for r in made.collect())


def test_a_step_is_one_job(spark):
    df = _rows(spark).cache()
    df.count()
    for fit in (lambda n: fit_relu_network(df, ["a", "b"], "k", 2, epochs=n),
                lambda n: fit_autoencoder(df, ["a", "b"], max_iter=n, layers=[2, 3, 2])):
        assert _jobs(spark, lambda: fit(7)) - _jobs(spark, lambda: fit(2)) == 5


def test_every_row_passes_a_tree_once(spark):
    df = _rows(spark)
    calls = spark.sparkContext.accumulator(0)
    old = hb._advance

    def counting(tree):
        run = old(tree)

        def counted(block):
            calls.add(1)
            return run(block)

        return counted

    hb._advance = counting
    try:
        model = hb.fit_hist_boosting(df.coalesce(1), ["a", "b"], "y", rounds=13, max_leaves=6)
    finally:
        hb._advance = old
    assert len(model.trees) == 13 and calls.value == 12  # one block; the last tree changes no further count
    want = df.select("y").toPandas().y
    assert ((model.transform(df).toPandas().prediction - want) ** 2).mean() < want.var() * 0.4
