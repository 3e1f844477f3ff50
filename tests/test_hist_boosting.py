"""Leaf-wise histogram boosting (M7) against one-at-a-time growth on the driver, and on a noisy fixture."""

import numpy as np
import pandas as pd
import pytest

from pulsekit.models import hist_boosting as hb


def grow_one_at_a_time(bins, res, max_leaves, least, rate):
    """Best-first growth with every histogram counted from the rows: (feature, cut, left, right, value) by node."""
    tree = hb.Tree()
    tree.add(-rate * res.mean())

    def split_of(rows):
        best = (1e-9, None)
        for f in range(bins.shape[1]):
            for c in range(255):
                left = bins[rows, f] <= c
                n = int(left.sum())
                if min(n, len(rows) - n) < least:
                    continue
                g, all_ = res[rows][left].sum(), res[rows].sum()
                gain = g * g / n + (all_ - g) ** 2 / (len(rows) - n) - all_ * all_ / len(rows)
                if gain > best[0] + 1e-7:
                    best = (gain, (f, c))
        return best

    leaves = {0: (np.arange(len(res)), *split_of(np.arange(len(res))))}
    while len(leaves) < max_leaves:
        at = max((k for k in leaves if leaves[k][2]), key=lambda k: (leaves[k][1], -k), default=None)
        if at is None:
            break
        rows, _, (f, c) = leaves.pop(at)
        sides = rows[bins[rows, f] <= c], rows[bins[rows, f] > c]
        kids = tree.split(at, f, c, tuple(-rate * res[s].mean() for s in sides))
        for k, s in zip(kids, sides):
            leaves[k] = (s, *split_of(s))
    return tree


@pytest.fixture(scope="module")
def noisy():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 3))
    x[:, 2] = np.round(x[:, 2])
    y = 10 * np.sin(x[:, 0]) + 5 * (x[:, 1] > 0) * x[:, 2] + rng.normal(size=len(x))
    return pd.DataFrame(np.column_stack([x, y]), columns=["a", "b", "c", "y"])


def test_trees_equal_one_at_a_time_growth(spark, noisy):
    model = hb.fit_hist_boosting(spark.createDataFrame(noisy).repartition(3), ["a", "b", "c"], "y", rounds=3, rate=0.3, max_leaves=9, max_bins=20)
    bins = hb.bin_rows(noisy[["a", "b", "c"]].to_numpy(), model.edges)
    pred = np.full(len(noisy), noisy.y.mean())
    for tree in model.trees:
        want = grow_one_at_a_time(bins, pred - noisy.y.to_numpy(), 9, 20, 0.3)
        assert (tree.feature, tree.cut, tree.left, tree.right) == (want.feature, want.cut, want.left, want.right)
        assert np.allclose(tree.value, want.value)
        pred += tree.predict(bins)
    assert len(model.trees) == 3


def test_noisy_fixture_save_and_load(spark, noisy, tmp_path):
    train, held = noisy[:1200], noisy[1200:]
    model = hb.fit_hist_boosting(spark.createDataFrame(train).repartition(2), ["a", "b", "c"], "y", rounds=24, rate=0.3, max_leaves=12)
    model.save(spark, str(tmp_path / "m"))
    again = hb.HistBoostingModel.load(spark, str(tmp_path / "m"))
    got = again.transform(spark.createDataFrame(held)).toPandas()
    r2 = 1 - ((got.y - got.prediction) ** 2).sum() / ((got.y - got.y.mean()) ** 2).sum()
    assert r2 >= 0.94
    first = model.transform(spark.createDataFrame(held)).toPandas()
    assert np.array_equal(first.prediction, got.prediction)


def test_odd_inputs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (float("nan"), 4.0), (2.0, None)] * 30, "a double, y double")
    model = hb.fit_hist_boosting(df, ["a"], "y", rounds=2, rate=1.0, least=5)
    got = {r.a is None or r.a != r.a: r.prediction for r in model.transform(df.where("y is not null")).collect()}
    assert got[True] == pytest.approx(3.5) and got[False] == pytest.approx(2.0)
    same = hb.fit_hist_boosting(df.withColumn("y", df.y * 0 + 1), ["a"], "y", rounds=3)
    assert same.trees == [] and same.base == 1.0
    with pytest.raises(ValueError):
        hb.fit_hist_boosting(df.limit(0), ["a"], "y")
