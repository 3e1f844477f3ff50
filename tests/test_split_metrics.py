import itertools
import random

import pytest
from pyspark.sql import functions as F

from pulsekit.functions import round_half_up
from pulsekit.operators import metrics, split


@pytest.mark.parametrize("n,expected", [(1, (0, 0, 1)), (2, (1, 0, 1)), (3, (1, 1, 1)), (4, (1, 1, 2)),
                                        (20, (14, 3, 3)), (30, (21, 4, 5))])
def test_split_sizes(n, expected):
    s = split.split_sizes(n)
    assert (s["train"], s["val"], s["test"]) == expected


def test_ratio_check():
    with pytest.raises(ValueError):
        split.split_sizes(10, (0.5, 0.2, 0.2))


def test_split_disjoint_and_invariant(spark):
    rows = [(f"P{i}", j) for i in range(30) for j in range(3)]
    df = spark.createDataFrame(rows, "patient_id string, x int")
    a = {r.patient_id: r.split for r in split.assign_splits(df).collect()}
    b = {r.patient_id: r.split for r in split.assign_splits(df.repartition(7)).collect()}
    assert a == b
    counts = {s: sum(1 for v in a.values() if v == s) for s in ("train", "val", "test")}
    assert counts == {"train": 21, "val": 4, "test": 5}
    tr, va, te = split.splits(df)
    ids = [set(r.patient_id for r in d.select("patient_id").distinct().collect()) for d in (tr, va, te)]
    assert not (ids[0] & ids[1]) and not (ids[0] & ids[2]) and not (ids[1] & ids[2])
    with pytest.raises(ValueError):
        split.assign_splits(df.drop("patient_id"))


def test_classification_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (2, 1)], "y int, p int")
    m = metrics.classification_metrics(df, "y", "p").first()
    assert m.recall == 0.0 and m.precision == 0.0 and m.f1_score == 0.0 and m.specificity == 1.0
    assert m.true_negatives == 2 and m.false_positives == 0  # label 2 ignored


def _brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_rank_auc_matches_brute_force_with_ties(spark):
    rng = random.Random(7)
    pairs = [(rng.randint(0, 1), float(rng.randint(0, 20))) for _ in range(400)]
    df = spark.createDataFrame(pairs, "y int, s double")
    for nb in (1, 4, 64):
        r = metrics.rank_auc(df.repartition(5), "y", "s", n_ranges=nb).first()
        assert r.auc_roc == pytest.approx(round(_brute_auc(pairs), 4))


def test_rank_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.5)], "y int, s double")
    assert metrics.rank_auc(df, "y", "s").first().auc_roc is None


def test_rank_auc_grouped(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.1), ("b", 0, 0.9)], "g string, y int, s double")
    out = {r.g: r.auc_roc for r in metrics.rank_auc(df, "y", "s", by=["g"]).collect()}
    assert out == {"a": 1.0, "b": 0.0}


def test_regression_constant_target(spark):
    df = spark.createDataFrame([(5.0, 5.0), (5.0, 5.0)], "y double, p double")
    assert metrics.regression_metrics(df, "y", "p").first().r2_score == 1.0
    df2 = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "y double, p double")
    r = metrics.regression_metrics(df2, "y", "p").first()
    assert r.r2_score == 0.0 and r.mse == 1.0 and r.rmse == 1.0


def test_accuracy_latency_contamination(spark):
    df = spark.createDataFrame([(1, 1, float(i)) for i in range(1, 101)], "y int, p int, ms double")
    assert metrics.accuracy(df, "y", "p").first().accuracy == 1.0
    lat = metrics.latency_summary(df, "ms").first()
    assert lat.latency_p95_ms == pytest.approx(95.05) and lat.latency_min_ms == 1.0
    assert metrics.anomaly_fraction(df, "y").first().contamination == 0.12


def test_rank_auc_grouped_bucketed_matches_brute_force(spark):
    rng = random.Random(21)
    rows = [(g, rng.randint(0, 1), float(rng.randint(0, 15))) for g in ("a", "b", "c") for _ in range(200)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    for nb in (1, 8):
        got = {r.g: r.auc_roc for r in metrics.rank_auc(df.repartition(3), "y", "s", by=["g"], n_ranges=nb).collect()}
        for g in ("a", "b", "c"):
            pairs = [(y, s) for gg, y, s in rows if gg == g]
            assert got[g] == pytest.approx(round(_brute_auc(pairs), 4))


def test_rounding_leaves_what_it_cannot_round(spark):
    import math

    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (1e15,), (-1e13,), (2.675,), (-0.00005,), (None,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 4)).collect()]
    assert math.isnan(got[0]) and got[1:] == [float("inf"), float("-inf"), 1e15, -1e13, 2.675, 0.0, None]
    assert df.select(round_half_up("x", 6)).collect()[4][0] == -1e13


def test_metrics_with_odd_values(spark):
    import math

    df = spark.createDataFrame([(1.0, 1.0), (0.0, None), (1.0, None), (0.0, 1.0)], "y double, p double")
    r = metrics.accuracy(df, "y", "p").first()
    assert (r.accuracy, r.n_samples) == (0.5, 2)
    odd = spark.createDataFrame([(0.9, 1.0), (0.2, 0.0), (float("nan"), 1.0), (1.0, 1.0), (0.0, 1.0), (None, 1.0)], "y double, p double")
    c = metrics.confusion(odd, "y", "p").first()
    assert (c.true_negatives, c.false_positives, c.false_negatives, c.true_positives) == (0, 1, 0, 1)
    assert metrics.rank_auc(odd, "y", "p").first().n_pos == 1
    m = metrics.regression_metrics(spark.createDataFrame([(1.0, float("nan")), (2.0, 2.0)], "y double, p double"), "y", "p").first()
    assert math.isnan(m.mse) and math.isnan(m.rmse) and math.isnan(m.r2_score)
    big = metrics.regression_metrics(spark.createDataFrame([(0.0, 1e9), (1.0, 2e9)], "y double, p double"), "y", "p").first()
    assert big.mse == pytest.approx(2.5e18, rel=1e-6) and big.rmse == pytest.approx(math.sqrt(big.mse))


def test_nan_metrics_fail_their_gates(spark):
    from pulsekit.operators import gates

    nan = float("nan")
    good = {"recall": 0.99, "false_positive_rate": 0.01, "precision": 0.9, "latency_p95_ms": 1.0, "size_mb": 1.0, "accuracy": 0.99, "r2_score": 0.99}
    for key in ("recall", "false_positive_rate", "precision", "latency_p95_ms", "size_mb"):
        row = gates.approval_gate(spark.createDataFrame([{**good, key: nan}])).first()
        assert not row.approved and len(row.rejection_reasons) == 1 and "NaN" in row.rejection_reasons[0]
    assert gates.approval_gate(spark.createDataFrame([good])).first().approved
    for rule, key in (("sleep", "accuracy"), ("activity", "accuracy"), ("glucose", "recall"), ("risk", "r2_score")):
        assert not gates.model_gate(spark.createDataFrame([{**good, key: nan}]), rule).first().approved
    df = spark.createDataFrame([{**good, "recall": nan, "accuracy": nan, "model_type": "classifier"}])
    assert df.select(gates.registry_status(df)).first()[0] == "rejected"


def test_stream_and_batch_tokens_agree(spark):
    import inspect

    from pulsekit.operators import privacy
    from pulsekit.streaming import stream_ops

    assert inspect.signature(stream_ops.anonymize_stream).parameters["token_len"].default == privacy.TOKEN_LEN
