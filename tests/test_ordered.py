"""Ordered statistics: forced ranges, hot groups, exact quantiles, hash-range splits."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsekit.operators import drift, metrics, ordered, scaling, split


def _hot_rows():
    rng = random.Random(4)
    groups = ["hot"] * 900 + ["a"] * 60 + ["b"] * 39 + [None]
    return [(g, round(rng.gauss(0, 50), 1)) for g in groups]


@pytest.mark.parametrize("n_ranges", [None, 1, 16])
def test_quantiles_of_a_hot_group(spark, n_ranges):
    rows = _hot_rows()
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = {r.g: r.quantiles for r in ordered.exact_quantiles(df, "x", probs, by=["g"], n_ranges=n_ranges).collect()}
    assert set(got) == {"hot", "a", "b", None}
    for g, q in got.items():
        assert q == pytest.approx(np.quantile([x for h, x in rows if h == g], probs))


def test_hot_group_spreads_over_ranges(spark):
    rows = spark.range(2000).select(F.when(F.col("id") < 1800, 0).otherwise(1).alias("g"), F.col("id").alias("x"),
                                    F.lit(1).cast("bigint").alias("n"))
    r = ordered.ranged(rows, ["g"], ["x"], n_ranges=16)
    assert r.where("g = 0").groupBy(ordered.RANGE).count().agg(F.max("count")).first()[0] < 400
    out = ordered.running_totals(r, ["g"], ["x"], ["n"])
    assert out.where("cum_n != CASE WHEN g = 0 THEN x + 1 ELSE x - 1799 END").count() == 0
    assert out.where("total_n != CASE WHEN g = 0 THEN 1800 ELSE 200 END").count() == 0


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([("a", None), ("a", float("nan")), ("b", 3.0)], "g string, x double")
    got = {r.g: r.quantiles for r in ordered.exact_quantiles(df, "x", [0.5], by=["g"]).collect()}
    assert got == {"a": [None], "b": [3.0]}
    assert ordered.exact_quantiles(df.limit(0), "x", [0.5]).first().quantiles == [None]
    lat = metrics.latency_summary(df, "x", by=["g"]).orderBy("g").collect()
    assert lat[0].latency_mean_ms is None and lat[1].latency_p99_ms == 3.0


def test_means_of_tiny_infinite_and_huge_values(spark):
    for values, mean in (([1e-13, 3e-13], 2e-13), ([1e27, 3e27], 2e27), ([1.0, float("inf")], float("inf"))):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        assert scaling.fit_params(df, ["x"], "standard").first().center == pytest.approx(mean)


def test_robust_params(spark):
    df = spark.createDataFrame([(float(i), 7.0, None) for i in range(10)], "x double, c double, e double")
    got = {r.feature: (r.center, r.scale) for r in scaling.fit_params(df, ["x", "c", "e"], "robust").collect()}
    assert got == {"x": (4.5, 4.5), "c": (7.0, 1.0), "e": (None, 1.0)}


def test_rows_find_their_split_without_a_join(spark):
    for n in (1, 2, 3, 4, 7, 30):
        df = spark.range(n * 3).select((F.col("id") % n).alias("patient_id"), "id")
        rows = split.split_by_patient(df)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
        ids = {(str(r.patient_id), r.split) for r in rows.collect()}
        assert ids == {(r.patient_id, r.split) for r in split.assign_splits(df).collect()}
        sizes = split.split_sizes(n)
        assert {s: sum(1 for _, t in ids if t == s) for s in ("train", "val", "test")} == {
            s: sizes[s] for s in ("train", "val", "test")}
    empty = spark.createDataFrame([(None, 1)], "patient_id string, x int")
    assert split.split_by_patient(empty).count() == 0 and split.assign_splits(empty).count() == 0


def test_exact_p_value_at_any_sizes(spark):
    a = spark.range(20).select(F.col("id").cast("double").alias("x"))
    assert drift.feature_drift(a, a, ["x"], p_method="exact").first().p_value == 1.0
    b = a.limit(10).withColumn("x", F.col("x") + 15)
    assert drift.feature_drift(a, b, ["x"], p_method="exact").first().p_value == round(drift.ks_pvalue_exact(0.75, 20, 10), 5)


def test_no_percentile_aggregate_over_the_rows(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("x"))
    for out in (metrics.latency_summary(df, "x"), scaling.fit_params(df, ["x"], "robust")):
        assert "percentile" not in out._jdf.queryExecution().executedPlan().toString()
