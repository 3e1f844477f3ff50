import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsekit.operators import timeseries
from pulsekit.operators.scaling import Scaler, fit_params


def test_robust_fixture(spark):
    df = spark.createDataFrame([(10.0, 20.0), (15.0, 25.0), (100.0, 200.0)], "a double, b double")
    p = {r.feature: (r.center, r.scale) for r in fit_params(df, ["a", "b"], "robust").collect()}
    assert p["a"] == (15.0, 45.0) and p["b"] == (25.0, 90.0)
    out = Scaler("robust").fit_transform(df, ["a"]).orderBy("b").collect()
    assert out[0].a == pytest.approx(-5 / 45)


def test_constant_columns(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    for m in ("standard", "minmax", "robust"):
        sc = Scaler(m).fit(df, ["x"])
        assert sc.params["x"][1] == 1.0
        vals = [r.x for r in sc.transform(df).collect()]
        assert vals.count(0.0) == 2 and vals.count(None) == 1


def test_standard_uses_population_std(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    assert Scaler("standard").fit(df, ["x"]).params["x"] == (2.0, 1.0)


def test_scaler_errors_and_roundtrip(spark, tmp_path):
    with pytest.raises(ValueError):
        Scaler("bogus")
    with pytest.raises(RuntimeError):
        Scaler("standard").transform(spark.range(1))
    df = spark.createDataFrame([(1.0,), (5.0,)], "x double")
    sc = Scaler("minmax").fit(df, ["x"])
    sc.save(spark, str(tmp_path / "p"))
    assert Scaler.load(spark, str(tmp_path / "p")).params == sc.params


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_resample_irregular_series(spark):
    start = _ts("2026-08-14 10:00:00")
    rows = [(start + dt.timedelta(seconds=73 * i), v) for i, v in enumerate([70.0, 72.0, 75.0, 73.0, 71.0])]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, hr_bpm double")
    out = timeseries.resample(df, freq="1min", keys=[]).orderBy("timestamp").collect()
    assert [r.hr_bpm for r in out] == [70.0, 72.0, 75.0, 73.0, 71.0]
    assert out[0].timestamp == start


def test_interpolation_edges(spark):
    start = _ts("2026-08-14 00:00:00")
    vals = [None, 1.0, None, None, None]
    df = spark.createDataFrame([(start + dt.timedelta(minutes=i), v) for i, v in enumerate(vals)],
                               "timestamp timestamp_ntz, x double")
    out = timeseries.resample(df, freq="1min", keys=[]).orderBy("timestamp").collect()
    assert [r.x for r in out] == [1.0] * 5


def test_linear_gap_and_anchor(spark):
    df = spark.createDataFrame(
        [("p", _ts("2026-08-15 00:02:00"), 0.0), ("p", _ts("2026-08-15 00:30:00"), 12.0)],
        "patient_id string, timestamp timestamp_ntz, x double",
    )
    out = timeseries.resample(df, freq="7min").orderBy("timestamp").collect()
    # buckets anchored at midnight of the first day: 00:00, 00:07, ..., 00:28
    assert out[0].timestamp == _ts("2026-08-15 00:00:00") and out[-1].timestamp == _ts("2026-08-15 00:28:00")
    assert [r.x for r in out] == [0.0, 3.0, 6.0, 9.0, 12.0]
    ff = timeseries.resample(df, freq="7min", method="ffill").orderBy("timestamp").collect()
    assert [r.x for r in ff] == [0.0, 0.0, 0.0, 0.0, 12.0]


def test_resample_slot_limit(spark):
    df = spark.createDataFrame([("p", _ts("2026-01-01 00:00:00"), 1.0), ("p", _ts("2026-01-02 00:00:00"), 2.0)],
                               "patient_id string, timestamp timestamp_ntz, x double")
    with pytest.raises(Exception):
        timeseries.resample(df, freq="1min", max_slots=100).collect()


@pytest.mark.parametrize("method", ["linear", "ffill", "bfill", "nearest"])
@pytest.mark.parametrize("keys", [[], ["patient_id"]])
def test_chunks_equal_one_chunk(spark, method, keys):
    import random

    rng = random.Random(8)
    rows = []
    for pid in ("a", "b", None):
        at = _ts("2026-03-01 00:00:00") + dt.timedelta(seconds=rng.randint(0, 80_000))
        for _ in range(60):
            at += dt.timedelta(seconds=rng.choice((20, 100, 4000, 40_000)))
            value = lambda: rng.choice((None, float("nan"), rng.uniform(0, 9)))
            rows.append((pid, at, value(), value(), None))
    df = spark.createDataFrame(rows, "patient_id string, timestamp timestamp_ntz, `x.y` double, z double, empty double")
    one = timeseries.resample(df, freq="7min", method=method, keys=keys, columns=["z", "empty"], chunk_slots=1 << 40)
    want = sorted(one.collect(), key=str)
    for size in (1, 7, 50):
        got = timeseries.resample(df.repartition(3), freq="7min", method=method, keys=keys, columns=["z", "empty"], chunk_slots=size)
        assert sorted(got.collect(), key=str) == want
    assert len(want) > 500 and all(r.empty is None for r in want)


def test_resample_methods_on_one_gap(spark):
    rows = [("p", _ts("2026-08-15 00:00:00"), None), ("p", _ts("2026-08-15 00:01:00"), 1.0), ("p", _ts("2026-08-15 00:05:00"), 5.0),
            ("p", _ts("2026-08-15 00:07:00"), None)]
    df = spark.createDataFrame(rows, "patient_id string, timestamp timestamp_ntz, x double")
    want = {"linear": [1, 1, 2, 3, 4, 5, 5, 5], "ffill": [1, 1, 1, 1, 1, 5, 5, 5], "bfill": [1, 1, 5, 5, 5, 5, 5, 5],
            "nearest": [1, 1, 1, 1, 5, 5, 5, 5]}
    for method, values in want.items():
        for size in (1, 3, 100):
            out = timeseries.resample(df, method=method, chunk_slots=size).orderBy("timestamp").collect()
            assert [r.x for r in out] == values


def test_sixty_days_of_seconds(spark):
    start = _ts("2026-01-01 00:00:00")
    rows = [("p", start, 0.0), ("p", start + dt.timedelta(days=20), 20.0), ("p", start + dt.timedelta(days=60), 60.0)]
    df = spark.createDataFrame(rows, "patient_id string, timestamp timestamp_ntz, x double")
    out = timeseries.resample(df, freq="1s", keys=[])
    day = (F.unix_micros(F.col("timestamp").cast("timestamp")) - int(start.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000) / 86_400_000_000
    out = out.withColumn("part", F.spark_partition_id())
    r = out.agg(F.count("*").alias("n"), F.max(F.abs(F.col("x") - day)).alias("off"), F.count_distinct("part").alias("parts")).first()
    assert r.n == 60 * 86_400 + 1 and r.off < 1e-9 and r.parts > 1


def test_empty_series(spark):
    df = spark.createDataFrame([("p", None, 1.0)], "patient_id string, timestamp timestamp_ntz, x double")
    assert timeseries.resample(df).count() == 0 and timeseries.resample(df, freq="7min", keys=[]).count() == 0


def test_clock_drift_fixture(spark):
    df = spark.createDataFrame([(100.0, 100.1), (101.0, 101.2), (102.0, 102.1)], "d double, s double")
    r = timeseries.clock_drift(df, "d", "s").first()
    assert r.mean_drift_sec == pytest.approx(0.4 / 3) and r.max_drift_sec == pytest.approx(0.2)
    assert r.is_drift_critical is False


def test_resample_hot_key_matches_pandas(spark):
    import random

    import pandas as pd

    rng = random.Random(4)
    start = _ts("2026-03-01 00:00:00")
    rows = []
    for pid, n in (("hot", 600), ("a", 150), ("b", 150)):  # one key holds two thirds of the rows
        t = start
        for _ in range(n):
            t += dt.timedelta(seconds=rng.randint(30, 900))
            rows.append((pid, t, None if rng.random() < 0.1 else rng.uniform(50, 120)))
    df = spark.createDataFrame(rows, "patient_id string, timestamp timestamp_ntz, hr_bpm double")
    got = {(r.patient_id, r.timestamp): r.hr_bpm for r in timeseries.resample(df.repartition(5), freq="7min").collect()}
    pdf = pd.DataFrame(rows, columns=["patient_id", "timestamp", "hr_bpm"])
    expected = {}
    for pid, g in pdf.groupby("patient_id"):
        s = g.set_index("timestamp")["hr_bpm"].astype(float).resample("7min").mean()
        s = s.interpolate(method="linear").bfill().ffill()
        for ts, v in s.items():
            expected[(pid, ts.to_pydatetime())] = v
    assert set(got) == set(expected)
    for k, v in expected.items():
        assert got[k] == pytest.approx(v, rel=1e-9, abs=1e-9)


def test_approximate_quantile_options(spark):
    from pulsekit.operators import drift

    df = spark.createDataFrame([(float(i),) for i in range(1000)], "x double")
    exact = Scaler("robust").fit(df, ["x"]).params["x"]
    approx = Scaler("robust", exact=False).fit(df, ["x"]).params["x"]
    assert exact == (499.5, 499.5)
    assert abs(approx[0] - exact[0]) <= 2 and abs(approx[1] - exact[1]) <= 4
    cur = df.withColumn("x", F.col("x") + 500)
    r = drift.feature_drift(df, cur, ["x"], exact=False).first()
    assert r.drift_detected and r.ks_statistic == 0.5


def test_resample_sorts_its_rows_once_and_narrow(spark):
    """Two sorts of rows as wide as their known points spilled at size; batches that cut chunks change nothing."""
    start = _ts("2026-03-01 00:00:00")
    rows = [(p, start + dt.timedelta(minutes=9 * i * i), None if i % 3 else float(i)) for p in "ab" for i in range(20)]
    df = spark.createDataFrame(rows, "patient_id string, timestamp timestamp_ntz, `x.y` double").repartition(2)
    out = timeseries.resample(df, freq="15min", chunk_slots=16)
    plan = out._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line and "__s#" in line]
    assert len(sorts) == 1 and "struct" not in sorts[0]
    assert out.columns == ["patient_id", "timestamp", "x.y"]
    want = sorted(out.collect())
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
        assert sorted(out.select("*").collect()) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert len(want) == 2 * (9 * 19 * 19 // 15 + 1)


@pytest.mark.parametrize("freq", ["15min", "7min"])
def test_resample_deals_its_means_by_chunk_once(spark, freq):
    """Chunks were summed up over means dealt by slot: with more tasks fewer of a chunk's rows met, and the shuffle grew faster than the rows."""
    start = _ts("2026-03-01 00:00:00")
    rows = [(p, start + dt.timedelta(minutes=9 * i * i), None if i % 3 else float(i)) for p in ("a", "b", None) for i in range(20)]
    df = spark.createDataFrame(rows, "patient_id string, timestamp timestamp_ntz, x double").repartition(2)

    def resampled():
        out = timeseries.resample(df, freq=freq, chunk_slots=16)
        plan = out._jdf.queryExecution().executedPlan().toString()
        return sorted(out.collect(), key=str), [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and "__chunk#" in x]

    got, dealt = resampled()
    assert dealt and all("REPARTITION_BY_NUM" in x for x in dealt)
    # a session that forgets how a union's sides are dealt moves the rows again and gives the same ones
    setting = "spark.sql.unionOutputPartitioning"
    kept = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "false")
        assert resampled()[0] == got
    finally:
        spark.conf.set(setting, kept)
    one = timeseries.resample(df, freq=freq, chunk_slots=1 << 40)
    assert sorted(one.collect(), key=str) == got and len(got) > 400
