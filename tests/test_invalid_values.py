"""Invalid values of any number as rows, a bounded list of them in the report; registry entries of one time."""

from pyspark.sql import functions as F

from pulsekit.operators import quality
from pulsekit.operators.registry import latest_per_key

RULES = {"k": ([0, 1], True), "m": ([5], False)}


def _detail(df, **kw):
    rows = quality.quality_report(df, range_rules={}, allowed_rules=RULES, **kw).where("check_name = 'allowed_set'").collect()
    return {(*[r[b] for b in kw.get("by", [])], r.column_name): (r.violations, r.severity, r.detail) for r in rows}


def test_many_values(spark):
    df = spark.range(300_000).select(F.lit("p").alias("patient_id"), (F.col("id") % 100_000).cast("int").alias("k"))
    assert quality.invalid_values(df, RULES).agg(F.count("*"), F.min("n"), F.max("n")).first()[:] == (99_998, 3, 3)
    first = ",".join(str(v) for v in range(2, 22))
    assert _detail(df) == {("k",): (299_994, "error", f"{first} and {99_998 - 20} more")}


def test_groups_nulls_and_order(spark):
    rows = [("a", 10, None), ("a", 9, 5.0), ("a", 9, 2.5), ("b", 1, float("nan")), (None, -3, 7.0), (None, 0, 5.0)]
    df = spark.createDataFrame(rows, "patient_id string, k int, m double")
    assert _detail(df, by=["patient_id"]) == {
        ("a", "k"): (3, "error", "9,10"), ("a", "m"): (1, "error", "2.5"), ("b", "k"): (0, "ok", ""), ("b", "m"): (0, "ok", ""),
        (None, "k"): (1, "error", "-3"), (None, "m"): (1, "error", "7.0")}
    got = {(r.column_name, r.value, r.n) for r in quality.invalid_values(df, RULES).collect()}
    assert got == {("k", "-3", 1), ("k", "9", 2), ("k", "10", 1), ("m", "2.5", 1), ("m", "7.0", 1)}
    assert quality.invalid_values(df.limit(0), RULES).count() == 0 and quality.invalid_values(df.drop("k", "m"), RULES).count() == 0
    assert _detail(df.limit(0)) == {("k",): (0, "ok", ""), ("m",): (0, "ok", "")}


def test_entries_of_one_time(spark):
    rows = [("m", "1", 7, "b"), ("m", "1", 7, "a"), ("m", "1", 6, "z")]
    for r in (rows, rows[::-1]):
        df = spark.createDataFrame(r, "model_id string, version string, registered_at long, status string").repartition(3)
        assert [x.status for x in latest_per_key(df).collect()] == ["b"]
