"""Keys and salts stay out of plans; fingerprints tell any two tables apart."""

import hashlib

from pyspark.sql import functions as F

from pulsekit.operators import privacy
from pulsekit.sources import io


def _plans(df):
    df.collect()
    return df._jdf.queryExecution().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_salt_and_key_are_in_no_plan(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("patient_id"), F.lit("x").alias("v"))
    tokens = privacy.pseudonymize(df, "grain-of-salt")
    assert "grain-of-salt" not in _plans(tokens)
    assert tokens.first().patient_id == "anon-" + hashlib.sha256(b"grain-of-salt0").hexdigest()[:32]
    cipher = df.select(io.encrypt_column("v", "pass-phrase").alias("c"))
    plain = cipher.select(io.decrypt_column("c", "pass-phrase").alias("v"))
    key = hashlib.sha256(b"pass-phrase").hexdigest()
    for q in (cipher, plain):
        text = _plans(q).lower()
        assert "pass-phrase" not in text and key not in text
    assert {r.v for r in plain.collect()} == {"x"}


def test_fingerprint_tells_rows_apart(spark):
    def fp(rows):
        return io.dataset_fingerprint(spark.createDataFrame(rows, "a string, b string, x array<int>")).first().fingerprint

    base = fp([("a|b", "c", [1]), ("d", None, None)])
    assert base == fp([("d", None, None), ("a|b", "c", [1])])
    assert len({base, fp([("a", "b|c", [1]), ("d", None, None)]), fp([("a|b", "c", [1]), ("d", "", None)]),
                fp([("a|b", "c", [2]), ("d", None, None)])}) == 4
