"""The training plan reads its source once, and gathers on the way what separate passes would."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF
from pulsekit.operators import privacy
from pulsekit.plans.training import prepare
from pulsekit.session import remove_table
from pulsekit.sources.adapter import load_vitals
from pulsekit.sources.io import dataset_fingerprint, digests_fingerprint, read_measurements, with_row_digest


def test_source_rows_are_read_once(spark, tmp_path):
    v = load_vitals(spark, SF).withColumn("__digest_x", F.lit(1))
    folder = str(tmp_path)

    def seen(frames):
        n = 0
        for pdf in frames:
            n += len(pdf)
            yield pdf
        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write(str(n))

    tagged, facts = prepare(spark, v.mapInPandas(seen, v.schema), salt="s")
    try:
        splits = {r["split"]: r["count"] for r in tagged.groupBy("split").count().collect()}
        read = sum(int((tmp_path / f).read_text()) for f in os.listdir(folder))
        assert read == v.count() == facts["sample_count"] and set(splits) == {"train", "val", "test"}
        assert facts["audit"] == privacy.audit_counts(v).first().asDict()
        assert facts["dataset_hash"] == dataset_fingerprint(read_measurements(spark, v)).first().fingerprint
        want = privacy.anonymize(read_measurements(spark, v), salt="s")[0]
        stored = spark.read.parquet(facts["table"])
        assert stored.where("__agreed").select(want.columns).exceptAll(want).count() == 0
        refused = stored.where("NOT __agreed")  # nothing of these rows but their digest
        assert refused.count() and refused.where(" OR ".join(f"{c} IS NOT NULL" for c in want.columns)).count() == 0
    finally:
        tagged.unpersist()
        remove_table(spark, facts["table"])
    assert not os.path.exists(facts["table"])


def test_fingerprint_from_digests(spark):
    df = spark.createDataFrame([(i % 5, [i], f"x{i}") for i in range(50)], "a int, d array<int>, c string").repartition(6)
    for rows in (df, df.limit(0)):
        got = with_row_digest(rows, "__digest").agg(digests_fingerprint("__digest")).first()[0]
        assert got == dataset_fingerprint(rows).first().fingerprint


def test_refusals(spark, tmp_path):
    v = load_vitals(spark, SF)
    with pytest.raises(privacy.ConsentError, match="lacks"):
        prepare(spark, v.drop(privacy.CONSENT_COL))
    for rows in (v.where(~F.col(privacy.CONSENT_COL)), v.limit(0)):
        with pytest.raises(privacy.ConsentError, match="Zero"):
            prepare(spark, rows, audit_sink=str(tmp_path / "audit"))
    assert not os.path.exists(tmp_path / "audit")
