"""Model registry as an append-only table.

The JSON document store is replaced by a table keyed (model_id, version):
registration appends a row, reading resolves "last write wins" per key with
``max_by`` (a grouped aggregate: partial aggregation per task, no window, no
single-partition sort). Latest version per model is another ``max_by``
ordered by the integer parts of the version (``compat=True``: plain string
order, where "10.0.0" < "9.0.0").
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions import semver_key
from pulsekit.operators.gates import registry_status
from pulsekit.schema import EMPTY_SHA256

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("model_id", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
        T.StructField("status", T.StringType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("deployed_to", T.ArrayType(T.StringType())),
        T.StructField("algorithm", T.StringType()),
        T.StructField("hyperparameters", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("artifacts", T.MapType(T.StringType(), T.StringType())),
        T.StructField("dataset_hash", T.StringType()),
        T.StructField("patient_count", T.LongType()),
        T.StructField("sample_count", T.LongType()),
        T.StructField("feature_schema_version", T.StringType()),
        T.StructField("changelog", T.StringType()),
        T.StructField("registered_at", T.TimestampType()),
    ]
)


def clean_artifact_path(p: str | Column) -> Column:
    """Backslash -> slash, then keep from 'model-registry' onward when present."""
    s = F.replace(p if isinstance(p, Column) else F.col(p), F.lit("\\"), F.lit("/"))
    pos = F.instr(s, "model-registry")
    return F.when(pos > 0, s.substr(pos, F.length(s))).otherwise(s)


def clean_artifacts(m: str | Column) -> Column:
    """G8 on a map column: drop empty values, clean the rest."""
    col = m if isinstance(m, Column) else F.col(m)
    kept = F.map_filter(col, lambda k, v: v.isNotNull() & (v != ""))
    return F.transform_values(kept, lambda k, v: clean_artifact_path(v))


def latest_per_key(entries: DataFrame, key_cols: list[str] | None = None, order_col: str = "registered_at") -> DataFrame:
    """G7 read path: last write wins per (model_id, version).

    Of entries written at the same time, the one whose text is greatest wins, on every read.
    """
    key_cols = key_cols or ["model_id", "version"]
    others = [c for c in entries.columns if c not in key_cols]
    order = F.struct(F.col(order_col), F.to_json(F.struct(*others)))
    latest = entries.groupBy(*key_cols).agg(F.max_by(F.struct(*others), order).alias("__e"))
    return latest.select(*key_cols, "__e.*")


def latest_version(entries: DataFrame, compat: bool = False) -> DataFrame:
    """(model_id, latest_version) -- integer-part order, or string order in compat."""
    order = F.col("version") if compat else F.struct(semver_key("version"), F.col("version"))
    return entries.groupBy("model_id").agg(F.max_by("version", order).alias("latest_version"))


def registry_summary(entries: DataFrame) -> DataFrame:
    """Id, latest version, algorithm ('N/A' when unknown) and target."""
    return registry_summary_from_latest(latest_per_key(entries))


def registry_summary_from_latest(latest: DataFrame) -> DataFrame:
    """G10 over entries already reduced to one row per (model_id, version)."""
    order = F.struct(semver_key("version"), F.col("version"))
    return latest.groupBy("model_id").agg(
        F.max_by(F.struct("version", "algorithm", "target"), order).alias("__l")
    ).select(
        "model_id",
        F.col("__l.version").alias("latest_version"),
        F.coalesce(F.col("__l.algorithm"), F.lit("N/A")).alias("algorithm"),
        F.col("__l.target").alias("target"),
    )


class ModelRegistry:
    """Append-only registry table at ``path`` (parquet)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def register(
        self,
        model_id: str,
        version: str,
        model_type: str,
        target: str,
        deployed_to: list[str],
        algorithm: str,
        hyperparameters: dict,
        metrics: dict,
        artifacts: dict,
        feature_schema_version: str,
        changelog: str = "",
        dataset_hash: str = "",
        patient_count: int = 0,
        sample_count: int = 0,
        force_status: str | None = None,
        compat: bool = False,
    ) -> dict:
        """Append one entry; status from G6 unless forced."""
        row = {
            "model_id": model_id,
            "version": version,
            "status": None,
            "model_type": model_type,
            "target": target,
            "deployed_to": list(deployed_to),
            "algorithm": algorithm,
            "hyperparameters": {k: json.dumps(v) if not isinstance(v, str) else v for k, v in hyperparameters.items()},
            "metrics": {k: float(v) for k, v in metrics.items() if v is not None},
            "artifacts": dict(artifacts),
            "dataset_hash": dataset_hash or EMPTY_SHA256,
            "patient_count": int(patient_count),
            "sample_count": int(sample_count),
            "feature_schema_version": feature_schema_version,
            "changelog": changelog,
            "registered_at": datetime.now(timezone.utc),
        }
        df = self.spark.createDataFrame([row], REGISTRY_SCHEMA)
        df = df.withColumn("artifacts", clean_artifacts("artifacts"))
        if force_status:
            df = df.withColumn("status", F.lit(force_status))
        else:
            wide = df.select("*", *[F.col("metrics")[m].alias(m) for m in
                                    ("recall", "false_positive_rate", "fpr", "precision", "accuracy", "r2_score", "r2", "mae")])
            wide = wide.withColumn("status", registry_status(wide, "model_type", compat=compat))
            df = wide.select(*REGISTRY_SCHEMA.fieldNames())
        df.coalesce(1).write.mode("append").parquet(self.path)
        return df.first().asDict()

    def entries(self) -> DataFrame:
        return latest_per_key(self.spark.read.schema(REGISTRY_SCHEMA).parquet(self.path))

    def get_latest_model(self, model_id: str, compat: bool = False) -> dict | None:
        lv = latest_version(self.entries().where(F.col("model_id") == model_id), compat).first()
        if lv is None:
            return None
        row = self.entries().where((F.col("model_id") == model_id) & (F.col("version") == lv.latest_version)).first()
        return row.asDict(recursive=True) if row else None


def read_registry_json(spark: SparkSession, path: str) -> DataFrame:
    """Nested {models: {model_id: {version: entry}}} document -> flat table.

    The document is one JSON object, so ``multiLine`` reads it whole in one
    task; registry documents are small metadata. Corrupt input fails (no
    silent empty registry).
    """
    entry = T.StructType(
        [
            T.StructField("modelId", T.StringType()),
            T.StructField("version", T.StringType()),
            T.StructField("status", T.StringType()),
            T.StructField("type", T.StringType()),
            T.StructField("target", T.StringType()),
            T.StructField("deployedTo", T.ArrayType(T.StringType())),
            T.StructField("training", T.StructType([
                T.StructField("date", T.StringType()),
                T.StructField("datasetHash", T.StringType()),
                T.StructField("patientCount", T.LongType()),
                T.StructField("sampleCount", T.LongType()),
                T.StructField("algorithm", T.StringType()),
            ])),
            T.StructField("evaluation", T.MapType(T.StringType(), T.DoubleType())),
            T.StructField("artifacts", T.MapType(T.StringType(), T.StringType())),
            T.StructField("deployment", T.StructType([
                T.StructField("requiredFeatureSchema", T.StringType()),
                T.StructField("changelog", T.StringType()),
            ])),
        ]
    )
    schema = T.StructType(
        [
            T.StructField("registry_version", T.StringType()),
            T.StructField("updated_at", T.StringType()),
            T.StructField("models", T.MapType(T.StringType(), T.MapType(T.StringType(), entry))),
        ]
    )
    doc = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    per_model = doc.select(F.explode("models").alias("model_id", "versions"))
    per_version = per_model.select("model_id", F.explode("versions").alias("version", "e"))
    return per_version.select(
        "model_id",
        "version",
        F.col("e.status").alias("status"),
        F.col("e.type").alias("model_type"),
        F.col("e.target").alias("target"),
        F.col("e.deployedTo").alias("deployed_to"),
        F.col("e.training.algorithm").alias("algorithm"),
        F.col("e.evaluation").alias("metrics"),
        F.col("e.artifacts").alias("artifacts"),
        F.col("e.training.datasetHash").alias("dataset_hash"),
        F.col("e.training.patientCount").alias("patient_count"),
        F.col("e.training.sampleCount").alias("sample_count"),
        F.col("e.deployment.requiredFeatureSchema").alias("feature_schema_version"),
        F.col("e.deployment.changelog").alias("changelog"),
        F.to_timestamp(F.col("e.training.date")).alias("registered_at"),
    )


def evaluation_report(gated: DataFrame, model_name: str | Column, version: str | Column, dataset_hash: str | Column,
                      feature_schema_version: str = "1.0.0", metric_cols: list[str] | None = None,
                      evaluated_at: Column | None = None) -> DataFrame:
    """One report row per gated row; write with ``write_json_reports``."""
    metric_cols = metric_cols or []
    name = model_name if isinstance(model_name, Column) else F.lit(model_name)
    ver = version if isinstance(version, Column) else F.lit(version)
    metrics_map = F.map_from_arrays(F.array(*[F.lit(m) for m in metric_cols]),
                                    F.array(*[F.col(m).cast("double") for m in metric_cols])) if metric_cols else \
        F.create_map().cast("map<string,double>")
    return gated.select(
        name.alias("model_name"),
        ver.alias("version"),
        (evaluated_at if evaluated_at is not None else F.current_timestamp()).alias("evaluation_timestamp"),
        F.when(F.col("approved"), F.lit("approved_for_export")).otherwise(F.lit("rejected")).alias("status"),
        F.col("approved").alias("clinical_approval"),
        F.col("rejection_reasons"),
        F.lit(feature_schema_version).alias("feature_schema_version"),
        (dataset_hash if isinstance(dataset_hash, Column) else F.lit(dataset_hash or EMPTY_SHA256)).alias("dataset_hash"),
        metrics_map.alias("metrics"),
    )
