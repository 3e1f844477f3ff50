"""End-to-end training plans.

The source is read once, by one narrow job that writes its anonymised rows to a
table in the shared folder. A row without consent leaves only its digest there.
Audit event and fingerprint are aggregates of that table, and quality report,
routing, split and features read it; the split rows are persisted
(MEMORY_AND_DISK) and reused by every model fit. A lost executor costs a read of
the table, never of the source.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.models import anomaly, mllib_models
from pulsekit.models.common import FitResult
from pulsekit.operators import drift, gates, metrics, privacy, quality, split
from pulsekit.operators.registry import ModelRegistry, evaluation_report, registry_summary
from pulsekit.schema import FEATURE_SCHEMA_VERSION
from pulsekit.session import checkpoint_dir, remove_table
from pulsekit.sources.io import digests_fingerprint, read_measurements, with_row_digest, write_json

SETTINGS_SCHEMA = "model_id string, algorithm string, hyperparameters string"


@dataclass(frozen=True)
class CatalogEntry:
    """What the catalogue knows of a model beside its training: registry row and gate."""

    model_type: str
    target: str
    deployed_to: tuple[str, ...]
    gate: str
    train: Callable


# Type, target, deployment and gate of each model.
TRAINERS = {
    "heart_rate_anomaly": CatalogEntry("anomaly_detection", "heart_rate", ("android", "backend"), "on_device",
                                       anomaly.train_heart_rate),
    "spo2_critical": CatalogEntry("critical_alert", "spo2_critical", ("android",), "on_device", mllib_models.train_spo2),
    "combined_vitals": CatalogEntry("anomaly_detection", "combined_vitals", ("backend",), "backend",
                                    anomaly.train_combined),
    "sleep_quality": CatalogEntry("classifier", "sleep_stage", ("android",), "sleep", mllib_models.train_sleep),
    "activity_recognition": CatalogEntry("classifier", "activity_class", ("android",), "activity",
                                         mllib_models.train_activity),
    "glucose_patterns": CatalogEntry("anomaly_detection", "glucose_pattern_flag", ("android", "backend"), "glucose",
                                     mllib_models.train_glucose),
    "risk_score": CatalogEntry("regression", "30_day_risk_score", ("backend",), "risk", mllib_models.train_risk),
}


def _free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def prepare(
    spark: SparkSession,
    source: str | DataFrame,
    salt: str | None = None,
    seed: int = 42,
    strict_quality: bool = False,
    audit_sink: str | None = None,
) -> tuple[DataFrame, dict]:
    """Anonymise, route invalid rows out (or fail when ``strict_quality``), split by patient.

    Returns the persisted tagged table (``split`` column) and run facts
    (audit row, quality verdict, fingerprint). ``facts["table"]`` is the folder of the
    anonymised rows, which the tagged table reads: remove it (``session.remove_table``)
    when the run is over.
    """
    rows = read_measurements(spark, source)
    privacy.consent_filter(rows)  # refuses tables without the flag before anything runs
    digest, agreed = _free_names(rows, "__digest", "__agreed")
    marked = with_row_digest(rows, digest).withColumn(agreed, F.coalesce(F.col(privacy.CONSENT_COL), F.lit(False)))
    anon = privacy.pseudonymize(privacy.drop_pii(marked), salt or privacy.new_salt())
    names = [c for c in anon.columns if c not in (digest, agreed)]
    anon = anon.select(*[F.when(F.col(agreed), F.col(f"`{c}`")).alias(c) for c in names], digest, agreed)
    facts: dict = {"table": f"{checkpoint_dir(spark)}/anonymised-{uuid.uuid4().hex}"}
    try:
        anon.write.parquet(facts["table"])
        stored = spark.read.schema(anon.schema).parquet(facts["table"])
        seen = stored.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(agreed)).alias("consented"),
                          digests_fingerprint(digest).alias("fingerprint")).first()
        if not seen.consented:
            raise privacy.ConsentError("Zero records with active consent for ML training.")
        anon = stored.where(F.col(agreed)).drop(digest, agreed)
        audit = privacy.audit_event(spark, seen.n, seen.consented, privacy.patient_count(anon))
        if audit_sink:
            audit.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(audit_sink)
        facts["audit"] = audit.first().asDict()
        facts["dataset_hash"], facts["sample_count"] = seen.fingerprint, seen.n
        if strict_quality:
            facts["quality"] = quality.require_valid(anon)
            valid = anon
        else:
            facts["quality"] = quality.validate(anon)
            valid = quality.quarantine(anon).where("is_valid").drop("reasons", "is_valid")
        return split.split_by_patient(valid, seed=seed).persist(StorageLevel.MEMORY_AND_DISK), facts
    except Exception:
        remove_table(spark, facts["table"])
        raise


def train_one(tagged: DataFrame, model_id: str, **kw):
    return TRAINERS[model_id].train(tagged, **kw)


def save_run(spark: SparkSession, res: FitResult, folder: str) -> dict[str, str]:
    """Model, scaler and settings as tables below ``folder`` (``scoring.load_run`` reads them); their paths by artifact name."""
    paths = {"model": f"{folder}/model", "normalizer": f"{folder}/scaler", "settings": f"{folder}/settings"}
    if hasattr(res.model, "write"):
        res.model.write().overwrite().save(paths["model"])
    else:
        res.model.save(spark, paths["model"])
    res.scaler.save(spark, paths["normalizer"])
    spark.createDataFrame([(res.model_id, res.algorithm, json.dumps(res.hyperparameters))], SETTINGS_SCHEMA).coalesce(
        1).write.mode("overwrite").parquet(paths["settings"])
    return paths


def stored_mb(spark: SparkSession, path: str) -> float:
    """Size of the files below ``path`` on any file system Spark reads (their contents are not read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return (files.agg(F.sum("length")).first()[0] or 0) / (1024.0 * 1024.0)


def run_catalog(
    spark: SparkSession,
    source: str | DataFrame,
    registry_path: str,
    version: str = "1.0.0",
    models: list[str] | None = None,
    trainer_kw: dict | None = None,
    artifacts_path: str | None = None,
    timings: DataFrame | None = None,
    drift_reference: DataFrame | None = None,
) -> dict:
    """M8: prepare once; fit, save, gate, report and register every model; optional drift check; summary.

    ``timings`` (model_id, ms) holds measured single-record latencies, which the gates of
    device models read; without it, and so for a missing model, latency counts as 0 and passes.
    Models, scalers and reports go below ``artifacts_path`` (beside the registry by default), a
    folder the cluster shares.
    """
    tagged, facts = prepare(spark, source)
    reg = ModelRegistry(spark, registry_path)
    artifacts_path = artifacts_path or f"{registry_path.rstrip('/')}_artifacts"
    latency = {}
    if timings is not None:
        latency = {r.model_id: {k: v for k, v in r.asDict().items() if k != "model_id"}
                   for r in metrics.latency_summary(timings, "ms", by=["model_id"]).collect()}  # one row a model
    results = {}
    try:
        for model_id in models or list(TRAINERS):
            plan = TRAINERS[model_id]
            res = train_one(tagged, model_id, **(trainer_kw or {}).get(model_id, {}))
            folder = f"{artifacts_path}/{model_id}/{version}"
            paths = save_run(spark, res, folder)
            values = {k: float(v) for k, v in {**res.metrics, **latency.get(model_id, {})}.items() if v is not None}
            values["size_mb"] = round(stored_mb(spark, paths["model"]), 3)
            gated = gates.model_gate(spark.createDataFrame([values]), plan.gate)
            verdict = gated.first()
            paths["evaluation_report"] = f"{folder}/report"
            write_json(evaluation_report(gated, model_id, version, facts["dataset_hash"], FEATURE_SCHEMA_VERSION,
                                         sorted(values)), paths["evaluation_report"])
            cohort = metrics.run_counts(tagged if res.cohort is None else res.cohort).first()
            entry = reg.register(
                model_id=model_id, version=version, model_type=plan.model_type, target=plan.target,
                deployed_to=list(plan.deployed_to), algorithm=res.algorithm, hyperparameters=res.hyperparameters,
                metrics=values, artifacts=paths, feature_schema_version=FEATURE_SCHEMA_VERSION,
                dataset_hash=facts["dataset_hash"], patient_count=cohort.patient_count, sample_count=cohort.sample_count,
            )
            # The approval gate and the registry status follow different rules; both are kept.
            results[model_id] = {"metrics": values, "gate_status": "approved_for_export" if verdict.approved
                                 else "rejected", "registry_status": entry["status"], "artifacts": paths,
                                 "reasons": list(verdict.rejection_reasons)}
        out = {"models": results, "facts": facts,
               "registry": [r.asDict() for r in registry_summary(reg.entries()).collect()]}
        if drift_reference is not None:
            per, summary = drift.check_drift(drift_reference, tagged.drop("split"))
            out["drift"] = summary.first().asDict()
        return out
    finally:
        tagged.unpersist()
        remove_table(spark, facts.pop("table"))
