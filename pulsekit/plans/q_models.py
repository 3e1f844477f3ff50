"""Registered model queries (M1-M7): every model is fitted on the vitals view and checked on its validation rows.

Learned numbers have no SQL form. A row therefore holds what SQL can derive exactly,
the sizes of both splits and the positives among the scored rows (from the confusion
counts), and whether the model reaches a stated quality, which the oracle expects.

The vitals view derives sleep stages from event ids and half of the glucose flags from
noise, so nothing can learn those: the bounds of these models (accuracy 0.2 of four
stages, AUC 0.6) only tell a working fit from a broken one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pulsekit.models import anomaly, mllib_models
from pulsekit.operators import privacy, split
from pulsekit.plans.catalog import register
from pulsekit.plans.oracles import with_vitals
from pulsekit.plans.scoring import load_run
from pulsekit.plans.training import prepare, save_run
from pulsekit.schema import ALLOWED_RULES, RANGE_RULES
from pulsekit.session import checkpoint_dir, remove_table
from pulsekit.sources.adapter import load_vitals

MODEL_SALT = "pulsekit-model-salt:"

ROW_SCHEMA = "model_id string, algorithm string, n_train long, n_val long, n_positive long, quality_reached boolean"


def _tagged(spark, sf_dir):
    v = load_vitals(spark, sf_dir)
    anon = privacy.pseudonymize(privacy.drop_pii(privacy.consent_filter(v)), MODEL_SALT)
    return split.split_by_patient(anon)


def _model_query(fn, quality: str, bound: float, **kw):
    def q(spark, sf_dir):
        tagged = _tagged(spark, sf_dir).cache()
        try:
            res = fn(tagged, **kw)
            m = res.metrics
            cells = ("true_positives", "false_positives", "true_negatives", "false_negatives")
            binary = all(c in m for c in cells)
            n_val = sum(m[c] for c in cells) if binary else m["n_samples"]
            positive = m["true_positives"] + m["false_negatives"] if binary else None
            cohort = tagged if res.cohort is None else res.cohort
            row = (res.model_id, res.algorithm, cohort.where(F.col("split") == "train").count(), n_val, positive,
                   m[quality] >= bound)
            return spark.createDataFrame([row], ROW_SCHEMA)
        finally:
            tagged.unpersist()

    return q


def _model_oracle(model_id: str, algorithm: str, label: str | None, rows: str = "TRUE") -> str:
    positive = f"count(*) FILTER (WHERE split = 'val' AND {label} = 1)" if label else "CAST(NULL AS BIGINT)"
    return with_vitals(
        f"SELECT '{model_id}' AS model_id, '{algorithm}' AS algorithm, count(*) FILTER (WHERE split = 'train') AS n_train, "
        f"count(*) FILTER (WHERE split = 'val') AS n_val, {positive} AS n_positive, TRUE AS quality_reached "
        "FROM co JOIN placed USING (anon)",
        f"c0 AS (SELECT *, 'anon-' || substr(sha256('{MODEL_SALT}' || patient_id), 1, {privacy.TOKEN_LEN}) AS anon "
        "FROM vitals WHERE consent_for_ml_training)",
        f"co AS (SELECT * FROM c0 WHERE {rows})",
        "ids AS (SELECT anon, row_number() OVER (ORDER BY sha256('42:' || anon)) AS rank, count(*) OVER () AS n "
        "FROM (SELECT DISTINCT anon FROM co))",
        "placed AS (SELECT anon, CASE WHEN rank <= floor(n * 0.7::DOUBLE) THEN 'train' "
        "WHEN rank <= floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM ids)",
    )


_SLEEPING = "is_sleeping = 1 OR (SELECT count(*) FROM c0 WHERE is_sleeping = 1) < 50"

for _fn, _id, _algorithm, _label, _rows, _quality, _bound, _kw in (
    (anomaly.train_heart_rate, "heart_rate_anomaly", "IsolationForest", "is_hr_anomaly", "TRUE", "auc_roc", 0.8, {}),
    (mllib_models.train_spo2, "spo2_critical", "RandomForestClassifier", "critical_spo2_drop", "TRUE", "recall", 0.95, {}),
    (anomaly.train_combined, "combined_vitals", "DenseAutoencoder", "is_hr_anomaly", "TRUE", "auc_roc", 0.5,
     {"max_iter": 250}),
    (mllib_models.train_sleep, "sleep_quality", "RandomForestClassifier", None, _SLEEPING, "accuracy", 0.2, {}),
    (mllib_models.train_activity, "activity_recognition", "ReluNetwork", None, "TRUE", "accuracy", 0.3,
     {"max_iter": 250}),
    (mllib_models.train_glucose, "glucose_patterns", "GBTClassifier", "glucose_pattern_flag", "TRUE", "auc_roc", 0.6, {}),
    (mllib_models.train_risk, "risk_score", "HistGradientBoosting", None, "TRUE", "r2_score", 0.94, {}),
):
    register(f"model_{_id}", _model_oracle(_id, _algorithm, _label, _rows))(_model_query(_fn, _quality, _bound, **_kw))


def _digest(scored, score: str):
    """Rows and a sum of row digests: equal tables have equal ones, in any order."""
    row = F.xxhash64("patient_id", "timestamp", F.col(score).cast("double"), F.col("pred").cast("double")).cast("decimal(38,0)")
    return tuple(scored.agg(F.count("*"), F.sum(row)).first())


def _reload_query(fn, score: str):
    """Fit, save, read back: the model read back scores every validation row as the fitted one did."""

    def q(spark, sf_dir):
        tagged = _tagged(spark, sf_dir).cache()
        try:
            res = fn(tagged)
            folder = f"{checkpoint_dir(spark)}/models-{uuid.uuid4().hex}"
            save_run(spark, res, folder)
            again = load_run(spark, folder).score(tagged.where("split = 'val'"), ["patient_id", "timestamp"])
            n, digest = _digest(again, "score")
            return spark.createDataFrame([(res.model_id, n, (n, digest) == _digest(res.scored, score))],
                                         "model_id string, n_val long, same_scores boolean")
        finally:
            tagged.unpersist()

    return q


for _fn, _id, _score in (
    (anomaly.train_heart_rate, "heart_rate_anomaly", "anomaly_score"),
    (mllib_models.train_spo2, "spo2_critical", "score"),
):
    register(f"model_reload_{_id}", f"SELECT model_id, n_val, TRUE AS same_scores FROM ({_model_oracle(_id, '', None)})")(
        _reload_query(_fn, _score))


_VALID = " AND ".join(
    [f"({c} IS NULL OR {c} BETWEEN {lo} AND {hi})" for c, (lo, hi, _) in RANGE_RULES.items()]
    + [f"({c} IS NULL OR {c} IN ({', '.join(map(str, allowed))}))" for c, (allowed, _) in ALLOWED_RULES.items()])


@register("training_tables", _model_oracle("", "", None, _VALID).replace(
    "SELECT '' AS model_id, '' AS algorithm, ", "SELECT (SELECT count(*) FROM vitals) AS records_total, "
    "(SELECT count(*) FROM c0) AS consented, (SELECT count(DISTINCT patient_id) FROM c0) AS patients, ").replace(
    "CAST(NULL AS BIGINT) AS n_positive, TRUE AS quality_reached", "count(*) FILTER (WHERE split = 'test') AS n_test"))
def q_training_tables(spark, sf_dir):
    """What the training plan prepares from one read of the source: audit counts and the rows of every split."""
    tagged, facts = prepare(spark, load_vitals(spark, sf_dir), salt=MODEL_SALT)
    try:
        size = {r["split"]: r["count"] for r in tagged.groupBy("split").count().collect()}  # three rows
        a = facts["audit"]
        row = (a["records_total"], a["records_consented_processed"], a["patients_count"],
               *[size.get(s, 0) for s in ("train", "val", "test")])
        return spark.createDataFrame([row], "records_total long, consented long, patients long, n_train long, n_val long, n_test long")
    finally:
        tagged.unpersist()
        remove_table(spark, facts["table"])
