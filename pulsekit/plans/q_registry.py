"""Registered queries: approval gates, registry status, versions, upserts, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsekit.functions import round_half_up
from pulsekit.operators import gates, registry
from pulsekit.operators.features import autonomic_stress, glucose_rule
from pulsekit.operators.ordered import exact_quantiles
from pulsekit.plans.catalog import register
from pulsekit.plans.oracles import R, with_vitals
from pulsekit.sources.adapter import load_vitals, read_table

# ---------------------------------------------------------------------------
# A per-patient metrics table derived from the vitals view (one grouped pass).
# ---------------------------------------------------------------------------

_ACT_PRED = "CAST(least(greatest(floor((hr_bpm - 50) / 25), 0), 3) AS INTEGER)"
_GLU_PRED = "CAST(hrv_ms < 24 AND hr_bpm > 85 AND activity_intensity = 0 AND is_sleeping = 0 AS INTEGER)"


def patient_metrics(v):
    t, p = F.col("glucose_pattern_flag"), glucose_rule().cast("int")
    act_pred = F.least(F.greatest(F.floor((F.col("hr_bpm") - 50) / 25), F.lit(0)), F.lit(3)).cast("int")
    sleep_pred = (F.col("is_sleeping") * 2).cast("int")
    y, yhat = F.col("risk_score_30d"), autonomic_stress() * 22.0
    agg = v.groupBy("patient_id").agg(
        F.count_if((t == 0) & (p == 0)).alias("tn"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
        F.count_if((t == 1) & (p == 1)).alias("tp"),
        F.avg((F.col("activity_class") == act_pred).cast("double")).alias("acc_act"),
        F.avg((F.col("sleep_stage") == sleep_pred).cast("double")).alias("acc_sleep"),
        F.sum((y - yhat) * (y - yhat)).alias("ssr"),
        (F.var_pop(y) * F.count(y)).alias("sst"),
    )
    p95 = exact_quantiles(v, F.col("hr_bpm") / 30, [0.95], by=["patient_id"])
    agg = agg.join(p95.select("patient_id", F.col("quantiles")[0].alias("p95")), "patient_id")
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    r2 = F.when(F.col("sst") == 0, F.when(F.col("ssr") == 0, 1.0).otherwise(0.0)).otherwise(1 - F.col("ssr") / F.col("sst"))
    return agg.select(
        "patient_id",
        round_half_up(F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)), 4).alias("recall"),
        round_half_up(F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)), 4).alias("precision"),
        round_half_up(F.coalesce(F.try_divide(fp, fp + tn), F.lit(0.0)), 4).alias("false_positive_rate"),
        round_half_up("acc_act", 4).alias("accuracy"),
        round_half_up("acc_sleep", 4).alias("sleep_accuracy"),
        round_half_up("p95", 3).alias("latency_p95_ms"),
        round_half_up(r2, 4).alias("r2_score"),
    )


_PM_CTE = (
    "pm0 AS (SELECT patient_id, "
    f"count(*) FILTER (WHERE glucose_pattern_flag = 0 AND {_GLU_PRED} = 0) AS tn, "
    f"count(*) FILTER (WHERE glucose_pattern_flag = 0 AND {_GLU_PRED} = 1) AS fp, "
    f"count(*) FILTER (WHERE glucose_pattern_flag = 1 AND {_GLU_PRED} = 0) AS fn, "
    f"count(*) FILTER (WHERE glucose_pattern_flag = 1 AND {_GLU_PRED} = 1) AS tp, "
    f"avg(CAST(activity_class = {_ACT_PRED} AS DOUBLE)) AS acc_act, "
    "avg(CAST(sleep_stage = is_sleeping * 2 AS DOUBLE)) AS acc_sleep, "
    "quantile_cont(hr_bpm / 30, 0.95) AS p95, "
    "sum((risk_score_30d - 22 * greatest(0, (100 - hrv_ms) / 80)) * (risk_score_30d - 22 * greatest(0, (100 - hrv_ms) / 80))) AS ssr, "
    "var_pop(risk_score_30d) * count(risk_score_30d) AS sst FROM vitals GROUP BY patient_id)",
    "pm AS (SELECT patient_id, "
    f"{R('CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END', 4)} AS recall, "
    f"{R('CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END', 4)} AS precision, "
    f"{R('CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0.0 END', 4)} AS false_positive_rate, "
    f"{R('acc_act', 4)} AS accuracy, {R('acc_sleep', 4)} AS sleep_accuracy, {R('p95', 3)} AS latency_p95_ms, "
    + R("CASE WHEN sst = 0 THEN CASE WHEN ssr = 0 THEN 1.0 ELSE 0.0 END ELSE 1 - ssr / sst END", 4)
    + " AS r2_score FROM pm0)",
)


def _fmt_sql(x: str, k: int) -> str:
    return f"printf('%.{k}f', {R(x, k)})"


_GATE_REASONS_SQL = (
    "concat_ws(' | ', "
    f"CASE WHEN recall < 0.95 THEN 'Recall (' || {_fmt_sql('recall', 3)} || ') is below the minimum of 0.95.' END, "
    f"CASE WHEN false_positive_rate > 0.05 THEN 'False positive rate (' || {_fmt_sql('false_positive_rate', 3)} "
    "|| ') exceeds the maximum of 0.05.' END, "
    f"CASE WHEN precision < 0.8 THEN 'Precision (' || {_fmt_sql('precision', 3)} || ') is below the minimum of 0.80.' END, "
    f"CASE WHEN latency_p95_ms > 5.0 THEN 'Latency p95 (' || {_fmt_sql('latency_p95_ms', 2)} "
    "|| ' ms) exceeds the on-device budget of 5.0 ms.' END)"
)


@register(
    "approval_gate",
    with_vitals(
        f"SELECT patient_id, r = '' AS approved, r AS rejection_reasons, "
        "CAST(CASE WHEN r = '' THEN 0 ELSE len(string_split(r, ' | ')) END AS INTEGER) AS n_reasons "
        f"FROM (SELECT patient_id, {_GATE_REASONS_SQL} AS r FROM pm)",
        *_PM_CTE,
    ),
)
def q_approval_gate(spark, sf_dir):
    g = gates.approval_gate(patient_metrics(load_vitals(spark, sf_dir)))
    return g.select("patient_id", "approved", F.array_join("rejection_reasons", " | ").alias("rejection_reasons"),
                    F.size("rejection_reasons").alias("n_reasons"))


@register(
    "model_gates",
    with_vitals(
        "SELECT patient_id, sleep_accuracy >= 0.6 AND latency_p95_ms < 10.0 AS sleep_gate, "
        "accuracy >= 0.85 AND latency_p95_ms < 5.0 AS activity_gate, "
        "recall >= 0.85 AND false_positive_rate <= 0.1 AS glucose_gate, r2_score >= 0.75 AS risk_gate FROM pm",
        *_PM_CTE,
    ),
)
def q_model_gates(spark, sf_dir):
    pm = patient_metrics(load_vitals(spark, sf_dir))
    return pm.select(
        "patient_id",
        gates.sleep_gate(pm, accuracy_col="sleep_accuracy").alias("sleep_gate"),
        gates.activity_gate(pm).alias("activity_gate"),
        gates.glucose_gate(pm).alias("glucose_gate"),
        gates.risk_gate(pm).alias("risk_gate"),
    )


# Every model's own gate over each patient's metrics, size included.
_GATE_RULES = ("on_device", "backend", "sleep", "activity", "glucose", "risk")


@register(
    "catalog_gates",
    with_vitals(
        "SELECT patient_id, rule, CAST(CASE rule "
        "WHEN 'on_device' THEN general + CAST(latency_p95_ms > 5.0 AS INTEGER) + CAST(size_mb > 2.0 AS INTEGER) "
        "WHEN 'backend' THEN general "
        "WHEN 'sleep' THEN CAST(NOT (accuracy >= 0.6 AND latency_p95_ms < 10.0 AND size_mb < 2.0) AS INTEGER) "
        "WHEN 'activity' THEN CAST(NOT (accuracy >= 0.85 AND latency_p95_ms < 5.0 AND size_mb < 2.0) AS INTEGER) "
        "WHEN 'glucose' THEN CAST(NOT (recall >= 0.85 AND false_positive_rate <= 0.1) AS INTEGER) "
        "ELSE CAST(NOT r2_score >= 0.75 AS INTEGER) END AS INTEGER) AS n_reasons FROM sized, "
        f"(SELECT unnest({list(_GATE_RULES)}) AS rule)",
        *_PM_CTE,
        "sized AS (SELECT *, latency_p95_ms * 0.5 AS size_mb, CAST(recall < 0.95 AS INTEGER) + "
        "CAST(false_positive_rate > 0.05 AS INTEGER) + CAST(precision < 0.8 AS INTEGER) AS general FROM pm)",
    ),
)
def q_catalog_gates(spark, sf_dir):
    pm = patient_metrics(load_vitals(spark, sf_dir)).withColumn("size_mb", F.col("latency_p95_ms") * 0.5)
    reasons = [F.struct(F.lit(rule).alias("rule"), F.col(f"n_{rule}").alias("n_reasons")) for rule in _GATE_RULES]
    for rule in _GATE_RULES:
        pm = gates.model_gate(pm, rule).withColumn(f"n_{rule}", F.size("rejection_reasons")).drop(
            "approved", "rejection_reasons")
    return pm.select("patient_id", F.inline(F.array(*reasons)))


_TYPES = ["anomaly_detection", "classifier", "risk_scoring", "other"]


def _status_query(compat: bool):
    def q(spark, sf_dir):
        pm = patient_metrics(load_vitals(spark, sf_dir))
        code = F.substring_index("patient_id", "-", -1).cast("int") % 4
        types = F.array(*[F.lit(t) for t in _TYPES])
        pm = pm.withColumn("model_type", F.element_at(types, code + 1))
        return pm.select("patient_id", "model_type", gates.registry_status(pm, compat=compat).alias("status"))

    return q


def _status_oracle(compat: bool) -> str:
    fpr = "1.0" if compat else "coalesce(false_positive_rate, 1.0)"
    r2 = "0.0" if compat else "coalesce(r2_score, 0.0)"
    types = ", ".join(f"'{t}'" for t in _TYPES)
    return with_vitals(
        "SELECT patient_id, model_type, CASE "
        "WHEN model_type IN ('anomaly_detection', 'critical_alert', 'classifier') THEN "
        f"CASE WHEN (recall >= 0.95 AND {fpr} <= 0.05) OR accuracy >= 0.85 THEN 'production' ELSE 'rejected' END "
        "WHEN model_type IN ('regression', 'risk_scoring', 'continuous_prediction') THEN "
        f"CASE WHEN {r2} >= 0.8 OR 999.0 <= 10.0 THEN 'production' ELSE 'rejected' END "
        "ELSE 'staged' END AS status FROM "
        f"(SELECT *, [{types}][CAST(split_part(patient_id, '-', 2) AS INTEGER) % 4 + 1] AS model_type FROM pm)",
        *_PM_CTE,
    )


register("registry_status", _status_oracle(False))(_status_query(False))
register("registry_status_compat", _status_oracle(True))(_status_query(True))


# ---------------------------------------------------------------------------
# Registry tables derived from events
# ---------------------------------------------------------------------------

def _entries(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("model_id"),
        F.concat_ws(".", (F.col("user_id") % 12).cast("string"), (F.col("event_id") % 10).cast("string"),
                    F.lit("0")).alias("version"),
        F.col("ts").alias("registered_at"),
        F.col("event_id"),
        F.when(F.col("value") > 250, "production").when(F.col("value") > 100, "rejected").otherwise("staged").alias("status"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("algo-"), F.col("event_type"))).alias("algorithm"),
        F.concat(F.lit("target-"), (F.col("user_id") % 5).cast("string")).alias("target"),
    )


_ENTRIES_CTE = (
    "en AS (SELECT event_type AS model_id, CAST(user_id % 12 AS VARCHAR) || '.' || CAST(event_id % 10 AS VARCHAR) || '.0' "
    "AS version, ts AS registered_at, event_id, CASE WHEN value > 250 THEN 'production' WHEN value > 100 THEN 'rejected' "
    "ELSE 'staged' END AS status, CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'algo-' || event_type END AS algorithm, "
    "'target-' || CAST(user_id % 5 AS VARCHAR) AS target FROM events)"
)
_SEMVER_SQL = "list_transform(string_split(version, '.'), lambda x: TRY_CAST(x AS INTEGER))"


@register(
    "registry_latest",
    f"WITH {_ENTRIES_CTE} SELECT model_id, arg_max(version, ({_SEMVER_SQL}, version)) AS latest_version "
    "FROM en GROUP BY model_id",
)
def q_registry_latest(spark, sf_dir):
    return registry.latest_version(_entries(spark, sf_dir))


@register(
    "registry_latest_compat",
    f"WITH {_ENTRIES_CTE} SELECT model_id, max(version) AS latest_version FROM en GROUP BY model_id",
)
def q_registry_latest_compat(spark, sf_dir):
    return registry.latest_version(_entries(spark, sf_dir), compat=True)


@register(
    "registry_upsert",
    f"WITH {_ENTRIES_CTE} SELECT model_id, version, status, registered_at, event_id FROM "
    "(SELECT *, row_number() OVER (PARTITION BY model_id, version ORDER BY registered_at DESC, event_id DESC) AS rn "
    "FROM en) WHERE rn = 1",
)
def q_registry_upsert(spark, sf_dir):
    e = _entries(spark, sf_dir).select("model_id", "version", "status", "registered_at", "event_id")
    e = e.withColumn("__order", F.struct("registered_at", "event_id"))
    return registry.latest_per_key(e, order_col="__order").drop("__order")


@register(
    "registry_summary",
    f"WITH {_ENTRIES_CTE}, lw AS (SELECT model_id, version, arg_max_null(algorithm, (registered_at, event_id)) AS algorithm, "
    "arg_max_null(target, (registered_at, event_id)) AS target FROM en GROUP BY model_id, version) "
    f"SELECT model_id, arg_max(version, ({_SEMVER_SQL}, version)) AS latest_version, "
    f"coalesce(arg_max_null(algorithm, ({_SEMVER_SQL}, version)), 'N/A') AS algorithm, "
    f"arg_max_null(target, ({_SEMVER_SQL}, version)) AS target FROM lw GROUP BY model_id",
)
def q_registry_summary(spark, sf_dir):
    e = _entries(spark, sf_dir).withColumn("__order", F.struct("registered_at", "event_id"))
    latest = registry.latest_per_key(e.select("model_id", "version", "algorithm", "target", "__order"), order_col="__order")
    return registry.registry_summary_from_latest(latest)


@register(
    "artifact_paths",
    "SELECT event_id, k AS artifact, CASE WHEN instr(replace(v, '\\', '/'), 'model-registry') > 0 THEN "
    "substr(replace(v, '\\', '/'), instr(replace(v, '\\', '/'), 'model-registry')) ELSE replace(v, '\\', '/') END AS path "
    "FROM (SELECT event_id, unnest(['model', 'normalizer', 'report']) AS k, unnest([ "
    "'C:\\Users\\dev\\AppData\\Temp\\run' || CAST(user_id AS VARCHAR) || '\\model-registry\\models\\' || event_type || '\\model.bin', "
    "CASE WHEN event_id % 5 = 0 THEN '' ELSE '/tmp/run/' || event_type || '/normalizer.parquet' END, "
    "'evaluation/reports/' || event_type || '_evaluation.json']) AS v FROM events) WHERE v IS NOT NULL AND v <> ''",
)
def q_artifact_paths(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    arts = F.create_map(
        F.lit("model"),
        F.concat(F.lit("C:\\Users\\dev\\AppData\\Temp\\run"), F.col("user_id").cast("string"),
                 F.lit("\\model-registry\\models\\"), F.col("event_type"), F.lit("\\model.bin")),
        F.lit("normalizer"),
        F.when(F.col("event_id") % 5 == 0, F.lit("")).otherwise(
            F.concat(F.lit("/tmp/run/"), F.col("event_type"), F.lit("/normalizer.parquet"))),
        F.lit("report"),
        F.concat(F.lit("evaluation/reports/"), F.col("event_type"), F.lit("_evaluation.json")),
    )
    cleaned = ev.select("event_id", registry.clean_artifacts(arts).alias("a"))
    return cleaned.select("event_id", F.explode("a").alias("artifact", "path"))


@register(
    "evaluation_report",
    with_vitals(
        "SELECT 'glucose_patterns' AS model_name, '1.0.0' AS version, "
        "CASE WHEN r = '' THEN 'approved_for_export' ELSE 'rejected' END AS status, r = '' AS clinical_approval, "
        "r AS rejection_reasons, '1.0.0' AS feature_schema_version, patient_id AS dataset_hash, "
        "recall AS metric_recall, false_positive_rate AS metric_false_positive_rate "
        f"FROM (SELECT patient_id, recall, false_positive_rate, {_GATE_REASONS_SQL} AS r FROM pm)",
        *_PM_CTE,
    ),
)
def q_evaluation_report(spark, sf_dir):
    g = gates.approval_gate(patient_metrics(load_vitals(spark, sf_dir)))
    rep = registry.evaluation_report(g, "glucose_patterns", "1.0.0", dataset_hash=F.col("patient_id"),
                                     metric_cols=["recall", "false_positive_rate"])
    return rep.select(
        "model_name", "version", "status", "clinical_approval",
        F.array_join("rejection_reasons", " | ").alias("rejection_reasons"),
        "feature_schema_version", "dataset_hash",
        F.col("metrics")["recall"].alias("metric_recall"),
        F.col("metrics")["false_positive_rate"].alias("metric_false_positive_rate"),
    )
