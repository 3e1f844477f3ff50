"""Registered queries: scaling, clock drift, split, metrics, AUC, latency, resampling."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from pulsekit.functions import round_half_up
from pulsekit.operators import features as fx
from pulsekit.operators import metrics, split, timeseries
from pulsekit.operators.ordered import exact_quantiles
from pulsekit.operators.scaling import Scaler, fit_params
from pulsekit.plans.catalog import register
from pulsekit.plans.oracles import R, R_any, with_vitals
from pulsekit.sources.adapter import load_vitals, read_table

SCALE_COLS = ["hr_bpm", "hrv_ms", "spo2_percent", "resp_rate", "temp_c", "bp_sys"]


# ---------------------------------------------------------------------------
# Scaling (A8-A11)
# ---------------------------------------------------------------------------

def _params_query(method):
    def q(spark, sf_dir):
        p = fit_params(load_vitals(spark, sf_dir), SCALE_COLS, method)
        return p.select("feature", round_half_up("center", 6).alias("center"), round_half_up("scale", 6).alias("scale"),
                        "method")

    return q


def _params_oracle(method: str) -> str:
    parts = []
    for c in SCALE_COLS:
        x = f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END"
        if method == "standard":
            center, scale = f"avg({x})", f"stddev_pop({x})"
        elif method == "minmax":
            center, scale = f"min({x})", f"max({x}) - min({x})"
        else:
            center = f"quantile_cont({x}, 0.5)"
            scale = f"quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)"
        parts.append(
            f"SELECT '{c}' AS feature, {R(center, 6)} AS center, "
            f"{R(f'CASE WHEN ({scale}) IS NULL OR ({scale}) = 0 THEN 1.0 ELSE {scale} END', 6)} AS scale, "
            f"'{method}' AS method FROM vitals"
        )
    return with_vitals("\nUNION ALL\n".join(parts))


for _m in ("standard", "minmax", "robust"):
    register(f"scaler_{_m}", _params_oracle(_m))(_params_query(_m))


@register(
    "scaled_robust",
    with_vitals(
        "SELECT patient_id, timestamp, "
        + ", ".join(f"{R(f'({c} - p.c_{c}) / p.s_{c}', 6)} AS {c}" for c in SCALE_COLS)
        + " FROM vitals, p",
        "p AS (SELECT "
        + ", ".join(
            f"quantile_cont({c}, 0.5) AS c_{c}, CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 "
            f"THEN 1.0 ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS s_{c}"
            for c in SCALE_COLS
        )
        + " FROM vitals)",
    ),
)
def q_scaled_robust(spark, sf_dir):
    v = load_vitals(spark, sf_dir)
    sc = Scaler("robust").fit(v, SCALE_COLS)
    out = sc.transform(v.select("patient_id", "timestamp", *SCALE_COLS))
    return out.select("patient_id", "timestamp", *[round_half_up(c, 6).alias(c) for c in SCALE_COLS])


# ---------------------------------------------------------------------------
# Clock drift
# ---------------------------------------------------------------------------

@register(
    "clock_drift",
    "WITH d AS (SELECT 'PAT-' || CAST(user_id AS VARCHAR) AS patient_id, "
    "abs((epoch_us(ts) / 1e6 + (event_id % 23) * 0.25) - epoch_us(ts) / 1e6) AS dd FROM events) "
    f"SELECT patient_id, {R('avg(dd)', 6)} AS mean_drift_sec, {R('max(dd)', 6)} AS max_drift_sec, "
    "max(dd) > 5.0 AS is_drift_critical FROM d GROUP BY patient_id",
)
def q_clock_drift(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    server = timeseries.epoch_seconds("ts")
    device = server + (F.col("event_id") % 23) * 0.25
    pairs = ev.select(F.concat(F.lit("PAT-"), F.col("user_id").cast("string")).alias("patient_id"),
                      device.alias("device"), server.alias("server"))
    out = timeseries.clock_drift(pairs, "device", "server", by=["patient_id"])
    return out.select("patient_id", round_half_up("mean_drift_sec", 6).alias("mean_drift_sec"),
                      round_half_up("max_drift_sec", 6).alias("max_drift_sec"), "is_drift_critical")


# ---------------------------------------------------------------------------
# Patient split
# ---------------------------------------------------------------------------

_SPLIT_CTES = (
    "ids AS (SELECT DISTINCT patient_id FROM vitals WHERE patient_id IS NOT NULL)",
    "r AS (SELECT patient_id, row_number() OVER (ORDER BY sha256('42:' || patient_id)) AS rank, "
    "count(*) OVER () AS n FROM ids)",
    "s AS (SELECT *, CAST(floor(CAST(n AS DOUBLE) * 0.7::DOUBLE) AS BIGINT) AS nt0, "
    "CAST(floor(CAST(n AS DOUBLE) * 0.15::DOUBLE) AS BIGINT) AS nv0 FROM r)",
    "s2 AS (SELECT *, n - nt0 - nv0 AS ns0, CASE WHEN nv0 = 0 AND nt0 > 1 THEN 1 ELSE 0 END AS tv FROM s)",
    "s3 AS (SELECT *, CASE WHEN ns0 = 0 AND nt0 - tv > 1 THEN 1 ELSE 0 END AS tt FROM s2)",
    "a AS (SELECT patient_id, rank, CASE WHEN tv = 1 AND rank = nt0 THEN 'val' "
    "WHEN tt = 1 AND rank = nt0 - tv THEN 'test' WHEN rank <= nt0 THEN 'train' "
    "WHEN rank <= nt0 + nv0 THEN 'val' ELSE 'test' END AS split FROM s3)",
)


@register("patient_split", with_vitals("SELECT patient_id, rank, split FROM a", *_SPLIT_CTES))
def q_patient_split(spark, sf_dir):
    return split.assign_splits(load_vitals(spark, sf_dir))


@register(
    "split_rows",
    with_vitals(
        "SELECT split, count(*) AS n_rows, count(DISTINCT patient_id) AS n_patients "
        "FROM vitals JOIN a USING (patient_id) GROUP BY split",
        *_SPLIT_CTES,
    ),
)
def q_split_rows(spark, sf_dir):
    tagged = split.split_by_patient(load_vitals(spark, sf_dir))
    return tagged.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.count_distinct("patient_id").alias("n_patients"))


# ---------------------------------------------------------------------------
# Classification / regression metrics (A14-A17), rank AUC (W6), latency
# ---------------------------------------------------------------------------

def _binary_oracle(src: str, t: str, p: str) -> str:
    rec = "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END"
    pre = "CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END"
    return [
        f"c AS (SELECT count(*) FILTER (WHERE {t} = 0 AND {p} = 0) AS tn, "
        f"count(*) FILTER (WHERE {t} = 0 AND {p} = 1) AS fp, count(*) FILTER (WHERE {t} = 1 AND {p} = 0) AS fn, "
        f"count(*) FILTER (WHERE {t} = 1 AND {p} = 1) AS tp FROM {src})",
        f"m AS (SELECT *, {rec} AS rec, {pre} AS pre FROM c)",
    ], (
        f"SELECT {R('rec', 4)} AS recall, {R('pre', 4)} AS precision, "
        f"{R('CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END', 4)} AS specificity, "
        f"{R('CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0.0 END', 4)} AS false_positive_rate, "
        f"{R('CASE WHEN pre + rec > 0 THEN 2 * pre * rec / (pre + rec) ELSE 0.0 END', 4)} AS f1_score, "
        "tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives FROM m"
    )


_GLUCOSE_RULE_SQL = "CAST(hrv_ms < 24 AND hr_bpm > 85 AND activity_intensity = 0 AND is_sleeping = 0 AS INTEGER)"
_BL = _binary_oracle("labels", "quality", "toxic")
_BR = _binary_oracle("g", "glucose_pattern_flag", "pred")


@register("binary_metrics_labels", "WITH " + ", ".join(_BL[0]) + " " + _BL[1])
def q_binary_labels(spark, sf_dir):
    return metrics.classification_metrics(read_table(spark, sf_dir, "labels"), "quality", "toxic")


@register(
    "binary_metrics_rule",
    with_vitals(_BR[1], f"g AS (SELECT glucose_pattern_flag, {_GLUCOSE_RULE_SQL} AS pred FROM vitals)", *_BR[0]),
)
def q_binary_rule(spark, sf_dir):
    from pulsekit.operators.features import glucose_rule

    v = load_vitals(spark, sf_dir).withColumn("pred", glucose_rule().cast("int"))
    return metrics.classification_metrics(v, "glucose_pattern_flag", "pred")


_AUC_CTES = (
    "g AS (SELECT s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM d "
    "WHERE y IN (0, 1) AND s IS NOT NULL AND NOT isnan(s) GROUP BY s)",
    "w AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
    "AS below FROM g)",
)
_AUC_BODY = (
    "SELECT "
    + R("CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / "
        "(2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END", 4)
    + " AS auc_roc, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM w"
)


def _auc_oracle(src_cte: str, vitals: bool = False) -> str:
    if vitals:
        return with_vitals(_AUC_BODY, src_cte, *_AUC_CTES)
    return "WITH " + ", ".join([src_cte, *_AUC_CTES]) + " " + _AUC_BODY


@register(
    "auc_labels",
    _auc_oracle("d AS (SELECT l.quality AS y, CAST(d.n_chars AS DOUBLE) AS s FROM labels l JOIN documents d "
                "USING (doc_id))"),
)
def q_auc_labels(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return metrics.rank_auc(lab.join(docs, "doc_id"), "quality", "n_chars")


@register(
    "auc_vitals",
    _auc_oracle("d AS (SELECT glucose_pattern_flag AS y, risk_score_30d AS s FROM vitals)", vitals=True),
)
def q_auc_vitals(spark, sf_dir):
    return metrics.rank_auc(load_vitals(spark, sf_dir), "glucose_pattern_flag", "risk_score_30d")


_ACT_PRED_SQL = "CAST(least(greatest(floor((hr_bpm - 50) / 25), 0), 3) AS INTEGER)"


@register(
    "accuracy_activity",
    with_vitals(f"SELECT {R('avg(CAST(activity_class = pred AS DOUBLE))', 4)} AS accuracy, count(*) AS n_samples "
                f"FROM (SELECT activity_class, {_ACT_PRED_SQL} AS pred FROM vitals)"),
)
def q_accuracy(spark, sf_dir):
    v = load_vitals(spark, sf_dir)
    pred = F.least(F.greatest(F.floor((F.col("hr_bpm") - 50) / 25), F.lit(0)), F.lit(3)).cast("int")
    return metrics.accuracy(v.withColumn("pred", pred), "activity_class", "pred")


@register(
    "regression_metrics",
    with_vitals(
        f"SELECT {R('avg(e)', 4)} AS mse, "
        + R("CASE WHEN var_pop(y) * count(y) = 0 THEN CASE WHEN sum(e) = 0 THEN 1.0 ELSE 0.0 END "
            "ELSE 1.0 - sum(e) / (var_pop(y) * count(y)) END", 4)
        + f" AS r2_score, {R('sqrt(avg(e))', 4)} AS rmse, count(*) AS n_samples FROM "
        "(SELECT risk_score_30d AS y, (risk_score_30d - p) * (risk_score_30d - p) AS e FROM "
        "(SELECT risk_score_30d, 22 * greatest(0, (100 - hrv_ms) / 80) AS p FROM vitals))"
    ),
)
def q_regression(spark, sf_dir):
    from pulsekit.operators.features import autonomic_stress

    v = load_vitals(spark, sf_dir).withColumn("p", autonomic_stress() * 22.0)
    return metrics.regression_metrics(v, "risk_score_30d", "p")


@register(
    "latency_summary",
    f"SELECT event_type, {R('avg(value)', 3)} AS latency_mean_ms, {R('quantile_cont(value, 0.95)', 3)} AS latency_p95_ms, "
    f"{R('quantile_cont(value, 0.99)', 3)} AS latency_p99_ms, {R('min(value)', 3)} AS latency_min_ms, "
    f"{R('max(value)', 3)} AS latency_max_ms FROM events GROUP BY event_type",
)
def q_latency(spark, sf_dir):
    return metrics.latency_summary(read_table(spark, sf_dir, "events"), "value", by=["event_type"])


_TRAIN_SQL = "FROM vitals JOIN a USING (patient_id) WHERE split = 'train'"


def _train_rows(spark, sf_dir):
    return split.split_by_patient(load_vitals(spark, sf_dir)).where("split = 'train'")


@register(
    "contamination",
    with_vitals(f"SELECT {R('least(greatest(avg(CAST(is_hr_anomaly AS DOUBLE)), 0.04), 0.12)', 6)} AS contamination "
                + _TRAIN_SQL, *_SPLIT_CTES),
)
def q_contamination(spark, sf_dir):
    share = metrics.anomaly_fraction(_train_rows(spark, sf_dir), "is_hr_anomaly")
    return share.select(round_half_up("contamination", 6).alias("contamination"))


@register(
    "run_counts",
    with_vitals("SELECT count(DISTINCT patient_id) AS patient_count, count(*) AS sample_count " + _TRAIN_SQL, *_SPLIT_CTES),
)
def q_run_counts(spark, sf_dir):
    return metrics.run_counts(_train_rows(spark, sf_dir))


@register(
    "score_threshold",
    with_vitals(
        "SELECT is_hr_anomaly, count(*) AS n_rows, count(*) FILTER (WHERE hr_bpm >= t) AS n_flagged FROM vitals, "
        "(SELECT quantile_cont(hr_bpm, 0.94) AS t FROM vitals) GROUP BY is_hr_anomaly"
    ),
)
def q_score_threshold(spark, sf_dir):
    """A19 over a fixed score column: rows at or above the score's 94th percentile, by label."""
    v = load_vitals(spark, sf_dir)
    t = exact_quantiles(v, "hr_bpm", [0.94]).first().quantiles[0]
    return v.groupBy("is_hr_anomaly").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("hr_bpm") >= t).alias("n_flagged"))


@register(
    "prediction_columns",
    with_vitals(
        "SELECT patient_id, timestamp, least(greatest(hr_bpm * 2 - 120, 0), 100) AS clipped, "
        "CAST(value_share >= 0.35 AS INTEGER) AS positive, "
        "CASE activity_class WHEN 0 THEN 'REST' WHEN 1 THEN 'WALKING' WHEN 2 THEN 'RUNNING' WHEN 3 THEN 'HIGH_INTENSITY' END "
        "AS class_name FROM (SELECT *, least(greatest((hr_bpm - 50) / 100, 0), 1) AS value_share FROM vitals)"
    ),
)
def q_prediction_columns(spark, sf_dir):
    """P19-P21 over fixed scores: clipped prediction, thresholded probability, class name."""
    share = F.least(F.greatest((F.col("hr_bpm") - 50) / 100, F.lit(0.0)), F.lit(1.0))
    v = load_vitals(spark, sf_dir).withColumn("raw", F.col("hr_bpm") * 2 - 120).withColumn(
        "probability", array_to_vector(F.array(F.lit(1.0) - share, share)))
    return v.select("patient_id", "timestamp", fx.clip_prediction("raw").alias("clipped"),
                    fx.threshold_positive("probability", 0.35).alias("positive"),
                    fx.activity_name("activity_class").alias("class_name"))


# ---------------------------------------------------------------------------
# Resampling
# ---------------------------------------------------------------------------

#: Every numeric column of the vitals view.
RESAMPLE_COLS = [
    "hr_bpm", "hrv_ms", "spo2_percent", "elevation_meters", "is_sleeping", "activity_intensity", "resp_rate", "temp_c",
    "bp_sys", "bp_dia", "movement_variance", "accel_x", "accel_y", "accel_z", "gyro_x", "gyro_y", "gyro_z", "sleep_stage",
    "activity_class", "is_hr_anomaly", "critical_spo2_drop", "glucose_pattern_flag", "risk_score_30d",
]


def _resample_oracle(step_us: int, method: str = "linear", one_series: bool = False) -> str:
    if one_series:  # every row under one key, which the result leaves out
        sql = _resample_oracle(step_us, method).replace("SELECT patient_id, epoch_us(timestamp)", "SELECT 0 AS patient_id, epoch_us(timestamp)")
        head, tail = sql.rsplit("SELECT patient_id, make_timestamp(slot)", 1)
        return f"{head}SELECT make_timestamp(slot){tail}"
    divides = 86_400_000_000 % step_us == 0
    cols_d = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in RESAMPLE_COLS)
    ctes = [f"b0 AS (SELECT patient_id, epoch_us(timestamp) AS us, {cols_d} FROM vitals WHERE timestamp IS NOT NULL)"]
    if divides:
        ctes.append(f"b AS (SELECT patient_id, (us // {step_us}) * {step_us} AS slot, * EXCLUDE (patient_id, us) FROM b0)")
    else:
        ctes.append("d AS (SELECT patient_id, (min(us) // 86400000000) * 86400000000 AS d0 FROM b0 GROUP BY patient_id)")
        ctes.append(f"b AS (SELECT patient_id, d0 + ((us - d0) // {step_us}) * {step_us} AS slot, "
                    "* EXCLUDE (patient_id, us, d0) FROM b0 JOIN d USING (patient_id))")
    ctes.append("m AS (SELECT patient_id, slot, " + ", ".join(f"avg({c}) AS {c}" for c in RESAMPLE_COLS)
                + " FROM b GROUP BY patient_id, slot)")
    ctes.append(f"g AS (SELECT patient_id, unnest(generate_series(min(slot), max(slot), {step_us})) AS slot "
                "FROM m GROUP BY patient_id)")
    ctes.append("f AS (SELECT g.patient_id, g.slot, " + ", ".join(f"m.{c}" for c in RESAMPLE_COLS)
                + " FROM g LEFT JOIN m ON g.patient_id = m.patient_id AND g.slot = m.slot)")
    win = []
    for c in RESAMPLE_COLS:
        win += [
            f"last_value({c} IGNORE NULLS) OVER wp AS p_{c}",
            f"last_value(CASE WHEN {c} IS NOT NULL THEN slot END IGNORE NULLS) OVER wp AS pt_{c}",
            f"first_value({c} IGNORE NULLS) OVER wn AS n_{c}",
            f"first_value(CASE WHEN {c} IS NOT NULL THEN slot END IGNORE NULLS) OVER wn AS nt_{c}",
        ]
    ctes.append(
        "i AS (SELECT patient_id, slot, " + ", ".join(RESAMPLE_COLS) + ", " + ", ".join(win) + " FROM f "
        "WINDOW wp AS (PARTITION BY patient_id ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        "wn AS (PARTITION BY patient_id ORDER BY slot ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"
    )
    outs = []
    for c in RESAMPLE_COLS:
        if method == "linear":
            inner = f"p_{c} + (n_{c} - p_{c}) * (slot - pt_{c}) / (nt_{c} - pt_{c})"
        elif method == "ffill":
            inner = f"p_{c}"
        elif method == "nearest":
            inner = f"CASE WHEN slot - pt_{c} <= nt_{c} - slot THEN p_{c} ELSE n_{c} END"
        else:
            inner = f"n_{c}"
        expr = (f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN p_{c} IS NOT NULL AND n_{c} IS NOT NULL THEN {inner} "
                f"WHEN p_{c} IS NOT NULL THEN p_{c} ELSE n_{c} END")
        outs.append(f"{R(expr, 6)} AS {c}")
    return with_vitals("SELECT patient_id, make_timestamp(slot) AS timestamp, " + ", ".join(outs) + " FROM i", *ctes)


def _resample_query(freq: str, method: str = "linear", keys: tuple[str, ...] = ("patient_id",)):
    def q(spark, sf_dir):
        r = timeseries.resample(load_vitals(spark, sf_dir), freq=freq, method=method, keys=list(keys), columns=RESAMPLE_COLS)
        return r.select(*keys, "timestamp", *[round_half_up(c, 6).alias(c) for c in RESAMPLE_COLS])

    return q


register("resample_15min_linear", _resample_oracle(15 * 60_000_000))(_resample_query("15min"))
register("resample_1h_ffill", _resample_oracle(3_600_000_000, "ffill"))(_resample_query("1h", "ffill"))
register("resample_7min_linear", _resample_oracle(7 * 60_000_000))(_resample_query("7min"))
register("resample_1h_bfill", _resample_oracle(3_600_000_000, "bfill"))(_resample_query("1h", "bfill"))
register("resample_50min_nearest", _resample_oracle(50 * 60_000_000, "nearest"))(_resample_query("50min", "nearest"))
register("resample_5min_one_series", _resample_oracle(5 * 60_000_000, one_series=True))(_resample_query("5min", keys=()))


@register(
    "auc_by_patient",
    with_vitals(
        "SELECT patient_id, "
        + R("CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / "
            "(2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END", 4)
        + " AS auc_roc, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM w GROUP BY patient_id",
        "g AS (SELECT patient_id, risk_score_30d AS s, count(*) FILTER (WHERE glucose_pattern_flag = 1) AS pos, "
        "count(*) FILTER (WHERE glucose_pattern_flag = 0) AS neg FROM vitals "
        "WHERE glucose_pattern_flag IN (0, 1) AND risk_score_30d IS NOT NULL AND NOT isnan(risk_score_30d) "
        "GROUP BY patient_id, risk_score_30d)",
        "w AS (SELECT patient_id, pos, neg, coalesce(sum(neg) OVER (PARTITION BY patient_id ORDER BY s "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)",
    ),
)
def q_auc_by_patient(spark, sf_dir):
    """W6 grouped: one exact AUC per patient (grouped running sums)."""
    return metrics.rank_auc(load_vitals(spark, sf_dir), "glucose_pattern_flag", "risk_score_30d", by=["patient_id"])


# Metrics by patient where values are missing, not numbers, infinite or huge in places that the event's number decides.
_ODD = {"truth": "CASE WHEN e % 97 = 0 THEN NULL WHEN e % 89 = 1 THEN {nan} WHEN e % 83 = 2 THEN 0.9 ELSE CAST(hr_bpm > 90 AS {d}) END",
        "guess": "CASE WHEN e % 101 = 3 THEN NULL WHEN e % 71 = 4 THEN 0.2 ELSE CAST(bp_sys > 128 AS {d}) END",
        "actual": "CASE WHEN e % 103 = 5 THEN NULL ELSE hr_bpm END",
        "forecast": "CASE WHEN u % 10 = 0 AND e % 7 = 1 THEN {nan} WHEN u % 10 = 1 AND e % 7 = 2 THEN {inf} "
                    "WHEN u % 10 = 2 AND e % 7 = 3 THEN 1e15 WHEN e % 107 = 4 THEN NULL ELSE bp_sys - 60 END"}
_ODD_DUCK = {k: v.format(nan="CAST('NaN' AS DOUBLE)", inf="CAST('Infinity' AS DOUBLE)", d="INTEGER") for k, v in _ODD.items()}
_ODD_VITALS = ("odd AS (SELECT patient_id, " + ", ".join(f"CAST({v} AS DOUBLE) AS {k}" for k, v in _ODD_DUCK.items())
               + " FROM (SELECT 'PAT-' || CAST(user_id AS VARCHAR) AS patient_id, event_id AS e, user_id AS u, "
               "50 + value / 2 AS hr_bpm, 110 + value / 4 AS bp_sys FROM events))")


def _odd_vitals(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").selectExpr(
        "concat('PAT-', CAST(user_id AS STRING)) AS patient_id", "event_id AS e", "user_id AS u", "50 + value / 2 AS hr_bpm", "110 + value / 4 AS bp_sys")
    return events.selectExpr("patient_id", *[
        f"CAST({v.format(nan=chr(39).join(['double(', 'NaN', ')']), inf=chr(39).join(['double(', 'Infinity', ')']), d='INT')} AS DOUBLE) AS {k}"
        for k, v in _ODD.items()])


@register(
    "odd_value_metrics",
    with_vitals(
        "SELECT patient_id, tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives, "
        f"{R('a', 4)} AS accuracy, n_acc AS accuracy_samples, {R_any('mse', 4)} AS mse, {R_any('sqrt(mse)', 4)} AS rmse, n_reg AS regression_samples FROM m",
        _ODD_VITALS,
        "m AS (SELECT patient_id, count(*) FILTER (WHERE truth = 0 AND guess = 0) AS tn, count(*) FILTER (WHERE truth = 0 AND guess = 1) AS fp, "
        "count(*) FILTER (WHERE truth = 1 AND guess = 0) AS fn, count(*) FILTER (WHERE truth = 1 AND guess = 1) AS tp, "
        "avg(CAST(truth = guess AS DOUBLE)) AS a, count(truth = guess) AS n_acc, avg((actual - forecast) * (actual - forecast)) AS mse, "
        "count(actual - forecast) AS n_reg FROM odd GROUP BY patient_id)",
    ),
)
def q_odd_value_metrics(spark, sf_dir):
    """A14, A16, A17 per patient over labels that are NULL, NaN or between the classes, and predictions that are NULL, NaN, infinite or 1e15."""
    v = _odd_vitals(spark, sf_dir)
    by = ["patient_id"]
    counts = metrics.confusion(v, "truth", "guess", by)
    acc = metrics.accuracy(v, "truth", "guess", by).withColumnRenamed("n_samples", "accuracy_samples")
    reg = metrics.regression_metrics(v, "actual", "forecast", by).withColumnRenamed("n_samples", "regression_samples").drop("r2_score")
    return counts.join(acc, by).join(reg, by)
