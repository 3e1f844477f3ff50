"""Anomaly pipelines: heart-rate isolation forest (M1) and combined-vitals autoencoder (M3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.models.autoencoder import fit_autoencoder
from pulsekit.models.common import FitResult
from pulsekit.models.isolation_forest import fit_isolation_forest
from pulsekit.operators import metrics
from pulsekit.operators.ordered import exact_quantiles
from pulsekit.operators.scaling import Scaler
from pulsekit.schema import COMBINED_FEATURES, HR_FEATURES


def _eval(scored: DataFrame, label: str, score: str) -> dict:
    m = metrics.classification_metrics(scored, label, "pred").first().asDict()
    auc = metrics.rank_auc(scored, label, score).first()
    if auc is not None and auc.auc_roc is not None:
        m["auc_roc"] = auc.auc_roc
    return m


def train_heart_rate(tagged: DataFrame, n_trees: int = 100, seed: int = 42, split: str = "val") -> FitResult:
    """M1: robust scaling, contamination from the train labels (A18), isolation
    forest, threshold = exact percentile of train scores at the contamination
    (A19); a row is flagged when its (negated) score is <= the threshold."""
    label = "is_hr_anomaly"
    train = tagged.where(F.col("split") == "train")
    contamination = metrics.anomaly_fraction(train, label).first().contamination
    scaler = Scaler("robust").fit(train, HR_FEATURES)
    forest = fit_isolation_forest(scaler.transform(train), HR_FEATURES, n_trees=n_trees, seed=seed,
                                  key_cols=["patient_id", "timestamp", *HR_FEATURES])
    scored_train = forest.score_column(scaler.transform(train)).withColumn("score", -F.col("anomaly_score"))
    threshold = exact_quantiles(scored_train, "score", [contamination]).first().quantiles[0]
    ev = forest.score_column(scaler.transform(tagged.where(F.col("split") == split)))
    ev = ev.withColumn("score", -F.col("anomaly_score")).withColumn("pred", (F.col("score") <= threshold).cast("int"))
    m = _eval(ev, label, "anomaly_score")
    return FitResult("heart_rate_anomaly", "IsolationForest", forest, scaler, m,
                     {"n_estimators": n_trees, "contamination": contamination, "threshold": threshold}, ev)


def train_combined(tagged: DataFrame, max_iter: int = 250, percentile: float = 94.0, seed: int = 42,
                   split: str = "val") -> FitResult:
    """M3: standard scaling, autoencoder, threshold = percentile of train
    reconstruction errors (94 by default); flagged when error >= threshold."""
    label = "is_hr_anomaly"
    train = tagged.where(F.col("split") == "train")
    scaler = Scaler("standard").fit(train, COMBINED_FEATURES)
    ae = fit_autoencoder(scaler.transform(train), COMBINED_FEATURES, max_iter=max_iter, seed=seed)
    err_train = ae.error_column(scaler.transform(train).dropna(subset=COMBINED_FEATURES))
    threshold = exact_quantiles(err_train, "recon_error", [percentile / 100.0]).first().quantiles[0]
    ae.threshold = threshold
    ev = ae.error_column(scaler.transform(tagged.where(F.col("split") == split)).dropna(subset=COMBINED_FEATURES))
    ev = ev.withColumn("pred", (F.col("recon_error") >= threshold).cast("int"))
    m = _eval(ev, label, "recon_error")
    return FitResult("combined_vitals", "DenseAutoencoder", ae, scaler, m,
                     {"layers": [6, 16, 4, 16, 6], "max_iter": max_iter, "percentile": percentile}, ev)
