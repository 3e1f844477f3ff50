"""Supervised models (M2, M4, M6 on MLlib, M6 over counted rows of :mod:`cells`; M5 on :mod:`relu_network`, M7 on :mod:`hist_boosting`).

Training data is the anonymised, split table; the scaler is fitted on the
train split only and inlined into the scoring projection. Evaluation runs on
the validation split (``split=`` selects another) with the exact metric
aggregates of ``operators.metrics``.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.models import cells
from pulsekit.models.hist_boosting import fit_hist_boosting
from pulsekit.models.common import FitResult, assemble, require_two_classes
from pulsekit.models.relu_network import fit_relu_network
from pulsekit.operators import features as fx
from pulsekit.operators import metrics
from pulsekit.operators.scaling import Scaler
from pulsekit.operators.split import split_by_patient
from pulsekit.schema import COMBINED_FEATURES, GLUCOSE_FEATURES, IMU_AXES, RISK_FEATURES, SPO2_FEATURES

#: Bins of a feature of the glucose model (MLlib's default). MLlib looks for cuts in a sample of ``maxBins ** 2`` rows;
#: with EVERY_BIN it sees all ``2 * 32**4`` cells there may be, and so cuts between any two bins.
MAX_BINS, EVERY_BIN = 32, 2048


def _eval_split(tagged: DataFrame, split: str) -> DataFrame:
    return tagged.where(F.col("split") == split)


def _binary_metrics(scored: DataFrame, label: str, pred: str = "pred", score: str = "score") -> dict:
    m = metrics.classification_metrics(scored, label, pred).first().asDict()
    auc = metrics.rank_auc(scored, label, score).first()
    if auc is not None and auc.auc_roc is not None:
        m["auc_roc"] = auc.auc_roc
    return m


def train_spo2(tagged: DataFrame, seed: int = 42, threshold: float = 0.35, split: str = "val", num_trees: int = 40) -> FitResult:
    """M2: random forest 40 x depth 5, class weights 1:5, p(1) >= 0.35."""
    label = "critical_spo2_drop"
    train = tagged.where(F.col("split") == "train")
    require_two_classes(train, label)
    scaler = Scaler("standard").fit(train, SPO2_FEATURES)
    tr = assemble(train, SPO2_FEATURES, scaler).withColumn("w", F.when(F.col(label) == 1, 5.0).otherwise(1.0))
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol="w", numTrees=num_trees, maxDepth=5,
                                featureSubsetStrategy="sqrt", seed=seed)
    model = rf.fit(tr.withColumn(label, F.col(label).cast("double")))
    scored = model.transform(assemble(_eval_split(tagged, split), SPO2_FEATURES, scaler))
    scored = scored.withColumn("score", vector_to_array("probability")[1]).withColumn(
        "pred", fx.threshold_positive("probability", threshold))
    return FitResult("spo2_critical", "RandomForestClassifier", model, scaler, _binary_metrics(scored, label),
                     {"num_trees": num_trees, "max_depth": 5, "class_weight": "1:5", "threshold": threshold}, scored)


def train_sleep(tagged: DataFrame, seed: int = 42, split: str = "val", num_trees: int = 50) -> FitResult:
    """M4: random forest 50 x depth 6 on sleeping rows (P12) with P8 features.

    Rows are filtered before the split, so the ratios hold for the patients that have such rows.
    """
    label = "sleep_stage"
    rows = split_by_patient(fx.sleep_rows(tagged.drop("split")))
    feats = ["movement_variance", "hr_avg", "hrv_avg", "duration_mins"]
    prepared = fx.sleep_features(rows, keep=["split", label])
    train = prepared.where(F.col("split") == "train")
    scaler = Scaler("standard").fit(train, feats)
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=num_trees, maxDepth=6, seed=seed)
    model = rf.fit(assemble(train, feats, scaler).withColumn(label, F.col(label).cast("double")))
    scored = model.transform(assemble(prepared.where(F.col("split") == split), feats, scaler))
    m = metrics.accuracy(scored.withColumn("pred", F.col("prediction").cast("int")), label, "pred").first().asDict()
    return FitResult("sleep_quality", "RandomForestClassifier", model, scaler, m,
                     {"num_trees": num_trees, "max_depth": 6}, scored, rows)


def train_activity(tagged: DataFrame, seed: int = 42, split: str = "val", max_iter: int = 250, batches: int = 1) -> FitResult:
    """M5: network 7-32-16-4 with ReLU layers, fitted by Adam in ``max_iter`` epochs of ``batches`` steps."""
    label = "activity_class"
    feats = IMU_AXES + ["accel_magnitude"]
    prepared = fx.activity_features(tagged, keep=["split", label])
    train = prepared.where(F.col("split") == "train")
    scaler = Scaler("standard").fit(train, feats)
    model = fit_relu_network(scaler.transform(train), feats, label, classes=4, epochs=max_iter, batches=batches, seed=seed)
    scored = model.transform(scaler.transform(prepared.where(F.col("split") == split)).dropna(subset=feats))
    scored = scored.withColumn("class_name", fx.activity_name("prediction"))
    m = metrics.accuracy(scored.withColumn("pred", F.col("prediction").cast("int")), label, "pred").first().asDict()
    return FitResult("activity_recognition", "ReluNetwork", model, scaler, m,
                     {"layers": [7, 32, 16, 4], "max_iter": max_iter, "batches": batches}, scored)


def train_glucose(tagged: DataFrame, seed: int = 42, split: str = "val", max_iter: int = 50) -> FitResult:
    """M6: gradient-boosted trees 50 x depth 4, rate 0.1, robust scaling.

    Rows are counted by their 32 bins a feature first (:mod:`cells`): trees are fitted to at most ``2 * 32**4`` weighted rows.
    """
    label = "glucose_pattern_flag"
    train = tagged.where(F.col("split") == "train")
    require_two_classes(train, label)
    scaler = Scaler("robust").fit(train, GLUCOSE_FEATURES)
    rows = scaler.transform(train).dropna(subset=GLUCOSE_FEATURES).withColumn(label, F.col(label).cast("double"))
    buckets = cells.fit_bucketizer(rows, GLUCOSE_FEATURES, MAX_BINS)
    counted = cells.count_cells(rows, buckets, label)
    gbt = GBTClassifier(featuresCol=cells.BINS, labelCol=label, weightCol=cells.WEIGHT, maxIter=max_iter, maxDepth=4, stepSize=0.1,
                        maxBins=EVERY_BIN, seed=seed)
    model = PipelineModel([buckets, cells.bin_assembler(buckets), gbt.fit(counted)])
    scored = model.transform(assemble(_eval_split(tagged, split), GLUCOSE_FEATURES, scaler))
    scored = scored.withColumn("score", vector_to_array("probability")[1]).withColumn("pred", F.col("prediction").cast("int"))
    return FitResult("glucose_patterns", "GBTClassifier", model, scaler, _binary_metrics(scored, label),
                     {"max_iter": max_iter, "max_depth": 4, "step_size": 0.1}, scored)


def train_risk(tagged: DataFrame, seed: int = 42, split: str = "val", max_iter: int = 120, max_leaves: int = 31) -> FitResult:
    """M7: histogram boosting, leaf-wise (120 rounds, rate 0.08), predictions clipped to [0, 100].

    Nothing is drawn at random, so ``seed`` changes nothing.
    """
    label = "risk_score_30d"
    scaler = Scaler("standard").fit(tagged.where(F.col("split") == "train"), RISK_FEATURES)
    scaled = scaler.transform(tagged)
    model = fit_hist_boosting(scaled.where(F.col("split") == "train"), RISK_FEATURES, label, rounds=max_iter, rate=0.08, max_leaves=max_leaves)
    scored = model.transform(_eval_split(scaled, split)).withColumn("pred", fx.clip_prediction("prediction"))
    m = metrics.regression_metrics(scored, label, "pred").first().asDict()
    return FitResult("risk_score", "HistGradientBoosting", model, scaler, m,
                     {"max_iter": max_iter, "step_size": 0.08, "max_leaves": max_leaves, "max_bins": 255}, scored)


__all__ = ["train_spo2", "train_sleep", "train_activity", "train_glucose", "train_risk", "COMBINED_FEATURES"]
