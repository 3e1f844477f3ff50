"""Saved models read back and applied to measurements (M1-M7).

A folder written by ``training.save_run`` holds the model, the scaler's
parameters and the settings. Scoring is a projection: features and scaling as
in training, then the model, with no shuffle and no pass over the data before.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.models.autoencoder import AutoencoderModel
from pulsekit.models.common import assemble
from pulsekit.models.hist_boosting import HistBoostingModel
from pulsekit.models.isolation_forest import IsolationForestModel
from pulsekit.models.relu_network import ReluNetworkModel
from pulsekit.operators import features as fx
from pulsekit.operators.scaling import Scaler
from pulsekit.schema import COMBINED_FEATURES, GLUCOSE_FEATURES, HR_FEATURES, IMU_AXES, RISK_FEATURES, SPO2_FEATURES

#: Algorithms of this package; any other is an MLlib model, which names its own class.
OWN = {"IsolationForest": IsolationForestModel, "DenseAutoencoder": AutoencoderModel, "HistGradientBoosting": HistBoostingModel,
       "ReluNetwork": ReluNetworkModel}

#: Model features in the order of training.
FEATURES = {
    "heart_rate_anomaly": HR_FEATURES,
    "spo2_critical": SPO2_FEATURES,
    "combined_vitals": COMBINED_FEATURES,
    "sleep_quality": ["movement_variance", "hr_avg", "hrv_avg", "duration_mins"],
    "activity_recognition": [*IMU_AXES, "accel_magnitude"],
    "glucose_patterns": GLUCOSE_FEATURES,
    "risk_score": RISK_FEATURES,
}


@dataclass
class SavedModel:
    model_id: str
    model: object
    scaler: Scaler
    settings: dict

    def score(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` columns of ``df`` with ``score`` and ``pred``, one row for each row that the model can judge.

        Score: anomaly score, reconstruction error, probability of class 1, or
        for classes and the risk the prediction itself. Rows that lack a
        feature are left out, but for the heart rate and risk models, which
        score them as in training (the forest sees them as not below any cut).
        ``df`` may have columns called score or pred; those can be kept only under another name.
        """
        clash = {"score", "pred"} & {c.lower() for c in keep}
        if clash:
            raise ValueError(f"cannot keep {sorted(clash)}: the result has columns of these names")
        kept = ["__keep"] if keep else []  # one struct, so that no derived feature clashes with a kept column
        if keep:
            df = df.withColumn("__keep", F.struct(*[F.col(f"`{c}`") for c in keep]))
        score, pred, rows = self._columns(df, kept)
        return rows.select(*[f"{c}.*" for c in kept], score.alias("score"), pred.alias("pred"))

    def _columns(self, df: DataFrame, keep: list[str]):
        names = FEATURES[self.model_id]
        if self.model_id == "heart_rate_anomaly":
            rows, s = self.model.score_column(self.scaler.transform(df)), F.col("anomaly_score")
            return s, (-s <= self.settings["threshold"]).cast("int"), rows
        if self.model_id == "combined_vitals":
            rows, e = self.model.error_column(self.scaler.transform(df).dropna(subset=names)), F.col("recon_error")
            return e, (e >= self.model.threshold).cast("int"), rows
        if self.model_id == "risk_score":
            p = fx.clip_prediction("prediction")
            return p, p, self.model.transform(self.scaler.transform(df))
        prepared = {"sleep_quality": fx.sleep_features, "activity_recognition": fx.activity_features}.get(self.model_id)
        rows = prepared(df, keep=keep) if prepared else df
        if isinstance(self.model, ReluNetworkModel):
            rows = self.model.transform(self.scaler.transform(rows).dropna(subset=names))
        else:  # among them activity networks of earlier releases
            rows = self.model.transform(assemble(rows, names, self.scaler))
        if prepared:
            return F.col("prediction"), F.col("prediction").cast("int"), rows
        if "threshold" in self.settings:
            pred = fx.threshold_positive("probability", self.settings["threshold"])
        else:
            pred = F.col("prediction").cast("int")
        return vector_to_array("probability")[1], pred, rows


def load_run(spark: SparkSession, folder: str) -> SavedModel:
    """The model that ``training.save_run`` wrote below ``folder``."""
    about = spark.read.parquet(f"{folder}/settings").first()
    own = OWN.get(about.algorithm)
    path = f"{folder}/model"
    model = own.load(spark, path) if own else DefaultParamsReader.loadParamsInstance(path, spark)
    return SavedModel(about.model_id, model, Scaler.load(spark, f"{folder}/scaler"), json.loads(about.hyperparameters))
