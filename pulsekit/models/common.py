"""Shared model plumbing: split-aware preparation, label checks, evaluation rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.operators.scaling import Scaler


class SingleClassError(ValueError):
    """The training label holds one class only; a binary model cannot be fitted."""


@dataclass
class FitResult:
    model_id: str
    algorithm: str
    model: object
    scaler: Scaler | None
    metrics: dict = field(default_factory=dict)
    hyperparameters: dict = field(default_factory=dict)
    scored: DataFrame | None = None
    cohort: DataFrame | None = None  # the rows the model was split from, where not all


def require_two_classes(train: DataFrame, label: str) -> None:
    """Raise before fitting when the binary label has a single class (one tiny aggregate)."""
    r = train.agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).first()
    if not r.pos or not r.neg:
        raise SingleClassError(f"label '{label}' needs both classes in the training split (pos={r.pos}, neg={r.neg})")


def assemble(df: DataFrame, features: list[str], scaler: Scaler | None, out: str = "features") -> DataFrame:
    """Scale (params inlined as literals) then assemble the MLlib vector; NULLs are skipped rows."""
    x = scaler.transform(df) if scaler is not None else df
    x = x.dropna(subset=features)
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="skip").transform(x)


def split_frames(tagged: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(tagged.where(F.col("split") == s) for s in ("train", "val", "test"))
