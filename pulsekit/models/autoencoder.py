"""Data-parallel dense autoencoder (M3): 6-16-4-16-6, ReLU, Adam.

Each iteration is one Spark job: every partition computes the gradient sum
of the squared reconstruction loss over its rows with NumPy, and the
driver, which receives 363 numbers a core whatever the rows, takes an Adam step on the 362 parameters. The training rows are persisted once as
blocks of numbers (:mod:`blocks`, MEMORY_AND_DISK) and reused by every
iteration; each iteration is a full pass, so for very large tables fit on a seeded-hash sample of the training
split (the caller's choice: the model is defined by its training rows). Scoring is an Arrow
``pandas_udf``: error = mean squared reconstruction error per row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.models.blocks import PASS_ROWS, number_blocks, summing

LAYERS = [6, 16, 4, 16, 6]


def _init(layers: list[int], seed: int) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    params = []
    for a, b in zip(layers[:-1], layers[1:]):
        bound = np.sqrt(6.0 / (a + b))
        params += [rng.uniform(-bound, bound, size=(a, b)), np.zeros(b)]
    return params


def _flatten(params: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in params])


def _unflatten(vec: np.ndarray, layers: list[int]) -> list[np.ndarray]:
    out, i = [], 0
    for a, b in zip(layers[:-1], layers[1:]):
        out.append(vec[i:i + a * b].reshape(a, b))
        i += a * b
        out.append(vec[i:i + b])
        i += b
    return out


def _forward(params, x):
    acts = [x]
    h = x
    n_layers = len(params) // 2
    for k in range(n_layers):
        h = h @ params[2 * k]
        h += params[2 * k + 1]
        if k < n_layers - 1:
            np.maximum(h, 0.0, out=h)
        acts.append(h)
    return acts


def _grad_sum(params, x):
    """Sum over rows of d/dparams 0.5 * ||f(x) - x||^2, and the loss sum."""
    acts = _forward(params, x)
    n_layers = len(params) // 2
    delta = acts[-1] - x
    loss = 0.5 * float((delta ** 2).sum())
    grads = [None] * len(params)
    for k in range(n_layers - 1, -1, -1):
        grads[2 * k] = acts[k].T @ delta
        grads[2 * k + 1] = delta.sum(axis=0)
        if k > 0:
            delta = delta @ params[2 * k].T
            delta *= acts[k] > 0
    return grads, loss


@dataclass
class AutoencoderModel:
    features: list[str]
    params: list[np.ndarray]
    threshold: float | None = None

    def save(self, spark, path: str) -> None:
        """Weights in layer order and the threshold as one Parquet row."""
        row = [(self.features, [p.ravel().tolist() for p in self.params], self.threshold)]
        spark.createDataFrame(row, "features array<string>, params array<array<double>>, threshold double").coalesce(
            1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> AutoencoderModel:
        """The model that :meth:`save` wrote; layer sizes follow from the features and the biases."""
        row = spark.read.parquet(path).first()
        if row is None:
            raise ValueError(f"no autoencoder at {path}")
        flat = [np.array(p, dtype=float) for p in row.params]
        sizes = [len(row.features), *[len(b) for b in flat[1::2]]]
        params = [p.reshape(sizes[i // 2], -1) if i % 2 == 0 else p for i, p in enumerate(flat)]
        return cls(list(row.features), params, row.threshold)

    def error_column(self, df: DataFrame, out: str = "recon_error") -> DataFrame:
        params = self.params

        @F.pandas_udf(T.DoubleType())
        def err(*cols: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=float) for c in cols])
            rec = _forward(params, x)[-1]
            return pd.Series(((rec - x) ** 2).mean(axis=1))

        return df.withColumn(out, err(*[F.col(c).cast("double") for c in self.features]))


def fit_autoencoder(
    df: DataFrame,
    features: list[str],
    max_iter: int = 250,
    learning_rate: float = 0.01,
    alpha: float = 1e-4,
    seed: int = 42,
    tol: float = 1e-7,
    layers: list[int] | None = None,
) -> AutoencoderModel:
    """Full-batch Adam on the distributed gradient; stops early when the loss stalls."""
    layers = layers or [len(features), 16, 4, 16, len(features)]
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in features]).dropna()
    data = number_blocks(rows, features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = (data.agg(F.sum(F.length("x"))).first()[0] or 0) // (8 * len(features))
        if n == 0:
            raise ValueError("no rows to fit the autoencoder")
        params = _init(layers, seed)
        vec = _flatten(params)
        m1, m2 = np.zeros_like(vec), np.zeros_like(vec)
        b1, b2, eps = 0.9, 0.999, 1e-8
        prev = None
        size = len(vec)
        run = summing(data, len(features))
        for it in range(1, max_iter + 1):
            cur = _unflatten(vec, layers)

            def part(blocks, cur=cur):
                total = np.zeros(size + 1)  # the loss comes first
                for rows in blocks:
                    for at in range(0, len(rows), PASS_ROWS):
                        g, l = _grad_sum(cur, rows[at : at + PASS_ROWS])
                        total[0] += l
                        total[1:] += _flatten(g)
                return total

            total = run(part)
            grad = total[1:] / n + alpha * vec
            loss = total[0] / n
            m1 = b1 * m1 + (1 - b1) * grad
            m2 = b2 * m2 + (1 - b2) * grad * grad
            step = learning_rate * (m1 / (1 - b1 ** it)) / (np.sqrt(m2 / (1 - b2 ** it)) + eps)
            vec = vec - step
            if prev is not None and abs(prev - loss) < tol:
                break
            prev = loss
        return AutoencoderModel(features=list(features), params=_unflatten(vec, layers))
    finally:
        data.unpersist()
