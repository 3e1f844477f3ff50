"""Data-parallel classifier network (M5): ReLU hidden layers, softmax output, Adam.

One step is one Spark job over one batch of the rows: every task adds up the
cross-entropy gradient of its rows with NumPy, and the driver, which receives one
number a parameter and core however many rows there are, takes the Adam step.

Rows are dealt to batches by a seeded hash of their values, so a batch is the same
under any partitioning. They are persisted in blocks (:mod:`blocks`), each of one
batch, so that a step reads its rows without converting them again;
``batches=1`` makes every step a full pass. Gradients are added as whole numbers
of 2^-44, which makes the sum the same in whatever order tasks finish.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.models.autoencoder import _flatten, _forward, _init, _unflatten
from pulsekit.models.blocks import PASS_ROWS, number_blocks, summing

#: Gradients of a step are whole numbers of 1 / SCALE, and are cut at +-LIMIT (a sum of 2^16 tasks still fits 64 bits).
SCALE, LIMIT = 2.0 ** 44, 4.0


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradient(params: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[list[np.ndarray], float]:
    """Sums over the rows: gradient of the cross-entropy by every parameter, and the cross-entropy itself."""
    acts = _forward(params, x)
    p = _softmax(acts[-1])
    rows = np.arange(len(y))
    loss = -float(np.log(np.maximum(p[rows, y], 1e-300)).sum())
    delta = p
    delta[rows, y] -= 1.0
    grads: list = [None] * len(params)
    for k in range(len(params) // 2 - 1, -1, -1):
        grads[2 * k], grads[2 * k + 1] = acts[k].T @ delta, delta.sum(axis=0)
        if k:
            delta = delta @ params[2 * k].T
            delta *= acts[k] > 0
    return grads, loss


@dataclass
class ReluNetworkModel:
    features: list[str]
    params: list[np.ndarray]

    def save(self, spark, path: str) -> None:
        """Weights in layer order as one Parquet row."""
        row = [(self.features, [p.ravel().tolist() for p in self.params])]
        spark.createDataFrame(row, "features array<string>, params array<array<double>>").coalesce(1).write.mode(
            "overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> ReluNetworkModel:
        """The model that :meth:`save` wrote; layer sizes follow from the features and the biases."""
        row = spark.read.parquet(path).first()
        if row is None:
            raise ValueError(f"no network at {path}")
        flat = [np.array(p, dtype=float) for p in row.params]
        sizes = [len(row.features), *[len(b) for b in flat[1::2]]]
        return cls(list(row.features), [p.reshape(sizes[i // 2], -1) if i % 2 == 0 else p for i, p in enumerate(flat)])

    def transform(self, df: DataFrame) -> DataFrame:
        """``probability`` (one a class) and ``prediction`` (the likeliest class, the smaller of equal ones).

        Both are NULL where a feature is missing, NaN or infinite. Columns of these
        names in ``df`` are replaced.
        """
        params = self.params

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def probabilities(*cols: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=float) for c in cols])
            known = np.isfinite(x).all(axis=1)
            out = np.full(len(x), None, dtype=object)
            for i, p in zip(np.flatnonzero(known), _softmax(_forward(params, x[known])[-1])):
                out[i] = p
            return pd.Series(out)

        p = F.col("probability")
        return df.withColumn("probability", probabilities(*[F.col(f"`{c}`").cast("double") for c in self.features])).withColumn(
            "prediction", (F.array_position(p, F.array_max(p)) - 1).cast("double"))


def fit_relu_network(
    df: DataFrame,
    features: list[str],
    label: str,
    classes: int,
    hidden: tuple[int, ...] = (32, 16),
    epochs: int = 250,
    batches: int = 1,
    learning_rate: float = 0.01,
    alpha: float = 1e-4,
    seed: int = 42,
    tol: float = 1e-7,
) -> ReluNetworkModel:
    """Weights after ``epochs`` passes of ``batches`` Adam steps each; ends when an epoch's mean loss changes by less than ``tol``.

    Rows whose label is not one of 0 to ``classes`` - 1, or that hold a missing, NaN
    or infinite feature, are not trained on; ``ValueError`` where none is left.
    Equal rows fall into one batch together; an empty batch takes no step.
    """
    x = [F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    y = F.col(f"`{label}`").cast("double")
    names = [f"x{i}" for i in range(len(features))]
    rows = df.select(*x, y.alias("y")).where(F.col("y").isin([float(k) for k in range(classes)]))
    for c in names:
        rows = rows.where(F.abs(c) < float("inf"))  # neither NULL nor NaN is below
    rows = rows.withColumn("y", F.col("y").cast("int")).withColumn(
        "batch", F.pmod(F.xxhash64(F.lit(seed), *names, "y"), F.lit(batches)).cast("int"))
    width = len(names) + 1
    blocks = number_blocks(rows.sortWithinPartitions("batch"), [*names, "y"], "batch").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = blocks.groupBy("by").agg((F.sum(F.length("x")) / (8 * width)).cast("long")).collect()  # one row a batch
        sizes = dict(map(tuple, found))
        if not sizes:
            raise ValueError("no rows to fit the network")
        passes = {b: summing(blocks.where(F.col("by") == b) if len(sizes) > 1 else blocks, width) for b in sizes}
        layers = [len(features), *hidden, classes]
        vec = _flatten(_init(layers, seed))
        m1, m2 = np.zeros_like(vec), np.zeros_like(vec)
        step, prev = 0, None
        for _ in range(epochs):
            total = 0.0
            for b in sorted(sizes):
                grad, loss = _mean_gradient(passes[b], _unflatten(vec, layers), sizes[b])
                total += loss
                grad = grad + alpha * vec
                step += 1
                m1 = 0.9 * m1 + 0.1 * grad
                m2 = 0.999 * m2 + 0.001 * grad * grad
                vec = vec - learning_rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
            mean = total / sum(sizes.values())
            if prev is not None and abs(prev - mean) < tol:
                break
            prev = mean
        return ReluNetworkModel(list(features), _unflatten(vec, layers))
    finally:
        blocks.unpersist()


def _batch_gradient(batch: DataFrame, names: list[str], params: list[np.ndarray], n: int) -> tuple[np.ndarray, float]:
    """Mean gradient and summed loss of the ``n`` rows of ``batch`` (label ``y``)."""
    return _mean_gradient(summing(number_blocks(batch, [*names, "y"]), len(names) + 1), params, n)


def _mean_gradient(run, params: list[np.ndarray], n: int) -> tuple[np.ndarray, float]:
    """Mean gradient and summed loss of one batch of ``n`` rows; one job."""
    size = sum(p.size for p in params)

    def part(blocks):
        grad, loss = np.zeros(size), 0.0
        for rows in blocks:
            for at in range(0, len(rows), PASS_ROWS):
                x = rows[at : at + PASS_ROWS]
                g, l = gradient(params, x[:, :-1], x[:, -1].astype(np.int64))
                grad += _flatten(g)
                loss += l
        mean = np.concatenate([[loss], grad]) / n
        return np.rint(np.clip(mean, -LIMIT, LIMIT) * SCALE).astype(np.int64)

    out = run(part) / SCALE
    return out[1:], out[0] * n
