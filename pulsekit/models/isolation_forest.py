"""Isolation Forest on Spark (M1; Liu, Ting and Zhou, 2008).

* Subsampling is hash-based, never partition-order based: each row gets
  ``m`` different candidate trees from seeded ``xxhash64`` values and is kept for
  a tree with a probability chosen so every tree sees about 1.5 x ``max_samples``
  candidates; a window per tree keeps the ``max_samples`` rows with the
  smallest hash, so no tree holds a row twice or fewer rows than its scores assume. Identical on task retry and under any partitioning.
* Each tree is grown in its own task (``groupBy(tree).applyInPandas``) from at
  most ``max_samples`` rows; the forest is a node table of at most
  ``n_trees * (2 * max_samples - 1)`` rows -- a proven bound, so it is safe to
  ship to the executors for scoring.
* Scoring is an Arrow ``pandas_udf`` that walks all trees vectorised per batch:
  s(x) = 2^(-E[h(x)] / c(max_samples)).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

EULER = 0.5772156649015329
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, size int"


def c_factor(n: int | np.ndarray) -> np.ndarray:
    """Average path length of an unsuccessful BST search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    nodes: list = []

    def rec(idx: np.ndarray, depth: int) -> int:
        nid = len(nodes)
        nodes.append(None)
        if depth >= limit or len(idx) <= 1:
            nodes[nid] = (-1, 0.0, -1, -1, len(idx))
            return nid
        xs = x[idx]
        lo, hi = xs.min(axis=0), xs.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if len(cand) == 0:
            nodes[nid] = (-1, 0.0, -1, -1, len(idx))
            return nid
        f = int(rng.choice(cand))
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = xs[:, f] < thr
        left = rec(idx[go_left], depth + 1)
        right = rec(idx[~go_left], depth + 1)
        nodes[nid] = (f, thr, left, right, len(idx))
        return nid

    rec(np.arange(len(x)), 0)
    return nodes


def _node_array(rows: pd.DataFrame) -> np.ndarray:
    """(tree, node, 5) from one row a node; places without a row are empty leaves, children included."""
    names = ["feature", "threshold", "left", "right", "size"]
    arr = np.zeros((int(rows["tree"].max()) + 1, int(rows[["node", "left", "right"]].max().max()) + 1, 5))
    arr[:, :, 0] = -1
    arr[rows["tree"].to_numpy(), rows["node"].to_numpy()] = rows[names].to_numpy(dtype=float)
    return arr


@dataclass
class IsolationForestModel:
    features: list[str]
    max_samples: int
    nodes: np.ndarray  # (n_trees, max_nodes, 5): feature, threshold, left, right, size

    def save(self, spark, path: str) -> None:
        """Node table as Parquet (at most trees x (2 x max_samples - 1) rows), each row with the model's features and sample size."""
        about = (self.features, self.max_samples)
        rows = [(t, i, *map(float, node), *about) for t, tree in enumerate(self.nodes) for i, node in enumerate(tree) if node[4] > 0]
        spark.createDataFrame(rows, "tree int, node int, feature double, threshold double, left double, right double, "
                                    "size double, features array<string>, max_samples int").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> IsolationForestModel:
        """The model that :meth:`save` wrote; its scores are the same to the last bit."""
        table = spark.read.parquet(path)
        if "features" not in table.columns:
            raise ValueError(f"{path} holds no features and sample size: it was saved before models could be read back")
        about = table.select("features", "max_samples").first()
        if about is None:
            raise ValueError(f"no forest at {path}")
        cells = table.select("tree", "node", "feature", "threshold", "left", "right", "size").toPandas()  # bounded, see save
        return cls(list(about.features), about.max_samples, _node_array(cells))

    def score_column(self, df: DataFrame, out: str = "anomaly_score") -> DataFrame:
        """Adds ``out`` = s(x) in (0, 1]; higher means more anomalous."""
        nodes = self.nodes
        denom = float(c_factor(self.max_samples))

        @F.pandas_udf(T.DoubleType())
        def score(*cols: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=float) for c in cols])
            n = len(x)
            total = np.zeros(n)
            rows = np.arange(n)
            for t in range(nodes.shape[0]):
                tree = nodes[t]
                node = np.zeros(n, dtype=np.int64)
                depth = np.zeros(n)
                while True:
                    feat = tree[node, 0].astype(np.int64)
                    active = feat >= 0
                    if not active.any():
                        break
                    thr = tree[node, 1]
                    val = x[rows, np.where(active, feat, 0)]
                    nxt = np.where(val < thr, tree[node, 2], tree[node, 3]).astype(np.int64)
                    node = np.where(active, nxt, node)
                    depth += active
                total += depth + c_factor(tree[node, 4])
            return pd.Series(np.power(2.0, -(total / nodes.shape[0]) / denom))

        return df.withColumn(out, score(*[F.col(c).cast("double") for c in self.features]))


def fit_isolation_forest(
    df: DataFrame,
    features: list[str],
    n_trees: int = 100,
    max_samples: int = 256,
    seed: int = 42,
    key_cols: list[str] | None = None,
) -> IsolationForestModel:
    """Grow ``n_trees`` isolation trees from seeded-hash subsamples of ``df``."""
    data = df.dropna(subset=features)
    n = data.count()
    if n == 0:
        raise ValueError("no rows to fit the isolation forest")
    psi = int(min(max_samples, n))
    limit = int(math.ceil(math.log2(max(psi, 2))))
    m = int(min(n_trees, max(1, math.ceil(1.5 * psi * n_trees / n))))
    keep_p = min(1.0, 1.5 * psi * n_trees / (n * m))
    key = [F.col(c).cast("string") for c in (key_cols or features)]
    # A row's trees are start, start + step, ...: different ones, since step and n_trees share no factor.
    steps = [k for k in range(1, n_trees + 1) if math.gcd(k, n_trees) == 1]

    def drawn(bound: int, *salt):
        return F.pmod(F.xxhash64(F.lit(seed), *salt, *key), F.lit(bound))

    step = F.element_at(F.array(*[F.lit(k) for k in steps]), (drawn(len(steps), F.lit(2)) + 1).cast("int"))
    start = drawn(n_trees, F.lit(1))
    cands = F.array(*[F.pmod(start + F.lit(j) * step, F.lit(n_trees)).cast("int") for j in range(m)])
    rows = data.select(*[F.col(c).cast("double").alias(c) for c in features], *[k.alias(f"__k{i}") for i, k in enumerate(key)],
                       F.explode(cands).alias("tree"))
    key = [F.col(f"__k{i}") for i in range(len(key))]
    rows = rows.where(drawn(1 << 40, F.lit(3), F.col("tree")) < int(keep_p * (1 << 40))).withColumn(
        "order", drawn(1 << 62, F.lit(4), F.col("tree")))
    w = Window.partitionBy("tree").orderBy("order", *features)
    sample = rows.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= psi).select(*features, "tree", "order")

    feats = list(features)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(["order", *feats])
        rng = np.random.default_rng(seed * 100_003 + t)
        nodes = _grow(pdf[feats].to_numpy(dtype=float), rng, limit)
        return pd.DataFrame(
            [(t, i, f, thr, l, r, s) for i, (f, thr, l, r, s) in enumerate(nodes)],
            columns=["tree", "node", "feature", "threshold", "left", "right", "size"],
        )

    table = sample.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
    rows = table.toPandas()  # at most n_trees * (2 * psi - 1) rows
    trees = sorted(rows["tree"].unique())
    max_nodes = int(rows["node"].max()) + 1
    arr = np.zeros((len(trees), max_nodes, 5))
    arr[:, :, 0] = -1
    for ti, t in enumerate(trees):
        sub = rows[rows["tree"] == t]
        arr[ti, sub["node"].to_numpy(), :] = sub[["feature", "threshold", "left", "right", "size"]].to_numpy(dtype=float)
    return IsolationForestModel(features=feats, max_samples=psi, nodes=arr)
