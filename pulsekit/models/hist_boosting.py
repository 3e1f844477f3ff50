"""Histogram gradient boosting with leaf-wise trees for regression (M7).

Features are cut into at most ``max_bins`` quantile bins once; the binned rows
are written as blocks (bytes of bins, targets, predictions) of bounded size.
A tree needs, for a node, the sum of residuals and the number of rows per
feature and bin. Tasks sum these over their blocks, a reduction by node adds
the tasks up, and the driver receives at most ``features x max_bins`` numbers a
node, whatever the rows. Only the smaller child of a split is counted; its
sibling is the parent less the child.

Trees grow best-first: of all leaves the one whose split gains most is split
next, up to ``max_leaves``. One pass over the data counts all leaves that may
be next at once; what a leaf-wise order would not have reached is left out when
the tree is cut out of the nodes whose gains are known. So a tree takes about
as many passes as it is deep, and its splits are those of one-at-a-time growth.

The blocks are persisted anew after each tree, with its predictions added, in
the job that counts the next root; so a row passes each tree once. Every ``FOLD``
trees they are checkpointed, which bounds the lineage and what a lost executor costs.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.models.blocks import deal, gathered
from pulsekit.operators.ordered import materialize
from pulsekit.session import ship_package

FOLD = 10
#: bins (a row a feature), labels and predictions of some rows
Block = tuple[np.ndarray, np.ndarray, np.ndarray]


@dataclass
class Tree:
    """Node k: rows with ``bins[feature[k]] <= cut[k]`` go to ``left[k]``, others to ``right[k]``; feature -1 is a leaf."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for row, x in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1), (self.value, value)):
            row.append(x)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, cut: int, values: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.cut[node] = feature, cut
        self.left[node], self.right[node] = self.add(values[0]), self.add(values[1])
        return self.left[node], self.right[node]

    def leaves(self, bins: np.ndarray) -> dict[int, np.ndarray]:
        """The rows of every leaf; nodes come before their children."""
        rows = {0: np.arange(len(bins))}
        for k, f in enumerate(self.feature):
            if f >= 0:
                mine = rows.pop(k)
                goes = bins[:, f][mine] <= self.cut[k]
                rows[self.left[k]], rows[self.right[k]] = mine[goes], mine[~goes]
        return rows

    def predict(self, bins: np.ndarray) -> np.ndarray:
        out = np.empty(len(bins))
        for k, rows in self.leaves(bins).items():
            out[rows] = self.value[k]
        return out


def bin_rows(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Number of edges below each value; a missing value lies above all others."""
    out = np.empty(x.shape, np.uint8, order="F")  # trees look at one feature at a time
    for f, e in enumerate(edges):
        out[:, f] = np.where(np.isnan(x[:, f]), len(e), np.searchsorted(e, x[:, f], side="left"))
    return out


def best_split(total: np.ndarray, count: np.ndarray, least: int) -> tuple[float, int, int]:
    """(gain, feature, cut) of the best split of a node by its sums per (feature, bin); gain 0 if there is none.

    The gain is the fall of the squared error; both sides keep ``least`` rows. Ties go to the first feature and cut.
    """
    g, n = np.cumsum(total, axis=1)[:, :-1], np.cumsum(count, axis=1)[:, :-1]
    g_all, n_all = total.sum(axis=1, keepdims=True), count.sum(axis=1, keepdims=True)
    ok = (n >= least) & (n_all - n >= least)
    if not ok.any():
        return 0.0, -1, -1
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(ok, g * g / n + (g_all - g) ** 2 / (n_all - n) - g_all * g_all / n_all, -np.inf)
    at = int(np.argmax(gain))
    f, c = divmod(at, gain.shape[1])
    return (float(gain[f, c]), f, c) if gain[f, c] > 1e-9 else (0.0, -1, -1)


class _Node:
    """A node of the grown tree: its histograms, best split, and once they are counted its children."""

    def __init__(self, total: np.ndarray, count: np.ndarray, least: int):
        self.total, self.count = total, count
        self.gain, self.feature, self.cut = best_split(total, count, least)
        self.children: tuple[_Node, _Node] | None = None

    def sides(self) -> tuple[tuple[float, int], tuple[float, int]]:
        """(sum, rows) left and right of the best split."""
        g, n = self.total[self.feature], self.count[self.feature]
        k = self.cut + 1
        return (float(g[:k].sum()), int(n[:k].sum())), (float(g[k:].sum()), int(n[k:].sum()))


def cut_out(root: _Node, max_leaves: int, rate: float) -> tuple[Tree, list[tuple[int, _Node]]]:
    """The best-first tree over the nodes that are known, and the leaves whose children its growth still needs.

    Growth goes on past a leaf whose children are not known, so that all
    leaves that may be split are returned at once; the tree is final when there are none.
    """
    tree = Tree()
    mean = lambda side: -rate * side[0] / max(side[1], 1)
    tree.add(mean((float(root.total[0].sum()), int(root.count[0].sum()))))
    heap, serial, leaves, last, open_ = [(-root.gain, 0, 0, root)], 1, 1, 0, []
    while heap and leaves < max_leaves:
        gain, _, at, node = heapq.heappop(heap)
        if gain >= 0:
            break
        last = at
        left, right = tree.split(at, node.feature, node.cut, tuple(map(mean, node.sides())))
        leaves += 1
        if node.children is None:
            open_.append((at, node))
            continue
        for k, child in ((left, node.children[0]), (right, node.children[1])):
            heapq.heappush(heap, (-child.gain, serial, k, child))
            serial += 1
    if leaves == max_leaves and open_ and open_[-1][0] == last:
        open_.pop()  # the last split of all: its children decide nothing
    return tree, open_


@dataclass
class HistBoostingModel:
    features: list[str]
    edges: list[np.ndarray]
    trees: list[Tree]
    base: float

    def column(self) -> Column:
        """Prediction of each row (Arrow batches); NULL and NaN features count as larger than any value."""
        model = self

        @F.pandas_udf("double")
        def predict(*cols: pd.Series) -> pd.Series:
            bins = bin_rows(np.column_stack([c.to_numpy(float) for c in cols]), model.edges)
            return pd.Series(model.base + sum((t.predict(bins) for t in model.trees), np.zeros(len(bins))))

        return predict(*[F.col(c).cast("double") for c in self.features])

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        ship_package(df.sparkSession)
        return df.withColumn(out, self.column())

    def save(self, spark: SparkSession, path: str) -> None:
        """One row: features, edges, trees and base."""
        trees = [(t.feature, t.cut, t.left, t.right, t.value) for t in self.trees]
        row = [(self.features, [e.tolist() for e in self.edges], trees, float(self.base))]
        kind = "array<struct<feature:array<int>,cut:array<int>,left:array<int>,right:array<int>,value:array<double>>>"
        spark.createDataFrame(row, f"features array<string>, edges array<array<double>>, trees {kind}, base double").coalesce(
            1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> HistBoostingModel:
        r = spark.read.parquet(path).first()
        return cls(list(r.features), [np.array(e, float) for e in r.edges], [Tree(*map(list, t)) for t in r.trees], r.base)


def _blocks(features: list[str], label: str, edges: list[np.ndarray]):
    def run(parts):
        for rows in gathered(parts):
            bins = bin_rows(rows[features].to_numpy(float), edges)
            yield pd.DataFrame({"bins": [bins.tobytes(order="F")], "y": [rows[label].to_numpy(np.float64).tobytes()]})

    return run


def _unpack(n_features: int, base: float):
    def run(row) -> Block:
        y = np.frombuffer(row.y)
        return np.frombuffer(row.bins, np.uint8).reshape(n_features, -1), y, np.full(len(y), base)

    return run


def _advance(tree: Tree):
    def run(block: Block) -> Block:
        bins, y, pred = block
        return bins, y, pred + tree.predict(bins.T)

    return run


def _count(n_features: int, n_bins: int, growing: Tree, wanted: list[int]):
    """Task: (place in ``wanted``, (sums of residuals, numbers of rows) by feature and bin) of every wanted node."""

    def run(blocks):
        total = np.zeros((len(wanted), n_features, n_bins))
        count = np.zeros((len(wanted), n_features, n_bins), np.int64)
        for bins, y, pred in blocks:
            leaves, res = growing.leaves(bins.T), pred - y
            for k, node in enumerate(wanted):
                rows = leaves[node]
                mine = res[rows]
                for f in range(n_features):
                    at = bins[f][rows]
                    total[k, f] += np.bincount(at, mine, n_bins)
                    count[k, f] += np.bincount(at, minlength=n_bins)
        for k in np.flatnonzero(count[:, 0].any(axis=1)).tolist():
            yield k, (total[k], count[k])

    return run


def _add(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return a[0] + b[0], a[1] + b[1]


def fit_hist_boosting(df: DataFrame, features: list[str], label: str, rounds: int = 120, rate: float = 0.1, max_leaves: int = 31,
                      least: int = 20, max_bins: int = 255) -> HistBoostingModel:
    """Squared-error boosting of leaf-wise trees; rows without a label do not train. Raises if none has one.

    Missing features are a bin above all others. Equal rows weigh as often as they occur.
    """
    if not 2 <= max_bins <= 255:
        raise ValueError("max_bins must be between 2 and 255")
    spark = df.sparkSession
    ship_package(spark)
    data = df.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias("__y")).where(
        "__y IS NOT NULL AND NOT isnan(__y)")
    probs = F.array(*[F.lit(i / max_bins) for i in range(1, max_bins)])
    cells = [F.percentile_approx(F.when(~F.isnan(c), F.col(c)), probs, 10_000).alias(c) for c in features]
    facts = data.agg(F.avg("__y").alias("__base"), F.count("*").alias("__n"), *cells).first()
    if not facts["__n"]:
        raise ValueError("no row has a label")
    edges = [np.unique(np.array(facts[c] or [], float)) for c in features]
    n_features, n_bins = len(features), max_bins + 1
    table = materialize(deal(data.mapInPandas(_blocks(features, "__y", edges), "bins binary, y binary")))
    blocks = table.rdd.map(_unpack(n_features, facts["__base"])).persist(StorageLevel.MEMORY_AND_DISK)
    model, kept = HistBoostingModel(list(features), edges, [], facts["__base"]), [blocks]

    def histograms(tree: Tree, wanted: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        found = kept[-1].mapPartitions(_count(n_features, n_bins, tree, wanted)).reduceByKey(
            _add, min(len(wanted), kept[-1].getNumPartitions())).collectAsMap()  # one histogram a node
        none = np.zeros((n_features, n_bins)), np.zeros((n_features, n_bins), np.int64)
        return [found.get(k, none) for k in range(len(wanted))]

    try:
        _grow(model, kept, histograms, rounds, rate, max_leaves, least)
    finally:
        for old in kept:
            old.unpersist()
    return model


def _grow(model: HistBoostingModel, kept: list[RDD], histograms, rounds: int, rate: float, max_leaves: int, least: int) -> None:
    """Adds the trees; ``kept`` holds the blocks of the last tree, and of the one before until those are there."""
    for _ in range(rounds):
        stump = Tree()
        stump.add(0.0)
        root = _Node(*histograms(stump, [0])[0], least)
        while len(kept) > 1:
            kept.pop(0).unpersist()  # the newer blocks are there
        tree, need = cut_out(root, max_leaves, rate)
        while need:
            smaller = [tree.left[at] if node.sides()[0][1] <= node.sides()[1][1] else tree.right[at] for at, node in need]
            for (at, node), child, (total, count) in zip(need, smaller, histograms(tree, smaller)):
                mine, other = _Node(total, count, least), _Node(node.total - total, node.count - count, least)
                node.children = (mine, other) if child == tree.left[at] else (other, mine)
            tree, need = cut_out(root, max_leaves, rate)
        if len(tree.feature) == 1:
            break  # nothing gains any more
        model.trees.append(tree)
        following = kept[-1].map(_advance(tree)).persist(StorageLevel.MEMORY_AND_DISK)
        if len(model.trees) % FOLD == 0:
            following.checkpoint()  # written by the next job
        kept.append(following)
