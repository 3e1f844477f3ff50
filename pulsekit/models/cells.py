"""Rows as counted cells, for tree fits that see nothing of a row but its bins.

A tree on binned features cannot tell rows of equal bins and label apart. Such
rows are counted into one row, a cell, whose weight is their number: one narrow
pass and one aggregation with partial counts in every task. There are at most
``bins ** features`` cells a label, whatever the rows, so that the many passes
of a fit are over a table that stops growing. The fit itself is MLlib's, with
a weight column; its sums over cells are those over the rows.
"""

from __future__ import annotations

import math
from bisect import bisect_left

import numpy as np
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.operators.ordered import materialize

#: evenly spaced quantiles that stand for a feature's distribution, as many as MLlib samples rows
GRID = 10_000
TASK_CELLS = 16_384
BINS, WEIGHT = "__bins", "__rows"


def _ends(counts: list[int], size: int) -> list[int]:
    """The last value of every bin but the last one, for bins of about ``size`` rows."""
    ends, held = [], 0
    for k, count in enumerate(counts):
        if held and held + count / 2 > size:  # nearer to the size without this value
            ends.append(k - 1)
            held = 0
        held += count
    return ends


def thresholds(values: np.ndarray, max_bins: int) -> list[float]:
    """At most ``max_bins - 1`` cuts, halfway between neighbouring values, that leave the smallest bins of even size.

    Few values have a bin each. A value too frequent for an even bin has its own.
    """
    v, n = np.unique(values, return_counts=True)
    counts = n.tolist()
    size = bisect_left(range(sum(counts)), True, key=lambda size: len(_ends(counts, size)) < max_bins)
    ends = np.array(_ends(counts, size), int)
    low, high = v[ends], v[ends + 1]
    with np.errstate(invalid="ignore"):
        middle = low / 2 + high / 2
    cuts = np.where(middle > low, middle, high)  # neighbouring floats and infinite values have no middle
    return np.unique(np.minimum(cuts, np.finfo(float).max)).tolist()


def fit_bucketizer(df: DataFrame, features: list[str], max_bins: int) -> Bucketizer:
    """Bins of even size over all rows, found from quantiles (rank error 1/10000)."""
    found = df.approxQuantile(features, [i / GRID for i in range(GRID + 1)], 1 / GRID)
    cuts = [thresholds(np.array(values, float), max_bins) or [0.0] for values in found]  # a bucketizer has one cut at least
    return Bucketizer(splitsArray=[[-math.inf, *c, math.inf] for c in cuts], inputCols=features,
                      outputCols=[f"__bin_{c}" for c in features])


def bin_assembler(bucketizer: Bucketizer) -> VectorAssembler:
    return VectorAssembler(inputCols=bucketizer.getOutputCols(), outputCol=BINS)


def count_cells(df: DataFrame, bucketizer: Bucketizer, label: str) -> DataFrame:
    """(bins vector, label, rows double): one row for all rows of equal bins and label; computed once."""
    rows = bucketizer.transform(df.select(*bucketizer.getInputCols(), label))
    # cast: the bucketizer declares its bins as categories, and trees would not keep their order
    bins = [F.col(c).cast("int").alias(c) for c in bucketizer.getOutputCols()]
    counted = rows.groupBy(*bins, label).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))
    counted = materialize(counted)
    few = counted.coalesce(1 + counted.count() // TASK_CELLS)  # never more than there are: a pass over few cells is few tasks
    return bin_assembler(bucketizer).transform(few).select(BINS, label, WEIGHT)
