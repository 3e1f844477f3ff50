"""Exact ordered statistics without a single-partition window.

KS distances, rank AUC, exact split ranks and exact quantiles need running
sums over a sort order. A plain ``Window.orderBy(...)`` funnels every row (or
every row of a hot group) through one task. Instead the compact input, one row
per distinct (group, order key), is

1. range-partitioned by (group, order key) and checkpointed together with the
   number of each row's range (:func:`ranged`);
2. summed per (group, range), at most groups + ranges rows, whose exclusive
   running sums are the ranges' offsets;
3. windowed by (group, range): offset + running sum inside the range.

A group with most of the rows spreads over most of the ranges, so no window
partition exceeds a range. The number of ranges is Spark's own (the session's
shuffle partitions, coalesced by AQE); there is no cap and no separate path for
small inputs. Results are exact; sampling decides only how even the ranges are.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions import nan_to_null

RANGE = "__range"


def materialize(df: DataFrame) -> DataFrame:
    """Compute a compact intermediate once and cut its lineage.

    Persist, write a reliable checkpoint to the shared ``spark.checkpoint.dir``
    (survives executor loss), then drop the cache: later reads come from the
    checkpoint files, so several consumers share one computation.
    """
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def ranged(df: DataFrame, group_cols: list[str], order_cols: list[str], n_ranges: int | None = None) -> DataFrame:
    """``df`` in ranges of (group, order key), checkpointed; column ``__range`` numbers them in order.

    ``order_cols`` must identify a row within a group. ``n_ranges`` forces a number of
    ranges (tests); by default Spark chooses it.
    """
    keys = [F.col(c) for c in (*group_cols, *order_cols)]
    spread = df.repartitionByRange(n_ranges, *keys) if n_ranges else df.repartitionByRange(*keys)
    return materialize(spread.withColumn(RANGE, F.spark_partition_id()))


def _offsets(totals: DataFrame, groups: list[str], sum_cols: list[str]) -> DataFrame:
    """Per (group, range): the sums of the group's earlier ranges and of the whole group."""
    whole = Window.partitionBy(*groups)
    before = whole.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *groups,
        RANGE,
        *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__o_{c}") for c in sum_cols],
        *[F.sum(f"__t_{c}").over(whole).alias(f"total_{c}") for c in sum_cols],
    )


def _ungrouped_offsets(totals: DataFrame, sum_cols: list[str]) -> DataFrame:
    """The same of one global order, added up on the driver: one row a range, whatever the data's size."""
    rows = sorted(totals.collect(), key=lambda r: r[RANGE])
    whole = [sum(r[f"__t_{c}"] or 0 for r in rows) for c in sum_cols]
    run, out = [0] * len(sum_cols), []
    for r in rows:
        out.append((r[RANGE], *run, *whole))
        run = [x + (r[f"__t_{c}"] or 0) for x, c in zip(run, sum_cols)]
    fields = [f"{RANGE} int", *[f"`__o_{c}` bigint" for c in sum_cols], *[f"`total_{c}` bigint" for c in sum_cols]]
    return totals.sparkSession.createDataFrame(out, ", ".join(fields))


def running_totals(
    rows: DataFrame,
    group_cols: list[str],
    order_cols: list[str],
    sum_cols: list[str],
) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum per group) and ``total_<c>`` (its sum over the group).

    ``rows`` comes from :func:`ranged` with the same groups and order.
    """
    groups = list(group_cols)
    totals = rows.groupBy(*groups, RANGE).agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols])
    offsets = _offsets(totals, groups, sum_cols) if groups else F.broadcast(_ungrouped_offsets(totals, sum_cols))
    inside = Window.partitionBy(*groups, RANGE).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    # Null-safe: a NULL group is a group like any other.
    left, right = rows.alias("l"), offsets.alias("r")
    same = F.col(f"l.{RANGE}") == F.col(f"r.{RANGE}")
    for g in groups:
        same = same & F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}"))
    joined = left.join(right, same).select("l.*", *[f"r.__o_{c}" for c in sum_cols], *[f"r.total_{c}" for c in sum_cols])
    return joined.select(
        *[c for c in rows.columns if c != RANGE],
        *[(F.col(f"__o_{c}") + F.sum(c).over(inside)).alias(f"cum_{c}") for c in sum_cols],
        *[f"total_{c}" for c in sum_cols],
    )


def quantile_columns(value: str, weight: str, probs: list[float]) -> list[Column]:
    """Aggregates over :func:`running_totals` rows that interpolate exact quantiles.

    ``weight`` counts a value's occurrences. The element at 0-based position i is the
    row with cum - weight <= i < cum; a quantile lies linearly between two positions.
    """
    out = []
    cum, w, n = F.col(f"cum_{weight}"), F.col(weight), F.col(f"total_{weight}")
    for p in probs:
        at = F.lit(float(p)) * (n - 1)
        low, high = F.floor(at), F.ceil(at)
        low_value = F.max(F.when((cum - w <= low) & (low < cum), F.col(value)))
        high_value = F.max(F.when((cum - w <= high) & (high < cum), F.col(value)))
        share = F.max(at - low)  # the same in every row of a group
        between = low_value * (F.lit(1.0) - share) + high_value * share
        out.append(F.when(low_value == high_value, low_value).otherwise(between))
    return out


def value_totals(df: DataFrame, value: str | Column, by: list[str], n_ranges: int | None = None) -> DataFrame:
    """One row per (by..., ``__v``) with its count ``__n`` and running totals, for :func:`quantile_columns`.

    Counting is partial in every task, so ties cost nothing. NULL and NaN become one
    row of count 0, which keeps groups without values.
    """
    v = nan_to_null(value).alias("__v")
    counts = df.select(*by, v).groupBy(*by, "__v").agg(F.count("__v").alias("__n"))
    return running_totals(ranged(counts, by, ["__v"], n_ranges), by, ["__v"], ["__n"])


def exact_quantiles(
    df: DataFrame, value: str | Column, probs: list[float], by: list[str] | None = None, n_ranges: int | None = None
) -> DataFrame:
    """(by..., quantiles array<double>): exact, linearly interpolated; NULLs for a group without values."""
    by = by or []
    return value_totals(df, value, by, n_ranges).groupBy(*by).agg(
        F.array(*quantile_columns("__v", "__n", probs)).alias("quantiles"))
