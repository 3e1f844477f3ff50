"""Distribution drift between a reference and a current table.

Plan: both tables are unpivoted to one long table (feature, side, value)
with NULL/NaN dropped and reduced ONCE to counts per (feature, value, side)
-- the sufficient statistic for everything that follows; for sensor values
with limited precision it is far smaller than the input. All features are
processed concurrently instead of a Python loop per feature:

* counts per (feature, side): sums over the compact table;
* D1: exact quantile edges of the reference side, from the running counts
  (``exact=False`` -> ``percentile_approx``);
* D2/D3: bin index = number of interior edges <= value (NumPy's rule, also
  with duplicate edges) per distinct value, counts per (feature, bin)
  left-joined from the full bin grid so empty bins still contribute, then PSI;
* W2/D4: two-level running sums over the compact table -> KS statistic
  D = max |F_ref - F_cur| after each tie group; its p-value from the exact
  distribution, or as a Spark expression from the asymptotic one.

The per-feature tables (edges, counts, results) are bounded by the number of
features (a schema property), so broadcasting them is safe.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions import ks_pvalue, round_half_up
from pulsekit.operators.ordered import materialize, quantile_columns, ranged, running_totals
from pulsekit.session import ship_package
from pulsekit.schema import DRIFT_P_VALUE, DRIFT_PSI, PSI_BUCKETS, PSI_FLOOR

EXACT_MAX_N = 10_000  # values a sample up to which "auto" takes the exact KS distribution
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def auto_features(reference: DataFrame, current: DataFrame) -> list[str]:
    """Numeric (not boolean / string) columns of the reference also present in current."""
    cur = set(current.columns)
    return [f.name for f in reference.schema.fields if isinstance(f.dataType, _NUMERIC) and f.name in cur]


def ks_pvalue_exact_equal(d: float, n: int) -> float:
    """Exact two-sided p-value for two samples of one size n, D = k/n, in closed form.

    p = 2 * sum_{j>=1} (-1)^(j+1) C(2n, n-jk) / C(2n, n), by log-gamma: tiny values keep their digits.
    """
    k = round(d * n)
    if k <= 0:
        return 1.0
    mid = 2.0 * math.lgamma(n + 1)
    terms = (math.exp(mid - math.lgamma(n - j * k + 1) - math.lgamma(n + j * k + 1)) * (-1) ** (j + 1) for j in range(1, n // k + 1))
    return min(1.0, max(0.0, 2.0 * sum(terms)))


def ks_pvalue_exact(d: float, n: int, m: int) -> float:
    """Exact two-sided p-value of the two-sample statistic: the probability of a distance of ``d`` or more.

    Under the null all orders of the pooled sample are equally likely: a walk
    that takes the rest of either sample at random. The chances of standing at
    each (i, j) are carried from one pooled value to the next, and a walk that
    reaches ``|i/n - j/m| >= d`` leaves; the p-value is what has left, so small
    ones keep their digits and nothing under- or overflows. Distances are
    compared as integers, in units of 1 / lcm(n, m).
    """
    if n == m:
        return ks_pvalue_exact_equal(d, n)
    g = math.gcd(n, m)
    up, over = m // g, n // g  # i/n - j/m = (i * up - j * over) / lcm
    k = round(d * n * up)
    if k <= 0:
        return 1.0
    left, low, here = 0.0, 0, np.ones(1)  # chances of i = low, low + 1, ... after t values
    for t in range(1, n + m + 1):
        i = np.arange(low, low + len(here))
        rest = n + m - t + 1
        step = np.zeros(len(here) + 1)
        step[:-1] = here * ((m - (t - 1 - i)) / rest)
        step[1:] += here * ((n - i) / rest)
        first = max(low, t - m, -((k - 1 - t * over) // (up + over)))
        last = min(low + len(here), n, t, (t * over + k - 1) // (up + over))
        if first > last:
            return 1.0
        left += float(step[: first - low].sum() + step[last + 1 - low :].sum())
        low, here = first, step[first - low : last + 1 - low]
    return min(1.0, left)


def exact_pvalues(stats: DataFrame, exact_max_n: int = EXACT_MAX_N) -> DataFrame:
    """(feature_idx, p_exact) for the features whose samples have at most ``exact_max_n`` values; a task a feature."""
    rows = stats.select("feature_idx", "ks_raw", "n_ref", "n_cur").where(F.greatest("n_ref", "n_cur") <= exact_max_n)

    def solve(batches):
        for part in batches:
            yield pd.DataFrame({"feature_idx": part.feature_idx, "p_exact": [
                ks_pvalue_exact(d, int(n), int(m)) for d, n, m in zip(part.ks_raw, part.n_ref, part.n_cur)]})

    ship_package(stats.sparkSession)
    spread = int(stats.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(spread, "feature_idx").mapInPandas(solve, "feature_idx int, p_exact double")


def to_long(df: DataFrame, features: list[str], side: str) -> DataFrame:
    """(feature_idx, value, side) with NULL and NaN removed (one SQL ``inline`` unpivot)."""
    structs = ", ".join(
        f"named_struct('feature_idx', {i}, 'value', CAST(`{f.replace('`', '``')}` AS DOUBLE))" for i, f in enumerate(features)
    )
    return df.selectExpr(f"inline(array({structs}))").selectExpr("feature_idx", "value", f"'{side}' AS side").where(
        "value IS NOT NULL AND NOT isnan(value)"
    )


def feature_drift(
    reference: DataFrame,
    current: DataFrame,
    features: list[str] | None = None,
    num_buckets: int = PSI_BUCKETS,
    p_value_threshold: float = DRIFT_P_VALUE,
    psi_threshold: float = DRIFT_PSI,
    exact: bool = True,
    n_ranges: int | None = None,
    p_method: str = "auto",
    exact_max_n: int = EXACT_MAX_N,
) -> DataFrame:
    """Per-feature KS statistic, p-value, PSI and drift flag.

    Unrounded ``ks_raw``, ``p_raw``, ``psi_raw`` are kept for the decision;
    ``ks_statistic`` (4 dp), ``p_value`` (5 dp) and ``psi`` (4 dp) are reported.
    A feature with no values on either side is skipped (no row).

    ``p_method``: "auto" takes the exact distribution of the KS distance where both
    samples have at most ``exact_max_n`` values, the asymptotic series beyond;
    "exact" takes it whatever the sizes (time grows with their product);
    "asymptotic" takes the series throughout.
    """
    features = features if features is not None else auto_features(reference, current)
    long = to_long(reference, features, "ref").unionByName(to_long(current, features, "cur"))

    # The only pass over the raw rows: counts per (feature, value) and side.
    # Partial aggregation shrinks it map-side; it is checkpointed once, in
    # ranges of (feature, value), and everything below comes from it.
    per_value = long.groupBy("feature_idx", "value").agg(
        F.count_if(F.col("side") == "ref").cast("bigint").alias("a_ref"),
        F.count_if(F.col("side") == "cur").cast("bigint").alias("a_cur"),
    )
    per_value = ranged(per_value, ["feature_idx"], ["value"], n_ranges)

    # One ordered pass: sizes, the KS distance (W2/D4) and the interior quantile
    # edges of the reference side (D1), one row per feature.
    cum = running_totals(per_value, ["feature_idx"], ["value"], ["a_ref", "a_cur"])
    cum = cum.where((F.col("total_a_ref") > 0) & (F.col("total_a_cur") > 0))
    gap = F.abs(F.col("cum_a_ref") / F.col("total_a_ref") - F.col("cum_a_cur") / F.col("total_a_cur"))
    probs = [i / num_buckets for i in range(1, num_buckets)]
    stats = materialize(cum.groupBy("feature_idx").agg(
        F.max("total_a_ref").alias("n_ref"),
        F.max("total_a_cur").alias("n_cur"),
        F.max(gap).alias("ks_raw"),
        F.array(*quantile_columns("value", "a_ref", probs)).alias("edges"),
    ))
    counts = stats.select("feature_idx", "n_ref", "n_cur")
    if exact:
        edges = stats.select("feature_idx", "edges")
    else:
        raw_ref = long.where(F.col("side") == "ref")
        edges = raw_ref.groupBy("feature_idx").agg(F.percentile_approx(
            "value", F.array(*[F.lit(p) for p in probs]), 10000).alias("edges"))

    # bin = number of interior edges <= value (per distinct value, then summed).
    binned = per_value.join(F.broadcast(edges), "feature_idx").select(
        "feature_idx", F.size(F.filter("edges", lambda e: e <= F.col("value"))).alias("bin"), "a_ref", "a_cur"
    )
    hist = binned.groupBy("feature_idx", "bin").agg(F.sum("a_ref").alias("c_ref"), F.sum("a_cur").alias("c_cur"))

    # D3: PSI over the full bin grid (an empty bin contributes through the floor).
    grid = counts.select("feature_idx", "n_ref", "n_cur",
                         F.explode(F.sequence(F.lit(0), F.lit(num_buckets - 1))).alias("bin"))
    g = grid.join(hist, ["feature_idx", "bin"], "left")
    r_pct = F.least(F.greatest(F.coalesce(F.col("c_ref"), F.lit(0)) / F.col("n_ref"), F.lit(PSI_FLOOR)), F.lit(1.0))
    c_pct = F.least(F.greatest(F.coalesce(F.col("c_cur"), F.lit(0)) / F.col("n_cur"), F.lit(PSI_FLOOR)), F.lit(1.0))
    psi = g.groupBy("feature_idx").agg(F.sum((c_pct - r_pct) * F.ln(c_pct / r_pct)).alias("psi_raw"))

    names = F.array(*[F.lit(f) for f in features])
    counts = counts.withColumn("feature", F.element_at(names, F.col("feature_idx") + 1))
    res = counts.join(stats.select("feature_idx", "ks_raw"), "feature_idx").join(psi, "feature_idx")
    res = res.withColumn("p_raw", ks_pvalue("ks_raw", "n_ref", "n_cur"))
    if p_method in ("auto", "exact"):
        # one row per feature
        exact_p = exact_pvalues(stats, exact_max_n if p_method == "auto" else 1 << 62)
        res = res.join(F.broadcast(exact_p), "feature_idx", "left").withColumn("p_raw", F.coalesce("p_exact", "p_raw")).drop("p_exact")
    elif p_method != "asymptotic":
        raise ValueError(f"unknown p_method: {p_method}")
    res = res.withColumn(
        "drift_detected", (F.col("p_raw") < p_value_threshold) | (F.col("psi_raw") > psi_threshold)
    )
    return res.select(
        "feature_idx",
        "feature",
        "n_ref",
        "n_cur",
        round_half_up("ks_raw", 4).alias("ks_statistic"),
        round_half_up("p_raw", 5).alias("p_value"),
        round_half_up("psi_raw", 4).alias("psi"),
        "drift_detected",
    )


def dataset_drift(per_feature: DataFrame, n_features: int) -> DataFrame:
    """One-row verdict. Skipped features stay in the denominator."""
    threshold = max(1, n_features // 3)
    drifted = F.count_if("drift_detected")
    names = F.array_join(
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.struct("feature_idx", "feature")))),
            lambda s: s["feature"],
        ),
        ",",
    )
    share = drifted / F.lit(float(n_features)) if n_features else F.lit(0.0)
    return per_feature.agg(
        F.lit(n_features).alias("n_features"),
        drifted.alias("drifted_features_count"),
        round_half_up(share, 3).alias("drift_share"),
        (drifted >= threshold).alias("dataset_drift"),
        (drifted >= threshold).alias("requires_retraining"),
        F.coalesce(names, F.lit("")).alias("drifted_features"),
    )


def check_drift(reference: DataFrame, current: DataFrame, features: list[str] | None = None, **kw):
    """(per_feature, summary) frames for a drift check."""
    features = features if features is not None else auto_features(reference, current)
    per = feature_drift(reference, current, features, **kw)
    return per, dataset_drift(per, len(features))


def alert_rows(summary: DataFrame) -> DataFrame:
    """Alert message rows; paging only when retraining is required.

    Delivery (chat / pager) is not built: rows are appended to an alerts table.
    """
    share_pct = F.format_string("%.1f", round_half_up(F.col("drift_share") * 100.0, 1))
    message = F.concat(
        F.lit("[Vitals ML Alert] Data drift detected. Drifted features: "),
        F.col("drifted_features"),
        F.lit(". Drift share: "),
        share_pct,
        F.lit("%. Action: review the production data distribution and trigger re-training."),
    )
    chat = F.struct(message.alias("message"), F.lit("chat").alias("channel"), F.lit("warning").alias("severity"),
                    F.lit(True).alias("deliver"))
    pager = F.struct(
        F.concat(F.lit("Drift alert: "), F.col("drifted_features_count").cast("string"),
                 F.lit(" features drifted")).alias("message"),
        F.lit("pager").alias("channel"),
        F.lit("warning").alias("severity"),
        F.col("requires_retraining").alias("deliver"),
    )
    # Both rows from one pass over the summary (a union would plan the drift job twice).
    return summary.select(F.inline(F.array(chat, pager)))
