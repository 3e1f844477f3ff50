"""Feature scaling with exact semantics.

Fitting is one global aggregate over the training rows (partial aggregation
per task); exact quartiles come from ranked value counts (``ordered``). The fitted state is a one-row-per-feature params table, tiny by
construction (features x 2 numbers), so transforming inlines the params as
literals: a pure projection, no join and no shuffle.

MLlib scalers are not used: StandardScaler uses the sample std (constant
column -> 0), MinMaxScaler maps a constant column to 0.5, RobustScaler picks
data points instead of interpolating quartiles.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.operators.ordered import exact_quantiles

METHODS = ("standard", "minmax", "robust")
PARAMS_SCHEMA = "feature string, center double, scale double, method string"


def _num(c: str):
    v = F.col(c).cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def fit_params(df: DataFrame, features: list[str], method: str = "robust", exact: bool = True) -> DataFrame:
    """Params table (feature, center, scale, method); NULL/NaN ignored while fitting.

    robust: median and IQR (linear-interpolated quartiles); ``exact=False`` uses
    ``percentile_approx`` (bounded memory per feature, rank error 1/10000).
    """
    if method not in METHODS:
        raise ValueError(f"Unknown scaling method: {method}")
    if method == "robust" and exact:
        return _exact_quartiles(df, features)
    aggs = []
    for i, c in enumerate(features):
        x = _num(c)
        if method == "standard":
            aggs += [F.avg(x).alias(f"c{i}"), F.stddev_pop(x).alias(f"s{i}")]
        elif method == "minmax":
            aggs += [F.min(x).alias(f"c{i}"), (F.max(x) - F.min(x)).alias(f"s{i}")]
        else:
            probs = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
            aggs.append(F.percentile_approx(x, probs, 10000).alias(f"q{i}"))
    wide = df.agg(*aggs)
    rows = []
    for i, c in enumerate(features):
        if method == "robust":
            center = F.col(f"q{i}")[1]
            scale = F.col(f"q{i}")[2] - F.col(f"q{i}")[0]
        else:
            center, scale = F.col(f"c{i}"), F.col(f"s{i}")
        scale = F.when(scale.isNull() | (scale == 0), F.lit(1.0)).otherwise(scale)
        rows.append(
            F.struct(
                F.lit(c).alias("feature"),
                center.cast("double").alias("center"),
                scale.cast("double").alias("scale"),
                F.lit(method).alias("method"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))


def _exact_quartiles(df: DataFrame, features: list[str]) -> DataFrame:
    """Robust params from exact quartiles: values are counted per feature and ranked in ranges."""
    cells = F.array(*[F.struct(F.lit(i).alias("__i"), _num(c).alias("__x")) for i, c in enumerate(features)])
    found = exact_quantiles(df.select(F.inline(cells)), "__x", [0.25, 0.5, 0.75], by=["__i"])
    names = F.array(*[F.lit(c) for c in features])
    every = df.sparkSession.range(len(features)).select(F.col("id").cast("int").alias("__i"))
    iqr = F.col("quantiles")[2] - F.col("quantiles")[0]
    return every.join(found, "__i", "left").select(  # both sides hold one row a feature
        F.element_at(names, F.col("__i") + 1).alias("feature"),
        F.col("quantiles")[1].alias("center"),
        F.when(iqr.isNull() | (iqr == 0), F.lit(1.0)).otherwise(iqr).alias("scale"),
        F.lit("robust").alias("method"),
    )


@dataclass
class Scaler:
    """Fitted scaler: collect the (tiny) params once, then transform lazily."""

    method: str = "robust"
    exact: bool = True
    params: dict[str, tuple[float, float]] = field(default_factory=dict)

    def __post_init__(self):
        if self.method not in METHODS:
            raise ValueError(f"Unknown scaling method: {self.method}")

    @property
    def is_fitted(self) -> bool:
        return bool(self.params)

    @property
    def feature_names(self) -> list[str]:
        return list(self.params)

    def fit(self, df: DataFrame, features: list[str]) -> "Scaler":
        rows = fit_params(df, features, self.method, self.exact).collect()
        self.params = {r.feature: (r.center, r.scale) for r in rows}
        return self

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """(x - center) / scale per fitted feature; missing values pass through."""
        if not self.is_fitted:
            raise RuntimeError("Scaler is not fitted yet.")
        exprs = {}
        for c, (center, scale) in self.params.items():
            # An unfitted-center (all-NULL column) leaves values unchanged as NULL.
            if center is None:
                exprs[c + suffix] = F.lit(None).cast("double")
            else:
                exprs[c + suffix] = (_num(c) - F.lit(float(center))) / F.lit(float(scale))
        return df.withColumns(exprs)

    def fit_transform(self, df: DataFrame, features: list[str]) -> DataFrame:
        return self.fit(df, features).transform(df)

    # Persist / restore as a params table.
    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(f, c, s, self.method) for f, (c, s) in self.params.items()]
        spark.createDataFrame(rows, PARAMS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Scaler":
        rows = spark.read.parquet(path).collect()
        if not rows:
            raise RuntimeError(f"No scaler params at {path}")
        return cls(method=rows[0].method, params={r.feature: (r.center, r.scale) for r in rows})


def transform_with_params(df: DataFrame, params: DataFrame, features: list[str]) -> DataFrame:
    """Lazy transform that joins nothing: params are pivoted to one row and
    attached with a broadcast of that single row (size bounded by the feature
    count). Used where collecting the params is undesirable (streaming)."""
    wide = params.groupBy().pivot("feature", features).agg(F.first(F.struct("center", "scale")))
    wide = wide.select(*[F.col(f).alias(f"__p_{f}") for f in features]).withColumn("__k", F.lit(0))
    out = df.withColumn("__k", F.lit(0)).join(F.broadcast(wide), "__k")
    return out.withColumns(
        {f: (_num(f) - F.col(f"__p_{f}.center")) / F.col(f"__p_{f}.scale") for f in features}
    ).drop("__k", *[f"__p_{f}" for f in features])
