"""Column-level helpers shared by every operator (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: str | Column, k: int) -> Column:
    """Round to ``k`` decimals, ties away from -inf: ``floor(x*10^k + 0.5)/10^k``.

    Spark's ``round`` and DuckDB's ``round`` break binary ties differently;
    this form gives identical doubles in both engines. NULL stays NULL. NaN,
    infinities and numbers from 2^52 / 10^k on, whose doubles lie no closer
    than the digit asked for, stay as they are.
    """
    c, scale = as_col(c).cast("double"), float(10**k)
    return F.when(F.abs(c) >= 2.0**52 / scale, c).otherwise(  # NaN is greater than any number
        F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale))


def nan_to_null(c: str | Column) -> Column:
    """Spark keeps NaN distinct from NULL (avg/max propagate NaN); fold NaN into NULL."""
    c = as_col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c.cast("double"))


def clip_keep_null(c: str | Column, lo: float | None, hi: float | None) -> Column:
    """Clamp into [lo, hi]; NULL stays NULL (``greatest``/``least`` skip it) and NaN becomes NULL.

    NaN sorts above every number, so ``least`` would turn it into the upper bound.
    """
    c = as_col(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNull() | F.isnan(c.cast("double")), F.lit(None).cast("double")).otherwise(out)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num/den with a zero (or NULL) denominator giving 0.0."""
    return F.coalesce(F.try_divide(as_col(num).cast("double"), as_col(den).cast("double")), F.lit(0.0))


def semver_key(version: str | Column) -> Column:
    """Version string -> array<int> ordering key ("10.0.0" > "9.0.0")."""
    return F.transform(F.split(as_col(version), r"\."), lambda p: p.try_cast("int"))


def ks_pvalue(d: str | Column, n: str | Column, m: str | Column, terms: int = 100) -> Column:
    """Asymptotic two-sided Kolmogorov p-value Q(lambda) as a Spark expression.

    lambda = D * sqrt(n*m/(n+m)); Q = 2 * sum_{k>=1} (-1)^(k-1) exp(-2 k^2 lambda^2).
    The series converges slowly near 0, where Q is 1 to double precision for
    lambda < 0.2; the result is clamped to [0, 1].
    """
    d, n, m = as_col(d).cast("double"), as_col(n).cast("double"), as_col(m).cast("double")
    lam = d * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0))
        * F.exp(F.lit(-2.0) * k.cast("double") * k.cast("double") * lam * lam),
    )
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))


def secret(value: str | bytes) -> Column:
    """A key or salt as a scalar subquery over a one-row table.

    Unlike a literal it cannot be folded into an expression, so no plan, event log or
    ``explain`` shows it.
    """
    kind = "binary" if isinstance(value, bytes) else "string"
    return SparkSession.active().createDataFrame([(value,)], f"secret {kind}").scalar()
