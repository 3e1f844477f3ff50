"""Rule-based data quality: null counts, rules report, verdict, quarantine.

All rule counters are evaluated in ONE global aggregate (partial aggregation
per task, a single tiny merge), then unpivoted to a long table. The
reference scanned each column four to five times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.schema import ALLOWED_RULES, RANGE_RULES

#: Invalid values that a report names; it says how many more there are (all of them: ``invalid_values``).
NAMED_VALUES = 20

REPORT_SCHEMA = "column_name string, check_name string, severity string, violations bigint, detail string"


class DataQualityError(ValueError):
    """Raised by ``require_valid`` with the list of error messages."""


def _is_missing(df: DataFrame, c: str) -> Column:
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _missing_sql(df: DataFrame, c: str) -> str:
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return f"({_q(c)} IS NULL OR isnan({_q(c)}))"
    return f"({_q(c)} IS NULL)"


def _lit_sql(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def null_counts(df: DataFrame) -> DataFrame:
    """A1: (column_name, null_count, total_records) for every column, one pass.

    Built as SQL expression strings: they are parsed on the JVM in one call
    each, so building the plan stays cheap for wide tables.
    """
    aggs = ["count(1) AS __total"] + [f"count_if({_missing_sql(df, c)}) AS __n{i}" for i, c in enumerate(df.columns)]
    wide = df.agg(*[F.expr(x) for x in aggs])
    rows = ", ".join(
        f"named_struct('column_name', {_lit_sql(c)}, 'null_count', __n{i})" for i, c in enumerate(df.columns)
    )
    return wide.selectExpr(f"inline(array({rows}))", "__total AS total_records")


def _not_allowed_sql(df: DataFrame, c: str, allowed) -> str:
    allowed_sql = ", ".join(f"{float(a)!r}D" for a in allowed)
    return f"(NOT {_missing_sql(df, c)} AND CAST({_q(c)} AS DOUBLE) NOT IN ({allowed_sql}))"


def invalid_values(df: DataFrame, allowed_rules: dict | None = None, by: list[str] | None = None) -> DataFrame:
    """A5/O4 as rows: (by..., column_name, value, place, n) for every different value outside its column's allowed set.

    ``value`` is text, ``place`` its number. A grouped count with map-side partial
    aggregation of the violating rows only: any number of different values, nothing
    collected. Missing values and columns that ``df`` lacks give no row.
    """
    allowed_rules = ALLOWED_RULES if allowed_rules is None else allowed_rules
    cells = [
        f"CASE WHEN {_not_allowed_sql(df, c, allowed)} THEN named_struct('column_name', {_lit_sql(c)}, "
        f"'value', CAST({_q(c)} AS STRING), 'place', CAST({_q(c)} AS DOUBLE)) END"
        for c, (allowed, _) in allowed_rules.items() if c in df.columns
    ] or ["CAST(NULL AS struct<column_name: string, value: string, place: double>)"]
    keys = [_q(b) for b in by or []]
    rows = df.selectExpr(*keys, f"inline(array_compact(array({', '.join(cells)})))")
    return rows.groupBy(*keys, "column_name", "value", "place").agg(F.count(F.lit(1)).alias("n"))


def _named_values(df: DataFrame, allowed_rules: dict, by: list[str]) -> DataFrame:
    """(by..., column_name, named): the smallest ``NAMED_VALUES`` invalid values and the number of others."""
    values = invalid_values(df, allowed_rules, by)
    keys = [F.col(_q(b)) for b in by]
    order = Window.partitionBy(*keys, "column_name").orderBy("place", "value")
    first = values.withColumn("__nth", F.row_number().over(order)).where(F.col("__nth") <= NAMED_VALUES)
    # at most NAMED_VALUES values a group are collected
    named = first.groupBy(*keys, "column_name").agg(F.array_sort(F.collect_list(F.struct("__nth", "value"))).alias("__first"))
    total = values.groupBy(*keys, "column_name").agg(F.count(F.lit(1)).alias("__total"))
    same = [named[_q(b)].eqNullSafe(total[_q(b)]) for b in [*by, "column_name"]]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    text = F.array_join("__first.value", ",")
    more = F.col("__total") - NAMED_VALUES
    return named.join(total, cond).select(
        *[named[_q(b)] for b in by], named["column_name"],
        F.when(more > 0, F.concat(text, F.lit(" and "), more.cast("string"), F.lit(" more"))).otherwise(text).alias("named"))


def quality_report(
    df: DataFrame,
    range_rules: dict | None = None,
    allowed_rules: dict | None = None,
    id_col: str = "patient_id",
    by: list[str] | None = None,
) -> DataFrame:
    """A2-A5 as a long table (column_name, check_name, severity, violations, detail).

    Checks: id presence / nulls (error), required columns (error), nulls per rule
    column (warning), values below / above inclusive bounds (error), values
    outside an allowed set (error, detail = sorted invalid values, the first
    ``NAMED_VALUES`` of them and how many more). A check that passes has severity 'ok'. With ``by`` the same report is produced per
    group (a grouped aggregate instead of a global one). All counters are one
    aggregate, written as SQL expression strings (cheap to build); the details come
    from a second pass over the columns with an allowed set.
    """
    range_rules = RANGE_RULES if range_rules is None else range_rules
    allowed_rules = ALLOWED_RULES if allowed_rules is None else allowed_rules
    by = by or []
    aggs: list[str] = []
    rows: list[str] = []

    def row(c: str, check: str, severity_sql: str, count_sql: str, detail_sql: str = "''") -> None:
        rows.append(
            f"named_struct('column_name', {_lit_sql(c)}, 'check_name', {_lit_sql(check)}, 'severity', {severity_sql}, "
            f"'violations', CAST({count_sql} AS BIGINT), 'detail', {detail_sql})"
        )

    def counted(c: str, check: str, alias: str, sev: str, detail_sql: str = "''") -> None:
        row(c, check, f"CASE WHEN {alias} > 0 THEN '{sev}' ELSE 'ok' END", alias, detail_sql)

    if id_col not in df.columns:
        row(id_col, "present", "'error'", "1", "'missing required column'")
    else:
        aggs.append(f"count_if({_q(id_col)} IS NULL) AS id_nulls")
        counted(id_col, "not_null", "id_nulls", "error")

    for i, (c, (lo, hi, required)) in enumerate(range_rules.items()):
        if c not in df.columns:
            if required:
                row(c, "present", "'error'", "1", "'required column missing'")
            continue
        miss = _missing_sql(df, c)
        aggs += [
            f"count_if({miss}) AS r{i}_null",
            f"count_if(NOT {miss} AND {_q(c)} < {float(lo)!r}D) AS r{i}_lo",
            f"count_if(NOT {miss} AND {_q(c)} > {float(hi)!r}D) AS r{i}_hi",
        ]
        counted(c, "nulls", f"r{i}_null", "warning")
        counted(c, f"below_min_{lo:g}", f"r{i}_lo", "error")
        counted(c, f"above_max_{hi:g}", f"r{i}_hi", "error")

    for j, (c, (allowed, required)) in enumerate(allowed_rules.items()):
        if c not in df.columns:
            if required:
                row(c, "present", "'error'", "1", "'required column missing'")
            continue
        aggs += [
            f"count_if({_missing_sql(df, c)}) AS s{j}_null",
            f"count_if({_not_allowed_sql(df, c, allowed)}) AS s{j}_bad",
        ]
        counted(c, "nulls", f"s{j}_null", "warning")
        counted(c, "allowed_set", f"s{j}_bad", "error")

    if not aggs:
        aggs = ["count(1) AS __n"]
    agg_cols = [F.expr(x) for x in aggs]
    wide = df.groupBy(*by).agg(*agg_cols) if by else df.agg(*agg_cols)
    report = wide.selectExpr(*[_q(b) for b in by], f"inline(array({', '.join(rows)}))")
    if not any(c in df.columns for c in allowed_rules):
        return report
    named = _named_values(df, allowed_rules, by)
    cond = (report["column_name"] == named["column_name"]) & (report["check_name"] == "allowed_set")
    for b in by:
        cond = cond & report[_q(b)].eqNullSafe(named[_q(b)])
    others = [report[_q(c)] for c in report.columns if c != "detail"]
    return report.join(named, cond, "left").select(*others, F.coalesce(named["named"], report["detail"]).alias("detail"))


def quality_verdict(report: DataFrame, total: DataFrame | None = None) -> DataFrame:
    """One row (errors, warnings, success) from a report."""
    return report.agg(
        F.count_if(F.col("severity") == "error").alias("error_count"),
        F.count_if(F.col("severity") == "warning").alias("warning_count"),
        (F.count_if(F.col("severity") == "error") == 0).alias("success"),
    )


def report_messages(report: DataFrame) -> list[str]:
    """Human-readable error lines (collects the small report, never data rows)."""
    lines = []
    for r in report.filter(F.col("severity") == "error").collect():
        lines.append(f"{r.column_name}: {r.check_name} ({r.violations}) {r.detail}".strip())
    return lines


def validate(df: DataFrame, **kw) -> dict:
    """Success / errors / warnings / metrics dictionary (one aggregate job)."""
    report = quality_report(df, **kw).cache()
    rows = report.collect()
    report.unpersist()
    errors = [f"{r.column_name}: {r.check_name} ({r.violations}) {r.detail}".strip() for r in rows if r.severity == "error"]
    warnings = [f"{r.column_name}: {r.check_name} ({r.violations})" for r in rows if r.severity == "warning"]
    return {"success": not errors, "errors": errors, "warnings": warnings, "report": rows}


def require_valid(df: DataFrame, **kw) -> dict:
    """A6 helper: raise ``DataQualityError`` listing the failed rules."""
    result = validate(df, **kw)
    if not result["success"]:
        raise DataQualityError(f"Data quality validation failed: {result['errors']}")
    return result


def quarantine(df: DataFrame, range_rules: dict | None = None, allowed_rules: dict | None = None) -> DataFrame:
    """Every row plus ``reasons`` (array of failed rules) and ``is_valid``.

    A row-local expression: no shuffle. Split with ``filter('is_valid')`` /
    ``filter('not is_valid')`` to route valid rows on and rejected rows to a
    quarantine table. NULLs are not reasons (they are warnings in the report).
    """
    range_rules = RANGE_RULES if range_rules is None else range_rules
    allowed_rules = ALLOWED_RULES if allowed_rules is None else allowed_rules
    reasons = []
    for c, (lo, hi, _req) in range_rules.items():
        if c in df.columns:
            ok = f"NOT {_missing_sql(df, c)}"  # NaN sorts above every number in Spark
            reasons.append(f"CASE WHEN {ok} AND {_q(c)} < {float(lo)!r}D THEN {_lit_sql(c + '_below_min')} END")
            reasons.append(f"CASE WHEN {ok} AND {_q(c)} > {float(hi)!r}D THEN {_lit_sql(c + '_above_max')} END")
    for c, (allowed, _req) in allowed_rules.items():
        if c in df.columns:
            allowed_sql = ", ".join(f"{float(x)!r}D" for x in allowed)
            reasons.append(f"CASE WHEN NOT {_missing_sql(df, c)} AND CAST({_q(c)} AS DOUBLE) NOT IN ({allowed_sql}) "
                           f"THEN {_lit_sql(c + '_not_allowed')} END")
    arr = f"array_compact(array({', '.join(reasons)}))" if reasons else "CAST(array() AS array<string>)"
    return df.selectExpr("*", f"{arr} AS reasons").selectExpr("*", "size(reasons) = 0 AS is_valid")
