"""Clock drift (A13) and resampling to a regular grid with interpolation.

Resampling plan (per key, default ``patient_id``), in chunks of ``chunk_slots``
grid slots, so that no task holds more of a series than a chunk:

1. Slot number ``floor((t - d0) / step)`` with ``d0`` the midnight of the key's
   first day. When the step divides a day, every midnight gives the same slots
   and the per-key ``d0`` join is skipped.
2. ``groupBy(key, slot).agg(avg)`` -- partial aggregation shrinks even a hot
   patient to at most one row per slot per task before the shuffle.
3. These means are dealt by (key, chunk). One row per (key, chunk) with data,
   made where its means lie: first and last known (slot, value) of every
   column. A window over these rows, 1 / ``chunk_slots`` of the grid, gives
   each chunk what is known before and after it; chunks without data are added
   between (J3).
4. That goes back to the chunks as two border rows, before the first and after
   the last slot. Only borders are dealt anew, and a chunk's rows are sorted
   once; a task walks over whole chunks with NumPy, finds the known point before
   and after every row, and expands each row into its slot and the empty ones up
   to the next. Rows are no wider than their values until then: nothing wide is
   sorted.

With ``keys=[]`` the one series spreads over tasks by chunks. Steps 3 and 4
read the same dealt means (a reused exchange); nothing runs before an action.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions import as_col, nan_to_null
from pulsekit.session import ship_package

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
DAY_US = 86_400_000_000
CHUNK_SLOTS = 10_000  # grid slots that one task expands and fills at a time
TOGETHER, OUT_ROWS = 8_192, 16_384  # rows of whole chunks that a task fills in one go; grid rows it gives back at a time


def clock_drift(
    df: DataFrame,
    device_col: str | Column,
    server_col: str | Column,
    by: list[str] | None = None,
    max_drift_seconds: float = 5.0,
) -> DataFrame:
    """Mean / max |device - server| in seconds; critical when max > limit.

    Pairs without a difference (NULL or NaN on either side) do not count.
    """
    by = by or []
    d = nan_to_null(F.abs(as_col(device_col).cast("double") - as_col(server_col).cast("double")))
    aggs = [F.avg(d).alias("mean_drift_sec"), F.max(d).alias("max_drift_sec")]
    out = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return out.withColumn("is_drift_critical", F.col("max_drift_sec") > F.lit(float(max_drift_seconds)))


def epoch_seconds(ts: str | Column) -> Column:
    """Seconds since the epoch as double (timestamp or timestamp_ntz, UTC session)."""
    return F.unix_micros(as_col(ts).cast("timestamp")).cast("double") / F.lit(1e6)


def parse_freq(freq: str | int | float) -> int:
    """'15min', '1h', '30s', '2d' or seconds -> step in microseconds."""
    if isinstance(freq, (int, float)):
        return int(round(float(freq) * 1_000_000))
    s = freq.strip().lower()
    units = {"us": 1, "ms": 1_000, "s": 1_000_000, "sec": 1_000_000, "min": 60_000_000, "t": 60_000_000,
             "h": 3_600_000_000, "d": DAY_US}
    for u in sorted(units, key=len, reverse=True):
        if s.endswith(u):
            num = s[: -len(u)] or "1"
            return int(round(float(num) * units[u]))
    raise ValueError(f"Unsupported frequency: {freq}")


def numeric_columns(df: DataFrame, exclude: list[str]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC) and f.name not in exclude]


def _known(cols: list[str], what: str) -> list[str]:
    return [what.replace("{c}", c.replace("`", "``")).replace("{i}", str(i)) for i, c in enumerate(cols)]


def slot_means(df: DataFrame, time_col: str, step: int, keys: list[str], cols: list[str]) -> DataFrame:
    """(keys, __d0, __s, columns): means per slot; slot ``__s`` begins ``__s`` steps after ``__d0`` (microseconds)."""
    base = df.where(F.col(time_col).isNotNull()).select(*keys, F.unix_micros(F.col(time_col).cast("timestamp")).alias("__us"), *[
        F.expr(e) for e in _known(cols, "nullif(CAST(`{c}` AS DOUBLE), double('NaN')) AS `{c}`")])
    if DAY_US % step == 0:
        slots = base.selectExpr("*", "0L AS __d0")
    else:
        first = base.groupBy(*keys).agg(F.expr(f"(min(__us) - pmod(min(__us), {DAY_US}L)) AS __d0"))
        # without keys there is one first day
        slots = base.join(first, keys) if keys else base.join(F.broadcast(first))
    slots = slots.withColumn("__s", F.expr(f"(__us - __d0 - pmod(__us - __d0, {step}L)) div {step}L"))
    return slots.groupBy(*[f"`{k}`" for k in keys], "__d0", "__s").agg(
        *[F.expr(e) for e in _known(cols, "avg(`{c}`) AS `{c}`")])


def _around(known: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the known row at or before, and after, every row of its chunk (rows ``first`` to ``last``); -1 if there is none."""
    n = len(known)
    at = np.arange(n)
    before = np.maximum.accumulate(np.where(known, at, -1))
    after = np.append(np.minimum.accumulate(np.where(known, at, n)[::-1])[::-1][1:], n)
    return np.where(before >= first, before, -1), np.where(after <= last, after, -1)


def _value(method: str, step: int, g: np.ndarray, p: tuple, n: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(values, which are known) of slots ``g`` from the known (slot, value, whether there is one) before and after."""
    (pt, pv, has_p), (nt, nv, has_n) = p, n
    first, then = np.where(has_p, pv, nv), np.where(has_n, nv, pv)
    both = has_p & has_n
    if method == "linear":
        rise, run = np.where(both, nv - pv, 0.0), np.where(both, ((nt - pt) * step).astype(np.float64), 1.0)
        out = np.where(has_p & (g == pt), first, first + rise * ((g - pt) * step).astype(np.float64) / run)
    elif method == "ffill":
        out = first
    elif method == "bfill":
        out = np.where(has_p & (g == pt), first, then)
    else:  # nearest; an exact tie takes the earlier value
        out = np.where(2 * g <= pt + nt, first, then)
    return out, has_p | has_n


def _fill(n_keys: int, names: list[str], method: str, step: int):
    """Task of the last step: sorted rows (keys, __d0, __s, __kind, __t, __v, columns, __upto) -> a row a slot of the grid.

    Every chunk begins with its border row of kind 0 and ends with that of kind 2,
    so whole chunks are filled together, however small each one is.
    """

    def grid(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        column = [c.combine_chunks() for c in rows.columns]
        column = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in column]
        d0, s, kind = (column[n_keys + i].to_numpy(zero_copy_only=False) for i in range(3))
        border = np.flatnonzero(kind != 1)
        first, last = (np.flatnonzero(kind == k)[np.cumsum(kind == 0) - 1] for k in (0, 2))
        n_cols = len(column) - n_keys - 6
        t, v = (column[n_keys + i].take(pa.array(border)).flatten() for i in (3, 4))
        has = t.is_valid().to_numpy(zero_copy_only=False).reshape(len(border), n_cols)
        t, v = (pc.fill_null(x, 0).to_numpy(zero_copy_only=False).reshape(len(border), n_cols) for x in (t, v))
        upto = column[-1].to_numpy(zero_copy_only=False)
        source = np.flatnonzero(upto > s)
        size = upto[source] - s[source]
        ends = np.cumsum(size)
        points = []
        for i in range(n_cols):
            c = column[n_keys + 5 + i]
            known, value, at = c.is_valid().to_numpy(zero_copy_only=False), pc.fill_null(c, 0.0).to_numpy(zero_copy_only=False).copy(), s.copy()
            known = known.copy()
            known[border], value[border], at[border] = has[:, i], v[:, i], t[:, i]
            points.append([(at[x], value[x], x >= 0) for x in (y[source] for y in _around(known, first, last))])
        for low in range(0, int(ends[-1]) if len(ends) else 0, OUT_ROWS):
            slot = np.arange(low, min(low + OUT_ROWS, int(ends[-1])))
            of = np.searchsorted(ends, slot, side="right")
            row = source[of]
            g = s[row] + slot - (ends - size)[of]
            out = [c.take(pa.array(row)) for c in column[:n_keys]]
            out.append(pa.array(d0[row] + g * step, pa.int64()).cast(pa.timestamp("us")))
            with np.errstate(invalid="ignore", over="ignore"):
                for p, n in points:
                    value, known = _value(method, step, g, tuple(x[of] for x in p), tuple(x[of] for x in n))
                    out.append(pa.array(value, pa.float64(), mask=~known))
            yield pa.RecordBatch.from_arrays(out, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, whole = [], 0, -1  # batches not yet filled, their rows, and the rows up to the last whole chunk
        for batch in batches:
            ends = np.flatnonzero(batch.column(n_keys + 2).to_numpy(zero_copy_only=False) == 2)
            if len(ends):
                whole = n + int(ends[-1]) + 1
            held.append(batch)
            n += batch.num_rows
            if whole >= TOGETHER:
                rows = pa.Table.from_batches(held)
                yield from grid(rows.slice(0, whole))
                held = rows.slice(whole).to_batches()
                n, whole = n - whole, -1
        if n:
            yield from grid(pa.Table.from_batches(held))

    return run


def resample(
    df: DataFrame,
    time_col: str = "timestamp",
    freq: str | int | float = "1min",
    method: str = "linear",
    keys: list[str] | None = None,
    columns: list[str] | None = None,
    max_slots: int | None = None,
    chunk_slots: int = CHUNK_SLOTS,
) -> DataFrame:
    """W3+W4: bucket means on a regular grid, gaps filled by ``method``.

    methods: linear / time (identical on a regular grid), ffill / pad,
    bfill / backfill, nearest. After the method, leading gaps take the first
    known value and trailing gaps the last one; an all-NULL column stays NULL.
    ``keys=[]`` resamples the whole table as one series (reference behaviour).
    Rows without a time do not count; NaN is NULL; rows with a NULL key form a
    series of their own. A series may be as long as it likes;
    ``max_slots`` refuses longer grids where a caller wants that.
    """
    if time_col not in df.columns:
        raise KeyError(f"resample needs the time column '{time_col}'")
    method = {"pad": "ffill", "backfill": "bfill", "time": "linear", "index": "linear"}.get(method, method)
    if method not in ("linear", "ffill", "bfill", "nearest"):
        raise ValueError(f"Unsupported interpolation method: {method}")
    keys = ["patient_id"] if keys is None else list(keys)
    cols = columns or numeric_columns(df, exclude=keys + [time_col])
    step = parse_freq(freq)
    quoted = [f"`{k}`" for k in keys]
    part = ", ".join(quoted) or "__d0"  # one value if there are no keys
    # by number: few rows may expand to many slots, so their size must not decide how many tasks there are
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(spread, *[F.col(c) for c in quoted or ["__d0"]], "__chunk")

    means = dealt(slot_means(df, time_col, step, keys, cols).selectExpr(
        *quoted, "__d0", f"(__s - pmod(__s, {chunk_slots}L)) div {chunk_slots}L AS __chunk", "__s", *_known(cols, "`{c}` AS __c{i}")))

    # a row per chunk with data, and what is known around it
    chunks = means.groupBy(*quoted, "__d0", "__chunk").agg(
        F.min("__s").alias("__first"), F.max("__s").alias("__last"),
        *[F.expr(e) for e in _known(cols, "min(if(__c{i} IS NULL, NULL, __s)) AS __ft{i}")],
        *[F.expr(e) for e in _known(cols, "min_by(__c{i}, if(__c{i} IS NULL, NULL, __s)) AS __fv{i}")],
        *[F.expr(e) for e in _known(cols, "max(if(__c{i} IS NULL, NULL, __s)) AS __lt{i}")],
        *[F.expr(e) for e in _known(cols, "max_by(__c{i}, if(__c{i} IS NULL, NULL, __s)) AS __lv{i}")]).selectExpr(
        *quoted, "__d0", "__chunk", "__first", "__last", *_known(cols, "if(__ft{i} IS NULL, NULL, struct(__ft{i} AS t, __fv{i} AS v)) AS __f{i}"),
        *_known(cols, "if(__lt{i} IS NULL, NULL, struct(__lt{i} AS t, __lv{i} AS v)) AS __l{i}"))
    before = f"(PARTITION BY {part} ORDER BY __chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    after = f"(PARTITION BY {part} ORDER BY __chunk DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    chunks = chunks.selectExpr(
        "*", f"lead(__chunk) OVER (PARTITION BY {part} ORDER BY __chunk) AS __next",
        f"min(__first) OVER (PARTITION BY {part}) AS __begin", f"max(__last) OVER (PARTITION BY {part}) AS __end",
        *_known(cols, f"last(__l{{i}}, true) OVER {before} AS __p{{i}}"), *_known(cols, f"last(__f{{i}}, true) OVER {after} AS __n{{i}}"))
    if max_slots is not None:
        chunks = chunks.withColumn("__next", F.expr(
            f"if(__end - __begin + 1 > {int(max_slots)}L, raise_error('resample grid exceeds max_slots={int(max_slots)}'), __next)"))
    chunks = chunks.withColumn("__c", F.expr("explode(sequence(__chunk, coalesce(__next - 1, __chunk)))"))
    def known(last: str, field: str, kind: str) -> str:
        return f"CAST(array({', '.join(_known(cols, f'({last}).{field}'))}) AS array<{kind}>)"

    def border(at: str, kind: int, last: str) -> str:
        return f"struct({at} AS __s, {kind} AS __kind, {known(last, 't', 'bigint')} AS __t, {known(last, 'v', 'double')} AS __v)"

    here = border(f"greatest(__begin, __c * {chunk_slots}L)", 0, "if(__c = __chunk, __p{i}, coalesce(__l{i}, __p{i}))")
    beyond = border(f"least(__end, __c * {chunk_slots}L + {chunk_slots - 1}L) + 1", 2, "__n{i}")
    borders = dealt(chunks.selectExpr(*quoted, "__d0", "__c AS __chunk", f"inline(array({here}, {beyond}))"))
    data = means.selectExpr(*quoted, "__d0", "__chunk", "__s", "1 AS __kind", "CAST(NULL AS array<bigint>) AS __t",
                            "CAST(NULL AS array<double>) AS __v", *_known(cols, "__c{i}"))
    rows = data.unionByName(borders.selectExpr("*", *_known(cols, "CAST(NULL AS DOUBLE) AS __c{i}")))
    # both sides are dealt alike, so the window finds each chunk whole without another exchange, and leaves its rows sorted
    rows = rows.withColumn("__upto", F.expr(f"lead(__s, 1, __s) OVER (PARTITION BY {part}, __chunk ORDER BY __s, __kind)"))
    ship_package(df.sparkSession)
    names = [*(f"__key{i}" for i in range(len(keys))), "__at", *(f"__c{i}" for i in range(len(cols)))]
    types = [*(rows.schema[k].dataType for k in keys), T.TimestampNTZType(), *[T.DoubleType()] * len(cols)]
    rows = rows.selectExpr(*quoted, "__d0", "__s", "__kind", "__t", "__v", *_known(cols, "__c{i}"), "__upto")
    filled = rows.mapInArrow(_fill(len(keys), names, method, step), T.StructType([T.StructField(n, t) for n, t in zip(names, types)]))
    return filled.toDF(*keys, time_col, *cols)
