"""Column -> Column helpers (survey 2.7, F1-F15).

Every helper returns a built-in Spark expression, so it stays inside
whole-stage codegen; none of them is a Python UDF.  The helpers exist
because the source semantics (Oracle SQL and pandas) differ from Spark's
defaults in ways that silently change results: NULL handling of
GREATEST/LEAST, division by zero under ANSI mode, the start of the week,
half-up versus half-even rounding, falsy defaults and NaN.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

BYTES_PER_GIB = 1073741824  # 2**30
GIB_PER_TIB = 1024


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- time -----------------------------------------------------------------

def ts_literal(value: str | dt.date | dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal; ``as_of`` is always an argument, never
    ``current_timestamp()``, so every result can be replayed."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    elif isinstance(value, dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(value).cast("timestamp_ntz")


def days_before(as_of, n_days: int | float) -> Column:
    """``as_of - n_days`` (Oracle ``sysdate - n``, fractions of a day
    included); constant-folded by Catalyst."""
    zero = F.lit(0)
    return ts_literal(as_of) - F.make_dt_interval(zero, zero, zero, F.lit(n_days * 86400).cast("decimal(18,6)"))


def trailing_window(
    ts: str | Column, as_of, n_days: int | float | None, partition_col: str | Column | None = None
) -> Column:
    """``ts >= as_of - n_days AND ts < as_of``.

    The upper bound makes a run replayable at a past ``as_of``.  Both
    bounds fold to literals, so the predicate reaches the Parquet scan.
    ``n_days=None`` keeps only the upper bound.  ``partition_col`` is the
    date of ``ts`` that the table is partitioned by, if it is: the same
    bounds on it let the scan open only the days of the window.
    """
    end, start = ts_literal(as_of), None if n_days is None else days_before(as_of, n_days)
    cond = col(ts) < end if start is None else (col(ts) >= start) & (col(ts) < end)
    if partition_col is not None:
        day = col(partition_col)
        cond = cond & (day <= end.cast("date"))
        if start is not None:
            cond = cond & (day >= start.cast("date"))
    return cond


def week_start(d: str | Column) -> Column:
    """Oracle ``TRUNC(d, 'DAY')`` - the Sunday that starts d's week.

    ``date_trunc('week')`` would give Monday.
    """
    d = col(d).cast("date")
    return F.date_sub(d, F.dayofweek(d) - 1)


def snapshot_week(as_of) -> Column:
    """Week label of the run: ``TRUNC(sysdate - 1, 'DAY')``."""
    return week_start(F.date_sub(ts_literal(as_of).cast("date"), 1))


def snapshot_label(as_of) -> Column:
    """the ``MM-dd-yyyy`` text stamp written by the snapshot jobs."""
    return F.date_format(ts_literal(as_of), "MM-dd-yyyy")


def whole_seconds_between(start: str | Column, end: str | Column) -> Column:
    """``(CAST(end AS DATE) - CAST(start AS DATE)) * 86400``.

    Oracle DATE drops fractional seconds, so both ends are truncated to the
    second before subtracting; the result is a whole number of seconds.
    """
    return F.timestamp_diff(
        "SECOND", F.date_trunc("second", col(start)), F.date_trunc("second", col(end))
    )


# --- NULL and arithmetic ----------------------------------------------------

def nvl(c: str | Column, default=0) -> Column:
    """``NVL`` / ``fillna``."""
    return F.coalesce(col(c), F.lit(default))


def safe_div(num: str | Column, den: str | Column) -> Column:
    """``num / NULLIF(den, 0)``; ANSI mode raises on ``x / 0``."""
    return col(num) / F.nullif(col(den), F.lit(0))


def _any_null(cols: list[Column]) -> Column:
    cond = cols[0].isNull()
    for c in cols[1:]:
        cond = cond | c.isNull()
    return cond


def oracle_greatest(*cols: str | Column) -> Column:
    """Oracle GREATEST is NULL when any argument is NULL; Spark's skips NULLs."""
    cs = [col(c) for c in cols]
    return F.when(_any_null(cs), F.lit(None)).otherwise(F.greatest(*cs))


def oracle_least(*cols: str | Column) -> Column:
    """Oracle LEAST is NULL when any argument is NULL; Spark's skips NULLs."""
    cs = [col(c) for c in cols]
    return F.when(_any_null(cs), F.lit(None)).otherwise(F.least(*cs))


# Rounding goes through DECIMAL(38,12): two plans that compute the same
# quantity with a different summation order can differ in the last bit of a
# double, and a value that sits on a rounding tie would then round two ways.
# Twelve decimals absorb that noise; a value of 1e26 or more is an overflow error.
# Only values next to a tie, and large ones, need the decimal: the others round
# the same way as doubles, which costs a small part of the time.
EXACT_SCALES, DOUBLE_BELOW, TIE_WIDTH = range(5), 1e8, 1e-6


def _decimal_round(c: Column, scale: int, fn) -> Column:
    exact = fn(c.cast("decimal(38,12)"), scale).cast("double")
    if scale not in EXACT_SCALES:
        return exact
    units = c.cast("double") * float(10**scale)
    whole = F.rint(units)
    clear = (F.abs(units) < DOUBLE_BELOW) & (F.abs(F.abs(units - whole) - 0.5) > TIE_WIDTH)
    return F.when(clear, whole / float(10**scale) + 0.0).otherwise(exact)  # + 0.0: a decimal has no negative zero


def sql_round(c: str | Column, scale: int) -> Column:
    """SQL ``ROUND`` (half away from zero)."""
    return _decimal_round(col(c), scale, F.round)


def pandas_round(c: str | Column, scale: int) -> Column:
    """pandas/numpy ``round`` (half to even)."""
    return _decimal_round(col(c), scale, F.bround)


def falsy_default(c: str | Column, default) -> Column:
    """F8: Python ``x or default`` - NULL *and* 0 become ``default``."""
    return F.coalesce(F.nullif(col(c), F.lit(0)), F.lit(default))


def to_double_or_null(c: str | Column) -> Column:
    """``pd.to_numeric(errors='coerce')`` - bad text becomes NULL.

    Spark parses the text 'NaN' as a NaN double; pandas treats NaN as
    missing, so NaN is turned into NULL as well (never let NaN in).
    """
    d = col(c).try_cast("double")
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def bytes_to_gib(c: str | Column) -> Column:
    """bytes -> GiB."""
    return col(c).cast("double") / BYTES_PER_GIB


def bytes_to_tib(c: str | Column) -> Column:
    """bytes -> TiB (``/1073741824/1024``)."""
    return col(c).cast("double") / BYTES_PER_GIB / GIB_PER_TIB


# --- text -------------------------------------------------------------------

def not_test_queue(queue: str | Column) -> Column:
    """Case-insensitive exclusion of test queues."""
    return ~F.lower(col(queue)).contains("test")


def rse_matches(rse: str | Column, kind: str = "DATADISK", mode: str = "suffix") -> Column:
    """SQL ``LIKE '%DATADISK'`` (suffix) or Python ``'DATADISK' in rse`` (contains)."""
    if mode == "suffix":
        return col(rse).endswith(kind)
    if mode == "contains":
        return col(rse).contains(kind)
    raise ValueError(f"unknown rse match mode {mode!r}")


def dataset_scope(did: str | Column) -> Column:
    """scope of a ``scope:name`` identifier; without ':' the text before the first '.'."""
    d = col(did)
    return F.when(d.contains(":"), F.substring_index(d, ":", 1)).otherwise(
        F.substring_index(d, ".", 1)
    )


def dataset_name(did: str | Column) -> Column:
    """name of a ``scope:name`` identifier; without ':' the whole text."""
    d = col(did)
    return F.when(d.contains(":"), d.substr(F.instr(d, ":") + 1, F.length(d))).otherwise(d)
