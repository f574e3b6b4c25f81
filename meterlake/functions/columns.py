"""Small Column-level helpers used across operators.

All of them are built-in expressions, so they stay inside whole-stage codegen and
comparisons against literals reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

# Exact money arithmetic: quantities and prices are decimals, so sums do not depend
# on addition order and pre-aggregating quantity before pricing is exact.
QTY = "decimal(20,6)"
MONEY = "decimal(12,2)"


def _iso(d) -> str:
    if isinstance(d, _dt.datetime):
        return d.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(d, _dt.date):
        return d.isoformat()
    return str(d)


def date_lit(d) -> Column:
    """A DATE literal (time-zone independent)."""
    return F.lit(_iso(d)[:10]).cast("date")


def ntz_lit(d) -> Column:
    """A TIMESTAMP_NTZ literal built from text, so no session or host zone is applied."""
    return F.lit(_iso(d)).cast("timestamp_ntz")


def _as_date(d) -> _dt.date:
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d)[:10])


def last_days(df: DataFrame, col: str, as_of, days: int) -> DataFrame:
    """FIL-2: rows whose ``col`` falls in the ``days`` days ending at ``as_of``.

    The window is ``[as_of - days, as_of]`` in whole days. ``as_of`` is a parameter (not
    ``current_date()``) so a report is repeatable. For timestamp columns the bounds are
    written against the raw column so the comparison is pushed into the scan.
    """
    end = _as_date(as_of)
    start = end - _dt.timedelta(days=days)
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, (TimestampNTZType, TimestampType)):
        lit = ntz_lit if isinstance(dtype, TimestampNTZType) else (
            lambda x: F.lit(_iso(x)).cast("timestamp"))
        return df.filter((c >= lit(start)) & (c < lit(end + _dt.timedelta(days=1))))
    if isinstance(dtype, DateType):
        return df.filter((c >= date_lit(start)) & (c <= date_lit(end)))
    raise TypeError(f"{col} is {dtype.simpleString()}, not a date or timestamp")


def between_marks(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """FIL-1: high-water filter ``lo < col <= hi`` (either bound may be None)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, TimestampNTZType):
        lit = ntz_lit
    elif isinstance(dtype, DateType):
        lit = date_lit
    elif isinstance(dtype, TimestampType):
        lit = lambda x: F.lit(f"{_iso(x)}Z").cast("timestamp")  # noqa: E731  marks are UTC wall time
    else:
        lit = F.lit
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(col) > lit(lo))
    if hi is not None:
        cond = cond & (F.col(col) <= lit(hi))
    return df.filter(cond)


def money(c: Column | str) -> Column:
    """Decimal amount rounded to cents, as DOUBLE for reporting."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 2).cast("double")


def ratio(num: Column | str, den: Column | str) -> Column:
    """AG-5: ``num / den`` as DOUBLE, NULL when ``den`` is 0 or NULL (never raises under ANSI)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
