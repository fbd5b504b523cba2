"""Date helpers: sargable year ranges, day differences, integer averages."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value: dt.datetime | dt.date) -> Column:
    """Zone-free literal: TIMESTAMP_NTZ for a datetime, DATE for a date.

    Built from text, so neither the Python process zone nor the session zone moves
    it, and comparing it with an NTZ column needs no cast on the column (pushdown).
    """
    if isinstance(value, dt.datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value.isoformat()).cast("date")


def year_range(c, year: int) -> Column:
    """``YEAR(c) = year`` written as a range so parquet min/max statistics prune."""
    c = F.col(c) if isinstance(c, str) else c
    return (c >= ts_lit(dt.datetime(year, 1, 1))) & (c < ts_lit(dt.datetime(year + 1, 1, 1)))


def days_between(start, end) -> Column:
    """Whole days from ``start`` to ``end`` (DATEDIFF(day, start, end))."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.datediff(e.cast("date"), s.cast("date"))


def avg_int(c) -> Column:
    """Average of an integer column truncated toward zero, as an integer (T-SQL AVG(int))."""
    c = F.col(c) if isinstance(c, str) else c
    s = F.sum(c)
    n = F.count(c)
    return (F.signum(s) * F.floor(F.abs(s) / n)).cast("int")
