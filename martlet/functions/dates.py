"""Date-key arithmetic shared by the date dimension, the fact partitions and
the per-minute counters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_key(ts: Column | str) -> Column:
    """YYYYMMDD integer key of a date or timestamp (pure arithmetic, no
    string formatting)."""
    d = _c(ts)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_key(key: Column | str) -> Column:
    """YYYYMM of a YYYYMMDD key; the fact's partition column."""
    return (_c(key) / 100).cast("int")


def key_of(value: dt.date | dt.datetime | int) -> int:
    """Python-side YYYYMMDD key of a literal bound."""
    if isinstance(value, int):
        return value
    return value.year * 10000 + value.month * 100 + value.day


def month_start_key(mkey: Column | str) -> Column:
    """First day key of a YYYYMM month: YYYYMM01."""
    return (_c(mkey) * 100 + 1).cast("int")


def month_end_key(mkey: Column | str) -> Column:
    """Exclusive upper bound of a month partition; December rolls the year."""
    m = _c(mkey)
    nxt = F.when(m % 100 == 12, (F.floor(m / 100) + 1) * 100 + 1).otherwise(m + 1)
    return (nxt * 100 + 1).cast("int")


def partition_name(mkey: Column | str) -> Column:
    """``fact_sales_YYYY_MM``."""
    m = _c(mkey)
    return F.format_string("fact_sales_%04d_%02d", (m / 100).cast("int"), m % 100)


def minute_label(ts: Column | str) -> Column:
    """Minute of a timestamp as text ``yyyy-MM-dd HH:mm:00``."""
    return F.date_format(F.date_trunc("minute", _c(ts)), "yyyy-MM-dd HH:mm:00")
