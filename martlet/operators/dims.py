"""Dimensions: date attributes, insert-if-absent loading and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.dates import date_key, month_key
from martlet.operators.ordering import first_per_key, global_row_number


def date_attributes(ts: Column | str) -> list[Column]:
    """full_date, date_key, day, month, year, quarter, month_key of a
    timestamp or date column."""
    c = F.col(ts) if isinstance(ts, str) else ts
    d = F.to_date(c)
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        month_key(date_key(d)).alias("month_key"),
    ]


def distinct_timestamps(transactions: DataFrame, col: str = "transaction_date") -> DataFrame:
    return transactions.select(col).where(F.col(col).isNotNull()).distinct()


def dim_date(transactions: DataFrame, col: str = "transaction_date") -> DataFrame:
    """One row per calendar day that has a transaction. The day is taken
    before the distinct, so the aggregate holds at most one row per day
    (bounded by the calendar, not by the data)."""
    days = transactions.select(F.to_date(col).alias("_d")).where(F.col("_d").isNotNull()).distinct()
    return days.select(*date_attributes("_d"))


def insert_if_absent(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose business key is not in ``existing``; when
    the batch repeats a key, its first row (full-row order) wins, as an
    insert that ignores conflicts would keep only one of them."""
    keys = list(keys)
    return first_per_key(incoming, keys).join(existing.select(*keys), keys, "left_anti")


def max_key(existing: DataFrame, key_col: str) -> int:
    """Largest surrogate key already assigned (0 for an empty dimension).
    A single-row aggregate: one number reaches the driver."""
    row = existing.agg(F.max(key_col).alias("m")).first()
    return int(row["m"]) if row is not None and row["m"] is not None else 0


def assign_keys(new_rows: DataFrame, business_key: str, key_col: str,
                start_after: int | Column = 0) -> DataFrame:
    """Surrogate keys ``start_after + 1 ..`` in business-key order, without
    funnelling the new members through one task."""
    keyed = global_row_number(new_rows, [business_key], key_col, offset=start_after)
    keyed = keyed.withColumn(key_col, F.col(key_col).cast("int"))
    return keyed.select(key_col, *[c for c in new_rows.columns])


def upsert_dimension(incoming: DataFrame, existing: DataFrame, business_key: str,
                     key_col: str) -> DataFrame:
    """New dimension rows with keys continuing after the existing maximum
    (type-0 dimension: members already loaded never change)."""
    new = insert_if_absent(incoming, existing, [business_key])
    return assign_keys(new, business_key, key_col, max_key(existing, key_col))
