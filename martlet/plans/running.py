"""Running totals of each customer's spend that loads continue.

The stored table has a row for each transaction, with the total *inside its
month*, in (date, id) order; a carry table has one row for each customer and
month: how many rows, their sum, the last position. A running total is the
row's total inside its month plus the carries of the customer's earlier
months, which are a few rows. So a load touches no later month:

* rows after the stored end of their month extend it from the carry alone and
  are appended, and no stored row is read for them;
* late rows (before that end) change the totals from the first of them to the
  end of their month: those are summed again, and the hash buckets they lie in
  are written anew, the other rows of a bucket as they are.

Layout: ``rows/`` and ``carry/`` by ``month_key`` and ``bucket``, a hash of
the customer. Sums run over range slices (``ordering.running_sum``), so a
customer who holds a third of all rows is not put into one task.

A load notes that it is open; where the next one finds the note, it takes the
carries from the rows that are there. Rows that a crash lost are missing from
the carries too, so the next load of the same batch adds them. A bucket that
is lost in the middle of its replacement comes back with the next whole
snapshot only.

Cases: a row without a date has no place in the order and is left out; a null
customer is a customer like any other; a null amount counts as 0; repeated
rows of one (customer, date, id) are one row, the least; an empty batch
changes nothing. Run one load at a time for each table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.functions.dates import date_key, month_key
from martlet.operators.joins import broadcast_if_small
from martlet.operators.ordering import first_per_key, running_sum
from martlet.session import checkpoint_dir
from martlet.sources.files import Files
from martlet.sources.readers import read_or_empty

OPEN, BUCKETS = "_load_open.json", "_buckets"
#: Hash buckets of a month, fixed by the first load of a table.
CONF_BUCKETS = ("martlet.running.buckets", 1)

ORDER = ["transaction_date", "transaction_id"]
KEY = ["customer_id", *ORDER]
GROUP = ["customer_id", "month_key"]
FOLDER = ["month_key", "bucket"]
SUM = T.DecimalType(28, 2)
ROWS = T.StructType([
    T.StructField("customer_id", T.IntegerType()), T.StructField("transaction_date", T.TimestampNTZType()),
    T.StructField("transaction_id", T.IntegerType()), T.StructField("total_amount", T.DecimalType(12, 2)),
    T.StructField("month_total", SUM), T.StructField("month_key", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
CARRY = T.StructType([
    T.StructField("customer_id", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("total", SUM),
    T.StructField("last_date", T.TimestampNTZType()), T.StructField("last_id", T.IntegerType()),
    T.StructField("month_key", T.IntegerType()), T.StructField("bucket", T.IntegerType())])


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A null-safe join on ``keys`` that keeps the left ones."""
    named = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(and_, (left[k].eqNullSafe(named[f"_r_{k}"]) for k in keys))
    return left.join(named, same, how).drop(*[f"_r_{k}" for k in keys])


def _position() -> Column:
    return F.struct(*ORDER)


def place(batch: DataFrame, buckets: int) -> DataFrame:
    """The rows of a batch with their month and bucket, one for each key."""
    dated = batch.select(*KEY, "total_amount").where(F.col("transaction_date").isNotNull())
    return first_per_key(dated, KEY).select(
        *KEY, "total_amount", month_key(date_key("transaction_date")).alias("month_key"),
        F.pmod(F.hash("customer_id"), F.lit(buckets)).alias("bucket"))


def carries(rows: DataFrame) -> DataFrame:
    """One row for each customer and month of ``rows``: count, sum, last position."""
    ends = rows.groupBy(*GROUP, "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("total_amount"), F.lit(0)).cast(SUM).alias("total"),
        F.max(_position()).alias("_last"))
    return ends.select("customer_id", "n", "total", F.col("_last.transaction_date").alias("last_date"),
                       F.col("_last.transaction_id").alias("last_id"), "month_key", "bucket")


def merged(*parts: DataFrame) -> DataFrame:
    """Carries of several sets of rows as one."""
    both = reduce(DataFrame.unionByName, parts)
    ends = both.groupBy(*GROUP, "bucket").agg(F.sum("n").alias("n"), F.sum("total").cast(SUM).alias("total"),
                                              F.max(F.struct("last_date", "last_id")).alias("_last"))
    return ends.select("customer_id", "n", "total", "_last.last_date", "_last.last_id", "month_key", "bucket")


def extend(spark: SparkSession, batch: DataFrame, root: str) -> int:
    """Add the rows of ``batch`` (customer_id, transaction_date,
    transaction_id, total_amount) that the table does not hold yet; returns
    their number. The batch may be new rows only or a whole snapshot."""
    checkpoint_dir(spark)
    root = root.rstrip("/")
    repair(spark, root)
    buckets = _buckets(spark, root)
    stored, known = read_rows(spark, root), read_or_empty(spark, f"{root}/carry", CARRY)

    ends = known.select(*GROUP, "n", F.struct(F.col("last_date").alias("transaction_date"), F.col("last_id").alias("transaction_id")).alias("_last"))
    placed = _join(place(batch, buckets), broadcast_if_small(ends), GROUP, "left") \
        .withColumn("after", F.col("n").isNull() | (_position() > F.col("_last"))).drop("n", "_last").checkpoint(eager=True)
    new, doubt = placed.where("after").drop("after"), placed.where(~F.col("after")).drop("after")
    late, months = None, _months(doubt)
    if months:  # a row at or before its month's end is late, or stored already
        late = _join(doubt, stored.where(F.col("month_key").isin(months)).select(*KEY), KEY, "left_anti").checkpoint(eager=True)
        new, months = new.unionByName(late), _months(late)
    inserted = new.count()
    if not inserted:
        return 0

    base, anew = known.select(*GROUP, F.col("total").alias("_base")), None
    if months:
        kept, again, base, there = _open_again(stored, late, base, months)
        summed = _sum(new.unionByName(again.select(*new.columns)), base)
        anew = kept.unionByName(_join(summed, there, FOLDER, "left_semi")).checkpoint(eager=True)
        summed = _join(summed, there, FOLDER, "left_anti")
    else:
        summed = _sum(new, base)
    touched = new.select(*FOLDER).distinct().checkpoint(eager=True)
    part = known.where(F.col("month_key").isin(_months(touched)))
    ended = merged(_join(part, broadcast_if_small(touched), FOLDER, "left_semi"), carries(new)).checkpoint(eager=True)

    files = Files(spark, root)
    files.write(f"{root}/{OPEN}", "{}")
    _write(summed, f"{root}/rows", "append")
    if anew is not None:
        _write(anew, f"{root}/rows", "overwrite")
    _write(ended, f"{root}/carry", "overwrite")
    files.delete(f"{root}/{OPEN}")
    return inserted


def _open_again(stored: DataFrame, late: DataFrame, base: DataFrame, months: list[int]) -> tuple[DataFrame, ...]:
    """For late rows: the stored rows of their buckets that keep their totals,
    those that are summed again, what the sums of each group start from, and
    the buckets (a checked broadcast)."""
    there = broadcast_if_small(late.select(*FOLDER).distinct().checkpoint(eager=True))
    first = broadcast_if_small(late.groupBy(*GROUP).agg(F.min(_position()).alias("_first")).checkpoint(eager=True))
    held = _join(stored.where(F.col("month_key").isin(months)), there, FOLDER, "left_semi")
    held = _join(held, first, GROUP, "left").withColumn(
        "_state", F.when(F.col("_first").isNull(), "other").when(_position() > F.col("_first"), "after").otherwise("before"))
    held = held.drop("_first").checkpoint(eager=True)
    before = held.where("_state = 'before'").groupBy(*GROUP).agg(F.sum("total_amount").cast(SUM).alias("_base"))
    base = _join(base, first.select(*GROUP), GROUP, "left_anti").unionByName(before).checkpoint(eager=True)
    return held.where("_state <> 'after'").select(*ROWS.fieldNames()), held.where("_state = 'after'"), base, there


def _sum(rows: DataFrame, base: DataFrame) -> DataFrame:
    """``rows`` with the totals inside their month, which start from ``base``."""
    summed = running_sum(rows, GROUP, ORDER, F.coalesce("total_amount", F.lit(0)).cast(SUM), "_sum")
    return _join(summed, broadcast_if_small(base), GROUP, "left").withColumn(
        "month_total", (F.coalesce("_base", F.lit(0)) + F.col("_sum")).cast(SUM)).select(*ROWS.fieldNames())


def _months(rows: DataFrame) -> list[int]:
    """The months of some rows (a list bounded by the calendar)."""
    return sorted(r[0] for r in rows.select("month_key").distinct().collect())


def _write(rows: DataFrame, path: str, mode: str) -> None:
    """Append to, or replace, the folders (month, bucket) that ``rows`` have."""
    rows.hint("rebalance", *FOLDER).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*FOLDER).parquet(path)


def _buckets(spark: SparkSession, root: str) -> int:
    """The number of buckets of the table: that of its first load, kept as a
    folder name so that it appears whole or not at all."""
    files = Files(spark, root)
    names = files.names(f"{root}/{BUCKETS}")
    if not names:
        key, default = CONF_BUCKETS
        names = [str(max(1, int(spark.conf.get(key, str(default)))))]
        files.fs.mkdirs(files.path(f"{root}/{BUCKETS}/{names[0]}"))
    return int(names[0])


def repair(spark: SparkSession, root: str) -> None:
    """After a load that did not end: the carries of the rows that are there."""
    files = Files(spark, root)
    if OPEN not in files.names(root):
        return
    ends = carries(read_rows(spark, root)).checkpoint(eager=True)
    ends.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*FOLDER).parquet(f"{root}/carry")
    files.delete(f"{root}/{OPEN}")


def read_rows(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root.rstrip('/')}/rows", ROWS)


def read(spark: SparkSession, root: str, months: Sequence[int] | None = None) -> DataFrame:
    """(customer_id, transaction_date, transaction_id, total_amount,
    running_total) of all rows, or of some ``months``: earlier ones then cost
    a read of their carries, not of their rows."""
    rows, known = read_rows(spark, root), read_or_empty(spark, f"{root.rstrip('/')}/carry", CARRY)
    if months is not None:
        rows, known = rows.where(F.col("month_key").isin(list(months))), known.where(F.col("month_key") <= max(months, default=0))
    # A customer has one carry a month, so the window is bounded by the calendar.
    earlier = Window.partitionBy("customer_id").orderBy("month_key").rowsBetween(Window.unboundedPreceding, -1)
    opening = known.select(*GROUP, F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("_opening"))
    return _join(rows, broadcast_if_small(opening), GROUP, "left").select(
        *KEY, "total_amount", (F.coalesce("_opening", F.lit(0)) + F.col("month_total")).cast(SUM).alias("running_total"))
