"""The line-grain sales fact: joins, measures, basket metrics, incremental
load and month partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions import dates, money
from martlet.operators import skew
from martlet.operators.joins import broadcast_if_small
from martlet.schemas import FACT_COLUMNS, FACT_LINE_KEY, SALES_KEY

DEFAULT_CAMPAIGN_KEY = 1


def join_header_lines(tx: DataFrame, items: DataFrame) -> DataFrame:
    """Header x lines on transaction_id (inner: headers without lines and
    lines whose header was rejected both drop)."""
    return tx.select("transaction_id", "customer_id", "transaction_date").join(
        items.select("transaction_item_id", "transaction_id", "product_id", "quantity", "price"),
        "transaction_id",
    )


def lookup_key(lines: DataFrame, dim: DataFrame, business_key: str, key_col: str) -> DataFrame:
    """Add ``key_col`` by an inner lookup on the business id, so a line whose
    member was rejected drops. Callers pass the dimension through
    ``broadcast_if_small`` when it may be broadcast."""
    return lines.join(dim.select(business_key, key_col), business_key)


def with_date_key(lines: DataFrame, ts: str = "transaction_date") -> DataFrame:
    """The day key derived from the timestamp. Equivalent to joining the
    day-level dim_date built from the same transactions (every day is in
    it), without the join."""
    return lines.withColumn("date_key", dates.date_key(F.col(ts)))


def lookup_date(lines: DataFrame, dim_date: DataFrame, ts: str = "transaction_date") -> DataFrame:
    """Inner join on differently named keys: line day -> dim_date.date_key."""
    keyed = lines.withColumn("_day_key", dates.date_key(F.col(ts)))
    # One row per calendar day: bounded by the calendar, broadcast.
    d = F.broadcast(dim_date.select(F.col("date_key"), F.col("month_key")))
    return keyed.join(d, keyed["_day_key"] == d["date_key"]).drop("_day_key")


def add_measures(lines: DataFrame, price: str = "price") -> DataFrame:
    """unit_price and the six derived amounts, exact decimals."""
    out = lines.withColumn("unit_price", F.col(price).cast(money.UNIT_MONEY))
    return out.withColumns(money.line_measures("quantity", "unit_price"))


def _basket_sums(lines: DataFrame) -> dict:
    return {"_q": F.sum("quantity"), "_c": F.sum(money.cents("unit_price")), "_n": F.count(F.lit(1))}


def add_basket_metrics(lines: DataFrame, hot: skew.HotKeys | None = None) -> DataFrame:
    """item_count = total quantity of the transaction, avg_item_price =
    unweighted mean line price, on every line.

    One window pass over (transaction_id, bucket). Lines that come out of
    a salted join are already partitioned and sorted that way, so the
    window needs no shuffle and no sort; a cold transaction has a single
    bucket, so its window is the whole basket. Hot transactions (a bounded
    list) get their totals from a grouped aggregate over just their lines
    (a literal ``isin`` filter that reaches the scans) broadcast back."""
    part = ["transaction_id"] + ([skew.SALT] if skew.SALT in lines.columns else [])
    w = Window.partitionBy(*part)
    out = lines.withColumns({k: agg.over(w) for k, agg in _basket_sums(lines).items()})
    if hot is not None and hot.values:
        sums = _basket_sums(lines)
        totals = (lines.where(F.col("transaction_id").isin(hot.values)).groupBy("transaction_id")
                  .agg(*[agg.alias(f"{k}_hot") for k, agg in sums.items()]))
        out = out.join(F.broadcast(totals), "transaction_id", "left")
        for k in sums:
            out = out.withColumn(k, F.coalesce(F.col(f"{k}_hot"), F.col(k))).drop(f"{k}_hot")
    return (out.withColumn("item_count", F.col("_q").cast("int"))
            .withColumn("avg_item_price", money.mean_from_cents("_c", "_n"))
            .drop("_q", "_c", "_n"))


def build_fact(tx_clean: DataFrame, items: DataFrame, dim_customer: DataFrame,
               dim_product: DataFrame, campaign_key: int = DEFAULT_CAMPAIGN_KEY) -> DataFrame:
    """The 16 columns of fact_sales for every line of a clean transaction
    whose customer and product are in their dimensions. Basket metrics are
    taken after the dimension lookups (lines dropped there do not count).

    Plan: header x lines is a sort-merge join on (transaction_id, bucket)
    where only hot transactions have more than one bucket; the dimensions
    are broadcast when their checked size allows, so the lines keep that
    partitioning through the lookups, the basket aggregate and its
    join-back (no second shuffle of the lines)."""
    hot = skew.heavy_hitters(items, "transaction_id")
    head = tx_clean.select("transaction_id", "customer_id", "transaction_date")
    body = items.select("transaction_item_id", "transaction_id", "product_id", "quantity", "price")
    lines = skew.salted_join(body, head, "transaction_id", hot, row_id="transaction_item_id")
    lines = lookup_key(lines, broadcast_if_small(dim_customer.select("customer_id", "customer_key")),
                       "customer_id", "customer_key")
    lines = lookup_key(lines, broadcast_if_small(dim_product.select("product_id", "product_key")),
                       "product_id", "product_key")
    lines = with_date_key(lines).withColumn("campaign_key", F.lit(campaign_key).cast("int"))
    lines = add_measures(lines)
    lines = add_basket_metrics(lines, hot)
    return lines.withColumnRenamed("date_key", "transaction_date_key").select(*FACT_COLUMNS)


def with_partition_columns(fact: DataFrame) -> DataFrame:
    """``month_key`` (partition column) and a stable ``sales_key``.

    The key is the day key followed by the 19 digits of the line id: unique
    because the line id is unique in its source and the day key is part of
    the line's identity, and stable across reruns, with no global
    coordination."""
    day = F.col("transaction_date_key").cast("decimal(8,0)") * F.lit(str(10 ** 19)).cast("decimal(20,0)")
    key = day + F.col("transaction_item_id").cast("decimal(19,0)")
    return fact.withColumn("sales_key", key.cast(SALES_KEY)).withColumn("month_key", dates.month_key("transaction_date_key"))


def new_lines(fact: DataFrame, existing: DataFrame, keys: Sequence[str] = FACT_LINE_KEY) -> DataFrame:
    """Fact rows whose (transaction, line, day) is not loaded yet."""
    keys = list(keys)
    return fact.join(existing.select(*keys), keys, "left_anti")


def partition_bounds(fact: DataFrame, key: str = "transaction_date_key") -> DataFrame:
    """The month partitions a set of fact rows needs: name, inclusive start
    key and exclusive end key (December rolls the year). Null keys skipped."""
    months = fact.select(dates.month_key(key).alias("month_key")).where(F.col("month_key").isNotNull()).distinct()
    return months.select(
        dates.partition_name("month_key").alias("partition_name"),
        dates.month_start_key("month_key").alias("start_key"),
        dates.month_end_key("month_key").alias("end_key"),
    )


def month_filter(from_key: int, to_key: int, key: str = "transaction_date_key") -> "F.Column":
    """Day-key range predicate plus the implied ``month_key`` range, so a
    month-partitioned fact is pruned to the touched partitions."""
    lo_m, hi_m = from_key // 100, to_key // 100
    return (F.col("month_key").between(lo_m, hi_m)) & F.col(key).between(from_key, to_key)
