"""Star queries over the fact and its dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.operators.facts import month_filter
from martlet.operators.joins import broadcast_if_small


def _measures() -> list:
    return [
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("gross_amount").cast("decimal(18,2)").alias("gross"),
        F.sum("profit_amount").cast("decimal(18,2)").alias("profit"),
    ]


def sales_by_quarter(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Lines, gross and profit per (year, quarter) through dim_date. The join
    carries ``month_key`` too, so a month-partitioned fact gets dynamic
    partition pruning from a filter on dim_date."""
    # One row per calendar day: bounded by the calendar, broadcast.
    d = F.broadcast(dim_date.select(F.col("date_key").alias("transaction_date_key"), "month_key",
                                    "year", "quarter"))
    f = fact if "month_key" in fact.columns else fact.withColumn(
        "month_key", (F.col("transaction_date_key") / 100).cast("int"))
    return f.join(d, ["transaction_date_key", "month_key"]).groupBy("year", "quarter").agg(*_measures())


def sales_by_city_category(fact: DataFrame, dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Slice by customer city and product category."""
    return (fact.join(broadcast_if_small(dim_customer.select("customer_key", "city")), "customer_key")
            .join(broadcast_if_small(dim_product.select("product_key", "category")), "product_key")
            .groupBy("city", "category").agg(*_measures()))


def fact_slice(fact: DataFrame, from_key: int, to_key: int) -> DataFrame:
    """Fact rows of an inclusive day-key range, with the implied month range
    added so a month-partitioned fact reads only the touched partitions."""
    f = fact if "month_key" in fact.columns else fact.withColumn(
        "month_key", (F.col("transaction_date_key") / 100).cast("int"))
    return f.where(month_filter(from_key, to_key))


def sales_date_range(fact: DataFrame, from_key: int, to_key: int) -> DataFrame:
    return fact_slice(fact, from_key, to_key).groupBy("month_key").agg(*_measures())
