"""Cleaning of the staged source tables (type coercion, text normalisation,
required / range / not-in-future filters, de-duplication) and the reasons
each rejected row was dropped for.

Every rule is a Column predicate, so the clean filter and the reject
reasons are the same expressions. A NULL never passes a comparison.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.text import blank_to_null, py_strip, strip_lower, strip_title
from martlet.operators.ordering import first_per_key

# Fixed values of the default campaign, emitted only when no campaign survives.
DEFAULT_CAMPAIGN = {
    "campaign_id": 0,
    "campaign_name": "default",
    "start_date": dt.date(1900, 1, 1),
    "end_date": dt.date(2099, 12, 31),
    "channel": "unknown",
}


def coerce_numeric(col: Column | str, dtype: str = "decimal(12,2)") -> Column:
    """Numeric coercion, anything unparsable becomes NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(dtype)


def coerce_timestamp(col: Column | str) -> Column:
    """Timestamp coercion, anything unparsable becomes NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("timestamp_ntz")


def coerce_date(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("date")


def _ok(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False))


def _first_failing(rules: Sequence[tuple[str, Column]]) -> Column:
    reason = F.lit(None).cast("string")
    for name, pred in reversed(rules):
        reason = F.when(~_ok(pred), F.lit(name)).otherwise(reason)
    return reason


def _all(rules: Sequence[tuple[str, Column]]) -> Column:
    cond = F.lit(True)
    for _, pred in rules:
        cond = cond & _ok(pred)
    return cond


# --- transactions -----------------------------------------------------------------

def stage_transactions(df: DataFrame) -> DataFrame:
    return df.select(
        "transaction_id", "customer_id",
        coerce_timestamp("transaction_date").alias("transaction_date"),
        coerce_numeric("total_amount", "decimal(12,2)").alias("total_amount"),
    )


def transaction_rules(as_of: dt.datetime) -> list[tuple[str, Column]]:
    return [
        ("missing_id", F.col("transaction_id").isNotNull()),
        ("missing_customer", F.col("customer_id").isNotNull()),
        ("bad_amount", F.col("total_amount") >= 0),
        ("future_date", F.col("transaction_date") <= F.lit(as_of)),
    ]


def clean_transactions(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Coerce, filter, keep one row per transaction id (the first in the
    order customer, date, amount)."""
    passed = stage_transactions(df).where(_all(transaction_rules(as_of)))
    return first_per_key(passed, ["transaction_id"])


# --- customers --------------------------------------------------------------------

def stage_customers(df: DataFrame) -> DataFrame:
    return df.select(
        "customer_id",
        py_strip("name").alias("name"),
        blank_to_null(strip_lower("email")).alias("email"),
        blank_to_null(strip_title("city")).alias("city"),
        coerce_timestamp("signup_date").alias("signup_date"),
    )


def customer_rules(as_of: dt.datetime) -> list[tuple[str, Column]]:
    return [
        ("missing_id", F.col("customer_id").isNotNull()),
        ("missing_email", F.col("email").isNotNull()),
        ("future_signup", F.col("signup_date") <= F.lit(as_of)),
        # A blank city cannot enter dim_customer (NOT NULL); it is
        # quarantined here instead of failing the whole load.
        ("blank_city", F.col("city").isNotNull()),
    ]


def customer_candidates(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Distinct cleaned customer rows: what a load offers the dimension
    (and counts as candidates); the same id may still occur twice."""
    return stage_customers(df).where(_all(customer_rules(as_of))).dropDuplicates()


def clean_customers(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Cleaned customer rows, one per customer id (the first in full-row
    order; removing exact duplicates first would not change it)."""
    return first_per_key(stage_customers(df).where(_all(customer_rules(as_of))), ["customer_id"])


# --- products ---------------------------------------------------------------------

def stage_products(df: DataFrame) -> DataFrame:
    return df.select(
        "product_id",
        py_strip("product_name").alias("product_name"),
        strip_title("category").alias("category"),
        coerce_numeric("price", "decimal(10,2)").alias("price"),
    )


def product_rules() -> list[tuple[str, Column]]:
    return [
        ("missing_id", F.col("product_id").isNotNull()),
        ("bad_price", F.col("price") >= 0),
    ]


def product_candidates(df: DataFrame) -> DataFrame:
    return stage_products(df).where(_all(product_rules())).dropDuplicates()


def clean_products(df: DataFrame) -> DataFrame:
    return first_per_key(stage_products(df).where(_all(product_rules())), ["product_id"])


# --- campaigns ----------------------------------------------------------------------

def stage_campaigns(df: DataFrame) -> DataFrame:
    return df.select(
        "campaign_id",
        py_strip("campaign_name").alias("campaign_name"),
        coerce_date("start_date").alias("start_date"),
        coerce_date("end_date").alias("end_date"),
        strip_lower("channel").alias("channel"),
    )


def campaign_rules() -> list[tuple[str, Column]]:
    return [
        ("missing_id", F.col("campaign_id").isNotNull()),
        ("bad_date_range", F.col("end_date") >= F.col("start_date")),
    ]


def campaign_candidates(df: DataFrame) -> DataFrame:
    return stage_campaigns(df).where(_all(campaign_rules())).dropDuplicates()


def clean_campaigns(df: DataFrame) -> DataFrame:
    return first_per_key(stage_campaigns(df).where(_all(campaign_rules())), ["campaign_id"])


def with_default_campaign(campaigns: DataFrame) -> DataFrame:
    """Add the default campaign row only when ``campaigns`` is empty.

    Lazy: emptiness is a scalar subquery over at most one row of the
    input, so no action runs on the driver and nothing grows with the data.
    """
    spark = campaigns.sparkSession
    d = DEFAULT_CAMPAIGN
    default = spark.range(1).select(
        F.lit(d["campaign_id"]).cast("int").alias("campaign_id"),
        F.lit(d["campaign_name"]).alias("campaign_name"),
        F.lit(d["start_date"]).alias("start_date"),
        F.lit(d["end_date"]).alias("end_date"),
        F.lit(d["channel"]).alias("channel"),
    )
    empty = campaigns.limit(1).select(F.count(F.lit(1))).scalar() == 0
    return campaigns.unionByName(default.where(empty))


# --- rejects ------------------------------------------------------------------------

def _rejects(staged: DataFrame, rules, key: str, table: str) -> DataFrame:
    """Counts per reason: the first failing rule of every dropped row, and
    the rows the de-duplication folds away (``duplicate``)."""
    tagged = staged.withColumn("reason", _first_failing(rules))
    failed = (tagged.where(F.col("reason").isNotNull())
              .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))
    passed = tagged.where(F.col("reason").isNull()).drop("reason")
    dups = (passed.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
            .agg(F.sum(F.col("_c") - 1).alias("n"))
            .select(F.lit("duplicate").alias("reason"), F.col("n").cast("long").alias("n"))
            .where(F.col("n") > 0))
    return (failed.unionByName(dups)
            .select(F.lit(table).alias("table_name"), "reason", F.col("n").cast("long").alias("n")))


def rejects_by_reason(customers: DataFrame, products: DataFrame, transactions: DataFrame,
                      campaigns: DataFrame, as_of: dt.datetime) -> DataFrame:
    """(table_name, reason, n) for every row the cleaning drops."""
    return (
        _rejects(stage_transactions(transactions), transaction_rules(as_of), "transaction_id", "transactions")
        .unionByName(_rejects(stage_customers(customers), customer_rules(as_of), "customer_id", "customers"))
        .unionByName(_rejects(stage_products(products), product_rules(), "product_id", "products"))
        .unionByName(_rejects(stage_campaigns(campaigns), campaign_rules(), "campaign_id", "marketing_campaigns"))
    )


def quarantine(staged: DataFrame, rules) -> DataFrame:
    """Row-level rejects: every dropped row with its first failing reason."""
    tagged = staged.withColumn("reason", _first_failing(rules))
    return tagged.where(F.col("reason").isNotNull())
