"""Relational operators found in the seed script, as deterministic user
operators: lateral expansion, per-row top-n, UPDATE ... FROM an aggregate,
running totals and id-range tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.operators.ordering import running_sum

# Customer tiers by id (upper id bound, tier, visits).
TIERS = [(20, "frequent", 15), (30, "regular", 8), (None, "occasional", 4)]


def line_totals(items: DataFrame) -> DataFrame:
    """(transaction_id, total) = sum(quantity x price) per transaction, with
    map-side partial sums."""
    amount = F.col("quantity").cast("decimal(10,0)") * F.col("price")
    return items.groupBy("transaction_id").agg(F.sum(amount).cast("decimal(12,2)").alias("total"))


def update_header_totals(headers: DataFrame, items: DataFrame) -> DataFrame:
    """UPDATE headers SET total_amount = line total FROM the aggregate:
    headers without lines keep their total."""
    t = line_totals(items)
    return headers.join(t, "transaction_id", "left").select(
        *[c for c in headers.columns if c != "total_amount"],
        F.coalesce(F.col("total"), F.col("total_amount")).cast("decimal(12,2)").alias("total_amount"),
    ).select(*headers.columns)


def header_total_mismatches(headers: DataFrame, items: DataFrame) -> DataFrame:
    """Headers whose total differs from the sum of their lines."""
    t = line_totals(items)
    return headers.join(t, "transaction_id").where(F.col("total_amount") != F.col("total")).select(
        "transaction_id", F.col("total_amount").alias("header_total"), F.col("total").alias("lines_total"))


def running_spend(tx: DataFrame) -> DataFrame:
    """Running total of each customer's spend in (date, id) order, without
    putting a whole customer into one task."""
    out = running_sum(tx, ["customer_id"], ["transaction_date", "transaction_id"],
                      "total_amount", "running_total")
    return out.select("customer_id", "transaction_id",
                      F.col("running_total").cast("decimal(18,2)").alias("running_total"))


def active_days(campaigns: DataFrame) -> DataFrame:
    """Lateral expansion: one row per day a campaign runs, ends included."""
    days = F.explode(F.sequence("start_date", "end_date", F.expr("INTERVAL 1 DAY")))
    return campaigns.where(F.col("end_date") >= F.col("start_date")) \
        .select("campaign_id", days.alias("active_date"))


def tier_of(customer_id: Column) -> tuple[Column, Column]:
    tier, visits = None, None
    for bound, name, n in reversed(TIERS):
        if bound is None:
            tier, visits = F.lit(name), F.lit(n)
        else:
            cond = customer_id <= bound
            tier = F.when(cond, F.lit(name)).otherwise(tier)
            visits = F.when(cond, F.lit(n)).otherwise(visits)
    return tier, visits


def customer_tiers(customers: DataFrame) -> DataFrame:
    tier, visits = tier_of(F.col("customer_id"))
    return customers.select("customer_id", tier.alias("tier"), visits.cast("int").alias("visits"))


def top_lines(lines: DataFrame, n: Column, most: int | None = None) -> DataFrame:
    """Per transaction, its ``n`` (a per-row expression) most expensive
    lines, ties by line id.

    ``most`` is an upper bound of ``n`` (by default its maximum, one number).
    It is a literal limit on the rank, which Spark applies to each task's
    lines before the shuffle (WindowGroupLimit), so a transaction sends at
    most ``most`` lines a task however many it has; the row's own ``n`` then
    decides among those."""
    lines = lines.withColumn("_n", n)
    if most is None:
        most = lines.agg(F.max("_n")).first()[0] or 0
    order = Window.partitionBy("transaction_id").orderBy(F.col("price").desc(), "transaction_item_id")
    ranked = lines.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= int(most))
    return ranked.where(F.col("rank") <= F.col("_n")).select("transaction_id", "transaction_item_id", "price", "rank")
