"""Sales by day, month and quarter, alone and sliced by customer, product or
campaign, from stored partials that every load extends by its new lines.

A *partial* is the count and the exact sums of some lines. One pass of
grouping sets over the new lines gives the finest partials: by day, and by
(month, customer), (month, product), (month, campaign). Coarser levels are
merges of these (a quarter is the sum of its months), so they are computed on
read and never stored.

The partials lie under ``rollup/month_key=YYYYMM``, one set of files for each
load. A crash between the fact append and the rollup append, or inside one,
leaves months whose partials count other lines than the fact holds. A load
notes its months in ``_load_open.json`` until it is through; where the next
one finds that note, it compares the counts of both and rebuilds the months
that differ from the fact.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.functions.dates import month_key
from martlet.sources.files import Files
from martlet.sources.readers import path_exists, read_or_empty

MONEY = "decimal(28,2)"
OPEN = "_load_open.json"
#: Partials that one task of ``levels`` merges.
ROWS = 250_000
#: Slice name and the fact's key column; ``all`` has no member.
SLICES = {"customer": "customer_key", "product": "product_key", "campaign": "campaign_key"}
PARTIAL = T.StructType([
    T.StructField("slice", T.StringType()), T.StructField("member", T.LongType()), T.StructField("day_key", T.IntegerType()),
    T.StructField("month_key", T.IntegerType()), T.StructField("n_lines", T.LongType()), T.StructField("quantity", T.LongType()),
    T.StructField("gross", T.DecimalType(28, 2)), T.StructField("profit", T.DecimalType(28, 2))])


def _measures() -> list:
    return [F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("quantity").cast("long")).alias("quantity"),
            F.sum("gross_amount").cast(MONEY).alias("gross"), F.sum("profit_amount").cast(MONEY).alias("profit")]


def _merged() -> list:
    return [F.sum("n_lines").alias("n_lines"), F.sum("quantity").alias("quantity"),
            F.sum("gross").cast(MONEY).alias("gross"), F.sum("profit").cast(MONEY).alias("profit")]


def partials(lines: DataFrame) -> DataFrame:
    """The finest partials of some fact lines: one pass, one shuffle of rows
    that were already summed in their map task."""
    keyed = lines.withColumn("day_key", F.col("transaction_date_key")).withColumn("month_key", month_key("transaction_date_key"))
    columns = ["month_key", "day_key", *SLICES.values()]
    sets = [["month_key", "day_key"], *[["month_key", c] for c in SLICES.values()]]
    grouped = keyed.groupingSets(sets, *columns).agg(F.grouping_id().alias("gid"), *_measures())
    # Bits of grouping_id, last column first: a column that is not grouped by has bit 1.
    bit = {c: 1 << (len(columns) - 1 - i) for i, c in enumerate(columns)}
    used = lambda c: F.col("gid").bitwiseAND(F.lit(bit[c])) == 0
    name, member = F.lit("all"), F.lit(None).cast("long")
    for slice_, c in SLICES.items():
        name = F.when(used(c), F.lit(slice_)).otherwise(name)
        member = F.when(used(c), F.col(c).cast("long")).otherwise(member)
    return grouped.select(name.alias("slice"), member.alias("member"), "day_key", "month_key", "n_lines", "quantity", "gross", "profit")


def merge(*parts: DataFrame) -> DataFrame:
    """Partials of several loads as one (rows of one key summed)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("slice", "member", "day_key", "month_key").agg(*_merged()).select(*PARTIAL.fieldNames())


def quarter_key(mkey: str = "month_key") -> F.Column:
    """YYYYQ of a YYYYMM month."""
    m = F.col(mkey)
    return ((m / 100).cast("int") * 10 + F.ceil((m % 100) / 3).cast("int")).cast("int")


def levels(parts: DataFrame, rows: int | None = None) -> DataFrame:
    """(slice, member, level, period, measures): every level from partials of
    any number of loads; ``period`` is YYYYMMDD, YYYYMM or YYYYQ. Slices have
    the levels month and quarter, ``all`` has the day too.

    ``rows``: about how many partials there are, or an upper bound (default:
    counted). Members are dealt to as many tasks as ``ROWS`` partials each ask
    for, so what a task holds does not grow with the sales. A member has one
    row a month and load (``all``: a day and load), so none fills a task."""
    n = max(1, math.ceil((parts.count() if rows is None else rows) / ROWS))
    at = lambda name, key: F.struct(F.lit(name).alias("level"), key.cast("int").alias("period"))
    day, month, quarter = at("day", F.col("day_key")), at("month", F.col("month_key")), at("quarter", quarter_key())
    of = F.when(F.col("slice") == "all", F.array(day, month, quarter)).otherwise(F.array(month, quarter))
    dealt = parts.repartition(n, "slice", "member").select(
        "slice", "member", F.explode(of).alias("at"), "n_lines", "quantity", "gross", "profit")
    return dealt.select("slice", "member", "at.level", "at.period", "n_lines", "quantity", "gross", "profit").groupBy(
        "slice", "member", "level", "period").agg(*_merged())


def by_campaign(parts: DataFrame, dim_campaign: DataFrame) -> DataFrame:
    """Quarterly sales of each campaign, by its id and name. The partials of
    a campaign are one row a month, so the join moves a few rows only."""
    rows = parts.filter(F.col("slice") == "campaign").groupBy("member", quarter_key().alias("quarter_key")).agg(*_merged())
    named = dim_campaign.select(F.col("campaign_key").cast("long").alias("member"), "campaign_id", "campaign_name")
    return rows.join(named, "member").select("campaign_id", "campaign_name", "quarter_key",
                                             "n_lines", "quantity", "gross", "profit")


# --- stored partials -------------------------------------------------------------------


def read(spark: SparkSession, path: str, months: list[int] | None = None) -> DataFrame:
    rows = read_or_empty(spark, path, PARTIAL)
    return rows if months is None else rows.where(F.col("month_key").isin(months))


def append(new_lines: DataFrame, path: str) -> None:
    """Add the partials of a load's new lines."""
    partials(new_lines).hint("rebalance", "month_key").write.mode("append").partitionBy("month_key").parquet(path)


def stale_months(fact: DataFrame, spark: SparkSession, path: str, months: list[int]) -> list[int]:
    """Months (of ``months``, bounded by the calendar) whose partials do not
    count the lines that the fact holds."""
    held = fact.where(F.col("month_key").isin(months)).groupBy("month_key").agg(F.count(F.lit(1)).alias("held"))
    known = read(spark, path, months).where(F.col("slice") == "all").groupBy("month_key").agg(F.sum("n_lines").alias("known"))
    both = held.join(known, "month_key", "full").where(~F.col("held").eqNullSafe(F.col("known")))
    return sorted(r["month_key"] for r in both.select("month_key").collect())


def open_load(spark: SparkSession, root: str, months: list[int]) -> None:
    """Note the months a load is about to extend."""
    Files(spark, root).write(f"{root}/{OPEN}", json.dumps(months))


def close_load(spark: SparkSession, root: str) -> None:
    Files(spark, root).delete(f"{root}/{OPEN}")


def repair(spark: SparkSession, fact: DataFrame, root: str, path: str) -> None:
    """After a load that did not end (its note is still there), or for a fact
    that never had partials: rebuild the months that differ."""
    files = Files(spark, root)
    noted = OPEN in files.names(root)
    if not noted and path_exists(spark, path):
        return
    try:
        months = json.loads(files.read(f"{root}/{OPEN}")) if noted and path_exists(spark, path) else None
    except ValueError:  # the note itself was cut short
        months = None
    if months is None:  # bounded by the calendar
        months = sorted(r["month_key"] for r in fact.select("month_key").distinct().collect())
    stale = stale_months(fact, spark, path, months) if months else []
    if stale:
        rebuild(fact, path, stale)
    close_load(spark, root)


def rebuild(fact: DataFrame, path: str, months: list[int]) -> None:
    """Replace the partials of some months by those of the fact."""
    rows = partials(fact.where(F.col("month_key").isin(months)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month_key").parquet(path)


def compact(spark: SparkSession, path: str, months: list[int]) -> None:
    """Merge the partials of many loads to one set of files for each month."""
    rows = merge(read(spark, path, months)).checkpoint(eager=True)  # read before the folder is replaced
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month_key").parquet(path)
