"""Source tables shaped from the generated test tables.

The test tables are clean TPC-H-like data; these views map them onto the
five order-taking tables and the sale-event topic, injecting the defects the
cleaning rules exist for (padding, case, blanks, negative and missing values,
future rows, duplicates, unknown references). The mapping is fixed so that
the same views can be written in DuckDB SQL (see ``martlet.plans.oracle``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators.ordering import global_row_number
from martlet.session import configure

# Fixed "now" of every test run: orders span 1995-01-01 .. 2001-08-01, so
# about a quarter of them lie in the future of this instant.
AS_OF = dt.datetime(2000, 1, 1, 0, 0, 0)

_CACHE: dict[tuple[str, str], "SourceSet"] = {}


class SourceSet:
    """The fixture views of one test-data folder, built lazily (only the
    line-item view runs a job when first used)."""

    TABLES = ("customers", "products", "transactions", "transaction_items",
              "marketing_campaigns", "sale_events", "produced_events")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._built = spark, sf_dir, {}

    def table(self, name: str) -> DataFrame:
        if name not in self.TABLES:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = globals()[name](self._spark, self._dir)
        return self._built[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self.table(name)
        except KeyError:
            raise AttributeError(name) from None


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days(base: dt.date, n) -> F.Column:
    return F.date_add(F.lit(base), n.cast("int")).cast("timestamp_ntz")


def _secs(ts: F.Column, n) -> F.Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    n = _read(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        key.cast("int").alias("customer_id"),
        F.concat(F.lit("  "), "c_name", F.lit("  ")).alias("name"),
        F.when(key % 97 == 3, F.lit("   "))
        .otherwise(F.concat(F.lit(" "), F.upper(F.replace("c_name", F.lit("#"), F.lit(""))),
                            F.lit("@MAIL.COM ")))
        .alias("email"),
        F.when(key % 101 == 5, F.lit(" "))
        .otherwise(F.lower(F.replace("n_name", F.lit("_"), F.lit("-"))))
        .alias("city"),
        _days(dt.date(1994, 1, 1), (key * 37) % 3000).alias("signup_date"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        key.cast("int").alias("product_id"),
        F.concat(F.lit(" "), "p_name").alias("product_name"),
        F.concat(F.lower("p_type"), F.lit(" ")).alias("category"),
        F.when(key % 89 == 7, F.lit(-1.0))
        .when(key % 83 == 9, F.lit(None).cast("double"))
        .otherwise(F.col("p_retailprice"))
        .cast("decimal(10,2)")
        .alias("price"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    when_ = _secs(F.col("o_orderdate"), (key * 7919) % 86400).alias("transaction_date")
    damaged = o.select(
        key.cast("int").alias("transaction_id"),
        F.when(key % 211 == 8, F.lit(None)).otherwise(F.col("o_custkey")).cast("int").alias("customer_id"),
        when_,
        F.when(key % 53 == 4, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
        .cast("decimal(12,2)").alias("total_amount"),
    )
    replayed = o.where(key % 41 == 6).select(
        key.cast("int").alias("transaction_id"),
        F.col("o_custkey").cast("int").alias("customer_id"),
        when_,
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
    )
    return damaged.unionByName(replayed)


# The total order that numbers the generated line items.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
              "l_shipdate"]


def transaction_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items: lineitem joined to part for the unit price. The source
    line id is the line's rank in ``LINE_ORDER`` (full rows are unique),
    computed with the distributed numbering of ``global_row_number``."""
    li = _read(spark, sf_dir, "lineitem").select(*LINE_ORDER)
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    joined = li.join(p, li.l_partkey == p.p_partkey).drop("p_partkey")
    numbered = global_row_number(joined, LINE_ORDER, "_line",
                                 keep=["l_orderkey", "l_partkey", "l_quantity", "p_retailprice"])
    return numbered.select(
        F.col("_line").cast("long").alias("transaction_item_id"),
        F.col("l_orderkey").cast("int").alias("transaction_id"),
        F.col("l_partkey").cast("int").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )


def marketing_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation")
    key, region = F.col("n_nationkey"), F.col("n_regionkey")
    start = F.date_add(F.lit(dt.date(1995, 1, 1)), (key * 30).cast("int"))
    span = F.when(key % 11 == 10, F.lit(-1)).otherwise(region + 7)
    return n.select(
        key.cast("int").alias("campaign_id"),
        F.concat(F.lit(" Campaign "), key.cast("string")).alias("campaign_name"),
        start.alias("start_date"),
        F.date_add(start, span.cast("int")).alias("end_date"),
        # Channel by region.
        F.when(region == 0, "Email ").when(region == 1, "Social Media")
        .when(region == 2, " Google Ads").otherwise("INFLUENCER").alias("channel"),
    )


def _events(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    e = src if src is not None else _read(spark, sf_dir, "events")
    key = F.col("event_id")
    price = F.col("value").cast("decimal(10,2)")
    qty = (key % 6).cast("int")
    return e.select(
        key.cast("int").alias("transaction_id"),
        (F.col("user_id") * 11).cast("int").alias("customer_id"),
        F.when(key % 97 == 11, F.lit(-1)).otherwise(key % 200).cast("int").alias("product_id"),
        qty.alias("quantity"),
        price.alias("price"),
        F.col("ts").alias("transaction_date"),
        (price * qty).cast("decimal(12,2)").alias("total_amount"),
    )


def produced_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir)


def sale_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _read(spark, sf_dir, "events")
    return _events(spark, sf_dir, raw.unionByName(raw.where(F.col("event_id") % 29 == 2)))


def sources(spark: SparkSession, sf_dir: str) -> SourceSet:
    """All fixture views for ``sf_dir``; built once per application."""
    configure(spark)
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect
        app = str(id(spark))
    key = (app, sf_dir.rstrip("/"))
    if key not in _CACHE:
        _CACHE[key] = SourceSet(spark, sf_dir)
    return _CACHE[key]
