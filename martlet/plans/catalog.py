"""Registered queries: one DataFrame builder per operator of the mart, each
taking ``(spark, sf_dir)`` and reading the test tables of ``sf_dir``."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from decimal import Decimal
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions import text as txt
from martlet.functions.text import py_strip, strip_lower, strip_title
from martlet.operators import clean, dims, events, facts, gate, incremental, quality, relops
from martlet.operators.joins import broadcast_if_small
from martlet.operators.ordering import first_per_key
from martlet.plans import rollup, running, star
from martlet.schemas import FACT_LINE_KEY, SOURCE_KEYS
from martlet.session import checkpoint_dir
from martlet.sources import splits
from martlet.sources.fixtures import AS_OF, SourceSet, sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


class Ctx:
    """The inputs of one query: the fixture views plus the shared derived
    frames (clean transactions, dimensions, fact), each built at most once
    per query, so a query that joins the fact back to its dimensions uses
    the same keyed dimension on both sides."""

    def __init__(self, src: SourceSet):
        self.src = src

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return getattr(self.src, name)

    @cached_property
    def tx_clean(self) -> DataFrame:
        return clean.clean_transactions(self.src.transactions, AS_OF)

    @cached_property
    def customer_rows(self) -> DataFrame:
        return clean.clean_customers(self.src.customers, AS_OF)

    @cached_property
    def customer_dim(self) -> DataFrame:
        return dims.assign_keys(self.customer_rows, "customer_id", "customer_key")

    @cached_property
    def product_dim(self) -> DataFrame:
        return dims.assign_keys(clean.clean_products(self.src.products), "product_id", "product_key")

    @cached_property
    def campaign_dim(self) -> DataFrame:
        rows = clean.with_default_campaign(clean.clean_campaigns(self.src.marketing_campaigns))
        return dims.assign_keys(rows, "campaign_id", "campaign_key")

    @cached_property
    def date_dim(self) -> DataFrame:
        return dims.dim_date(self.tx_clean)

    @cached_property
    def header_lines(self) -> DataFrame:
        return facts.join_header_lines(self.tx_clean, self.src.transaction_items)

    @cached_property
    def fact(self) -> DataFrame:
        return facts.build_fact(self.tx_clean, self.src.transaction_items, self.customer_dim, self.product_dim)

    @cached_property
    def fact_table(self) -> DataFrame:
        """The fact written once to the checkpoint folder, for queries that
        read it more than once (a stored table rather than a recomputed
        plan, as the loaded fact is in a warehouse)."""
        checkpoint_dir(self.src.customers.sparkSession)
        return self.fact.checkpoint(eager=True)


def query(fn: Callable[[Ctx], DataFrame]) -> Callable[[Ctx], DataFrame]:
    """Register ``fn(ctx)`` under its name as a ``(spark, sf_dir)`` query."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Ctx(sources(spark, sf_dir)))
    return fn


# --- cleaning ----------------------------------------------------------------------

@query
def clean_transactions(src: Ctx) -> DataFrame:
    return src.tx_clean


@query
def dim_customer(src: Ctx) -> DataFrame:
    return src.customer_dim


@query
def dim_product(src: Ctx) -> DataFrame:
    return src.product_dim


@query
def dim_campaign(src: Ctx) -> DataFrame:
    return src.campaign_dim


@query
def dim_date(src: Ctx) -> DataFrame:
    return src.date_dim


# --- fact -----------------------------------------------------------------------------

@query
def join_header_lines(src: Ctx) -> DataFrame:
    return src.header_lines.select("transaction_item_id", "transaction_id", "customer_id",
                                    "product_id", "transaction_date")


@query
def fact_measures(src: Ctx) -> DataFrame:
    m = facts.add_measures(src.header_lines)
    return m.select("transaction_item_id", "unit_price", "gross_amount", "net_amount",
                    "tax_amount", "total_amount", "cost_amount", "profit_amount")


@query
def fact_sales(src: Ctx) -> DataFrame:
    return src.fact


@query
def lookup_customer(src: Ctx) -> DataFrame:
    return facts.lookup_key(src.header_lines, broadcast_if_small(src.customer_dim), "customer_id", "customer_key") \
        .select("transaction_item_id", "customer_key")


@query
def lookup_product(src: Ctx) -> DataFrame:
    return facts.lookup_key(src.header_lines, broadcast_if_small(src.product_dim), "product_id", "product_key") \
        .select("transaction_item_id", "product_key")


@query
def lookup_date(src: Ctx) -> DataFrame:
    return facts.lookup_date(src.header_lines, src.date_dim) \
        .select("transaction_item_id", "date_key")


@query
def basket_metrics(src: Ctx) -> DataFrame:
    return src.fact.select("transaction_item_id", "item_count", "avg_item_price")


LOADED_BEFORE = 19980101  # date keys below this count as already loaded


def loaded_fact(src: Ctx) -> DataFrame:
    return src.fact_table.where(F.col("transaction_date_key") < LOADED_BEFORE)



def _new_rows(src: Ctx) -> DataFrame:
    """The fact rows a load over ``loaded_fact`` inserts, found through the
    line filter of the loaded keys before any of them is built."""
    loaded = facts.with_partition_columns(loaded_fact(src))
    held = loaded.select(*FACT_LINE_KEY, "month_key")
    blocks = incremental.blocks_for(held)
    keys = incremental.line_keys(src.tx_clean, src.transaction_items)
    new, n = incremental.new_keys(keys, incremental.line_filter(held, blocks), blocks, loaded)
    if n:
        new = incremental.insertable(new, src.customer_dim, src.product_dim)
    return incremental.build_new(src.tx_clean, src.transaction_items, src.customer_dim, src.product_dim, new, n)


@query
def fact_incremental(src: Ctx) -> DataFrame:
    return _new_rows(src)


@query
def fact_after_append(src: Ctx) -> DataFrame:
    appended = loaded_fact(src).unionByName(facts.new_lines(src.fact_table, loaded_fact(src)))
    return facts.with_partition_columns(appended).groupBy("month_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("gross_amount").cast("decimal(18,2)").alias("gross"))


@query
def fact_partition_bounds(src: Ctx) -> DataFrame:
    return facts.partition_bounds(src.fact)


# --- scans, coercions, text -----------------------------------------------------------

@query
def scan_splits(src: Ctx) -> DataFrame:
    """Each source table through the splits planned for its key (about 16 by
    their rows): the rows that the splits read, and whether one of them holds
    over twice the mean."""
    spark, out = src.customers.sparkSession, []
    for table in ("customers", "products", "transactions", "transaction_items"):
        rows, view, key = src.table(table), f"martlet_{table}_{uuid.uuid4().hex}", SOURCE_KEYS[table]
        rows.select(key).createOrReplaceTempView(view)
        conditions = splits.plan(spark.sql, view, key, max(1, rows.count() // 16))
        read = F.explode(F.array_compact(F.array(*[F.when(F.expr(c), F.lit(i)) for i, c in enumerate(conditions)])))
        depth = rows.select(read.alias("split"), key).groupBy("split").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col(key).cast("decimal(20,0)")).alias("keys"))
        mean = F.sum("n") / len(conditions)
        out.append(depth.agg(F.sum("n").alias("n_rows"), F.sum("keys").cast("decimal(38,0)").alias("key_sum"),
                             F.coalesce(F.max("n") > 2 * mean, F.lit(False)).alias("uneven"))
                   .select(F.lit(table).alias("table_name"), "n_rows", "key_sum", "uneven"))
        spark.catalog.dropTempView(view)
    return reduce(DataFrame.unionByName, out)


@query
def scan_snapshot_counts(src: Ctx) -> DataFrame:
    frames = [src.table(t).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(t).alias("table_name"), "n_rows") for t in SOURCE_TABLES]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


SOURCE_TABLES = ["customers", "products", "transactions", "transaction_items", "marketing_campaigns"]


@query
def coerce_numeric(src: Ctx) -> DataFrame:
    t = src.transactions
    text = F.when(F.col("transaction_id") % 17 == 0, F.lit("bad")).otherwise(F.col("total_amount").cast("string"))
    return t.select("transaction_id", clean.coerce_numeric(text, "decimal(12,2)").alias("value"))


@query
def coerce_timestamp(src: Ctx) -> DataFrame:
    t = src.transactions
    text = F.when(F.col("transaction_id") % 17 == 0, F.lit("bad")).otherwise(F.col("transaction_date").cast("string"))
    return t.select("transaction_id", clean.coerce_timestamp(text).alias("value"))


@query
def clean_strip(src: Ctx) -> DataFrame:
    return src.customers.select("customer_id", py_strip("name").alias("name"))


@query
def clean_lower(src: Ctx) -> DataFrame:
    return src.customers.select("customer_id", strip_lower("email").alias("email"))


@query
def clean_title(src: Ctx) -> DataFrame:
    return src.customers.select("customer_id", strip_title("city").alias("city"))


@query
def clean_title_category(src: Ctx) -> DataFrame:
    return src.products.select("product_id", strip_title("category").alias("category"))


@query
def blank_to_null(src: Ctx) -> DataFrame:
    return src.customers.select(
        "customer_id",
        txt.blank_to_null(strip_lower("email")).alias("email"),
        txt.blank_to_null(strip_title("city")).alias("city"))


@query
def dim_campaign_default(src: Ctx) -> DataFrame:
    none_left = clean.clean_campaigns(src.marketing_campaigns).where(
        F.col("start_date") > F.lit(AS_OF.date()))
    return clean.with_default_campaign(none_left)


# --- de-duplication ---------------------------------------------------------------------

@query
def dedupe_by_key(src: Ctx) -> DataFrame:
    return first_per_key(src.transactions, ["transaction_id"])


@query
def dedupe_full_row(src: Ctx) -> DataFrame:
    return src.transactions.dropDuplicates()


@query
def distinct_timestamps(src: Ctx) -> DataFrame:
    return dims.distinct_timestamps(src.tx_clean)


EARLIER_RUN = dt.datetime(1996, 1, 1)  # members signed up before it were loaded by an earlier run


def _loaded_customers(src: Ctx) -> DataFrame:
    rows = src.customer_rows.where(F.col("signup_date") < F.lit(EARLIER_RUN))
    return dims.assign_keys(rows, "customer_id", "customer_key")


@query
def dim_upsert_new_rows(src: Ctx) -> DataFrame:
    return dims.insert_if_absent(src.customer_rows, _loaded_customers(src), ["customer_id"])


@query
def surrogate_keys(src: Ctx) -> DataFrame:
    loaded = _loaded_customers(src)
    new = dims.upsert_dimension(src.customer_rows, loaded, "customer_id", "customer_key")
    return loaded.select("customer_id", "customer_key").unionByName(new.select("customer_id", "customer_key"))


# --- events and streaming semantics (batch form) -----------------------------------------

@query
def stream_reference_data(src: Ctx) -> DataFrame:
    return events.reference_ranges(src.customers, src.products)


@query
def events_to_json(src: Ctx) -> DataFrame:
    return events.to_payload(src.sale_events)


@query
def events_from_json(src: Ctx) -> DataFrame:
    return events.from_payload(events.to_payload(src.sale_events)).drop(events.CORRUPT)


@query
def event_amounts(src: Ctx) -> DataFrame:
    return src.sale_events.select("transaction_id", events.event_amount().alias("total_amount"))


def _validated(src: Ctx) -> DataFrame:
    return events.validate(src.sale_events, src.customers, src.products)


@query
def stream_accepted(src: Ctx) -> DataFrame:
    return events.accepted(_validated(src))


@query
def stream_rejects(src: Ctx) -> DataFrame:
    return events.rejected(_validated(src)).select("transaction_id", "reason")


@query
def stream_headers(src: Ctx) -> DataFrame:
    return events.headers(events.accepted(_validated(src)))


@query
def stream_lines(src: Ctx) -> DataFrame:
    # The line id is a hash that SQL need not repeat: the event stands for it.
    found = events.lines(events.accepted(_validated(src)), keep=("customer_id", "transaction_date", "total_amount"))
    return found.dropDuplicates(["transaction_item_id"]).drop("transaction_item_id")


@query
def minute_counts(src: Ctx) -> DataFrame:
    return events.minute_counts(src.produced_events)


@query
def minute_counts_completed(src: Ctx) -> DataFrame:
    return events.completed_minutes(events.minute_counts(src.produced_events))


@query
def minute_count_lines(src: Ctx) -> DataFrame:
    return events.minute_lines(events.completed_minutes(events.minute_counts(src.produced_events)))


@query
def id_high_water(src: Ctx) -> DataFrame:
    return events.id_high_water(src.transactions, src.transaction_items)


@query
def load_summary(src: Ctx) -> DataFrame:
    """Rows offered to each target (what the load log sums) and rows a
    first load inserts (one per business key)."""
    def counts(name: str, df: DataFrame, key: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("candidates"),
                      F.count_distinct(key).alias("inserted")).select(
            F.lit(name).alias("table_name"), "candidates", "inserted")
    cust = clean.customer_candidates(src.customers, AS_OF)
    prod = clean.product_candidates(src.products)
    camp = clean.campaign_candidates(src.marketing_campaigns)
    dates_ = dims.distinct_timestamps(src.tx_clean).select(
        "transaction_date", F.to_date("transaction_date").alias("_day"))
    f = src.fact
    return (counts("dim_customer", cust, "customer_id")
            .unionByName(counts("dim_product", prod, "product_id"))
            .unionByName(counts("dim_campaign", camp, "campaign_id"))
            .unionByName(counts("dim_date", dates_, "_day"))
            .unionByName(counts("fact_sales", f, "transaction_item_id")))


# --- re-aimed seed operators ----------------------------------------------------------------

@query
def header_total(src: Ctx) -> DataFrame:
    return relops.line_totals(src.transaction_items)


def _headers(src: Ctx) -> DataFrame:
    return first_per_key(src.transactions, ["transaction_id"])


@query
def header_total_update(src: Ctx) -> DataFrame:
    return relops.update_header_totals(_headers(src), src.transaction_items)


@query
def audit_header_total(src: Ctx) -> DataFrame:
    return relops.header_total_mismatches(_headers(src), src.transaction_items)


@query
def running_customer_spend(src: Ctx) -> DataFrame:
    return relops.running_spend(src.tx_clean)


@query
def running_spend_loads(src: Ctx) -> DataFrame:
    """The stored running totals after three loads: the sales before a day,
    all sales but every fifth, then a whole snapshot with the late fifth."""
    spark, tx = src.customers.sparkSession, src.tx_clean
    root = f"{checkpoint_dir(spark)}/martlet-running-{uuid.uuid4().hex}"
    early = F.pmod(F.xxhash64("transaction_id"), F.lit(5)) > 0
    before = F.col("transaction_date") < F.to_date(F.lit(str(LOADED_BEFORE)), "yyyyMMdd")
    for batch in (tx.where(early & before), tx.where(early), tx):
        running.extend(spark, batch, root)
    return running.read(spark, root).select("customer_id", "transaction_id", F.col("running_total").cast("decimal(18,2)").alias("running_total"))


@query
def campaign_calendar(src: Ctx) -> DataFrame:
    return relops.active_days(clean.clean_campaigns(src.marketing_campaigns))


@query
def customer_tiers(src: Ctx) -> DataFrame:
    return relops.customer_tiers(src.customers)


@query
def topn_per_group(src: Ctx) -> DataFrame:
    lines = src.header_lines
    n = F.when(F.col("customer_id") <= 20, F.lit(3)).otherwise(F.lit(2))
    return relops.top_lines(lines, n, most=3)


# --- audits ---------------------------------------------------------------------------------

def _source_tables(src: Ctx) -> dict[str, DataFrame]:
    return {t: src.table(t) for t in SOURCE_TABLES}


@query
def audit_nulls(src: Ctx) -> DataFrame:
    return quality.null_violations(_source_tables(src))


@query
def audit_unique_ids(src: Ctx) -> DataFrame:
    """The integer keys among the unique ones, by bitmaps of their blocks."""
    return reduce(DataFrame.unionByName, [
        quality.duplicate_ids(src.table(t), SOURCE_KEYS[t], f"{t}.{SOURCE_KEYS[t]} unique") for t in SOURCE_TABLES])


@query
def audit_unique(src: Ctx) -> DataFrame:
    return quality.unique_violations([
        ("customers.customer_id unique", src.customers, ["customer_id"]),
        ("customers.email unique", src.customers, ["email"]),
        ("products.product_id unique", src.products, ["product_id"]),
        ("transactions.transaction_id unique", src.transactions, ["transaction_id"]),
        ("transaction_items.transaction_item_id unique", src.transaction_items, ["transaction_item_id"]),
        ("marketing_campaigns.campaign_id unique", src.marketing_campaigns, ["campaign_id"]),
        ("dim_customer.customer_id unique", src.customer_dim, ["customer_id"]),
        ("dim_product.product_id unique", src.product_dim, ["product_id"]),
        ("dim_campaign.campaign_id unique", src.campaign_dim, ["campaign_id"]),
        ("dim_date.date_key unique", src.date_dim, ["date_key"]),
    ])


@query
def audit_fact_unique(src: Ctx) -> DataFrame:
    return quality.unique_violations([("fact_sales line unique", src.fact,
                                       ["transaction_id", "transaction_item_id", "transaction_date_key"])])


@query
def audit_checks(src: Ctx) -> DataFrame:
    return quality.check_violations([
        ("products.price >= 0", src.products, F.col("price") >= 0),
        ("transactions.total_amount >= 0", src.transactions, F.col("total_amount") >= 0),
        ("transaction_items.quantity > 0", src.transaction_items, F.col("quantity") > 0),
        ("transaction_items.price >= 0", src.transaction_items, F.col("price") >= 0),
        ("marketing_campaigns.end_date >= start_date", src.marketing_campaigns,
         F.col("end_date") >= F.col("start_date")),
    ])


@query
def audit_gross(src: Ctx) -> DataFrame:
    f = src.fact
    return quality.check_violations([
        ("fact_sales.gross_amount = quantity * unit_price", f,
         F.col("gross_amount") == F.col("quantity").cast("decimal(10,0)") * F.col("unit_price")),
    ])


@query
def audit_lengths(src: Ctx) -> DataFrame:
    return quality.length_violations(_source_tables(src))


@query
def audit_fact_fk(src: Ctx) -> DataFrame:
    return quality.fk_violations_one_pass(src.fact, [
        ("fact_sales.transaction_date_key -> dim_date", "transaction_date_key", src.date_dim, "date_key"),
        ("fact_sales.customer_key -> dim_customer", "customer_key", src.customer_dim, "customer_key"),
        ("fact_sales.product_key -> dim_product", "product_key", src.product_dim, "product_key"),
        ("fact_sales.campaign_key -> dim_campaign", "campaign_key", src.campaign_dim, "campaign_key"),
    ])


@query
def audit_write_rules(src: Ctx) -> DataFrame:
    """Every rule the load can refuse a source snapshot for, one scan a table."""
    return gate.report(_source_tables(src), gate.source_rules())


@query
def audit_precision(src: Ctx) -> DataFrame:
    items = src.transaction_items
    line = F.col("quantity").cast("decimal(10,0)") * F.col("price")
    ev = src.sale_events
    return quality.precision_violations([
        ("transaction_items line amount fits decimal(12,2)", items, line, "decimal(12,2)"),
        ("fact_sales.total_amount fits decimal(12,2)", items, line * F.lit(Decimal("1.10")), "decimal(12,2)"),
        ("sale_events.total_amount fits decimal(12,2)", ev,
         F.col("price") * F.col("quantity").cast("decimal(10,0)"), "decimal(12,2)"),
    ])


@query
def orphan_lines(src: Ctx) -> DataFrame:
    return quality.orphans(src.transaction_items, src.tx_clean, "transaction_id") \
        .select("transaction_item_id", "transaction_id")


@query
def rejects_by_reason(src: Ctx) -> DataFrame:
    return clean.rejects_by_reason(src.customers, src.products, src.transactions,
                                   src.marketing_campaigns, AS_OF)


# --- star queries ------------------------------------------------------------------------------

@query
def sales_by_quarter(src: Ctx) -> DataFrame:
    return star.sales_by_quarter(src.fact, src.date_dim)


@query
def sales_by_city_category(src: Ctx) -> DataFrame:
    return star.sales_by_city_category(src.fact, src.customer_dim, src.product_dim)


RANGE_FROM, RANGE_TO = 19960315, 19970630


@query
def sales_date_range(src: Ctx) -> DataFrame:
    return star.sales_date_range(src.fact, RANGE_FROM, RANGE_TO)


def _loads(src: Ctx) -> DataFrame:
    """The partials of two loads: the lines loaded before, and the new ones."""
    fact = src.fact_table
    return rollup.partials(fact.where(F.col("transaction_date_key") < LOADED_BEFORE)).unionByName(
        rollup.partials(fact.where(F.col("transaction_date_key") >= LOADED_BEFORE)))


@query
def sales_rollup(src: Ctx) -> DataFrame:
    # A line has one partial of each slice at most.
    return rollup.levels(_loads(src), rows=(1 + len(rollup.SLICES)) * src.fact_table.count())


@query
def sales_by_campaign(src: Ctx) -> DataFrame:
    return rollup.by_campaign(_loads(src), src.campaign_dim)


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)

