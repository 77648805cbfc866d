"""The daily warehouse load: extract to staging, clean, load dimensions
(insert-if-absent), build the fact and append only new lines into month
partitions.

Layout under ``warehouse_root``: ``staging/``, ``dim_customer/``,
``dim_product/``, ``dim_campaign/``, ``dim_date/``, ``fact_sales/``,
``line_filter/`` and ``rollup/`` (the last three by ``month_key``). Every step is idempotent, so a failed or
repeated run is repaired by running it again: dimensions skip members they
already hold and the fact skips lines it already holds. Plain Parquet has
no multi-writer transactions; run one load at a time per warehouse.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet import schemas
from martlet.functions.dates import date_key, month_key
from martlet.operators import clean, dims, facts, gate, incremental
from martlet.plans import rollup
from martlet.plans import running as running_totals
from martlet.session import configure
from martlet.sources.readers import read_or_empty, read_staging, snapshot_to_staging


def load_dimension(spark: SparkSession, incoming: DataFrame, path: str, business_key: str,
                   key_col: str, schema) -> int:
    """Append members not yet in the dimension, keys continuing after the
    current maximum. Returns the number of rows inserted; members without a
    key are refused (``gate.RuleViolation``) before anything is appended."""
    existing = read_or_empty(spark, path, schema)
    # The keyed new members are materialised in the checkpoint folder by the
    # numbering, so counting them re-reads that slice, not the sources.
    new = dims.upsert_dimension(incoming, existing, business_key, key_col).select(*schema.fieldNames())
    keyed = gate.dimension_rules(path.rsplit("/", 1)[-1], [key_col, business_key]).violations
    seen = new.agg(F.count(F.lit(1)), *[F.count_if(v) for v in keyed.values()]).first()
    gate.refuse({rule: n for rule, n in zip(keyed, seen[1:], strict=True) if n})
    inserted = seen[0]
    new.write.mode("append").parquet(path)
    return inserted


def load_dim_date(spark: SparkSession, days: DataFrame, path: str) -> int:
    """Insert days not yet present (one row per calendar day: tiny)."""
    existing = read_or_empty(spark, path, schemas.DIM_DATE)
    new = days.join(existing.select("date_key"), "date_key", "left_anti").select(*schemas.DIM_DATE.fieldNames())
    inserted = new.count()
    new.coalesce(1).write.mode("append").parquet(path)
    return inserted


def load_fact(spark: SparkSession, tx: DataFrame, items: DataFrame, root: str, months: list[int]) -> tuple[int, int]:
    """Append fact lines whose (transaction, line, day) is not loaded yet;
    returns (candidate lines, inserted lines), candidates being the lines
    that are loaded already and those inserted now.

    New lines are found first (``operators.incremental``): on a repeated load
    no dimension is read and no fact row is built. The new rows are kept in
    the checkpoint folder, since three tables are written from them, in this
    order, once their constraints hold (``operators.gate``, counted while they
    are kept; a violation raises and nothing is written): the line filter
    (which may hold lines that are not loaded, never the reverse), the fact, the rollup partials (rebuilt by month where a crash
    left them apart). The fact write asks AQE to
    rebalance by month, so a hot month is split over several writers."""
    path, filters, sums = f"{root}/fact_sales", f"{root}/line_filter", f"{root}/rollup"
    fact = read_or_empty(spark, path, schemas.FACT_SALES)
    rollup.repair(spark, fact, root, sums)
    existing = fact.where(F.col("month_key").isin(months))
    known = incremental.ensure_filter(spark, existing, filters, months)
    bitmaps = read_or_empty(spark, filters, incremental.FILTER).where(F.col("month_key").isin(months))
    new, loaded = incremental.new_keys(incremental.line_keys(tx, items), bitmaps, known, existing)
    if new.isEmpty():
        return loaded, 0
    # Keys are read back from the stored dimensions (lineage cut there).
    dim_c, dim_p = (spark.read.parquet(f"{root}/{d}") for d in ("dim_customer", "dim_product"))
    if loaded:
        new = incremental.insertable(new, dim_c, dim_p)
        if new.isEmpty():
            return loaded, 0
    rows = incremental.build_new(tx, items, dim_c, dim_p, new, loaded)
    guard = gate.Gate(facts.with_partition_columns(rows).select(*schemas.FACT_SALES.fieldNames()), gate.fact_rules())
    rows = guard.rows.checkpoint(eager=True)
    inserted = guard.check()
    if inserted:
        rollup.open_load(spark, root, months)
        incremental.append_filter(rows.select(*schemas.FACT_LINE_KEY, "month_key"), filters, known)
        rows.hint("rebalance", "month_key").write.mode("append").partitionBy("month_key").parquet(path)
        rollup.append(rows, sums)
        rollup.close_load(spark, root)
    return loaded + inserted, inserted


def transform_and_load(spark: SparkSession, staged: Mapping[str, DataFrame], warehouse_root: str,
                       as_of: dt.datetime, running: bool = False) -> DataFrame:
    """Clean the staged tables, load the four dimensions and the fact, and
    with ``running`` the running totals of each customer's spend.
    Returns (table_name, candidates, inserted) per target."""
    configure(spark)
    root = warehouse_root.rstrip("/")
    tx = clean.clean_transactions(staged["transactions"], as_of)
    write_rejects(staged, f"{root}/rejects", as_of)

    summary: list[tuple[str, int, int]] = []

    def dim(name, incoming, key, key_col, schema):
        # The cleaned members feed the count, the range sampling and the
        # numbering: keep them for the length of this load instead of
        # cleaning three times (dimensions are small next to the fact; lost
        # blocks are recomputed from their deterministic lineage).
        incoming = incoming.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            candidates = incoming.count()
            inserted = load_dimension(spark, incoming, f"{root}/{name}", key, key_col, schema)
        finally:
            incoming.unpersist()
        summary.append((name, candidates, inserted))

    # Candidates are the distinct cleaned rows (what the load log counts);
    # the insert keeps the first row of an id that occurs twice.
    dim("dim_customer", clean.customer_candidates(staged["customers"], as_of),
        "customer_id", "customer_key", schemas.DIM_CUSTOMER)
    dim("dim_product", clean.product_candidates(staged["products"]),
        "product_id", "product_key", schemas.DIM_PRODUCT)
    dim("dim_campaign", clean.with_default_campaign(clean.campaign_candidates(staged["marketing_campaigns"])),
        "campaign_id", "campaign_key", schemas.DIM_CAMPAIGN)

    # The reference offers one dim_date row per distinct timestamp and keeps
    # one per day; both numbers are reported.
    stamps = dims.distinct_timestamps(tx).count()
    summary.append(("dim_date", stamps, load_dim_date(spark, dims.dim_date(tx), f"{root}/dim_date")))

    # Months of this load: at most one per calendar month (a list bounded by
    # the calendar, not by the data, so it may come to the driver).
    months = sorted(r["m"] for r in tx.select(month_key(date_key("transaction_date")).alias("m"))
                    .where(F.col("m").isNotNull()).distinct().collect())
    candidates, inserted = load_fact(spark, tx, staged["transaction_items"], root, months)
    summary.append(("fact_sales", candidates, inserted))
    if running:
        summary.append(("running_spend", tx.count(), running_totals.extend(spark, tx, f"{root}/running_spend")))
    return spark.createDataFrame(summary, "table_name string, candidates long, inserted long")


def write_rejects(staged: Mapping[str, DataFrame], path: str, as_of: dt.datetime) -> None:
    """Row-level quarantine of the current snapshot: every row a cleaning
    rule drops, with the first rule it fails, in ``rejects/<table>``
    (replaced on every run, as the sources are full snapshots)."""
    checks = {
        "transactions": (clean.stage_transactions, clean.transaction_rules(as_of)),
        "customers": (clean.stage_customers, clean.customer_rules(as_of)),
        "products": (clean.stage_products, clean.product_rules()),
        "marketing_campaigns": (clean.stage_campaigns, clean.campaign_rules()),
    }
    for table, (stage, rules) in checks.items():
        clean.quarantine(stage(staged[table]), rules).write.mode("overwrite").parquet(f"{path}/{table}")


def run_pipeline(spark: SparkSession, sources: Mapping[str, DataFrame], warehouse_root: str,
                 as_of: dt.datetime, run_id: str | None = None, strict: bool = False, running: bool = False) -> DataFrame:
    """Extract (snapshot to staging, published atomically), then transform
    and load from the published snapshot. ``strict`` refuses a snapshot that
    breaks a declared constraint of the source tables; without it the
    cleaning rules put such rows into ``rejects/``. ``running`` keeps up the
    running totals too (``read_running_spend``)."""
    staging = f"{warehouse_root.rstrip('/')}/staging"
    snapshot_to_staging(spark, sources, staging, run_id, gate.source_rules() if strict else None)
    return transform_and_load(spark, read_staging(spark, staging), warehouse_root, as_of, running)


def read_fact(spark: SparkSession, warehouse_root: str) -> DataFrame:
    return spark.read.parquet(f"{warehouse_root.rstrip('/')}/fact_sales")


def read_rollup(spark: SparkSession, warehouse_root: str) -> DataFrame:
    """Sales by day, month, quarter and slice, from the stored partials."""
    return rollup.levels(rollup.read(spark, f"{warehouse_root.rstrip('/')}/rollup"))


def read_running_spend(spark: SparkSession, warehouse_root: str) -> DataFrame:
    """Running totals of each customer's spend, where the loads keep them."""
    return running_totals.read(spark, f"{warehouse_root.rstrip('/')}/running_spend")
