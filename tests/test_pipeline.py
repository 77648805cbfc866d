"""Warehouse load properties: idempotence, split loads, type-0 dimensions,
date-change reloads, stable keys, partition layout."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martlet.plans import pipeline
from martlet.sources.fixtures import AS_OF, sources

SOURCE_TABLES = ["customers", "products", "transactions", "transaction_items", "marketing_campaigns"]


def fixture_tables(spark):
    src = sources(spark, SF_SMALL)
    return {t: src.table(t) for t in SOURCE_TABLES}


def line_keys(spark, wh):
    return {(r[0], r[1], r[2]) for r in pipeline.read_fact(spark, wh)
            .select("transaction_id", "transaction_item_id", "transaction_date_key").collect()}


def test_second_load_adds_nothing(spark, scratch):
    tabs = fixture_tables(spark)
    first = {r[0]: (r[1], r[2]) for r in pipeline.run_pipeline(spark, tabs, scratch, AS_OF).collect()}
    second = {r[0]: (r[1], r[2]) for r in pipeline.run_pipeline(spark, tabs, scratch, AS_OF).collect()}
    assert first["fact_sales"][1] > 0 and first["fact_sales"][0] == first["fact_sales"][1]
    assert all(v[1] == 0 for v in second.values())
    assert second["fact_sales"][0] == first["fact_sales"][0]
    fact = pipeline.read_fact(spark, scratch)
    assert fact.count() == first["fact_sales"][1]
    # the fact is laid out in month partitions named by month_key
    assert any(d.startswith("month_key=") for d in os.listdir(os.path.join(scratch, "fact_sales")))
    assert fact.groupBy("sales_key").count().where("count > 1").count() == 0
    # rejected rows are kept with their reason
    rej = spark.read.parquet(os.path.join(scratch, "rejects", "transactions"))
    assert {r.reason for r in rej.select("reason").distinct().collect()} >= {"future_date", "bad_amount"}


def test_split_load_equals_single_load(spark, scratch):
    tabs = fixture_tables(spark)
    single = os.path.join(scratch, "single")
    split = os.path.join(scratch, "split")
    pipeline.run_pipeline(spark, tabs, single, AS_OF)
    early = dict(tabs, transactions=tabs["transactions"].where(F.col("transaction_date") < F.lit(dt.datetime(1997, 1, 1))))
    pipeline.run_pipeline(spark, early, split, AS_OF)
    pipeline.run_pipeline(spark, tabs, split, AS_OF)
    assert line_keys(spark, single) == line_keys(spark, split)


def small_sources(spark, name="Ann", when=dt.datetime(1999, 3, 1, 12, 0)):
    return {
        "customers": spark.createDataFrame([(1, name, "a@x.com", "paris", dt.datetime(1998, 1, 1))],
                                           "customer_id int, name string, email string, city string, signup_date timestamp_ntz"),
        "products": spark.createDataFrame([(1, "pen", "office", Decimal("2.50"))],
                                          "product_id int, product_name string, category string, price decimal(10,2)"),
        "transactions": spark.createDataFrame([(100, 1, when, Decimal("5.00"))],
                                              "transaction_id int, customer_id int, transaction_date timestamp_ntz, total_amount decimal(12,2)"),
        "transaction_items": spark.createDataFrame([(1000, 100, 1, 2, Decimal("2.50"))],
                                                   "transaction_item_id int, transaction_id int, product_id int, quantity int, price decimal(10,2)"),
        "marketing_campaigns": spark.createDataFrame([], "campaign_id int, campaign_name string, start_date date, end_date date, channel string"),
    }


def test_dimensions_are_insert_only_and_keys_stable(spark, scratch):
    pipeline.run_pipeline(spark, small_sources(spark), scratch, AS_OF)
    pipeline.run_pipeline(spark, small_sources(spark, name="Changed"), scratch, AS_OF)
    dim = spark.read.parquet(os.path.join(scratch, "dim_customer")).collect()
    assert [(r.customer_key, r.customer_id, r.name) for r in dim] == [(1, 1, "Ann")]
    camp = spark.read.parquet(os.path.join(scratch, "dim_campaign")).collect()
    assert [(r.campaign_key, r.campaign_id, r.campaign_name) for r in camp] == [(1, 0, "default")]


def test_changed_transaction_date_loads_a_second_row(spark, scratch):
    pipeline.run_pipeline(spark, small_sources(spark), scratch, AS_OF)
    pipeline.run_pipeline(spark, small_sources(spark, when=dt.datetime(1999, 4, 2, 8, 0)), scratch, AS_OF)
    rows = sorted((r.transaction_date_key, r.month_key, r.gross_amount)
                  for r in pipeline.read_fact(spark, scratch).collect())
    assert rows == [(19990301, 199903, Decimal("5.00")), (19990402, 199904, Decimal("5.00"))]


@pytest.mark.parametrize("table", ["dim_customer", "dim_product"])
def test_keys_unique_after_two_loads(spark, scratch, table):
    tabs = fixture_tables(spark)
    pipeline.run_pipeline(spark, tabs, scratch, AS_OF)
    pipeline.run_pipeline(spark, tabs, scratch, AS_OF)
    d = spark.read.parquet(os.path.join(scratch, table))
    key = table.replace("dim_", "") + "_key"
    assert d.count() == d.select(key).distinct().count() == d.select(key.replace("_key", "_id")).distinct().count()


def test_staging_pointer_switches_after_all_tables(spark, scratch):
    from martlet.sources.readers import current_run, read_staging, snapshot_to_staging
    tabs = small_sources(spark)
    staging = os.path.join(scratch, "staging")
    snapshot_to_staging(spark, tabs, staging, run_id="r1")
    snapshot_to_staging(spark, tabs, staging, run_id="r2")
    assert current_run(spark, staging) == "r2"
    staged = read_staging(spark, staging)
    assert set(staged) == set(SOURCE_TABLES) and staged["transactions"].count() == 1


def test_line_ids_above_31_bits_get_unique_sales_keys(spark):
    from martlet.operators.facts import with_partition_columns

    ids = [1, 2**31 + 5, 2**40, 2**63 - 1]
    rows = spark.createDataFrame([(day, i) for day in (20240131, 20240201) for i in ids],
                                 "transaction_date_key int, transaction_item_id long")
    keys = [r.sales_key for r in with_partition_columns(rows).collect()]
    assert None not in keys and len(set(keys)) == len(keys)
