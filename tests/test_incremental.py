"""New lines found before the fact is built, and rollups kept up by loads."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlet.operators import incremental
from martlet.plans import pipeline, rollup
from martlet.schemas import FACT_LINE_KEY
from martlet.sources.fixtures import AS_OF
from test_pipeline import fixture_tables, small_sources


def keys(spark, ids, month=202401):
    return spark.range(1).select(F.explode(F.array(*[F.lit(i) for i in ids])).alias("i")).select(
        (F.col("i") % 1000).cast("int").alias("transaction_id"), F.col("i").cast("long").alias("transaction_item_id"),
        F.lit(month * 100 + 5).alias("transaction_date_key"), F.lit(month).alias("month_key"), F.lit(1).alias("customer_id"), F.lit(1).alias("product_id"))


def flagged(df, bitmaps, blocks):
    return {r.transaction_item_id for r in incremental.maybe_loaded(df, bitmaps, blocks).where("maybe").collect()}


def test_filter_misses_no_loaded_line_and_few_others_pass(spark):
    first, second = keys(spark, range(3000)), keys(spark, range(3000, 6000))
    blocks = incremental.blocks_for(first)
    assert blocks == {202401: 2}
    bitmaps = incremental.line_filter(first, blocks).unionByName(incremental.line_filter(second, blocks)).checkpoint()
    assert flagged(keys(spark, range(6000)), bitmaps, blocks) == set(range(6000))
    assert len(flagged(keys(spark, range(10_000, 14_000)), bitmaps, blocks)) < 400
    assert flagged(keys(spark, range(50), month=202402), bitmaps, blocks) == set()


def test_surely_new_lines_read_no_fact(spark):
    loaded, new = keys(spark, range(100)), keys(spark, range(5000, 5020))
    blocks = incremental.blocks_for(loaded)
    unread = keys(spark, [1]).withColumn("transaction_item_id", F.raise_error(F.lit("the fact was read")).cast("long"))
    got, n = incremental.new_keys(new, incremental.line_filter(loaded, blocks), blocks, unread)
    assert (got.count(), n) == (20, 0)
    both = new.unionByName(keys(spark, range(90, 110)))
    got, n = incremental.new_keys(both, incremental.line_filter(loaded, blocks), blocks, loaded)
    assert (got.count(), n) == (30, 10)
    assert incremental.new_keys(new.limit(0), incremental.line_filter(loaded, blocks), blocks, unread)[1] == 0


def test_null_line_ids_are_one_key(spark):
    lone = keys(spark, [1]).withColumn("transaction_item_id", F.lit(None).cast("long"))
    blocks = incremental.blocks_for(lone)
    got, n = incremental.new_keys(lone, incremental.line_filter(lone, blocks), blocks, lone)
    assert (got.count(), n) == (0, 1)


def test_reload_builds_nothing(spark, scratch, monkeypatch):
    pipeline.run_pipeline(spark, small_sources(spark), scratch, AS_OF)

    def built(*_):
        raise AssertionError("a fact row was built")

    monkeypatch.setattr(incremental, "build_new", built)
    again = {r[0]: (r[1], r[2]) for r in pipeline.run_pipeline(spark, small_sources(spark), scratch, AS_OF).collect()}
    assert again["fact_sales"] == (1, 0)


def test_a_fact_without_filter_or_rollup_gets_them(spark, scratch):
    """A warehouse that an older version has loaded."""
    pipeline.run_pipeline(spark, small_sources(spark), scratch, AS_OF)
    other = os.path.join(scratch, "other")
    for t in ("dim_customer", "dim_product", "dim_campaign", "dim_date"):
        spark.read.parquet(os.path.join(scratch, t)).write.parquet(os.path.join(other, t))
    pipeline.read_fact(spark, scratch).write.partitionBy("month_key").parquet(os.path.join(other, "fact_sales"))
    again = {r[0]: (r[1], r[2]) for r in pipeline.run_pipeline(spark, small_sources(spark), other, AS_OF).collect()}
    assert again["fact_sales"] == (1, 0)
    assert sorted(map(tuple, pipeline.read_rollup(spark, other).collect()), key=str) == sorted(
        map(tuple, pipeline.read_rollup(spark, scratch).collect()), key=str)


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_partials_of_two_loads_equal_a_full_rebuild(spark, scratch):
    tabs = fixture_tables(spark)
    early = dict(tabs, transactions=tabs["transactions"].where(F.col("transaction_date") < F.lit(dt.datetime(1997, 1, 15))))
    pipeline.run_pipeline(spark, early, scratch, AS_OF)
    pipeline.run_pipeline(spark, tabs, scratch, AS_OF)
    fact = pipeline.read_fact(spark, scratch)
    want = table(rollup.levels(rollup.partials(fact)))
    assert table(pipeline.read_rollup(spark, scratch)) == want
    path = os.path.join(scratch, "rollup")
    rollup.compact(spark, path, [199701, 199702])
    assert table(pipeline.read_rollup(spark, scratch)) == want
    # a crash: the partials of one month count other lines than the fact holds
    rollup.open_load(spark, scratch, [199701, 199702])
    rollup.append(fact.where("month_key = 199702").limit(3), path)
    assert rollup.stale_months(fact, spark, path, [199701, 199702]) == [199702]
    pipeline.run_pipeline(spark, tabs, scratch, AS_OF)
    assert table(pipeline.read_rollup(spark, scratch)) == want and rollup.OPEN not in os.listdir(scratch)


def test_levels_by_hand(spark):
    row = lambda day, c, q, g: (day, c, 7, 1, q, Decimal(g), Decimal(g))
    fact = spark.createDataFrame(
        [row(20240131, 1, 2, "1.10"), row(20240201, 1, 1, "2.00"), row(20240401, 2, 3, "4.00")],
        "transaction_date_key int, customer_key int, product_key int, campaign_key int, quantity int, gross_amount decimal(12,2), profit_amount decimal(12,2)")
    got = {(r.slice, r.member, r.level, r.period): (r.n_lines, r.quantity, str(r.gross)) for r in rollup.levels(rollup.partials(fact)).collect()}
    assert got["all", None, "day", 20240131] == (1, 2, "1.10")
    assert got["all", None, "quarter", 20241] == got["customer", 1, "quarter", 20241] == (2, 3, "3.10")
    assert got["customer", 2, "month", 202404] == got["campaign", 1, "quarter", 20242] == (1, 3, "4.00")
    assert got["product", 7, "month", 202402] == (1, 1, "2.00") and len(got) == 3 + 3 + 2 + 3 + 2 + 3 + 2 + 3 + 2
    assert rollup.levels(rollup.partials(fact.limit(0))).collect() == []


@pytest.mark.parametrize("column", FACT_LINE_KEY)
def test_a_change_of_any_key_column_is_new(spark, column):
    old = keys(spark, [5])
    blocks = incremental.blocks_for(old)
    changed = old.withColumn(column, (F.col(column) + 1).cast(old.schema[column].dataType))
    got, n = incremental.new_keys(changed, incremental.line_filter(old, blocks), blocks, old)
    assert (got.count(), n) == (1, 0)


def test_levels_are_merged_by_as_many_tasks_as_the_partials_ask_for(spark):
    """What a task of ``levels`` holds does not grow with the sales, and a partial goes only into levels it has."""
    day = F.expr("cast(date_format(date_add(DATE'2024-01-01', cast(id % 400 as int)), 'yyyyMMdd') as int)")
    fact = spark.range(3000).select(
        day.alias("transaction_date_key"), (F.col("id") % 50).cast("int").alias("customer_key"), (F.col("id") % 70).cast("int").alias("product_key"),
        F.lit(1).alias("campaign_key"), F.lit(2).alias("quantity"), F.lit("1.10").cast("decimal(12,2)").alias("gross_amount"),
        F.lit("0.10").cast("decimal(12,2)").alias("profit_amount"))
    parts = rollup.partials(fact.where("transaction_date_key < 20240615")).unionByName(rollup.partials(fact.where("transaction_date_key >= 20240615")))
    many = rollup.levels(parts, rows=19 * rollup.ROWS + 1)
    assert many.rdd.getNumPartitions() == 20
    got = {(r.slice, r.member, r.level, r.period): (r.n_lines, r.quantity, str(r.gross), str(r.profit)) for r in many.collect()}
    want = {}
    for f in fact.collect():
        d, m = f.transaction_date_key, f.transaction_date_key // 100
        periods = [("month", m), ("quarter", m // 100 * 10 + (m % 100 + 2) // 3)]
        for key in [("all", None, "day", d), *[(s, None if s == "all" else f[c], *p) for s, c in (("all", None), *rollup.SLICES.items()) for p in periods]]:
            want[key] = want.get(key, 0) + 1
    assert got == {k: (n, 2 * n, str(n * Decimal("1.10")), str(n * Decimal("0.10"))) for k, n in want.items()}
    assert table(rollup.levels(parts)) == table(many)
