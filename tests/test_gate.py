"""Constraints at write time: counted by the write itself, and a load that
breaks one is not published."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_of
from martlet.operators import gate
from martlet.plans import pipeline
from martlet.sources import readers
from martlet.sources.fixtures import AS_OF
from test_pipeline import small_sources


def bad_items(spark):
    """One good line, one of quantity 0, one without a price."""
    return spark.createDataFrame([(1, 1, 1, 2, Decimal("2.50")), (2, 1, 1, 0, Decimal("2.50")), (3, 1, 1, 1, None)],
                                 "transaction_item_id long, transaction_id int, product_id int, quantity int, price decimal(10,2)")


def test_counts_come_with_the_write(spark, scratch):
    rows = spark.range(0, 1000, numPartitions=7).selectExpr("id", "IF(id % 10 = 0, NULL, id) AS v")
    rules = gate.Rules("t").not_null(["id", "v"]).check("v < 500", F.col("v") < 500).lengths({"id": 2})
    guard = gate.Gate(rows, rules)
    guard.rows.write.parquet(os.path.join(scratch, "t"))
    assert guard.counts() == {"t.id not null": 0, "t.v not null": 100, "t.v < 500": 450, "t.id length <= 2": 900}
    assert guard.written() == 1000
    with pytest.raises(gate.RuleViolation, match="t.v not null: 100 rows"):
        guard.check()


def test_counts_of_a_checkpoint_are_not_doubled(spark, scratch):
    from martlet.session import checkpoint_dir

    checkpoint_dir(spark)
    rows = spark.range(0, 1000, numPartitions=7).repartition(3).withColumn("v", F.lit(None).cast("int"))
    guard = gate.Gate(rows, gate.Rules("t").not_null(["v"]))
    assert guard.rows.checkpoint(eager=True).count() == 1000
    assert guard.written() == 1000 and guard.counts() == {"t.v not null": 1000}


def test_empty_table_breaks_no_rule(spark, scratch):
    guard = gate.Gate(spark.createDataFrame([], "v int"), gate.Rules("t").not_null(["v"]).check("v > 0", F.col("v") > 0))
    guard.rows.write.parquet(os.path.join(scratch, "t"))
    assert guard.check() == 0


def test_violating_snapshot_is_not_published(spark, scratch):
    readers.snapshot_to_staging(spark, small_sources(spark, "Old"), scratch, rules=gate.source_rules())
    new = dict(small_sources(spark, "New"), transaction_items=bad_items(spark))
    with pytest.raises(gate.RuleViolation) as broken:
        readers.snapshot_to_staging(spark, new, scratch, rules=gate.source_rules())
    assert broken.value.counts == {"transaction_items.quantity > 0": 1, "transaction_items.price not null": 1}
    assert [r["name"] for r in readers.read_staging(spark, scratch)["customers"].collect()] == ["Old"]
    readers.snapshot_to_staging(spark, new, scratch)  # without rules, as before
    assert [r["name"] for r in readers.read_staging(spark, scratch)["customers"].collect()] == ["New"]


def test_strict_load_refuses_what_the_plain_load_takes(spark, scratch):
    long_name = small_sources(spark, "x" * 101)
    with pytest.raises(gate.RuleViolation, match="customers.name length <= 100: 1 rows"):
        pipeline.run_pipeline(spark, long_name, os.path.join(scratch, "strict"), AS_OF, strict=True)
    loaded = {r[0]: r[2] for r in pipeline.run_pipeline(spark, long_name, os.path.join(scratch, "plain"), AS_OF).collect()}
    assert loaded["fact_sales"] > 0


def test_fact_with_a_broken_rule_is_not_appended(spark, scratch, monkeypatch):
    pipeline.run_pipeline(spark, small_sources(spark), scratch, AS_OF)
    before = pipeline.read_fact(spark, scratch).count()
    whole = pipeline.facts.with_partition_columns
    monkeypatch.setattr(pipeline.facts, "with_partition_columns",
                        lambda rows: whole(rows).withColumn("gross_amount", (F.col("gross_amount") + 1).cast("decimal(12,2)")))
    later = small_sources(spark)
    later["transactions"] = later["transactions"].withColumn("transaction_date", F.col("transaction_date") + F.expr("INTERVAL 1 DAY"))
    with pytest.raises(gate.RuleViolation, match="gross_amount = quantity"):
        pipeline.run_pipeline(spark, later, scratch, AS_OF)
    assert pipeline.read_fact(spark, scratch).count() == before
    monkeypatch.undo()
    pipeline.run_pipeline(spark, later, scratch, AS_OF)  # repaired by running again
    assert pipeline.read_fact(spark, scratch).count() > before


def test_report_reads_each_table_once(spark):
    from martlet.plans.catalog import all_queries
    from martlet.sources.fixtures import sources

    src = sources(spark, SF_SMALL)
    rules = gate.source_rules()
    one = plan_of(gate.report({"products": src.table("products")}, {"products": rules["products"]}))
    assert one.count("Scan parquet") <= plan_of(src.table("products")).count("Scan parquet")
    names = {r.rule for r in all_queries()["audit_write_rules"](spark, SF_SMALL).collect()}
    assert names == {n for r in rules.values() for n in r.violations}


def test_line_without_a_price_refuses_the_fact_load(spark, scratch):
    tabs = small_sources(spark)
    line = "transaction_item_id long, transaction_id int, product_id int, quantity int, price decimal(10,2)"
    tabs["transaction_items"] = spark.createDataFrame([(1, 100, 1, 2, Decimal("2.50")), (2, 100, 1, 1, None)], line)
    with pytest.raises(gate.RuleViolation, match="fact_sales.unit_price not null: 1 rows"):
        pipeline.run_pipeline(spark, tabs, scratch, AS_OF)
    assert not os.path.exists(os.path.join(scratch, "fact_sales"))
