"""Plan properties: no Python in any registered query, month pruning on
the partitioned fact, dynamic pruning through dim_date, pushdown."""

import os

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL, plan_of
from martlet.plans import pipeline, star
from martlet.plans.catalog import all_queries
from martlet.sources.fixtures import AS_OF, sources

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas",
            "FlatMapGroupsInArrow")


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_python_in_plan(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_SMALL), "extended")
    assert not any(n in plan for n in PY_NODES), name


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    wh = str(tmp_path_factory.mktemp("wh"))
    src = sources(spark, SF_SMALL)
    tabs = {t: src.table(t) for t in ["customers", "products", "transactions", "transaction_items",
                                      "marketing_campaigns"]}
    pipeline.run_pipeline(spark, tabs, wh, AS_OF)
    return wh


def test_date_range_prunes_month_partitions(spark, warehouse):
    fact = pipeline.read_fact(spark, warehouse)
    plan = plan_of(star.sales_date_range(fact, 19960315, 19970630), "formatted")
    assert "PartitionFilters: [isnotnull(month_key" in plan and "199603" in plan and "199706" in plan
    # the day-key range alone would not prune: the month range does
    assert "(month_key#" in plan.split("PartitionFilters:")[1].split("\n")[0]


def test_quarter_query_gets_dynamic_pruning(spark, warehouse):
    from pyspark.sql import functions as F
    fact = pipeline.read_fact(spark, warehouse)
    dd = spark.read.parquet(os.path.join(warehouse, "dim_date")).where(F.col("year") == 1996)
    plan = plan_of(star.sales_by_quarter(fact, dd), "formatted")
    assert "dynamicpruning" in plan.lower()


def test_source_scans_prune_columns(spark):
    plan = plan_of(entry.queries()["customer_tiers"](spark, SF_SMALL), "formatted")
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in plan


def test_top_lines_are_limited_before_the_shuffle(spark):
    from pyspark.sql import functions as F

    from martlet.operators.relops import top_lines

    lines = spark.range(1000).selectExpr("cast(id % 3 as int) transaction_id", "id transaction_item_id", "cast(id % 7 as decimal(10,2)) price")
    got = top_lines(lines, F.when(F.col("transaction_id") == 0, 4).otherwise(1))
    plan = plan_of(got, "formatted")
    assert plan.count("WindowGroupLimit") >= 2 and "rangepartitioning" not in plan and "Scan ExistingRDD" not in plan
    assert sorted((r.transaction_id, r.rank) for r in got.collect()) == [(0, 1), (0, 2), (0, 3), (0, 4), (1, 1), (2, 1)]
    assert top_lines(lines.limit(0), F.lit(2)).collect() == []
