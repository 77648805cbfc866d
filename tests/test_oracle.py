"""Every registered query against its DuckDB twin on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import digest, duck, type_diffs  # noqa: E402

# What SQL can't express has its brute-force tests in tests/llm/.
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_of_the_mart_has_an_oracle():
    from martlet.plans.catalog import all_queries

    assert set(all_queries()) <= set(NAMES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(entry.oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert type_diffs(sdf, rel) == []
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows) == digest(rel.columns, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "transaction_date_key"
    assert df.count() > 0
