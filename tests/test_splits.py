"""Splits of equal depth: every row in one split, depths within bounds on
skewed keys, the same SQL on Spark and DuckDB."""

import random

import duckdb
import pyarrow as pa
import pytest

from martlet.sources import splits


def keys_of(kind, n=20_000):
    rnd = random.Random(7)
    if kind == "dense then sparse":
        return list(range(n // 2)) + [10 ** 9 + 10_007 * i for i in range(n // 2)]
    if kind == "powers":
        return [int(2 ** rnd.uniform(0, 61)) for _ in range(n)]
    if kind == "negative":
        return [-5 * i for i in range(n)]
    if kind == "a hot key":
        return [42] * (n // 3) + list(range(n - n // 3))
    return [7] * n


def on_duck(keys):
    con = duckdb.connect()
    con.register("t", pa.table({"k": pa.array(keys, pa.int64())}))
    asked = []

    class Rows(list):
        def first(self):
            return self[0]

        def collect(self):
            return self

    def run(sql):
        asked.append(sql)
        return Rows(con.execute(sql).fetchall())

    return con, run, asked


def depths(con, conditions):
    return [con.execute(f"SELECT COUNT(*) FROM t WHERE {c}").fetchone()[0] for c in conditions]


@pytest.mark.parametrize("kind", ["dense then sparse", "powers", "negative"])
def test_depths_are_within_a_quarter(kind):
    keys = keys_of(kind)
    con, run, asked = on_duck(keys)
    got = depths(con, splits.plan(run, "t", "k", 1000))
    assert sum(got) == len(keys) and len(got) == 20
    assert max(got) <= 1250 and min(got) >= 750
    assert len(asked) < 20


def test_uniform_bounds_would_not_be():
    """The same keys in twenty equal ranges: one split holds half of them."""
    keys = keys_of("dense then sparse")
    width = (max(keys) + 1) / 20
    assert max(sum(int(k / width) == i for k in keys) for i in range(20)) >= 10_000


def test_a_hot_key_is_not_cut_and_spoils_no_other_split():
    keys = keys_of("a hot key")
    con, run, _ = on_duck(keys)
    got = depths(con, splits.plan(run, "t", "k", 1000))
    assert sum(got) == len(keys)
    assert sum(d > 1250 for d in got) == 1
    assert splits.plan(on_duck(keys_of("one key"))[1], "t", "k", 1000) == ["1 = 1"]


def test_nulls_and_empty_tables_and_few_rows():
    con, run, _ = on_duck([None, None, 3, 9, None, 12])
    got = splits.plan(run, "t", "k", 1)
    assert depths(con, got) == [4, 1, 1]
    assert splits.plan(on_duck([])[1], "t", "k", 10) == ["1 = 1"]
    assert splits.plan(on_duck([None])[1], "t", "k", 10) == ["1 = 1"]
    with pytest.raises(ValueError):
        splits.plan(run, "t", "k", 0)


def test_spark_runs_the_same_queries(spark):
    keys = keys_of("powers", 3000)
    spark.createDataFrame([(k,) for k in keys], "k long").createOrReplaceTempView("split_keys")
    got = splits.plan(spark.sql, "split_keys", "k", 300)
    con, run, _ = on_duck(keys)
    assert got == splits.plan(run, "t", "k", 300)


def test_rows_that_come_after_planning_are_read():
    con, run, _ = on_duck(list(range(100)))
    conditions = splits.plan(run, "t", "k", 10)
    con.register("t2", pa.table({"k": pa.array([-50, 5000], pa.int64())}))
    assert sum(con.execute(f"SELECT COUNT(*) FROM t2 WHERE {c}").fetchone()[0] for c in conditions) == 2
