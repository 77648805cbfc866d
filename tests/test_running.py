"""Running totals that loads continue: equal to one pass over all rows,
whatever the order the rows came in, and no later month is written."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlet.plans import pipeline, running
from martlet.sources.fixtures import AS_OF
from test_pipeline import small_sources

SCHEMA = "customer_id int, transaction_date timestamp_ntz, transaction_id int, total_amount decimal(12,2)"


@pytest.fixture(autouse=True)
def few_buckets(spark):
    spark.conf.set(running.CONF_BUCKETS[0], "2")
    yield
    spark.conf.unset(running.CONF_BUCKETS[0])


def rows_of(n, seed=1):
    """A third of the rows are one customer's; many share a time."""
    rnd = random.Random(seed)
    start = dt.datetime(1999, 1, 1)
    return [(1 if i % 3 == 0 else rnd.randint(2, 9), start + dt.timedelta(days=rnd.randint(0, 100), hours=rnd.randint(0, 2)), i,
             Decimal(rnd.randint(1, 9999)) / 100) for i in range(n)]


def brute(rows):
    out, total = {}, {}
    for c, when, i, amount in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        total[c] = total.get(c, Decimal(0)) + (amount or 0)
        out[(c, when, i)] = total[c]
    return out


def load(spark, root, rows):
    return running.extend(spark, spark.createDataFrame(rows, SCHEMA), root)


def got(spark, root, **kw):
    out = running.read(spark, root, **kw).collect()
    assert len({(r[0], r[1], r[2]) for r in out}) == len(out)
    return {(r[0], r[1], r[2]): r.running_total for r in out}


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(os.path.join(root, "rows")) for f in names if f.endswith(".parquet")}


def test_loads_in_any_order_equal_one(spark, scratch):
    rows = rows_of(400)
    random.Random(5).shuffle(rows)
    assert [load(spark, scratch, rows[:150]), load(spark, scratch, rows[100:300]), load(spark, scratch, rows)] == [150, 150, 100]
    assert got(spark, scratch) == brute(rows)
    some = {k: v for k, v in brute(rows).items() if k[1].month in (2, 4)}
    assert got(spark, scratch, months=[199902, 199904]) == some


def test_new_rows_append_and_late_rows_write_their_bucket_only(spark, scratch):
    rows = sorted(rows_of(300), key=lambda r: (r[1], r[2]))
    rows, late = [r for r in rows if r[2] != 150], [r for r in rows if r[2] == 150]
    load(spark, scratch, rows[:250])
    first = files(scratch)
    load(spark, scratch, rows[250:])
    second = files(scratch)
    assert first < second  # nothing that was there is written again
    load(spark, scratch, late)
    gone = {os.path.dirname(f) for f in second - files(scratch)}
    month = late[0][1].strftime("%Y%m")
    assert len(gone) == 1 and f"month_key={month}" in gone.pop()
    assert got(spark, scratch) == brute(rows + late)


def test_rows_after_the_end_read_no_stored_row(spark, scratch, monkeypatch):
    rows = sorted(rows_of(60), key=lambda r: (r[1], r[2]))
    load(spark, scratch, rows[:50])
    plain = running.read_rows
    monkeypatch.setattr(running, "read_rows", lambda s, r: plain(s, r).withColumn(
        "total_amount", F.raise_error(F.lit("a stored row was read")).cast("decimal(12,2)")))
    later = [(r[0], r[1] + dt.timedelta(days=400), r[2], r[3]) for r in rows[50:]]
    assert load(spark, scratch, later) == 10
    monkeypatch.undo()
    assert got(spark, scratch) == brute(rows[:50] + later)


def test_nulls_repeats_and_empty_batches(spark, scratch):
    day = dt.datetime(1999, 5, 5)
    rows = [(None, day, 1, Decimal("1.00")), (None, day, 2, None), (3, day, 3, Decimal("2.50")), (3, day, 4, Decimal("2.50"))]
    assert load(spark, scratch, []) == 0
    assert load(spark, scratch, rows + [(3, day, 3, Decimal("2.50")), (3, None, 9, Decimal("7.00"))]) == 4
    assert load(spark, scratch, [(None, day - dt.timedelta(days=1), 7, Decimal("4.00")), *rows]) == 1
    assert got(spark, scratch) == brute(rows + [(None, day - dt.timedelta(days=1), 7, Decimal("4.00"))])
    assert load(spark, scratch, []) == 0


@pytest.mark.parametrize("step", range(3))
def test_a_load_that_did_not_end_is_repaired_by_the_next(spark, scratch, monkeypatch, step):
    """It ends before the append, before the late rows, before the carries."""
    rows = rows_of(200)
    random.Random(3).shuffle(rows)
    load(spark, scratch, rows[:120])
    plain, done = running._write, []

    def write(*args):
        if len(done) == step:
            raise RuntimeError("lost")
        done.append(1)
        plain(*args)

    monkeypatch.setattr(running, "_write", write)
    with pytest.raises(RuntimeError, match="lost"):
        load(spark, scratch, rows)
    monkeypatch.undo()
    load(spark, scratch, rows)
    assert got(spark, scratch) == brute(rows)
    assert load(spark, scratch, rows) == 0


def test_the_warehouse_load_keeps_them_up(spark, scratch):
    src = small_sources(spark)
    assert {r[0]: r[2] for r in pipeline.run_pipeline(spark, src, scratch, AS_OF, running=True).collect()}["running_spend"] == 1
    assert {r[0]: r[2] for r in pipeline.run_pipeline(spark, src, scratch, AS_OF, running=True).collect()}["running_spend"] == 0
    assert pipeline.read_running_spend(spark, scratch).count() == 1
