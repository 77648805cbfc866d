"""A transaction holding a third of all lines is found, split over several
buckets, and the fact (joins + basket metrics) is unchanged by the split."""

import datetime as dt
from decimal import Decimal

import pytest

from martlet.operators import facts, skew
from martlet.operators.joins import broadcast_if_small


@pytest.fixture()
def skew_conf(spark):
    keys = {"martlet.skew.sampleFraction": "0.5", "martlet.skew.minSampledRows": "20",
            "martlet.skew.rowsPerBucket": "100"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def skewed_inputs(spark, n_lines=3000):
    items = []
    for i in range(n_lines):
        tid = 1 if i % 3 == 0 else 2 + i % 400          # transaction 1 holds a third
        items.append((i + 1, tid, 1 + i % 5, 1 + i % 4, Decimal(f"{1 + i % 7}.{i % 100:02d}")))
    tx = [(t, 10 + t % 3, dt.datetime(1999, 1, 1 + t % 28, 12, 0), Decimal("1.00")) for t in range(1, 402)]
    items_df = spark.createDataFrame(items, "transaction_item_id int, transaction_id int, product_id int, "
                                            "quantity int, price decimal(10,2)")
    tx_df = spark.createDataFrame(tx, "transaction_id int, customer_id int, transaction_date timestamp_ntz, "
                                      "total_amount decimal(12,2)")
    cust = spark.createDataFrame([(10, 1), (11, 2), (12, 3)], "customer_id int, customer_key int")
    prod = spark.createDataFrame([(p, p + 100) for p in range(1, 5)], "product_id int, product_key int")
    return tx_df, items_df, cust, prod


def test_heavy_hitter_found_and_split(spark, skew_conf):
    _, items, _, _ = skewed_inputs(spark)
    hot = skew.heavy_hitters(items, "transaction_id")
    assert hot.values == [1]
    assert hot.buckets[1] > 2
    spread = skew.spread(items, "transaction_id", hot, "transaction_item_id")
    n_buckets = spread.where("transaction_id = 1").select(skew.SALT).distinct().count()
    assert n_buckets == hot.buckets[1]


def test_salted_fact_equals_plain_fact(spark, skew_conf):
    tx, items, cust, prod = skewed_inputs(spark)
    salted = facts.build_fact(tx, items, cust, prod)
    lines = (facts.join_header_lines(tx, items).join(cust, "customer_id").join(prod, "product_id"))
    plain = facts.add_basket_metrics(facts.add_measures(lines))
    cols = ["transaction_item_id", "gross_amount", "tax_amount", "item_count", "avg_item_price"]
    got = sorted(tuple(r) for r in salted.select(*cols).collect())
    want = sorted(tuple(r) for r in plain.select(*cols).collect())
    assert got == want and len(got) == 2400  # product 5 is unknown: 600 lines drop
    hot_row = salted.where("transaction_id = 1").select("item_count", "avg_item_price").distinct().collect()
    assert len(hot_row) == 1  # every line of the hot basket sees the whole basket


def test_broadcast_only_under_checked_bound(spark):
    small = spark.range(10)
    assert broadcast_if_small(small, 100) is not small  # wrapped in a broadcast hint
    big = spark.range(1000)
    assert broadcast_if_small(big, 100) is big


def test_lookup_flag_salted_fallback_keeps_every_row(spark, skew_conf):
    from martlet.operators.joins import lookup_flag
    ev = spark.createDataFrame([(i, 7 if i % 3 == 0 else i % 50) for i in range(3000)], "transaction_id int, customer_id int")
    ref = spark.createDataFrame([(c,) for c in range(0, 40)] + [(7,), (7,)], "customer_id int")
    spark.conf.set("martlet.broadcast.maxRows", "5")  # force the shuffle path
    try:
        out = lookup_flag(ev, ref, "customer_id", "known", row_id="transaction_id")
        rows = out.collect()
    finally:
        spark.conf.unset("martlet.broadcast.maxRows")
    assert len(rows) == 3000
    got = {r.transaction_id: bool(r.known) for r in rows}
    assert got == {i: (7 if i % 3 == 0 else i % 50) < 40 for i in range(3000)}


def test_lookup_flag_by_keys_matches_full_lookup(spark):
    from martlet.operators.joins import lookup_flag, lookup_flag_by_keys
    ev = spark.createDataFrame([(i, i % 70) for i in range(500)], "transaction_id int, customer_id int")
    ref = spark.createDataFrame([(c,) for c in range(0, 1000, 3)], "customer_id int")
    a = sorted(tuple(r) for r in lookup_flag_by_keys(ev, ref, "customer_id", "k", "transaction_id").collect())
    b = sorted(tuple(r) for r in lookup_flag(ev, ref, "customer_id", "k", "transaction_id").collect())
    assert a == b and len(a) == 500
    spark.conf.set("martlet.lookup.maxInlineKeys", "10")  # over the bound: falls back
    try:
        c = sorted(tuple(r) for r in lookup_flag_by_keys(ev, ref, "customer_id", "k", "transaction_id").collect())
    finally:
        spark.conf.unset("martlet.lookup.maxInlineKeys")
    assert c == b
