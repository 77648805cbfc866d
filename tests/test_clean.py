"""Golden rows for cleaning, measures and date keys."""

import datetime as dt
from decimal import Decimal


from martlet.functions import dates, money
from martlet.operators import clean, dims, facts

AS_OF = dt.datetime(2000, 1, 1)


def test_clean_transactions_filters_and_first_row(spark):
    rows = [
        (1, 10, "1999-05-01 10:00:00", "5.00"),
        (1, 9, "1999-05-02 10:00:00", "7.00"),   # same id, smaller customer: wins
        (2, None, "1999-05-01 10:00:00", "5.00"),  # missing customer
        (3, 11, "2001-01-01 00:00:00", "5.00"),  # future
        (4, 12, "1999-01-01 00:00:00", "-1.00"),  # negative
        (5, 13, "not a date", "3.00"),           # unparsable date -> NULL -> dropped
        (6, 14, "1999-12-31 23:59:59", "abc"),   # unparsable amount -> NULL -> dropped
        (7, 15, "2000-01-01 00:00:00", "0"),     # exactly as_of, zero amount: kept
    ]
    df = spark.createDataFrame(rows, "transaction_id int, customer_id int, transaction_date string, total_amount string")
    out = {r["transaction_id"]: r for r in clean.clean_transactions(df, AS_OF).collect()}
    assert sorted(out) == [1, 7]
    assert out[1]["customer_id"] == 9 and out[1]["total_amount"] == Decimal("7.00")


def test_rejects_by_reason_counts_first_failing_rule(spark):
    tx = spark.createDataFrame([(1, None, dt.datetime(2001, 1, 1), Decimal("-1")),
                                (2, 1, dt.datetime(2001, 1, 1), Decimal("1")),
                                (3, 1, dt.datetime(1999, 1, 1), Decimal("1")),
                                (3, 2, dt.datetime(1999, 1, 1), Decimal("1"))],
                               "transaction_id int, customer_id int, transaction_date timestamp_ntz, total_amount decimal(12,2)")
    cust = spark.createDataFrame([(1, " a ", "  ", "x", dt.datetime(1999, 1, 1)),
                                  (2, "b", "B@X.COM", " ", dt.datetime(1999, 1, 1))],
                                 "customer_id int, name string, email string, city string, signup_date timestamp_ntz")
    prod = spark.createDataFrame([(1, "p", "c", Decimal("-1"))], "product_id int, product_name string, category string, price decimal(10,2)")
    camp = spark.createDataFrame([(1, "c", dt.date(2000, 1, 2), dt.date(2000, 1, 1), "e")],
                                 "campaign_id int, campaign_name string, start_date date, end_date date, channel string")
    got = {(r[0], r[1]): r[2] for r in clean.rejects_by_reason(cust, prod, tx, camp, AS_OF).collect()}
    assert got == {("transactions", "missing_customer"): 1, ("transactions", "future_date"): 1,
                   ("transactions", "duplicate"): 1, ("customers", "missing_email"): 1,
                   ("customers", "blank_city"): 1, ("products", "bad_price"): 1,
                   ("marketing_campaigns", "bad_date_range"): 1}


def test_customer_cleaning_golden(spark):
    df = spark.createDataFrame([(1, "\t Ann \n", "  ANN@MAIL.COM ", " new-york ", dt.datetime(1999, 1, 1)),
                                (1, "Ann", "ann@mail.com", "New-York", dt.datetime(1999, 1, 1)),
                                (2, "Bob", " ", "x", dt.datetime(1999, 1, 1))],
                               "customer_id int, name string, email string, city string, signup_date timestamp_ntz")
    out = clean.clean_customers(df, AS_OF).collect()
    assert [tuple(r) for r in out] == [(1, "Ann", "ann@mail.com", "New-York", dt.datetime(1999, 1, 1))]


def test_default_campaign_only_when_empty(spark):
    schema = "campaign_id int, campaign_name string, start_date date, end_date date, channel string"
    empty = spark.createDataFrame([], schema)
    got = [tuple(r) for r in clean.with_default_campaign(empty).collect()]
    assert got == [(0, "default", dt.date(1900, 1, 1), dt.date(2099, 12, 31), "unknown")]
    one = spark.createDataFrame([(5, "c", dt.date(2000, 1, 1), dt.date(2000, 1, 2), "email")], schema)
    assert [r[0] for r in clean.with_default_campaign(one).collect()] == [5]


def test_tax_tie_rounds_half_up_and_average_exact(spark):
    lines = spark.createDataFrame([(1, 1, 1, Decimal("3.50")), (1, 2, 1, Decimal("0.01")),
                                   (1, 3, 1, Decimal("0.02")), (2, 4, 7, Decimal("0.05"))],
                                  "transaction_id int, transaction_item_id int, quantity int, price decimal(10,2)")
    m = facts.add_basket_metrics(facts.add_measures(lines))
    got = {r["transaction_item_id"]: r for r in m.collect()}
    assert got[1]["tax_amount"] == Decimal("0.35")           # 3.50 * 0.10
    assert got[4]["gross_amount"] == Decimal("0.35")
    assert got[4]["tax_amount"] == Decimal("0.04")           # 0.035 -> 0.04 (half up)
    assert got[4]["total_amount"] == Decimal("0.39")         # 0.385 -> 0.39
    assert got[1]["avg_item_price"] == Decimal("1.18")       # 3.53 / 3 = 1.1766..
    assert got[1]["item_count"] == 3 and got[4]["item_count"] == 7


def test_mean_from_cents_half_up(spark):
    df = spark.createDataFrame([(1, 2), (5, 2), (3, 4), (7, 4)], "s long, n long")
    got = [r[0] for r in df.select(money.mean_from_cents("s", "n")).collect()]
    assert got == [Decimal("0.01"), Decimal("0.03"), Decimal("0.01"), Decimal("0.02")]


def test_date_keys_and_december_roll(spark):
    df = spark.createDataFrame([(dt.datetime(1999, 12, 31, 23, 59),), (dt.datetime(2000, 2, 29, 1, 0),)],
                               "ts timestamp_ntz")
    out = df.select(*dims.date_attributes("ts")).orderBy("date_key").collect()
    assert [(r.date_key, r.day, r.month, r.year, r.quarter, r.month_key) for r in out] == [
        (19991231, 31, 12, 1999, 4, 199912), (20000229, 29, 2, 2000, 1, 200002)]
    b = spark.createDataFrame([(19991231,), (20000229,), (None,)], "transaction_date_key int")
    bounds = sorted(tuple(r) for r in facts.partition_bounds(b).collect())
    assert bounds == [("fact_sales_1999_12", 19991201, 20000101), ("fact_sales_2000_02", 20000201, 20000301)]
    assert dates.key_of(dt.date(2024, 2, 29)) == 20240229


def test_dim_date_one_row_per_day(spark):
    tx = spark.createDataFrame([(dt.datetime(1999, 1, 1, h),) for h in range(5)], "transaction_date timestamp_ntz")
    assert dims.dim_date(tx).count() == 1
    assert dims.distinct_timestamps(tx).count() == 5


def test_surrogate_keys_continue_after_existing(spark):
    existing = spark.createDataFrame([(1, 10), (2, 20)], "customer_key int, customer_id int")
    incoming = spark.createDataFrame([(30, "c"), (10, "a2"), (25, "b")], "customer_id int, name string")
    new = dims.upsert_dimension(incoming, existing, "customer_id", "customer_key")
    assert sorted((r.customer_id, r.customer_key) for r in new.collect()) == [(25, 3), (30, 4)]
