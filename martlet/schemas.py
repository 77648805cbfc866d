"""Explicit schemas for every table of the mart. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY10 = T.DecimalType(10, 2)
MONEY12 = T.DecimalType(12, 2)
SALES_KEY = T.DecimalType(38, 0)


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- source (order-taking) tables -------------------------------------------
CUSTOMERS = _s(("customer_id", T.IntegerType()), ("name", T.StringType()),
               ("email", T.StringType()), ("city", T.StringType()),
               ("signup_date", T.TimestampNTZType()))
PRODUCTS = _s(("product_id", T.IntegerType()), ("product_name", T.StringType()),
              ("category", T.StringType()), ("price", MONEY10))
TRANSACTIONS = _s(("transaction_id", T.IntegerType()), ("customer_id", T.IntegerType()),
                  ("transaction_date", T.TimestampNTZType()), ("total_amount", MONEY12))
TRANSACTION_ITEMS = _s(("transaction_item_id", T.LongType()),
                       ("transaction_id", T.IntegerType()), ("product_id", T.IntegerType()),
                       ("quantity", T.IntegerType()), ("price", MONEY10))
MARKETING_CAMPAIGNS = _s(("campaign_id", T.IntegerType()), ("campaign_name", T.StringType()),
                         ("start_date", T.DateType()), ("end_date", T.DateType()),
                         ("channel", T.StringType()))

SOURCES = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "transactions": TRANSACTIONS,
    "transaction_items": TRANSACTION_ITEMS,
    "marketing_campaigns": MARKETING_CAMPAIGNS,
}

# Primary keys of the source tables (used by audits and incremental reads).
SOURCE_KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "transactions": "transaction_id",
    "transaction_items": "transaction_item_id",
    "marketing_campaigns": "campaign_id",
}

# --- warehouse ----------------------------------------------------------------
DIM_DATE = _s(("date_key", T.IntegerType()), ("full_date", T.DateType()),
              ("day", T.IntegerType()), ("month", T.IntegerType()),
              ("year", T.IntegerType()), ("quarter", T.IntegerType()),
              ("month_key", T.IntegerType()))
DIM_CUSTOMER = _s(("customer_key", T.IntegerType()), *[(f.name, f.dataType) for f in CUSTOMERS])
DIM_PRODUCT = _s(("product_key", T.IntegerType()), *[(f.name, f.dataType) for f in PRODUCTS])
DIM_CAMPAIGN = _s(("campaign_key", T.IntegerType()),
                  *[(f.name, f.dataType) for f in MARKETING_CAMPAIGNS])

FACT_COLUMNS = [
    "transaction_date_key", "customer_key", "product_key", "campaign_key",
    "transaction_id", "transaction_item_id", "quantity", "unit_price",
    "gross_amount", "net_amount", "tax_amount", "total_amount", "cost_amount",
    "profit_amount", "item_count", "avg_item_price",
]
FACT_SALES = _s(("sales_key", SALES_KEY),
                ("transaction_date_key", T.IntegerType()), ("customer_key", T.IntegerType()),
                ("product_key", T.IntegerType()), ("campaign_key", T.IntegerType()),
                ("transaction_id", T.IntegerType()), ("transaction_item_id", T.LongType()),
                ("quantity", T.IntegerType()), ("unit_price", MONEY10),
                ("gross_amount", MONEY12), ("net_amount", MONEY12), ("tax_amount", MONEY12),
                ("total_amount", MONEY12), ("cost_amount", MONEY12), ("profit_amount", MONEY12),
                ("item_count", T.IntegerType()), ("avg_item_price", MONEY10),
                ("month_key", T.IntegerType()))
# Natural key of a fact line; the date key is part of it (a changed
# transaction date loads the line again).
FACT_LINE_KEY = ["transaction_id", "transaction_item_id", "transaction_date_key"]

# --- sale event (one JSON object per message) ---------------------------------
SALE_EVENT = _s(("transaction_id", T.IntegerType()), ("customer_id", T.IntegerType()),
                ("product_id", T.IntegerType()), ("quantity", T.IntegerType()),
                ("price", MONEY10), ("transaction_date", T.StringType()),
                ("total_amount", MONEY12))
EVENT_FIELDS = [f.name for f in SALE_EVENT]
# Wire format of transaction_date (UTC wall clock).
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
