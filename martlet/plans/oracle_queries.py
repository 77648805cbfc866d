"""DuckDB twin of every registered query (same names, same columns)."""

from __future__ import annotations

from martlet.plans.oracle import AS_OF, CTES, TX_COLS, first_per, sql, strip, title

ORACLE: dict[str, str] = {}


def oracle(name: str, body: str, *needs: str) -> None:
    ORACLE[name] = sql(body, *needs)


# --- cleaning ----------------------------------------------------------------------
oracle("clean_transactions", "SELECT * FROM tx_clean", "tx_clean")
oracle("dim_customer", "SELECT * FROM dim_customer", "dim_customer")
oracle("dim_product", "SELECT * FROM dim_product", "dim_product")
oracle("dim_campaign", "SELECT * FROM dim_campaign", "dim_campaign")
oracle("dim_date", "SELECT * FROM dim_date", "dim_date")

# --- fact ---------------------------------------------------------------------------
oracle("join_header_lines", """
    SELECT transaction_item_id, transaction_id, customer_id, product_id, transaction_date
    FROM header_lines""", "header_lines")
oracle("fact_measures", """
    SELECT transaction_item_id, CAST(price AS DECIMAL(10,2)) AS unit_price,
           CAST(quantity * price AS DECIMAL(12,2)) AS gross_amount,
           CAST(quantity * price AS DECIMAL(12,2)) AS net_amount,
           CAST(CAST(quantity * price AS DECIMAL(12,2)) * 0.10 AS DECIMAL(12,2)) AS tax_amount,
           CAST(CAST(quantity * price AS DECIMAL(12,2)) * 1.10 AS DECIMAL(12,2)) AS total_amount,
           CAST(CAST(quantity * price AS DECIMAL(12,2)) * 0.60 AS DECIMAL(12,2)) AS cost_amount,
           CAST(CAST(quantity * price AS DECIMAL(12,2)) * 0.40 AS DECIMAL(12,2)) AS profit_amount
    FROM header_lines""", "header_lines")
oracle("fact_sales", "SELECT * FROM fact_sales", "fact_sales")
oracle("lookup_customer", """
    SELECT l.transaction_item_id, c.customer_key
    FROM header_lines l JOIN dim_customer c ON l.customer_id = c.customer_id""",
       "header_lines", "dim_customer")
oracle("lookup_product", """
    SELECT l.transaction_item_id, p.product_key
    FROM header_lines l JOIN dim_product p ON l.product_id = p.product_id""",
       "header_lines", "dim_product")
oracle("lookup_date", """
    SELECT l.transaction_item_id, d.date_key
    FROM header_lines l JOIN dim_date d ON CAST(l.transaction_date AS DATE) = d.full_date""",
       "header_lines", "dim_date")
oracle("basket_metrics", "SELECT transaction_item_id, item_count, avg_item_price FROM fact_sales",
       "fact_sales")
oracle("fact_incremental", "SELECT * FROM fact_sales WHERE transaction_date_key >= 19980101",
       "fact_sales")
oracle("fact_after_append", """
    SELECT CAST(transaction_date_key // 100 AS INTEGER) AS month_key, COUNT(*) AS n,
           CAST(SUM(gross_amount) AS DECIMAL(18,2)) AS gross
    FROM fact_sales GROUP BY 1""", "fact_sales")
oracle("fact_partition_bounds", """
    SELECT 'fact_sales_' || lpad(CAST(m // 100 AS VARCHAR), 4, '0') || '_'
               || lpad(CAST(m % 100 AS VARCHAR), 2, '0') AS partition_name,
           CAST(m * 100 + 1 AS INTEGER) AS start_key,
           CAST(CASE WHEN m % 100 = 12 THEN (m // 100 + 1) * 10000 + 101 ELSE (m + 1) * 100 + 1 END
                AS INTEGER) AS end_key
    FROM (SELECT DISTINCT transaction_date_key // 100 AS m FROM fact_sales)""", "fact_sales")

# --- scans, coercions, text -----------------------------------------------------------------
oracle("scan_splits", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows, CAST(SUM({k}) AS DECIMAL(38,0)) AS key_sum, FALSE AS uneven FROM {t}"
    for t, k in [("customers", "customer_id"), ("products", "product_id"), ("transactions", "transaction_id"),
                 ("transaction_items", "transaction_item_id")]),
       "customers", "products", "transactions", "transaction_items")
oracle("scan_snapshot_counts", """
    SELECT 'customers' AS table_name, COUNT(*) AS n_rows FROM customers
    UNION ALL SELECT 'products', COUNT(*) FROM products
    UNION ALL SELECT 'transactions', COUNT(*) FROM transactions
    UNION ALL SELECT 'transaction_items', COUNT(*) FROM transaction_items
    UNION ALL SELECT 'marketing_campaigns', COUNT(*) FROM marketing_campaigns""",
       "customers", "products", "transactions", "transaction_items", "marketing_campaigns")
oracle("coerce_numeric", """
    SELECT transaction_id, TRY_CAST(CASE WHEN transaction_id % 17 = 0 THEN 'bad'
           ELSE CAST(total_amount AS VARCHAR) END AS DECIMAL(12,2)) AS value
    FROM transactions""", "transactions")
oracle("coerce_timestamp", """
    SELECT transaction_id, TRY_CAST(CASE WHEN transaction_id % 17 = 0 THEN 'bad'
           ELSE CAST(transaction_date AS VARCHAR) END AS TIMESTAMP) AS value
    FROM transactions""", "transactions")
oracle("clean_strip", f"SELECT customer_id, {strip('name')} AS name FROM customers", "customers")
oracle("clean_lower", f"SELECT customer_id, lower({strip('email')}) AS email FROM customers", "customers")
oracle("clean_title", f"SELECT customer_id, {title(strip('city'))} AS city FROM customers", "customers")
oracle("clean_title_category",
       f"SELECT product_id, {title(strip('category'))} AS category FROM products", "products")
oracle("blank_to_null", "SELECT customer_id, email, city FROM cust_stage", "cust_stage")
oracle("dim_campaign_default", """
    SELECT * FROM (SELECT * FROM camp_clean WHERE start_date > DATE '2000-01-01')
    UNION ALL
    SELECT 0, 'default', DATE '1900-01-01', DATE '2099-12-31', 'unknown'
    WHERE NOT EXISTS (SELECT 1 FROM camp_clean WHERE start_date > DATE '2000-01-01')""",
       "camp_clean")

# --- de-duplication --------------------------------------------------------------------------
oracle("dedupe_by_key", first_per("transaction_id", TX_COLS, "transactions"), "transactions")
oracle("dedupe_full_row", "SELECT DISTINCT * FROM transactions", "transactions")
oracle("distinct_timestamps", "SELECT DISTINCT transaction_date FROM tx_clean", "tx_clean")
oracle("dim_upsert_new_rows", """
    SELECT * FROM cust_clean WHERE NOT (signup_date < TIMESTAMP '1996-01-01 00:00:00')""", "cust_clean")
oracle("surrogate_keys", """
    SELECT customer_id, CAST(row_number() OVER (ORDER BY customer_id) AS INTEGER) AS customer_key
    FROM cust_clean WHERE signup_date < TIMESTAMP '1996-01-01 00:00:00'
    UNION ALL
    SELECT customer_id, CAST((SELECT COUNT(*) FROM cust_clean WHERE signup_date < TIMESTAMP '1996-01-01 00:00:00')
                             + row_number() OVER (ORDER BY customer_id) AS INTEGER)
    FROM cust_clean WHERE NOT (signup_date < TIMESTAMP '1996-01-01 00:00:00')""", "cust_clean")

# --- events ------------------------------------------------------------------------------------
oracle("stream_reference_data", """
    SELECT 'customer' AS kind, COUNT(customer_id) AS n, MIN(customer_id) AS min_id,
           MAX(customer_id) AS max_id FROM customers
    UNION ALL
    SELECT 'product', COUNT(product_id), MIN(product_id), MAX(product_id) FROM products""",
       "customers", "products")
PAYLOAD = """'{"transaction_id":' || transaction_id || ',"customer_id":' || customer_id
    || ',"product_id":' || product_id || ',"quantity":' || quantity
    || ',"price":' || CAST(price AS VARCHAR)
    || ',"transaction_date":"' || strftime(transaction_date, '%Y-%m-%d %H:%M:%S')
    || '","total_amount":' || CAST(total_amount AS VARCHAR) || '}'"""
oracle("events_to_json", f"SELECT transaction_id, {PAYLOAD} AS payload FROM sale_events", "sale_events")
oracle("events_from_json", """
    SELECT transaction_id, customer_id, product_id, quantity, price,
           date_trunc('second', transaction_date) AS transaction_date, total_amount
    FROM sale_events""", "sale_events")
oracle("event_amounts", """
    SELECT transaction_id, CAST(round(price * quantity, 2) AS DECIMAL(12,2)) AS total_amount
    FROM sale_events""", "sale_events")
CTES["ev_checked"] = (["sale_events", "customers", "products"], """
    SELECT e.*, CASE WHEN e.transaction_id IS NULL OR e.transaction_date IS NULL THEN 'malformed'
                     WHEN e.customer_id IS NULL OR e.product_id IS NULL OR e.quantity IS NULL
                          OR e.price IS NULL OR e.total_amount IS NULL THEN 'missing_field'
                     WHEN NOT e.quantity > 0 THEN 'quantity'
                     WHEN e.price < 0 THEN 'price'
                     WHEN e.total_amount < 0 THEN 'total_amount'
                     WHEN e.customer_id NOT IN (SELECT customer_id FROM customers WHERE customer_id IS NOT NULL)
                          OR e.customer_id IS NULL THEN 'unknown_customer'
                     WHEN e.product_id NOT IN (SELECT product_id FROM products WHERE product_id IS NOT NULL)
                          OR e.product_id IS NULL THEN 'unknown_product' END AS reason
    FROM sale_events e""")
CTES["ev_ok"] = (["ev_checked"], """
    SELECT transaction_id, customer_id, product_id, quantity, price, transaction_date, total_amount
    FROM ev_checked WHERE reason IS NULL""")
oracle("stream_accepted", "SELECT * FROM ev_ok", "ev_ok")
oracle("stream_rejects", "SELECT transaction_id, reason FROM ev_checked WHERE reason IS NOT NULL",
       "ev_checked")
oracle("stream_headers", first_per("transaction_id", ["customer_id", "transaction_date", "total_amount"],
                                   "ev_ok"), "ev_ok")
oracle("stream_lines", "SELECT DISTINCT * FROM ev_ok", "ev_ok")
CTES["minutes"] = (["produced_events"], """
    SELECT strftime(date_trunc('minute', transaction_date), '%Y-%m-%d %H:%M:00') AS minute,
           COUNT(*) AS n
    FROM produced_events GROUP BY 1""")
CTES["minutes_done"] = (["minutes"], """
    SELECT * FROM minutes WHERE minute < (SELECT MAX(minute) FROM minutes)""")
oracle("minute_counts", "SELECT * FROM minutes", "minutes")
oracle("minute_counts_completed", "SELECT * FROM minutes_done", "minutes_done")
oracle("minute_count_lines", "SELECT minute || ' -> ' || n || ' transactions' AS line FROM minutes_done",
       "minutes_done")
oracle("id_high_water", """
    SELECT CAST(greatest(coalesce((SELECT MAX(transaction_id) FROM transactions), 0),
                         coalesce((SELECT MAX(transaction_id) FROM transaction_items), 0)) AS BIGINT) AS last_id,
           CAST(greatest(coalesce((SELECT MAX(transaction_id) FROM transactions), 0),
                         coalesce((SELECT MAX(transaction_id) FROM transaction_items), 0)) + 1 AS BIGINT) AS next_id""",
       "transactions", "transaction_items")
oracle("load_summary", """
    SELECT 'dim_customer' AS table_name, COUNT(*) AS candidates, COUNT(DISTINCT customer_id) AS inserted
    FROM (SELECT DISTINCT * FROM cust_pass)
    UNION ALL SELECT 'dim_product', COUNT(*), COUNT(DISTINCT product_id) FROM (SELECT DISTINCT * FROM prod_pass)
    UNION ALL SELECT 'dim_campaign', COUNT(*), COUNT(DISTINCT campaign_id) FROM (SELECT DISTINCT * FROM camp_pass)
    UNION ALL SELECT 'dim_date', COUNT(DISTINCT transaction_date), COUNT(DISTINCT CAST(transaction_date AS DATE))
              FROM tx_clean
    UNION ALL SELECT 'fact_sales', COUNT(*), COUNT(DISTINCT transaction_item_id) FROM fact_sales""",
       "cust_pass", "prod_pass", "camp_pass", "tx_clean", "fact_sales")

# --- seed operators ------------------------------------------------------------------------------
CTES["line_totals"] = (["transaction_items"], """
    SELECT transaction_id, CAST(SUM(quantity * price) AS DECIMAL(12,2)) AS total
    FROM transaction_items GROUP BY transaction_id""")
CTES["headers_src"] = (["transactions"], first_per("transaction_id", TX_COLS, "transactions"))
oracle("header_total", "SELECT * FROM line_totals", "line_totals")
oracle("header_total_update", """
    SELECT h.transaction_id, h.customer_id, h.transaction_date,
           CAST(coalesce(t.total, h.total_amount) AS DECIMAL(12,2)) AS total_amount
    FROM headers_src h LEFT JOIN line_totals t ON h.transaction_id = t.transaction_id""",
       "headers_src", "line_totals")
oracle("audit_header_total", """
    SELECT h.transaction_id, h.total_amount AS header_total, t.total AS lines_total
    FROM headers_src h JOIN line_totals t ON h.transaction_id = t.transaction_id
    WHERE h.total_amount <> t.total""", "headers_src", "line_totals")
oracle("running_customer_spend", """
    SELECT customer_id, transaction_id,
           CAST(SUM(total_amount) OVER (PARTITION BY customer_id ORDER BY transaction_date, transaction_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS running_total
    FROM tx_clean""", "tx_clean")
ORACLE["running_spend_loads"] = ORACLE["running_customer_spend"]
oracle("campaign_calendar", """
    SELECT campaign_id, CAST(d AS DATE) AS active_date
    FROM camp_clean, unnest(generate_series(CAST(start_date AS TIMESTAMP), CAST(end_date AS TIMESTAMP),
                                            INTERVAL 1 DAY)) AS g(d)""", "camp_clean")
oracle("customer_tiers", """
    SELECT customer_id,
           CASE WHEN customer_id <= 20 THEN 'frequent' WHEN customer_id <= 30 THEN 'regular'
                ELSE 'occasional' END AS tier,
           CAST(CASE WHEN customer_id <= 20 THEN 15 WHEN customer_id <= 30 THEN 8 ELSE 4 END AS INTEGER) AS visits
    FROM customers""", "customers")
oracle("topn_per_group", """
    SELECT transaction_id, transaction_item_id, price, rank FROM (
      SELECT transaction_id, transaction_item_id, price, customer_id,
             CAST(row_number() OVER (PARTITION BY transaction_id ORDER BY price DESC, transaction_item_id)
                  AS INTEGER) AS rank
      FROM header_lines)
    WHERE rank <= CASE WHEN customer_id <= 20 THEN 3 ELSE 2 END""", "header_lines")

# --- audits ----------------------------------------------------------------------------------------
_SOURCE_COLS = {
    "customers": ["customer_id", "name", "email", "city", "signup_date"],
    "products": ["product_id", "product_name", "category", "price"],
    "transactions": ["transaction_id", "customer_id", "transaction_date", "total_amount"],
    "transaction_items": ["transaction_item_id", "transaction_id", "product_id", "quantity", "price"],
    "marketing_campaigns": ["campaign_id", "campaign_name", "start_date", "end_date", "channel"],
}
oracle("audit_nulls", "\nUNION ALL\n".join(
    f"SELECT '{t}.{c} not null' AS rule, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_violations FROM {t}"
    for t, cols in _SOURCE_COLS.items() for c in cols), *_SOURCE_COLS)


def _dups(rule: str, table: str, key: str) -> str:
    return (f"SELECT '{rule}' AS rule, (SELECT COUNT(*) FROM (SELECT {key} FROM {table} "
            f"WHERE {key} IS NOT NULL GROUP BY {key} HAVING COUNT(*) > 1)) AS n_violations")


oracle("audit_unique_ids", "\nUNION ALL\n".join(_dups(f"{t}.{cols[0]} unique", t, cols[0]) for t, cols in _SOURCE_COLS.items()),
       *_SOURCE_COLS)
oracle("audit_unique", "\nUNION ALL\n".join([
    _dups("customers.customer_id unique", "customers", "customer_id"),
    _dups("customers.email unique", "customers", "email"),
    _dups("products.product_id unique", "products", "product_id"),
    _dups("transactions.transaction_id unique", "transactions", "transaction_id"),
    _dups("transaction_items.transaction_item_id unique", "transaction_items", "transaction_item_id"),
    _dups("marketing_campaigns.campaign_id unique", "marketing_campaigns", "campaign_id"),
    _dups("dim_customer.customer_id unique", "dim_customer", "customer_id"),
    _dups("dim_product.product_id unique", "dim_product", "product_id"),
    _dups("dim_campaign.campaign_id unique", "dim_campaign", "campaign_id"),
    _dups("dim_date.date_key unique", "dim_date", "date_key"),
]), *_SOURCE_COLS, "dim_customer", "dim_product", "dim_campaign", "dim_date")
oracle("audit_fact_unique", """
    SELECT 'fact_sales line unique' AS rule, (SELECT COUNT(*) FROM (
        SELECT 1 FROM fact_sales GROUP BY transaction_id, transaction_item_id, transaction_date_key
        HAVING COUNT(*) > 1)) AS n_violations""", "fact_sales")
oracle("audit_checks", """
    SELECT 'products.price >= 0' AS rule, COUNT(*) FILTER (WHERE NOT (price >= 0)) AS n_violations FROM products
    UNION ALL SELECT 'transactions.total_amount >= 0', COUNT(*) FILTER (WHERE NOT (total_amount >= 0)) FROM transactions
    UNION ALL SELECT 'transaction_items.quantity > 0', COUNT(*) FILTER (WHERE NOT (quantity > 0)) FROM transaction_items
    UNION ALL SELECT 'transaction_items.price >= 0', COUNT(*) FILTER (WHERE NOT (price >= 0)) FROM transaction_items
    UNION ALL SELECT 'marketing_campaigns.end_date >= start_date', COUNT(*) FILTER (WHERE NOT (end_date >= start_date))
              FROM marketing_campaigns""", *_SOURCE_COLS)
oracle("audit_gross", """
    SELECT 'fact_sales.gross_amount = quantity * unit_price' AS rule,
           COUNT(*) FILTER (WHERE NOT (gross_amount = quantity * unit_price)) AS n_violations
    FROM fact_sales""", "fact_sales")
_LIMITS = {"customers": {"name": 100, "email": 150, "city": 100},
           "products": {"product_name": 150, "category": 100},
           "marketing_campaigns": {"campaign_name": 150, "channel": 50}}
oracle("audit_lengths", "\nUNION ALL\n".join(
    f"SELECT '{t}.{c} length <= {n}' AS rule, COUNT(*) FILTER (WHERE length({c}) > {n}) AS n_violations FROM {t}"
    for t, lim in _LIMITS.items() for c, n in lim.items()), *_LIMITS)
oracle("audit_write_rules", "\nUNION ALL\n".join([
    *[f"SELECT '{t}.{c} not null' AS rule, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_violations FROM {t}"
      for t, cols in _SOURCE_COLS.items() for c in cols],
    *[f"SELECT '{t}.{c} length <= {n}', COUNT(*) FILTER (WHERE length({c}) > {n}) FROM {t}"
      for t, lim in _LIMITS.items() for c, n in lim.items()],
    "SELECT 'products.price >= 0', COUNT(*) FILTER (WHERE price < 0) FROM products",
    "SELECT 'transactions.total_amount >= 0', COUNT(*) FILTER (WHERE total_amount < 0) FROM transactions",
    "SELECT 'transaction_items.quantity > 0', COUNT(*) FILTER (WHERE quantity <= 0) FROM transaction_items",
    "SELECT 'transaction_items.price >= 0', COUNT(*) FILTER (WHERE price < 0) FROM transaction_items",
    "SELECT 'marketing_campaigns.end_date >= start_date', COUNT(*) FILTER (WHERE end_date < start_date) FROM marketing_campaigns",
]), *_SOURCE_COLS)
oracle("audit_fact_fk", """
    SELECT 'fact_sales.transaction_date_key -> dim_date' AS rule,
           COUNT(*) FILTER (WHERE transaction_date_key NOT IN (SELECT date_key FROM dim_date)) AS n_violations
    FROM fact_sales
    UNION ALL SELECT 'fact_sales.customer_key -> dim_customer',
           COUNT(*) FILTER (WHERE customer_key NOT IN (SELECT customer_key FROM dim_customer)) FROM fact_sales
    UNION ALL SELECT 'fact_sales.product_key -> dim_product',
           COUNT(*) FILTER (WHERE product_key NOT IN (SELECT product_key FROM dim_product)) FROM fact_sales
    UNION ALL SELECT 'fact_sales.campaign_key -> dim_campaign',
           COUNT(*) FILTER (WHERE campaign_key NOT IN (SELECT campaign_key FROM dim_campaign)) FROM fact_sales""",
       "fact_sales", "dim_date", "dim_customer", "dim_product", "dim_campaign")
oracle("audit_precision", """
    SELECT 'transaction_items line amount fits decimal(12,2)' AS rule,
           COUNT(*) FILTER (WHERE TRY_CAST(quantity * price AS DECIMAL(12,2)) IS NULL) AS n_violations
    FROM transaction_items
    UNION ALL SELECT 'fact_sales.total_amount fits decimal(12,2)',
           COUNT(*) FILTER (WHERE TRY_CAST(quantity * price * 1.10 AS DECIMAL(12,2)) IS NULL) FROM transaction_items
    UNION ALL SELECT 'sale_events.total_amount fits decimal(12,2)',
           COUNT(*) FILTER (WHERE TRY_CAST(price * quantity AS DECIMAL(12,2)) IS NULL) FROM sale_events""",
       "transaction_items", "sale_events")
oracle("orphan_lines", """
    SELECT transaction_item_id, transaction_id FROM transaction_items
    WHERE transaction_id NOT IN (SELECT transaction_id FROM tx_clean)""", "transaction_items", "tx_clean")


def _reasons(table: str, stage: str, key: str, rules: list[tuple[str, str]]) -> str:
    case = " ".join(f"WHEN NOT coalesce({pred}, false) THEN '{name}'" for name, pred in rules)
    return f"""
    SELECT '{table}' AS table_name, reason, COUNT(*) AS n FROM (
        SELECT CASE {case} END AS reason FROM {stage}) WHERE reason IS NOT NULL GROUP BY reason
    UNION ALL
    SELECT '{table}', 'duplicate', n FROM (
        SELECT CAST(SUM(c - 1) AS BIGINT) AS n FROM (SELECT COUNT(*) AS c FROM {stage}
        WHERE {' AND '.join(f'coalesce({p}, false)' for _, p in rules)} GROUP BY {key})) WHERE n > 0"""


oracle("rejects_by_reason", "\nUNION ALL\n".join([
    _reasons("transactions", "tx_stage", "transaction_id", [
        ("missing_id", "transaction_id IS NOT NULL"), ("missing_customer", "customer_id IS NOT NULL"),
        ("bad_amount", "total_amount >= 0"), ("future_date", "transaction_date <= " + AS_OF)]),
    _reasons("customers", "cust_stage", "customer_id", [
        ("missing_id", "customer_id IS NOT NULL"), ("missing_email", "email IS NOT NULL"),
        ("future_signup", "signup_date <= " + AS_OF), ("blank_city", "city IS NOT NULL")]),
    _reasons("products", "prod_stage", "product_id", [
        ("missing_id", "product_id IS NOT NULL"), ("bad_price", "price >= 0")]),
    _reasons("marketing_campaigns", "camp_stage", "campaign_id", [
        ("missing_id", "campaign_id IS NOT NULL"), ("bad_date_range", "end_date >= start_date")]),
]), "tx_stage", "cust_stage", "prod_stage", "camp_stage")

# --- star queries ----------------------------------------------------------------------------------
oracle("sales_by_quarter", """
    SELECT d.year, d.quarter, COUNT(*) AS n_lines, CAST(SUM(f.gross_amount) AS DECIMAL(18,2)) AS gross,
           CAST(SUM(f.profit_amount) AS DECIMAL(18,2)) AS profit
    FROM fact_sales f JOIN dim_date d ON f.transaction_date_key = d.date_key
    GROUP BY d.year, d.quarter""", "fact_sales", "dim_date")
oracle("sales_by_city_category", """
    SELECT c.city, p.category, COUNT(*) AS n_lines, CAST(SUM(f.gross_amount) AS DECIMAL(18,2)) AS gross,
           CAST(SUM(f.profit_amount) AS DECIMAL(18,2)) AS profit
    FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key
    JOIN dim_product p ON f.product_key = p.product_key
    GROUP BY c.city, p.category""", "fact_sales", "dim_customer", "dim_product")
oracle("sales_date_range", """
    SELECT CAST(transaction_date_key // 100 AS INTEGER) AS month_key, COUNT(*) AS n_lines,
           CAST(SUM(gross_amount) AS DECIMAL(18,2)) AS gross, CAST(SUM(profit_amount) AS DECIMAL(18,2)) AS profit
    FROM fact_sales WHERE transaction_date_key BETWEEN 19960315 AND 19970630
    GROUP BY 1""", "fact_sales")
_SUMS = """COUNT(*) AS n_lines, CAST(SUM(quantity) AS BIGINT) AS quantity,
           CAST(SUM(gross_amount) AS DECIMAL(28,2)) AS gross, CAST(SUM(profit_amount) AS DECIMAL(28,2)) AS profit"""
_PERIODS = """SELECT *, transaction_date_key AS day, CAST(transaction_date_key // 100 AS INTEGER) AS month,
           CAST((transaction_date_key // 10000) * 10 + (transaction_date_key // 100 % 100 + 2) // 3 AS INTEGER) AS quarter FROM fact_sales"""
oracle("sales_rollup", f"""
    SELECT CASE WHEN customer_key IS NOT NULL THEN 'customer' WHEN product_key IS NOT NULL THEN 'product'
                WHEN campaign_key IS NOT NULL THEN 'campaign' ELSE 'all' END AS slice,
           CAST(coalesce(customer_key, product_key, campaign_key) AS BIGINT) AS member,
           CASE WHEN day IS NOT NULL THEN 'day' WHEN month IS NOT NULL THEN 'month' ELSE 'quarter' END AS level,
           coalesce(day, month, quarter) AS period, {_SUMS}
    FROM ({_PERIODS}) GROUP BY GROUPING SETS ((day), (month), (quarter), (month, customer_key), (quarter, customer_key),
         (month, product_key), (quarter, product_key), (month, campaign_key), (quarter, campaign_key))""", "fact_sales")
oracle("sales_by_campaign", f"""
    SELECT campaign_id, campaign_name, quarter AS quarter_key, {_SUMS}
    FROM ({_PERIODS}) JOIN dim_campaign USING (campaign_key) GROUP BY campaign_id, campaign_name, quarter""", "fact_sales", "dim_campaign")
