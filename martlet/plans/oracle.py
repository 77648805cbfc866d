"""Independent DuckDB SQL for every registered query (the correctness gate).

Only the raw test tables exist on the DuckDB side, so each statement
carries the fixture views and the shared cleaning steps as CTEs. ``CTES``
maps a name to (dependencies, body); :func:`sql` pulls in what a query
needs, dependencies first.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2000-01-01 00:00:00'"

# Python str.isspace() characters, RE2 syntax (same set as functions.text).
_WS = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^{_WS}+|{_WS}+\\z', '', 'g')"


def title(e: str) -> str:
    """Python str.title(): upper after an uncased character, else lower."""
    return (
        f"CASE WHEN {e} IS NULL THEN NULL ELSE array_to_string(list_transform("
        f"range(1, length({e}) + 1), lambda i: CASE WHEN i > 1 AND regexp_matches("
        f"substr({e}, i - 1, 1), '[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]') THEN lower(substr({e}, i, 1)) "
        f"ELSE upper(substr({e}, i, 1)) END), '') END"
    )


def first_per(key: str, cols: list[str], src: str) -> str:
    order = ", ".join(f"{c} NULLS LAST" for c in cols)
    return (f"SELECT {key}, {', '.join(cols)} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {order}) AS rn__ FROM {src}) WHERE rn__ = 1")


CUST_COLS = ["name", "email", "city", "signup_date"]
PROD_COLS = ["product_name", "category", "price"]
CAMP_COLS = ["campaign_name", "start_date", "end_date", "channel"]
TX_COLS = ["customer_id", "transaction_date", "total_amount"]

_SECS = "to_seconds(CAST((o_orderkey * 7919) % 86400 AS BIGINT))"

CTES: dict[str, tuple[list[str], str]] = {
    # --- fixture views ---------------------------------------------------------
    "customers": ([], f"""
        SELECT CAST(c_custkey AS INTEGER) AS customer_id,
               '  ' || c_name || '  ' AS name,
               CASE WHEN c_custkey % 97 = 3 THEN '   '
                    ELSE ' ' || upper(replace(c_name, '#', '')) || '@MAIL.COM ' END AS email,
               CASE WHEN c_custkey % 101 = 5 THEN ' '
                    ELSE lower(replace(n_name, '_', '-')) END AS city,
               CAST(DATE '1994-01-01' + CAST((c_custkey * 37) % 3000 AS INTEGER) AS TIMESTAMP) AS signup_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "products": ([], """
        SELECT CAST(p_partkey AS INTEGER) AS product_id, ' ' || p_name AS product_name,
               lower(p_type) || ' ' AS category,
               CAST(CASE WHEN p_partkey % 89 = 7 THEN -1.0 WHEN p_partkey % 83 = 9 THEN NULL
                         ELSE p_retailprice END AS DECIMAL(10,2)) AS price
        FROM part"""),
    "transactions": ([], f"""
        SELECT CAST(o_orderkey AS INTEGER) AS transaction_id,
               CAST(CASE WHEN o_orderkey % 211 = 8 THEN NULL ELSE o_custkey END AS INTEGER) AS customer_id,
               o_orderdate + {_SECS} AS transaction_date,
               CAST(CASE WHEN o_orderkey % 53 = 4 THEN -o_totalprice ELSE o_totalprice END AS DECIMAL(12,2)) AS total_amount
        FROM orders
        UNION ALL
        SELECT CAST(o_orderkey AS INTEGER), CAST(o_custkey AS INTEGER), o_orderdate + {_SECS},
               CAST(o_totalprice AS DECIMAL(12,2))
        FROM orders WHERE o_orderkey % 41 = 6"""),
    "transaction_items": ([], """
        SELECT CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                    l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
                    l_shipdate) AS BIGINT) AS transaction_item_id,
               CAST(l_orderkey AS INTEGER) AS transaction_id, CAST(l_partkey AS INTEGER) AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity, CAST(p_retailprice AS DECIMAL(10,2)) AS price
        FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    "marketing_campaigns": ([], """
        SELECT CAST(n_nationkey AS INTEGER) AS campaign_id,
               ' Campaign ' || CAST(n_nationkey AS VARCHAR) AS campaign_name,
               DATE '1995-01-01' + 30 * n_nationkey AS start_date,
               DATE '1995-01-01' + 30 * n_nationkey
                   + CASE WHEN n_nationkey % 11 = 10 THEN -1 ELSE 7 + n_regionkey END AS end_date,
               CASE n_regionkey WHEN 0 THEN 'Email ' WHEN 1 THEN 'Social Media'
                    WHEN 2 THEN ' Google Ads' ELSE 'INFLUENCER' END AS channel
        FROM nation"""),
    "raw_events": ([], """
        SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 29 = 2"""),
    "sale_events": (["raw_events"], """
        SELECT CAST(event_id AS INTEGER) AS transaction_id, CAST(user_id * 11 AS INTEGER) AS customer_id,
               CAST(CASE WHEN event_id % 97 = 11 THEN -1 ELSE event_id % 200 END AS INTEGER) AS product_id,
               CAST(event_id % 6 AS INTEGER) AS quantity, CAST(value AS DECIMAL(10,2)) AS price,
               ts AS transaction_date,
               CAST(CAST(value AS DECIMAL(10,2)) * CAST(event_id % 6 AS INTEGER) AS DECIMAL(12,2)) AS total_amount
        FROM raw_events"""),
    "produced_events": ([], """
        SELECT CAST(event_id AS INTEGER) AS transaction_id, ts AS transaction_date FROM events"""),
    # --- cleaning ------------------------------------------------------------------
    "tx_stage": (["transactions"], """
        SELECT transaction_id, customer_id, TRY_CAST(transaction_date AS TIMESTAMP) AS transaction_date,
               TRY_CAST(total_amount AS DECIMAL(12,2)) AS total_amount FROM transactions"""),
    "tx_pass": (["tx_stage"], f"""
        SELECT * FROM tx_stage WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL
          AND total_amount >= 0 AND transaction_date <= {AS_OF}"""),
    "tx_clean": (["tx_pass"], first_per("transaction_id", TX_COLS, "tx_pass")),
    "cust_stage": (["customers"], f"""
        SELECT customer_id, {strip('name')} AS name,
               nullif(lower({strip('email')}), '') AS email,
               nullif({title(strip('city'))}, '') AS city,
               TRY_CAST(signup_date AS TIMESTAMP) AS signup_date
        FROM customers"""),
    "cust_pass": (["cust_stage"], f"""
        SELECT * FROM cust_stage WHERE customer_id IS NOT NULL AND email IS NOT NULL
          AND signup_date <= {AS_OF} AND city IS NOT NULL"""),
    "cust_clean": (["cust_pass"], first_per("customer_id", CUST_COLS, "(SELECT DISTINCT * FROM cust_pass)")),
    "dim_customer": (["cust_clean"], """
        SELECT CAST(row_number() OVER (ORDER BY customer_id) AS INTEGER) AS customer_key, *
        FROM cust_clean"""),
    "prod_stage": (["products"], f"""
        SELECT product_id, {strip('product_name')} AS product_name,
               {title(strip('category'))} AS category,
               TRY_CAST(price AS DECIMAL(10,2)) AS price
        FROM products"""),
    "prod_pass": (["prod_stage"], """
        SELECT * FROM prod_stage WHERE product_id IS NOT NULL AND price >= 0"""),
    "prod_clean": (["prod_pass"], first_per("product_id", PROD_COLS, "(SELECT DISTINCT * FROM prod_pass)")),
    "dim_product": (["prod_clean"], """
        SELECT CAST(row_number() OVER (ORDER BY product_id) AS INTEGER) AS product_key, *
        FROM prod_clean"""),
    "camp_stage": (["marketing_campaigns"], f"""
        SELECT campaign_id, {strip('campaign_name')} AS campaign_name,
               TRY_CAST(start_date AS DATE) AS start_date, TRY_CAST(end_date AS DATE) AS end_date,
               lower({strip('channel')}) AS channel
        FROM marketing_campaigns"""),
    "camp_pass": (["camp_stage"], """
        SELECT * FROM camp_stage WHERE campaign_id IS NOT NULL AND end_date >= start_date"""),
    "camp_clean": (["camp_pass"], first_per("campaign_id", CAMP_COLS, "(SELECT DISTINCT * FROM camp_pass)")),
    "camp_with_default": (["camp_clean"], """
        SELECT * FROM camp_clean
        UNION ALL
        SELECT 0, 'default', DATE '1900-01-01', DATE '2099-12-31', 'unknown'
        WHERE NOT EXISTS (SELECT 1 FROM camp_clean)"""),
    "dim_campaign": (["camp_with_default"], """
        SELECT CAST(row_number() OVER (ORDER BY campaign_id) AS INTEGER) AS campaign_key, *
        FROM camp_with_default"""),
    "dim_date": (["tx_clean"], """
        SELECT DISTINCT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key,
               d AS full_date, CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month,
               CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(year(d) * 100 + month(d) AS INTEGER) AS month_key
        FROM (SELECT CAST(transaction_date AS DATE) AS d FROM tx_clean)"""),
    # --- fact -------------------------------------------------------------------------
    "header_lines": (["tx_clean", "transaction_items"], """
        SELECT t.transaction_id, t.customer_id, t.transaction_date, i.transaction_item_id,
               i.product_id, i.quantity, i.price
        FROM tx_clean t JOIN transaction_items i ON t.transaction_id = i.transaction_id"""),
    "fact_lines": (["header_lines", "dim_customer", "dim_product"], """
        SELECT CAST(year(l.transaction_date) * 10000 + month(l.transaction_date) * 100
                    + day(l.transaction_date) AS INTEGER) AS transaction_date_key,
               c.customer_key, p.product_key, 1 AS campaign_key, l.transaction_id,
               l.transaction_item_id, l.quantity, l.price AS unit_price
        FROM header_lines l JOIN dim_customer c ON l.customer_id = c.customer_id
        JOIN dim_product p ON l.product_id = p.product_id"""),
    "basket": (["fact_lines"], """
        SELECT transaction_id, CAST(SUM(quantity) AS INTEGER) AS item_count,
               CAST(CAST((2 * SUM(CAST(unit_price * 100 AS BIGINT)) + COUNT(*)) // (2 * COUNT(*))
                    AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) AS avg_item_price
        FROM fact_lines GROUP BY transaction_id"""),
    "fact_sales": (["fact_lines", "basket"], """
        SELECT l.transaction_date_key, l.customer_key, l.product_key, l.campaign_key,
               l.transaction_id, l.transaction_item_id, l.quantity, l.unit_price,
               CAST(l.quantity * l.unit_price AS DECIMAL(12,2)) AS gross_amount,
               CAST(l.quantity * l.unit_price AS DECIMAL(12,2)) AS net_amount,
               CAST(CAST(l.quantity * l.unit_price AS DECIMAL(12,2)) * 0.10 AS DECIMAL(12,2)) AS tax_amount,
               CAST(CAST(l.quantity * l.unit_price AS DECIMAL(12,2)) * 1.10 AS DECIMAL(12,2)) AS total_amount,
               CAST(CAST(l.quantity * l.unit_price AS DECIMAL(12,2)) * 0.60 AS DECIMAL(12,2)) AS cost_amount,
               CAST(CAST(l.quantity * l.unit_price AS DECIMAL(12,2)) * 0.40 AS DECIMAL(12,2)) AS profit_amount,
               b.item_count, b.avg_item_price
        FROM fact_lines l JOIN basket b ON l.transaction_id = b.transaction_id"""),
}


def sql(body: str, *needs: str) -> str:
    """``WITH`` clause holding ``needs`` and their dependencies, then ``body``."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in CTES[name][0]:
            visit(dep)
        ordered.append(name)

    for n in needs:
        visit(n)
    if not ordered:
        return body.strip()
    parts = [f"{n} AS ({CTES[n][1].strip()})" for n in ordered]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
