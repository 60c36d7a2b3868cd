"""DuckDB SQL for the star views over the driver tables (the oracle side).

The Spark side builds the same views with the DataFrame API in
``sources.binding``; these strings are an independent restatement used only
by ``oracle_sql()``.  ``R(x, n)`` renders the rounding rule both engines
share: ``CAST(round(CAST(x AS DECIMAL(38,6)), n) AS DOUBLE)``.
"""

from __future__ import annotations

import re

AS_OF_SQL = "TIMESTAMP '2001-08-02 00:00:00'"


def R(expr: str, n: int) -> str:
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38,6)), {n}) AS DOUBLE)"


def HE(expr: str, n: int) -> str:
    """numpy-style rounding of a DOUBLE: round_even(x * 10^n, 0) / 10^n."""
    scale = float(10 ** n)
    return f"(round_even(CAST(({expr}) AS DOUBLE) * {scale}, 0) / {scale})"


def PCT(num: str, den: str, n: int = 1) -> str:
    return R(f"({num}) * 100.0 / NULLIF(({den}), 0)", n)


def DAYS(later: str, earlier: str) -> str:
    return f"CAST(extract(day FROM (({later}) - ({earlier}))) AS BIGINT)"


VIEWS = {
    "dim_customers": """
        SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id, c.c_name AS customer_unique_id,
               CAST(NULL AS VARCHAR) AS zip_code, c.c_mktsegment AS city, n.n_name AS state
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "dim_sellers": """
        SELECT CAST(s.s_suppkey AS VARCHAR) AS seller_id, CAST(NULL AS VARCHAR) AS zip_code,
               s.s_name AS city, n.n_name AS state
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "dim_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               CASE WHEN p_brand = 'Brand#7' THEN NULL ELSE p_brand END AS category_name_english,
               CAST(length(p_name) AS INTEGER) AS name_length,
               CAST(length(p_type) AS INTEGER) AS description_length,
               CAST(p_size % 5 + 1 AS INTEGER) AS photos_qty,
               CAST(p_size * 100 AS DECIMAL(10,2)) AS weight_g
        FROM part""",
    "dim_date": """
        SELECT date_key, CAST(year(date_key) AS INTEGER) AS year,
               CAST(quarter(date_key) AS INTEGER) AS quarter,
               CAST(month(date_key) AS INTEGER) AS month,
               rpad(strftime(date_key, '%B'), 9, ' ') AS month_name,
               CAST(weekofyear(date_key) AS INTEGER) AS week,
               CAST(dayofweek(date_key) AS INTEGER) AS day_of_week,
               dayofweek(date_key) IN (0, 6) AS is_weekend
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_key FROM orders
              WHERE o_orderdate IS NOT NULL)""",
    "fact_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                    WHEN 'P' THEN 'processing' ELSE lower(o_orderstatus) END AS order_status,
               o_orderdate AS purchase_date, o_orderdate AS approved_date,
               o_orderdate AS delivered_carrier_date,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL
                    ELSE o_orderdate + to_days(CAST(o_orderkey * 7 % 40 AS INTEGER))
                                     + to_hours(CAST(o_orderkey % 24 AS INTEGER)) END
                   AS delivered_customer_date,
               o_orderdate + INTERVAL 20 DAY AS estimated_delivery_date,
               CAST(o_orderdate AS DATE) AS purchase_date_key
        FROM orders""",
    "fact_order_items": """
        SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS item_id,
               CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(l_suppkey AS VARCHAR) AS seller_id, l_shipdate AS shipping_date,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CAST(l_quantity AS DECIMAL(12,2)) AS freight_value
        FROM lineitem""",
    "fact_payments": """
        SELECT CAST(o_orderkey * 2 AS BIGINT) AS payment_id, CAST(o_orderkey AS VARCHAR) AS order_id,
               1 AS payment_sequential, o_orderpriority AS payment_type,
               CAST(o_orderkey % 10 + 1 AS INTEGER) AS installments,
               CAST(o_totalprice AS DECIMAL(12,2)) AS payment_value
        FROM orders WHERE o_orderkey % 97 <> 0
        UNION ALL
        SELECT CAST(o_orderkey * 2 + 1 AS BIGINT), CAST(o_orderkey AS VARCHAR), 2, 'voucher', 1,
               CAST(10.00 AS DECIMAL(12,2))
        FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 5 = 0""",
    "fact_reviews": """
        SELECT CAST(o_orderkey AS VARCHAR) AS review_id, CAST(o_orderkey AS VARCHAR) AS order_id,
               CAST(o_orderkey % 5 + 1 AS INTEGER) AS review_score,
               o_orderdate + INTERVAL 21 DAY AS review_created_date,
               o_orderdate + INTERVAL 23 DAY AS answer_date
        FROM orders WHERE o_orderkey % 3 <> 0
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR) || 'b', CAST(o_orderkey AS VARCHAR), 5,
               o_orderdate + INTERVAL 21 DAY, o_orderdate + INTERVAL 23 DAY
        FROM orders WHERE o_orderkey % 50 = 1""",
    "ml_churn_predictions": """
        SELECT c_name AS customer_unique_id,
               CASE c_custkey % 4 WHEN 0 THEN 'Champions' WHEN 1 THEN 'At Risk' WHEN 2 THEN 'Lost'
                    ELSE 'Needs Attention' END AS rfm_segment,
               CAST(c_custkey % 400 AS DECIMAL(10,2)) AS recency_days,
               CAST(c_custkey % 5 + 1 AS INTEGER) AS frequency,
               CAST(c_acctbal AS DECIMAL(12,2)) AS monetary,
               CAST((c_custkey % 1000) / 1000.0 AS DECIMAL(6,4)) AS churn_probability,
               CASE WHEN (c_custkey % 1000) / 1000.0 <= 0.33 THEN 'Low'
                    WHEN (c_custkey % 1000) / 1000.0 <= 0.66 THEN 'Medium' ELSE 'High' END AS churn_label
        FROM customer WHERE c_custkey % 13 <> 0""",
    "ml_clv_predictions": """
        SELECT c_name AS customer_unique_id,
               CASE c_custkey % 4 WHEN 0 THEN 'Champions' WHEN 1 THEN 'At Risk' WHEN 2 THEN 'Lost'
                    ELSE 'Needs Attention' END AS rfm_segment,
               CAST(c_acctbal AS DECIMAL(12,2)) AS monetary,
               CAST(c_acctbal AS DECIMAL(12,2)) AS predicted_clv,
               CASE c_custkey % 4 WHEN 0 THEN 'Bronze' WHEN 1 THEN 'Silver' WHEN 2 THEN 'Gold'
                    ELSE 'Platinum' END AS clv_segment,
               CAST(c_custkey % 400 AS DECIMAL(10,2)) AS recency_days,
               CAST(c_custkey % 5 + 1 AS INTEGER) AS frequency
        FROM customer WHERE c_custkey % 17 <> 0""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the star-view CTEs it references.

    ``sql`` may itself start with ``WITH``; its CTEs are appended after the
    views."""
    body = sql.strip()
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", body)]
    # views referencing other views are not used; each view reads driver tables only
    ctes = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in used)
    if not ctes:
        return body
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
