"""DuckDB oracle SQL for the load, scan, audit and join/aggregate keys."""

from __future__ import annotations

from shopmetrics.plans.oracle_views import R
from shopmetrics.schema import FOREIGN_KEYS, MAX_LENGTHS, NOT_NULL, PRIMARY_KEYS, STAR_TABLES

ORACLE = {}

_TS = "'%Y-%m-%d %H:%M:%S'"

ORACLE["coerce_dates"] = f"""
SELECT order_id, customer_id, order_status, purchase_date AS order_purchase_timestamp,
       CAST(approved_date AS VARCHAR) AS order_approved_at,
       CASE WHEN order_status = 'processing' THEN NULL ELSE delivered_carrier_date END
           AS order_delivered_carrier_date,
       delivered_customer_date AS order_delivered_customer_date,
       estimated_delivery_date AS order_estimated_delivery_date
FROM fact_orders"""

ORACLE["dim_customers"] = "SELECT * FROM dim_customers"
ORACLE["dim_sellers"] = "SELECT * FROM dim_sellers"
ORACLE["dim_products"] = """SELECT *, CAST(NULL AS DECIMAL(6,2)) AS length_cm, CAST(NULL AS DECIMAL(6,2)) AS height_cm,
       CAST(NULL AS DECIMAL(6,2)) AS width_cm FROM dim_products"""
ORACLE["dim_date"] = "SELECT * FROM dim_date"
ORACLE["fact_orders"] = """
SELECT order_id, customer_id, order_status, purchase_date, approved_date,
       CASE WHEN order_status = 'processing' THEN NULL ELSE delivered_carrier_date END AS delivered_carrier_date,
       delivered_customer_date, estimated_delivery_date, purchase_date_key
FROM fact_orders"""
ORACLE["fact_order_items"] = """
SELECT order_id, product_id, seller_id, shipping_date, price, freight_value FROM fact_order_items"""
ORACLE["fact_payments"] = """
SELECT order_id, payment_sequential, payment_type, installments, payment_value FROM fact_payments"""
ORACLE["fact_reviews"] = "SELECT * FROM fact_reviews"

ORACLE["insert_ignore"] = """
WITH target AS (
    SELECT r.review_id, r.order_id, r.review_score FROM fact_reviews r
    JOIN fact_orders o ON o.order_id = r.order_id
    WHERE o.order_status = 'shipped' AND NOT suffix(r.review_id, 'b')),
firsts AS (
    SELECT review_id, order_id, review_score FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY review_id) AS rn FROM fact_reviews) x
    WHERE rn = 1)
SELECT * FROM target
UNION ALL
SELECT f.* FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.order_id = f.order_id)"""

ORACLE["orders_scan"] = "SELECT order_id, order_status, purchase_date FROM fact_orders"

ORACLE["table_row_counts"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count, COUNT(*) = 0 AS is_empty FROM {t}"
    for t in STAR_TABLES)

ORACLE["audit_primary_keys"] = "\nUNION ALL\n".join(f"""
SELECT '{t}' AS table_name, '{k[0]}' AS key_column, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS rows,
       CAST(COALESCE(SUM(CASE WHEN {k[0]} IS NULL THEN n ELSE 0 END), 0) AS BIGINT) AS null_keys,
       CAST(COALESCE(SUM(CASE WHEN {k[0]} IS NOT NULL AND n > 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS duplicate_keys,
       CAST(COALESCE(SUM(CASE WHEN {k[0]} IS NOT NULL AND n > 1 THEN n - 1 ELSE 0 END), 0) AS BIGINT)
           AS duplicate_rows
FROM (SELECT {k[0]}, COUNT(*) AS n FROM {t} GROUP BY {k[0]}) g""" for t, k in PRIMARY_KEYS.items())

ORACLE["audit_foreign_keys"] = "\nUNION ALL\n".join(f"""
SELECT '{c}' AS child_table, '{cc}' AS child_column, '{p}' AS parent_table, '{pc}' AS parent_column,
       CAST(COUNT(*) AS BIGINT) AS orphan_rows
FROM {c} x WHERE x.{cc} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pc} = x.{cc})"""
    for c, cc, p, pc in FOREIGN_KEYS)


def _domain_sql() -> str:
    parts = []
    for t in STAR_TABLES:
        rules = []
        for col in NOT_NULL.get(t, []):
            rules.append((col, "not_null", f"{col} IS NULL"))
        for col, limit in MAX_LENGTHS.get(t, {}).items():
            rules.append((col, f"max_length_{limit}", f"length({col}) > {limit}"))
        if t == "fact_reviews":
            rules.append(("review_score", "between_1_5", "NOT (review_score BETWEEN 1 AND 5)"))
        for col in {"fact_order_items": ["price", "freight_value"], "fact_payments": ["payment_value"],
                    "dim_products": ["weight_g"]}.get(t, []):
            rules.append((col, "fits_numeric_10_2", f"abs({col}) >= 100000000"))
        for col in ["length_cm", "height_cm", "width_cm"] if t == "dim_products" else []:
            rules.append((col, "fits_numeric_6_2", f"abs({col}) >= 10000"))
        for col, rule, pred in rules:
            parts.append(f"SELECT '{t}' AS table_name, '{col}' AS column_name, '{rule}' AS rule, "
                         f"CAST(COALESCE(SUM(CASE WHEN {pred} THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations "
                         f"FROM ({ORACLE.get(t, 'SELECT * FROM ' + t)}) x")
    return "\nUNION ALL\n".join(parts)


ORACLE["audit_domains"] = _domain_sql()

ORACLE["join_order_customer_payment"] = f"""
SELECT o.order_id, c.customer_unique_id, c.state, o.purchase_date, p.payment_sequential, p.payment_type,
       CAST(p.payment_value AS DOUBLE) AS payment_value
FROM fact_orders o JOIN dim_customers c ON c.customer_id = o.customer_id
JOIN fact_payments p ON p.order_id = o.order_id
WHERE o.order_status = 'delivered'"""

ORACLE["agg_basic"] = f"""
SELECT seller_id, CAST(COUNT(*) AS BIGINT) AS items, CAST(COUNT(product_id) AS BIGINT) AS items_with_product,
       {R('SUM(price)', 2)} AS total_price, {R('AVG(price)', 2)} AS avg_price,
       {R('MIN(price)', 2)} AS min_price, {R('MAX(price)', 2)} AS max_price
FROM fact_order_items GROUP BY seller_id"""

ORACLE["clv_log_target"] = """
SELECT customer_unique_id, monetary,
       CAST(round(CAST(ln(1 + monetary) AS DECIMAL(38,9)), 9) AS DOUBLE) AS log_monetary,
       CAST(round(CAST(greatest(exp(ln(1 + monetary)) - 1, 0) AS DECIMAL(38,6)), 2) AS DOUBLE) AS back_transformed
FROM features"""
