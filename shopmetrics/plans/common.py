"""Shared building blocks of the reports: delivered orders and per-order
pre-aggregates of the 1:N facts.

Pre-aggregating payments, items and reviews per ``order_id`` before joining
keeps every join 1:1 on the order key: the fact tables shuffle once on
``order_id`` (map-side partial sums first), and no order x payment x item
fan-out is ever materialised, so a pathological order with thousands of
items and payments costs no more than its row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmetrics.sources.binding import Star

DELIVERED = "delivered"


def orders_with_status(st, status: str) -> DataFrame:
    """Orders in one status; a bound star pushes the filter to its scan."""
    if hasattr(st, "orders_with_status"):
        return st.orders_with_status(status)
    return st.fact_orders.where(F.col("order_status") == status)


def delivered_orders(st: Star, *cols: str) -> DataFrame:
    return orders_with_status(st, DELIVERED).select("order_id", *cols)


def calendar(st: Star, *cols: str) -> DataFrame:
    """dim_date, broadcast: one row per calendar day, so its size is bounded
    by the date span (a few thousand rows), not by the data volume."""
    return F.broadcast(st.dim_date.select(F.col("date_key").alias("purchase_date_key"), *cols))


def payments_per_order(st: Star) -> DataFrame:
    """order_id, pay_sum (exact decimal), pay_rows."""
    return st.fact_payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("pay_sum"), F.count(F.lit(1)).alias("pay_rows"))


def items_per_order(st: Star) -> DataFrame:
    """order_id, freight_sum, item_rows."""
    return st.fact_order_items.groupBy("order_id").agg(
        F.sum("freight_value").alias("freight_sum"), F.count(F.lit(1)).alias("item_rows"))


def reviews_per_order(st: Star) -> DataFrame:
    """order_id, rev_rows (matching rows of a LEFT JOIN), review_ids
    (non-NULL ids), score_sum, score_n."""
    return st.fact_reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("rev_rows"),
        F.count("review_id").alias("review_ids"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_n"))


def left_join_weight(rows_col: str) -> F.Column:
    """Rows an order contributes to a LEFT JOIN: max(matches, 1)."""
    return F.greatest(F.coalesce(F.col(rows_col), F.lit(0)), F.lit(1)).cast("bigint")


def exact_div(num, den):
    """num / den in exact decimal arithmetic (NULL when den is 0)."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return n.cast("decimal(38,6)") / F.nullif(d.cast("decimal(38,0)"), F.lit(0))
