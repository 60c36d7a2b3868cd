"""Read an existing PostgreSQL star schema over JDBC.

A single JDBC read is one task on one connection.  Each table is instead
read with ``predicates``: N disjoint filters on a hash of its key, so N
executors read in parallel and the rows arrive already spread by key.
Needs the PostgreSQL JDBC driver on the classpath (not shipped here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopmetrics.schema import STAR_TABLES
from shopmetrics.sources.frames import TableStar

# Column hashed to split each table's read (its key, or the order key for facts).
SPLIT_COLUMNS = {
    "dim_customers": "customer_id",
    "dim_sellers": "seller_id",
    "dim_products": "product_id",
    "dim_date": "date_key",
    "fact_orders": "order_id",
    "fact_order_items": "order_id",
    "fact_payments": "order_id",
    "fact_reviews": "order_id",
    "ml_churn_predictions": "customer_unique_id",
    "ml_clv_predictions": "customer_unique_id",
}


def hash_predicates(column: str, parts: int) -> list[str]:
    """Disjoint, covering PostgreSQL predicates on ``hashtext(column)``
    (NULL keys go to the first part)."""
    preds = [f"mod(abs(hashtext(CAST({column} AS text))::bigint), {parts}) = {i}" for i in range(parts)]
    preds[0] = f"({preds[0]}) OR {column} IS NULL"
    return preds


def read_table(spark: SparkSession, url: str, table: str, properties: dict, parts: int = 16) -> DataFrame:
    column = SPLIT_COLUMNS.get(table)
    props = {"fetchsize": "10000", **properties}
    if column is None or parts <= 1:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, predicates=hash_predicates(column, parts), properties=props)


def read_star(spark: SparkSession, url: str, properties: dict, parts: int = 16,
              tables: list[str] | None = None) -> TableStar:
    """The star (and prediction tables when listed) as a :class:`TableStar`."""
    names = tables or STAR_TABLES
    return TableStar(**{t: read_table(spark, url, t, properties, parts) for t in names})
