"""Star-schema contracts: column types, keys, foreign keys and domain rules.

Types follow the reference DDL, with money widened to DECIMAL(12,2) (driver
prices exceed NUMERIC(10,2)).  The key metadata drives the audit jobs in
``operators.quality``; nothing here is enforced on write (Parquet has no
constraints), so the rules are checked as Spark jobs instead.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
TS = T.TimestampNTZType()

DIM_CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("customer_unique_id", T.StringType(), False),
    T.StructField("zip_code", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
])
DIM_SELLERS = T.StructType([
    T.StructField("seller_id", T.StringType(), False),
    T.StructField("zip_code", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
])
DIM_PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("category_name_english", T.StringType()),
    T.StructField("name_length", T.IntegerType()),
    T.StructField("description_length", T.IntegerType()),
    T.StructField("photos_qty", T.IntegerType()),
    T.StructField("weight_g", T.DecimalType(10, 2)),
    T.StructField("length_cm", T.DecimalType(6, 2)),
    T.StructField("height_cm", T.DecimalType(6, 2)),
    T.StructField("width_cm", T.DecimalType(6, 2)),
])
DIM_DATE = T.StructType([
    T.StructField("date_key", T.DateType(), False),
    T.StructField("year", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("month_name", T.StringType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("is_weekend", T.BooleanType()),
])
FACT_ORDERS = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("purchase_date", TS),
    T.StructField("approved_date", TS),
    T.StructField("delivered_carrier_date", TS),
    T.StructField("delivered_customer_date", TS),
    T.StructField("estimated_delivery_date", TS),
    T.StructField("purchase_date_key", T.DateType()),
])
FACT_ORDER_ITEMS = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("seller_id", T.StringType()),
    T.StructField("shipping_date", TS),
    T.StructField("price", MONEY),
    T.StructField("freight_value", MONEY),
])
FACT_PAYMENTS = T.StructType([
    T.StructField("payment_id", T.LongType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("payment_sequential", T.IntegerType()),
    T.StructField("payment_type", T.StringType()),
    T.StructField("installments", T.IntegerType()),
    T.StructField("payment_value", MONEY),
])
FACT_REVIEWS = T.StructType([
    T.StructField("review_id", T.StringType(), False),
    T.StructField("order_id", T.StringType()),
    T.StructField("review_score", T.IntegerType()),
    T.StructField("review_created_date", TS),
    T.StructField("answer_date", TS),
])
ML_CHURN_PREDICTIONS = T.StructType([
    T.StructField("customer_unique_id", T.StringType(), False),
    T.StructField("rfm_segment", T.StringType()),
    T.StructField("recency_days", T.DecimalType(10, 2)),
    T.StructField("frequency", T.IntegerType()),
    T.StructField("monetary", MONEY),
    T.StructField("churn_probability", T.DecimalType(6, 4)),
    T.StructField("churn_label", T.StringType()),
    T.StructField("predicted_at", T.TimestampType()),
])
ML_CLV_PREDICTIONS = T.StructType([
    T.StructField("customer_unique_id", T.StringType(), False),
    T.StructField("rfm_segment", T.StringType()),
    T.StructField("monetary", MONEY),
    T.StructField("predicted_clv", MONEY),
    T.StructField("clv_segment", T.StringType()),
    T.StructField("recency_days", T.DecimalType(10, 2)),
    T.StructField("frequency", T.IntegerType()),
    T.StructField("predicted_at", T.TimestampType()),
])
STREAMING_ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("order_value", MONEY),
    T.StructField("freight_value", MONEY),
    T.StructField("state", T.StringType()),
    T.StructField("payment_type", T.StringType()),
    T.StructField("review_score", T.IntegerType()),
    T.StructField("event_timestamp", T.TimestampNTZType()),
    T.StructField("received_at", T.TimestampType()),
])

# Live-order JSON message (one flat object per event).
LIVE_ORDER_JSON = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("items", T.IntegerType()),
    T.StructField("order_value", T.DoubleType()),
    T.StructField("freight_value", T.DoubleType()),
    T.StructField("state", T.StringType()),
    T.StructField("payment_type", T.StringType()),
    T.StructField("review_score", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
])

# Primary keys of the star tables.
PRIMARY_KEYS = {
    "dim_customers": ["customer_id"],
    "dim_sellers": ["seller_id"],
    "dim_products": ["product_id"],
    "dim_date": ["date_key"],
    "fact_orders": ["order_id"],
    "fact_order_items": ["item_id"],
    "fact_payments": ["payment_id"],
    "fact_reviews": ["review_id"],
}

# Foreign keys: (child table, child column, parent table, parent column).
FOREIGN_KEYS = [
    ("fact_orders", "customer_id", "dim_customers", "customer_id"),
    ("fact_orders", "purchase_date_key", "dim_date", "date_key"),
    ("fact_order_items", "order_id", "fact_orders", "order_id"),
    ("fact_order_items", "product_id", "dim_products", "product_id"),
    ("fact_order_items", "seller_id", "dim_sellers", "seller_id"),
    ("fact_payments", "order_id", "fact_orders", "order_id"),
    ("fact_reviews", "order_id", "fact_orders", "order_id"),
]

# VARCHAR/CHAR length limits of the reference DDL (checked as audits).
MAX_LENGTHS = {
    "dim_customers": {"customer_id": 50, "customer_unique_id": 50, "zip_code": 10, "city": 100, "state": 2},
    "dim_sellers": {"seller_id": 50, "zip_code": 10, "city": 100, "state": 2},
    "dim_products": {"product_id": 50, "category_name_english": 100},
    "fact_orders": {"order_id": 50, "customer_id": 50, "order_status": 30},
    "fact_payments": {"order_id": 50, "payment_type": 30},
    "fact_reviews": {"review_id": 50, "order_id": 50},
}

NOT_NULL = {"dim_customers": ["customer_unique_id"]}

STAR_TABLES = [
    "dim_customers", "dim_sellers", "dim_products", "dim_date",
    "fact_orders", "fact_order_items", "fact_payments", "fact_reviews",
]
