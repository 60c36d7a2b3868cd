"""Load jobs over raw staging frames.

``raw_from_driver`` derives CSV-shaped staging frames from the driver
tables (timestamps rendered as text, a stale re-delivery of every customer
appended after the first delivery, untranslated and missing categories), so
the load path -- name-driven date coercion, strict casts, first-row-wins
dedupe, translation join -- runs on the whole tables and must reproduce the
star views exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmetrics.functions.core import ntz_text
from shopmetrics.session import scratch_path
from shopmetrics.sources import ingest
from shopmetrics.sources.binding import Star

STALE_CITY = "STALE"
UNTRANSLATED_BRAND = "Brand#1"


def _text(c: str) -> F.Column:
    return ntz_text(c)


def _seq(df: DataFrame) -> DataFrame:
    return df.withColumn(ingest.INGEST_SEQ, F.monotonically_increasing_id())


def raw_from_driver(st: Star) -> dict[str, DataFrame]:
    fresh = st.dim_customers.select(
        "customer_id", "customer_unique_id", F.col("zip_code").alias("customer_zip_code_prefix"),
        F.col("city").alias("customer_city"), F.col("state").alias("customer_state"))
    stale = fresh.withColumn("customer_city", F.lit(STALE_CITY))
    sellers = st.dim_sellers.select("seller_id", F.col("zip_code").alias("seller_zip_code_prefix"),
                                    F.col("city").alias("seller_city"), F.col("state").alias("seller_state"))
    part = st.raw("part")
    brand = F.col("p_brand")
    native = (F.when(brand == "Brand#7", F.lit(None).cast("string"))
              .when(brand == UNTRANSLATED_BRAND, brand)
              .otherwise(F.concat(F.lit("cat_"), F.lower(brand))))
    products = part.select(
        F.col("p_partkey").cast("string").alias("product_id"), native.alias("product_category_name"),
        F.length("p_name").cast("int").alias("product_name_lenght"),
        F.length("p_type").cast("int").alias("product_description_lenght"),
        (F.col("p_size") % 5 + 1).cast("int").alias("product_photos_qty"),
        (F.col("p_size") * 100).cast("double").alias("product_weight_g"),
        F.lit(None).cast("double").alias("product_length_cm"),
        F.lit(None).cast("double").alias("product_height_cm"),
        F.lit(None).cast("double").alias("product_width_cm"))
    translation = (part.where(~brand.isin("Brand#7", UNTRANSLATED_BRAND))
                   .select(F.concat(F.lit("cat_"), F.lower(brand)).alias("product_category_name"),
                           brand.alias("product_category_name_english")).distinct())
    o = st.fact_orders
    orders = o.select(
        "order_id", "customer_id", "order_status",
        _text("purchase_date").alias("order_purchase_timestamp"),
        _text("approved_date").alias("order_approved_at"),
        F.when(F.col("order_status") == "processing", F.lit("pending"))
        .otherwise(_text("delivered_carrier_date")).alias("order_delivered_carrier_date"),
        F.coalesce(_text("delivered_customer_date"), F.lit("")).alias("order_delivered_customer_date"),
        _text("estimated_delivery_date").alias("order_estimated_delivery_date"))
    items = st.raw("lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"), F.col("l_suppkey").cast("string").alias("seller_id"),
        _text("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("freight_value"))
    payments = st.fact_payments.select(
        "order_id", "payment_sequential", "payment_type",
        F.col("installments").alias("payment_installments"),
        F.col("payment_value").cast("double").alias("payment_value"))
    reviews = st.fact_reviews.select(
        "review_id", "order_id", "review_score",
        F.lit(None).cast("string").alias("review_comment_title"),
        F.lit(None).cast("string").alias("review_comment_message"),
        _text("review_created_date").alias("review_creation_date"),
        _text("answer_date").alias("review_answer_timestamp"))
    raw = {
        "raw_customers": fresh.unionByName(stale),
        "raw_sellers": sellers, "raw_products": products, "raw_category_translation": translation,
        "raw_orders": orders, "raw_order_items": items, "raw_payments": payments, "raw_reviews": reviews,
    }
    return {k: _seq(ingest.coerce_dates(v)) for k, v in raw.items()}


def star_from_driver(st: Star) -> dict[str, DataFrame]:
    return ingest.build_star(raw_from_driver(st))


def write_raw_csv(spark: SparkSession, st: Star, folder: str | None = None) -> str:
    """Write the staging frames as CSV folders named by their file stems."""
    folder = folder or scratch_path(spark, "raw-csv")
    stems = {v: k for k, v in ingest.RAW_NAME_MAP.items()}
    for table, df in raw_from_driver(st).items():
        out = df.drop(ingest.INGEST_SEQ)
        for c, t in out.dtypes:
            if t.startswith("timestamp"):
                out = out.withColumn(c, ntz_text(c))
        out.write.mode("overwrite").option("header", True).csv(f"{folder}/{stems[table]}.csv")
    return folder


def ingest_raw_csv(spark: SparkSession, st: Star) -> DataFrame:
    """A1 end to end: CSV folder -> staging frames -> star -> row counts."""
    folder = write_raw_csv(spark, st)
    loaded = ingest.build_star(ingest.load_raw_folder(spark, folder))
    return ingest.table_row_counts(loaded)


def insert_ignore_reviews(st: Star) -> DataFrame:
    """A11 on the whole review table: a one-review-per-order table whose
    current content is the first reviews of shipped orders receives the
    full review batch keyed by order (first review id wins)."""
    r = st.fact_reviews.select("review_id", "order_id", "review_score")
    shipped = st.fact_orders.where(F.col("order_status") == "shipped").select("order_id")
    target = r.join(shipped, "order_id").where(~F.col("review_id").endswith("b")).select(*r.columns)
    return ingest.insert_ignore_result(target, r, ["order_id"], order=F.col("review_id"))


def sink_overwrite_roundtrip(spark: SparkSession, st: Star) -> DataFrame:
    """A12: overwrite the same path twice (idempotent reload), read it back."""
    path = scratch_path(spark, "sink-fact-orders")
    for _ in range(2):
        ingest.sink_overwrite(st.fact_orders, path)
    return spark.read.parquet(path)
