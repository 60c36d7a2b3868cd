"""Raw files -> star schema.

* CSV scans use explicit schemas (no inference pass over 100 TB); the zip
  prefix stays a string so leading zeros survive.
* "First row wins" dedupe and insert-ignore are ``min_by`` aggregations:
  partial (map-side) aggregation collapses a hot key before the shuffle, so
  a key holding a third of the rows never lands whole in one task.
* Loads are overwrite sinks, so re-running a load is idempotent.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmetrics.functions.core import MONEY
from shopmetrics.sources import quoted_csv

# Raw file stem -> staging table name.
RAW_NAME_MAP = {
    "olist_customers_dataset": "raw_customers",
    "olist_sellers_dataset": "raw_sellers",
    "olist_products_dataset": "raw_products",
    "olist_orders_dataset": "raw_orders",
    "olist_order_items_dataset": "raw_order_items",
    "olist_order_payments_dataset": "raw_payments",
    "olist_order_reviews_dataset": "raw_reviews",
    "olist_geolocation_dataset": "raw_geolocation",
    "product_category_name_translation": "raw_category_translation",
}

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols])


# Raw CSV schemas (header names as they appear in the files).  Dates are read
# as strings and coerced by name (A2); zip prefixes stay strings.
RAW_SCHEMAS = {
    "raw_customers": _schema(("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
                             ("customer_city", S), ("customer_state", S)),
    "raw_sellers": _schema(("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S),
                           ("seller_state", S)),
    "raw_products": _schema(("product_id", S), ("product_category_name", S), ("product_name_lenght", I),
                            ("product_description_lenght", I), ("product_photos_qty", I),
                            ("product_weight_g", D), ("product_length_cm", D), ("product_height_cm", D),
                            ("product_width_cm", D)),
    "raw_category_translation": _schema(("product_category_name", S), ("product_category_name_english", S)),
    "raw_orders": _schema(("order_id", S), ("customer_id", S), ("order_status", S),
                          ("order_purchase_timestamp", S), ("order_approved_at", S),
                          ("order_delivered_carrier_date", S), ("order_delivered_customer_date", S),
                          ("order_estimated_delivery_date", S)),
    "raw_order_items": _schema(("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
                               ("shipping_limit_date", S), ("price", D), ("freight_value", D)),
    "raw_payments": _schema(("order_id", S), ("payment_sequential", I), ("payment_type", S),
                            ("payment_installments", I), ("payment_value", D)),
    "raw_reviews": _schema(("review_id", S), ("order_id", S), ("review_score", I),
                           ("review_comment_title", S), ("review_comment_message", S),
                           ("review_creation_date", S), ("review_answer_timestamp", S)),
}

INGEST_SEQ = "_ingest_seq"
CORRUPT_ROW = "_corrupt_row"


# ---------------------------------------------------------------- A1 / A2 --
def raw_table_name(stem: str) -> str:
    return RAW_NAME_MAP.get(stem, f"raw_{stem}")


def list_raw_csv(spark: SparkSession, folder: str) -> dict[str, str]:
    """Map staging table name -> CSV path (a file or a folder of part files
    named ``<stem>.csv``); raise when the folder is missing or holds none.

    Listing goes through the ``binaryFile`` source with only the ``path``
    column selected (file contents are never read), so it works on any
    filesystem Spark can read; only the distinct names under the folder
    reach the driver, not the paths of their part files."""
    base = folder.rstrip("/")
    root = base.split("://", 1)[-1].split(":", 1)[-1]
    first = F.split_part(F.element_at(F.split("path", re.escape(root) + "/+", 2), -1), F.lit("/"), F.lit(1))
    try:
        names = [r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
                 .select(first.alias("name")).where("lower(name) like '%.csv'").distinct().collect()]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        names = []
    if not names:
        raise FileNotFoundError(f"No CSV files found in {folder}")
    return {raw_table_name(n[:-4]): f"{base}/{n}" for n in sorted(names)}


def read_raw_csv(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """Scan one raw CSV with its declared schema (all strings when unknown),
    coerce date-named columns, and tag each row with its place: part file by
    name, then byte offset in the file.

    Quoted fields may hold line breaks and doubled quotes; a file is read in
    byte ranges all the same (``quoted_csv``).  Rows that do not fit the
    schema keep what could be parsed; ``malformed_rows`` finds them."""
    df = _scan_csv(spark, path, table)
    place = F.struct("file", "row").alias(INGEST_SEQ)
    return coerce_dates(df.select(*[c for c in df.columns[2:] if c != CORRUPT_ROW], place))


def _scan_csv(spark: SparkSession, path: str, table: str | None) -> DataFrame:
    schema = RAW_SCHEMAS.get(table or "")
    if schema is None:
        head = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
        schema = _schema(*[(c, S) for c in head.columns])
    return quoted_csv.parse_records(quoted_csv.read_records(spark, path), schema, CORRUPT_ROW)


def malformed_rows(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """Text of the rows of a raw CSV that do not fit its schema."""
    return _scan_csv(spark, path, table).where(F.col(CORRUPT_ROW).isNotNull()).select(CORRUPT_ROW)


def date_like_columns(columns: Iterable[str]) -> list[str]:
    """Columns whose lower-case name contains ``date`` or ``timestamp``."""
    return [c for c in columns if "date" in c.lower() or "timestamp" in c.lower()]


def coerce_dates(df: DataFrame) -> DataFrame:
    """Parse date-named columns to TIMESTAMP_NTZ; unparsable text -> NULL."""
    targets = set(date_like_columns(df.columns))
    if not targets:
        return df
    return df.select(*[
        F.col(c).cast("string").try_cast("timestamp_ntz").alias(c) if c in targets else F.col(c)
        for c in df.columns
    ])


def load_raw_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """A1: every CSV in ``folder`` as a lazily read staging DataFrame."""
    return {t: read_raw_csv(spark, p, t) for t, p in list_raw_csv(spark, folder).items()}


# ---------------------------------------------------------------- A11 ------
def first_per_key(df: DataFrame, keys: list[str], order: Column | str = INGEST_SEQ) -> DataFrame:
    """Keep the first row per key (lowest ``order``), as a partial aggregate."""
    order_col = F.col(order) if isinstance(order, str) else order
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*others), order_col).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str],
                  order: Column | str = INGEST_SEQ) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO NOTHING``: the rows to append.

    First row per key in the batch wins; keys already in the target are
    skipped (left-anti join).  Returns only the new rows; the caller appends.
    """
    fresh = first_per_key(batch, keys, order)
    return fresh.join(target.select(*keys).distinct(), on=keys, how="left_anti")


def insert_ignore_result(target: DataFrame, batch: DataFrame, keys: list[str],
                         order: Column | str = INGEST_SEQ) -> DataFrame:
    """The target table after the insert-ignore (target rows + new rows)."""
    cols = target.columns
    return target.unionByName(insert_ignore(target, batch, keys, order).select(*cols))


# ---------------------------------------------------------------- A3-A10 ---
def _drop_seq(df: DataFrame) -> DataFrame:
    return df.drop(INGEST_SEQ)


def build_dim_customers(raw: DataFrame) -> DataFrame:
    df = raw.select(F.col("customer_id"), F.col("customer_unique_id"),
                    F.col("customer_zip_code_prefix").cast("string").alias("zip_code"),
                    F.col("customer_city").alias("city"), F.col("customer_state").alias("state"), INGEST_SEQ)
    return _drop_seq(first_per_key(df, ["customer_id"]))


def build_dim_sellers(raw: DataFrame) -> DataFrame:
    df = raw.select("seller_id", F.col("seller_zip_code_prefix").cast("string").alias("zip_code"),
                    F.col("seller_city").alias("city"), F.col("seller_state").alias("state"), INGEST_SEQ)
    return _drop_seq(first_per_key(df, ["seller_id"]))


def build_dim_products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """LEFT JOIN the category translation (one row per category after the
    dedupe; AQE broadcasts it by measured size) and fall back to the native
    name."""
    tr = first_per_key(translation.select("product_category_name", "product_category_name_english",
                                          INGEST_SEQ), ["product_category_name"]).drop(INGEST_SEQ)
    p = raw.join(tr, on="product_category_name", how="left")
    df = p.select(
        "product_id",
        F.coalesce("product_category_name_english", "product_category_name").alias("category_name_english"),
        F.col("product_name_lenght").cast("int").alias("name_length"),
        F.col("product_description_lenght").cast("int").alias("description_length"),
        F.col("product_photos_qty").cast("int").alias("photos_qty"),
        F.col("product_weight_g").cast("decimal(10,2)").alias("weight_g"),
        F.col("product_length_cm").cast("decimal(6,2)").alias("length_cm"),
        F.col("product_height_cm").cast("decimal(6,2)").alias("height_cm"),
        F.col("product_width_cm").cast("decimal(6,2)").alias("width_cm"),
        INGEST_SEQ,
    )
    return _drop_seq(first_per_key(df, ["product_id"]))


# Fixed value: PostgreSQL TO_CHAR(ts, 'Month') pads month names to 9 chars.
MONTH_NAME_WIDTH = 9


def derive_dim_date(orders: DataFrame, ts_col: str) -> DataFrame:
    """A6: one row per distinct purchase date (NULL purchase skipped).

    The distinct runs first (partial aggregation shrinks each partition to
    its few thousand dates), then the calendar attributes are computed on
    the small result."""
    d = (orders.where(F.col(ts_col).isNotNull())
         .select(F.col(ts_col).cast("date").alias("date_key")).distinct())
    dow = (F.dayofweek("date_key") - 1).cast("int")
    return d.select(
        "date_key",
        F.year("date_key").cast("int").alias("year"),
        F.quarter("date_key").cast("int").alias("quarter"),
        F.month("date_key").cast("int").alias("month"),
        F.rpad(F.date_format("date_key", "MMMM"), MONTH_NAME_WIDTH, " ").alias("month_name"),
        F.weekofyear("date_key").cast("int").alias("week"),
        dow.alias("day_of_week"),
        dow.isin(0, 6).alias("is_weekend"),
    )


def strict_timestamp(c: str) -> Column:
    """``::timestamp`` on text: ANSI cast, a malformed value fails the load."""
    return F.col(c).cast("string").cast("timestamp_ntz")


def build_fact_orders(raw: DataFrame) -> DataFrame:
    df = raw.select(
        "order_id", "customer_id", "order_status",
        F.col("order_purchase_timestamp").cast("timestamp_ntz").alias("purchase_date"),
        strict_timestamp("order_approved_at").alias("approved_date"),
        F.col("order_delivered_carrier_date").cast("timestamp_ntz").alias("delivered_carrier_date"),
        F.col("order_delivered_customer_date").cast("timestamp_ntz").alias("delivered_customer_date"),
        F.col("order_estimated_delivery_date").cast("timestamp_ntz").alias("estimated_delivery_date"),
        F.col("order_purchase_timestamp").cast("date").alias("purchase_date_key"),
        INGEST_SEQ,
    )
    return _drop_seq(first_per_key(df, ["order_id"]))


def build_fact_order_items(raw: DataFrame) -> DataFrame:
    """Plain load, no dedupe (as the reference); ``item_id`` is a hash of the
    natural key (order_id, order_item_id), the same in every run."""
    return raw.select(
        F.xxhash64("order_id", F.col("order_item_id").cast("int")).alias("item_id"), "order_id", "product_id", "seller_id",
        F.col("shipping_limit_date").cast("timestamp_ntz").alias("shipping_date"),
        F.col("price").cast(MONEY).alias("price"),
        F.col("freight_value").cast(MONEY).alias("freight_value"),
    )


def build_fact_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.xxhash64("order_id", F.col("payment_sequential").cast("int")).alias("payment_id"), "order_id",
        F.col("payment_sequential").cast("int").alias("payment_sequential"),
        "payment_type",
        F.col("payment_installments").cast("int").alias("installments"),
        F.col("payment_value").cast(MONEY).alias("payment_value"),
    )


def build_fact_reviews(raw: DataFrame) -> DataFrame:
    df = raw.select(
        "review_id", "order_id", F.col("review_score").cast("int").alias("review_score"),
        F.col("review_creation_date").cast("timestamp_ntz").alias("review_created_date"),
        F.col("review_answer_timestamp").cast("timestamp_ntz").alias("answer_date"),
        INGEST_SEQ,
    )
    return _drop_seq(first_per_key(df, ["review_id"]))


def build_star(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A3-A10 over the staging tables returned by :func:`load_raw_folder`."""
    out = {}
    if "raw_customers" in raw:
        out["dim_customers"] = build_dim_customers(raw["raw_customers"])
    if "raw_sellers" in raw:
        out["dim_sellers"] = build_dim_sellers(raw["raw_sellers"])
    if "raw_products" in raw and "raw_category_translation" in raw:
        out["dim_products"] = build_dim_products(raw["raw_products"], raw["raw_category_translation"])
    if "raw_orders" in raw:
        out["dim_date"] = derive_dim_date(raw["raw_orders"], "order_purchase_timestamp")
        out["fact_orders"] = build_fact_orders(raw["raw_orders"])
    if "raw_order_items" in raw:
        out["fact_order_items"] = build_fact_order_items(raw["raw_order_items"])
    if "raw_payments" in raw:
        out["fact_payments"] = build_fact_payments(raw["raw_payments"])
    if "raw_reviews" in raw:
        out["fact_reviews"] = build_fact_reviews(raw["raw_reviews"])
    return out


# ---------------------------------------------------------------- A12 / A14 --
def sink_overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Full-replace sink (``if_exists="replace"``): Parquet, overwrite mode.

    Overwrite makes a re-run idempotent; Spark's commit protocol means a
    lost executor's partial files never become visible."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One ``count(*)`` row per table plus an EMPTY flag, as one DataFrame.

    Each count is a scan with no columns read (Parquet row-group metadata);
    the union is a handful of rows."""
    parts = [t.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("is_empty", F.col("row_count") == 0)


# ---- bucketed star tables ----------------------------------------------------
# Fixed layout: every fact joins on order_id; dimensions on their keys.
BUCKET_KEYS = {
    "fact_orders": "order_id",
    "fact_order_items": "order_id",
    "fact_payments": "order_id",
    "fact_reviews": "order_id",
    "dim_customers": "customer_id",
    "dim_products": "product_id",
}


def save_star_tables(star: dict[str, DataFrame], database: str, buckets: int,
                     location: str | None = None) -> list[str]:
    """Write the star as catalog tables, facts bucketed and sorted by
    ``order_id`` into the same number of buckets.

    Joins and aggregations on the bucket key then read co-partitioned
    buckets and plan no shuffle (no ``Exchange hashpartitioning(order_id)``),
    which is what the per-order pre-aggregates and fact joins of every
    report need at scale.  Overwrite keeps reloads idempotent."""
    if not star:
        return []
    spark = next(iter(star.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    written = []
    for name, df in star.items():
        w = df.write.mode("overwrite").format("parquet")
        key = BUCKET_KEYS.get(name)
        if key and buckets:
            w = w.bucketBy(buckets, key).sortBy(key)
        if location:
            w = w.option("path", f"{location.rstrip('/')}/{name}")
        w.saveAsTable(f"{database}.{name}")
        written.append(f"{database}.{name}")
    return written
