"""Bind the driver's TPC-H-style parquet tables to the retail star schema.

This is the only module that knows the test data layout.  Every star table
is a lazy DataFrame over one parquet scan: Catalyst prunes the columns each
report uses and pushes its filters into the scan.  Multi-row derivations
(payments, reviews) use one scan plus ``explode`` rather than a union of
scans, so each fact reads its source once.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmetrics.functions.core import AS_OF, MONEY
from shopmetrics.sources.ingest import derive_dim_date

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Fixed values of the binding (FIXTURES.md section 3).
STATUS_MAP = {"F": "delivered", "O": "shipped", "P": "processing"}
NULL_CATEGORY_BRAND = "Brand#7"
BOUND_SEGMENTS = ["Champions", "At Risk", "Lost", "Needs Attention"]
BOUND_CLV_TIERS = ["Bronze", "Silver", "Gold", "Platinum"]


def _key(c: str) -> Column:
    return F.col(c).cast("string")


def churn_label_expr(prob: Column) -> Column:
    """Fixed bins (0,.33], (.33,.66], (.66,1] -> Low / Medium / High.

    Exactly 0.0 lies outside the first bin in the reference (label "nan");
    we label it Low (deliberate, documented deviation)."""
    return (F.when(prob <= 0.33, "Low")
            .when(prob <= 0.66, "Medium")
            .when(prob <= 1.0, "High"))


class Star:
    """Lazy star-schema views over one driver scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- dimensions --------------------------------------------------------
    @cached_property
    def dim_customers(self) -> DataFrame:
        c = self.raw("customer")
        n = self.raw("nation")
        # nation is a fixed 25-row table: broadcasting it is size-bounded.
        return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
                .select(_key("c_custkey").alias("customer_id"),
                        F.col("c_name").alias("customer_unique_id"),
                        F.lit(None).cast("string").alias("zip_code"),
                        F.col("c_mktsegment").alias("city"),
                        F.col("n_name").alias("state")))

    @cached_property
    def dim_sellers(self) -> DataFrame:
        s = self.raw("supplier")
        n = self.raw("nation")
        return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
                .select(_key("s_suppkey").alias("seller_id"),
                        F.lit(None).cast("string").alias("zip_code"),
                        F.col("s_name").alias("city"),
                        F.col("n_name").alias("state")))

    @cached_property
    def dim_products(self) -> DataFrame:
        p = self.raw("part")
        cat = F.when(F.col("p_brand") == NULL_CATEGORY_BRAND, F.lit(None)).otherwise(F.col("p_brand"))
        return p.select(
            _key("p_partkey").alias("product_id"),
            cat.cast("string").alias("category_name_english"),
            F.length("p_name").cast("int").alias("name_length"),
            F.length("p_type").cast("int").alias("description_length"),
            (F.col("p_size") % 5 + 1).cast("int").alias("photos_qty"),
            (F.col("p_size") * 100).cast("decimal(10,2)").alias("weight_g"),
            F.lit(None).cast("decimal(6,2)").alias("length_cm"),
            F.lit(None).cast("decimal(6,2)").alias("height_cm"),
            F.lit(None).cast("decimal(6,2)").alias("width_cm"),
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        return derive_dim_date(self.raw("orders"), "o_orderdate")

    # -- facts -------------------------------------------------------------
    @cached_property
    def fact_orders(self) -> DataFrame:
        return self._orders_view(self.raw("orders"))

    def orders_with_status(self, status: str) -> DataFrame:
        """``fact_orders`` filtered on ``order_status``, with the filter
        stated on the source code column so it reaches the Parquet scan
        (``PushedFilters``) instead of running after the code->name map."""
        codes = [c for c, name in STATUS_MAP.items() if name == status]
        o = self.raw("orders")
        if codes:
            o = o.where(F.col("o_orderstatus").isin(codes))
        else:
            o = o.where(~F.col("o_orderstatus").isin(list(STATUS_MAP)) &
                        (F.lower("o_orderstatus") == status))
        return self._orders_view(o)

    def _orders_view(self, o: DataFrame) -> DataFrame:
        k = F.col("o_orderkey")
        ts = F.col("o_orderdate")
        status = F.coalesce(
            *[F.when(F.col("o_orderstatus") == code, F.lit(name)) for code, name in STATUS_MAP.items()],
            F.lower("o_orderstatus"))
        delivered = F.when(k % 11 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
            ts + F.make_dt_interval(days=(k * 7 % 40).cast("int"), hours=(k % 24).cast("int")))
        return o.select(
            _key("o_orderkey").alias("order_id"),
            _key("o_custkey").alias("customer_id"),
            status.alias("order_status"),
            ts.alias("purchase_date"),
            ts.alias("approved_date"),
            ts.alias("delivered_carrier_date"),
            delivered.alias("delivered_customer_date"),
            (ts + F.make_dt_interval(days=F.lit(20))).alias("estimated_delivery_date"),
            ts.cast("date").alias("purchase_date_key"),
        )

    @cached_property
    def fact_order_items(self) -> DataFrame:
        li = self.raw("lineitem")
        return li.select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("item_id"),
            _key("l_orderkey").alias("order_id"),
            _key("l_partkey").alias("product_id"),
            _key("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_date"),
            F.col("l_extendedprice").cast(MONEY).alias("price"),
            F.col("l_quantity").cast(MONEY).alias("freight_value"),
        )

    @cached_property
    def fact_payments(self) -> DataFrame:
        o = self.raw("orders")
        k = F.col("o_orderkey")
        first = F.struct((k * 2).alias("payment_id"), F.lit(1).alias("seq"),
                         F.col("o_orderpriority").alias("ptype"),
                         (k % 10 + 1).cast("int").alias("inst"),
                         F.col("o_totalprice").cast(MONEY).alias("val"))
        voucher = F.struct((k * 2 + 1).alias("payment_id"), F.lit(2).alias("seq"),
                           F.lit("voucher").alias("ptype"), F.lit(1).alias("inst"),
                           F.lit(10.00).cast(MONEY).alias("val"))
        rows = F.when(k % 5 == 0, F.array(first, voucher)).otherwise(F.array(first))
        return (o.where(k % 97 != 0)
                .select(_key("o_orderkey").alias("order_id"), F.explode(rows).alias("p"))
                .select(F.col("p.payment_id").cast("bigint").alias("payment_id"),
                        "order_id",
                        F.col("p.seq").cast("int").alias("payment_sequential"),
                        F.col("p.ptype").alias("payment_type"),
                        F.col("p.inst").cast("int").alias("installments"),
                        F.col("p.val").alias("payment_value")))

    @cached_property
    def fact_reviews(self) -> DataFrame:
        o = self.raw("orders")
        k = F.col("o_orderkey")
        ts = F.col("o_orderdate")
        created = ts + F.make_dt_interval(days=F.lit(21))
        first = F.when(k % 3 != 0, F.struct(_key("o_orderkey").alias("rid"),
                                            (k % 5 + 1).cast("int").alias("score")))
        second = F.when(k % 50 == 1, F.struct(F.concat(_key("o_orderkey"), F.lit("b")).alias("rid"),
                                              F.lit(5).alias("score")))
        return (o.where((k % 3 != 0) | (k % 50 == 1))
                .select(_key("o_orderkey").alias("order_id"), created.alias("created"),
                        F.explode(F.array(first, second)).alias("r"))
                .where(F.col("r").isNotNull())
                .select(F.col("r.rid").alias("review_id"), "order_id",
                        F.col("r.score").alias("review_score"),
                        F.col("created").alias("review_created_date"),
                        (F.col("created") + F.make_dt_interval(days=F.lit(2))).alias("answer_date")))

    # -- bound prediction tables (inputs of the affinity reports) ----------
    @cached_property
    def ml_churn_predictions(self) -> DataFrame:
        c = self.raw("customer")
        k = F.col("c_custkey")
        prob = ((k % 1000) / F.lit(1000.0)).cast("decimal(6,4)")
        seg = F.element_at(F.array(*[F.lit(s) for s in BOUND_SEGMENTS]), (k % 4 + 1).cast("int"))
        return (c.where(k % 13 != 0)
                .select(F.col("c_name").alias("customer_unique_id"),
                        seg.alias("rfm_segment"),
                        (k % 400).cast("decimal(10,2)").alias("recency_days"),
                        (k % 5 + 1).cast("int").alias("frequency"),
                        F.col("c_acctbal").cast(MONEY).alias("monetary"),
                        prob.alias("churn_probability"),
                        churn_label_expr(prob).alias("churn_label"),
                        F.lit(AS_OF).cast("timestamp").alias("predicted_at")))

    @cached_property
    def ml_clv_predictions(self) -> DataFrame:
        c = self.raw("customer")
        k = F.col("c_custkey")
        seg = F.element_at(F.array(*[F.lit(s) for s in BOUND_SEGMENTS]), (k % 4 + 1).cast("int"))
        tier = F.element_at(F.array(*[F.lit(s) for s in BOUND_CLV_TIERS]), (k % 4 + 1).cast("int"))
        return (c.where(k % 17 != 0)
                .select(F.col("c_name").alias("customer_unique_id"),
                        seg.alias("rfm_segment"),
                        F.col("c_acctbal").cast(MONEY).alias("monetary"),
                        F.col("c_acctbal").cast(MONEY).alias("predicted_clv"),
                        tier.alias("clv_segment"),
                        (k % 400).cast("decimal(10,2)").alias("recency_days"),
                        (k % 5 + 1).cast("int").alias("frequency"),
                        F.lit(AS_OF).cast("timestamp").alias("predicted_at")))

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def register_views(self) -> None:
        """Expose every star table as a temp view for ``spark.sql`` reports."""
        for name in ("dim_customers", "dim_sellers", "dim_products", "dim_date", "fact_orders",
                     "fact_order_items", "fact_payments", "fact_reviews",
                     "ml_churn_predictions", "ml_clv_predictions"):
            self.table(name).createOrReplaceTempView(name)


_CACHE: dict = {}


def star(spark: SparkSession, sf_dir: str) -> Star:
    key = (id(spark), sf_dir.rstrip("/"))
    s = _CACHE.get(key)
    if s is None or s.spark is not spark:
        s = _CACHE[key] = Star(spark, sf_dir)
    return s
