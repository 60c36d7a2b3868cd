"""The standing business reports.

Each function returns a lazy DataFrame with the reference's output columns.
Counts are BIGINT, measures DOUBLE rounded half-up, months DATE.  Joins run
on their natural keys; dimension sides are left to AQE's size-checked
broadcast (``spark.sql.autoBroadcastJoinThreshold`` is checked against the
runtime size of each side, with sort-merge join beyond it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmetrics.functions.core import half_up, month_diff, month_start, pct, whole_days
from shopmetrics.plans.common import (
    calendar, delivered_orders, exact_div, items_per_order, left_join_weight, payments_per_order,
    reviews_per_order,
)
from shopmetrics.sources.binding import Star


def _whole_frame() -> Window:
    # Windows below run over already-aggregated frames (a few dozen rows).
    return Window.partitionBy()


# I9 ----------------------------------------------------------------------
def payment_mix(st: Star) -> DataFrame:
    """Payment method breakdown over all payments (no status filter)."""
    agg = st.fact_payments.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.avg("payment_value").alias("_avg"),
        F.sum("payment_value").alias("_sum"),
        F.avg("installments").alias("_inst"))
    total = F.sum("transactions").over(_whole_frame())
    return agg.select(
        "payment_type",
        F.col("transactions").cast("bigint").alias("transactions"),
        half_up("_avg", 2).alias("avg_payment"),
        half_up("_sum", 2).alias("total_value"),
        half_up("_inst", 1).alias("avg_installments"),
        pct("transactions", total, 1).alias("pct_of_transactions"),
    ).orderBy(F.desc("total_value"), "payment_type")


# I4 / I5 -------------------------------------------------------------------
def _monthly_base(st: Star) -> DataFrame:
    o = delivered_orders(st, "customer_id", "purchase_date_key")
    c = st.dim_customers.select("customer_id", "customer_unique_id")
    d = calendar(st, "year", "month", "month_name")
    return (o.join(payments_per_order(st), "order_id")
            .join(items_per_order(st), "order_id")
            .join(c, "customer_id")
            .join(d, "purchase_date_key"))


def _with_mom(agg: DataFrame) -> DataFrame:
    w = Window.orderBy("year", "month")
    prev = F.lag("_gross").over(w)
    return agg.withColumn("_prev", prev).select(
        "year", "month", "month_name", "total_orders", "unique_customers",
        half_up("_gross", 2).alias("gross_revenue"),
        half_up("_aov", 2).alias("avg_order_value"),
        half_up("_freight", 2).alias("total_freight"),
        half_up(F.col("_gross") - F.col("_freight"), 2).alias("net_revenue"),
        pct(F.col("_gross") - F.col("_prev"), F.col("_prev"), 1).alias("mom_growth_pct"),
    ).orderBy("year", "month")


def monthly_revenue_rollup(st: Star) -> DataFrame:
    """Monthly rollup with the reference's payments x items fan-out.

    Over the fan-out join every payment repeats once per item of its order
    and every freight once per payment, so per order the report sees
    ``pay_sum * item_rows`` revenue, ``freight_sum * pay_rows`` freight and
    ``pay_rows * item_rows`` payment rows.  Computing those products from
    per-order pre-aggregates gives the identical (exact decimal) numbers
    without materialising the fan-out."""
    b = _monthly_base(st)
    agg = b.groupBy("year", "month", "month_name").agg(
        F.count(F.lit(1)).cast("bigint").alias("total_orders"),
        F.count_distinct("customer_unique_id").cast("bigint").alias("unique_customers"),
        F.sum(F.col("pay_sum") * F.col("item_rows")).alias("_gross"),
        F.sum(F.col("pay_rows") * F.col("item_rows")).alias("_rows"),
        F.sum(F.col("freight_sum") * F.col("pay_rows")).alias("_freight"))
    return _with_mom(agg.withColumn("_aov", exact_div("_gross", "_rows")))


def monthly_revenue_rollup_dedup(st: Star) -> DataFrame:
    """Same report with true totals: payments and freight summed per order
    before the join (no fan-out); AOV is revenue per order."""
    b = _monthly_base(st)
    agg = b.groupBy("year", "month", "month_name").agg(
        F.count(F.lit(1)).cast("bigint").alias("total_orders"),
        F.count_distinct("customer_unique_id").cast("bigint").alias("unique_customers"),
        F.sum("pay_sum").alias("_gross"),
        F.sum("freight_sum").alias("_freight"))
    return _with_mom(agg.withColumn("_aov", exact_div("_gross", "total_orders")))


# I6 ----------------------------------------------------------------------
def state_revenue(st: Star) -> DataFrame:
    """Revenue by state; AOV is the average *payment row*, as the reference."""
    o = delivered_orders(st, "customer_id")
    c = st.dim_customers.select("customer_id", "customer_unique_id", "state")
    b = o.join(payments_per_order(st), "order_id").join(c, "customer_id")
    agg = b.groupBy("state").agg(
        F.count(F.lit(1)).cast("bigint").alias("orders"),
        F.count_distinct("customer_unique_id").cast("bigint").alias("customers"),
        F.sum("pay_sum").alias("_rev"),
        F.sum("pay_rows").alias("_rows"))
    return agg.select(
        "state", "orders", "customers",
        half_up("_rev", 2).alias("revenue"),
        half_up(exact_div("_rev", "_rows"), 2).alias("avg_order_value"),
    ).orderBy(F.desc("revenue"), "state")


# I7 ----------------------------------------------------------------------
def category_revenue_top20(st: Star, k: int = 20) -> DataFrame:
    """Revenue by category, top k.  The reviews LEFT JOIN repeats each item
    once per review of its order; reproduced with per-order review counts."""
    i = st.fact_order_items.select("order_id", "product_id", "price")
    o = delivered_orders(st)
    p = st.dim_products.select("product_id", "category_name_english")
    r = reviews_per_order(st)
    b = (i.join(o, "order_id").join(r, "order_id", "left").join(p, "product_id")
         .withColumn("_w", left_join_weight("rev_rows")))
    agg = b.groupBy("category_name_english").agg(
        F.count_distinct("order_id").cast("bigint").alias("orders"),
        F.sum("_w").cast("bigint").alias("items_sold"),
        F.sum(F.col("price") * F.col("_w")).alias("_rev"),
        F.sum("score_sum").alias("_ssum"),
        F.sum("score_n").alias("_sn"))
    out = agg.select(
        F.coalesce("category_name_english", F.lit("unknown")).alias("category"),
        "orders", "items_sold",
        half_up("_rev", 2).alias("revenue"),
        half_up(exact_div("_rev", "items_sold"), 2).alias("avg_item_price"),
        half_up(exact_div("_ssum", "_sn"), 2).alias("avg_review_score"))
    return out.orderBy(F.desc("revenue"), "category").limit(k)


# I8 ----------------------------------------------------------------------
def delivery_by_month(st: Star) -> DataFrame:
    """Delivery performance; orders repeat once per review (LEFT JOIN), a
    NULL estimate counts as late, NULL delivery dates are dropped."""
    o = (delivered_orders(st, "purchase_date_key", "purchase_date", "delivered_customer_date",
                          "estimated_delivery_date")
         .where(F.col("delivered_customer_date").isNotNull())
         .select("order_id", "purchase_date_key",
                 whole_days("delivered_customer_date", "purchase_date").alias("_days"),
                 F.when(F.col("delivered_customer_date") <= F.col("estimated_delivery_date"), 1)
                 .otherwise(0).alias("_on_time")))
    d = calendar(st, "year", "month")
    b = (o.join(reviews_per_order(st), "order_id", "left").join(d, "purchase_date_key")
         .withColumn("_w", left_join_weight("rev_rows")))
    agg = b.groupBy("year", "month").agg(
        F.sum("_w").cast("bigint").alias("delivered_orders"),
        F.sum(F.col("_days") * F.col("_w")).alias("_dsum"),
        F.sum(F.col("_on_time") * F.col("_w")).alias("_ontime"),
        F.sum("score_sum").alias("_ssum"),
        F.sum("score_n").alias("_sn"))
    return agg.select(
        "year", "month", "delivered_orders",
        half_up(exact_div("_dsum", "delivered_orders"), 1).alias("avg_delivery_days"),
        pct("_ontime", "delivered_orders", 1).alias("on_time_pct"),
        half_up(exact_div("_ssum", "_sn"), 2).alias("avg_review_score"),
    ).orderBy("year", "month")


# I3 ----------------------------------------------------------------------
def first_purchase(st: Star) -> DataFrame:
    """customer_unique_id, cohort_month (month of the first delivered order)."""
    o = delivered_orders(st, "customer_id", "purchase_date")
    c = st.dim_customers.select("customer_id", "customer_unique_id")
    return (o.join(c, "customer_id").groupBy("customer_unique_id")
            .agg(month_start(F.min("purchase_date")).alias("cohort_month")))


def monthly_activity(st: Star) -> DataFrame:
    """customer_unique_id, activity_month, cohort_month (the customer's first such month), paid,
    monthly_revenue: one row for each month in which a customer has a delivered order."""
    o = delivered_orders(st, "customer_id", "purchase_date")
    c = st.dim_customers.where("customer_unique_id is not null").select("customer_id", "customer_unique_id")
    b = o.where("purchase_date is not null").join(c, "customer_id").join(payments_per_order(st), "order_id", "left")
    months = (b.groupBy("customer_unique_id", month_start("purchase_date").alias("activity_month"))
              .agg(F.count("pay_rows").alias("_paid"), F.round(F.sum("pay_sum"), 2).alias("monthly_revenue")))
    # a customer has one row a month here, so these windows are as long as the calendar
    first = F.min("activity_month").over(Window.partitionBy("customer_unique_id"))
    return months.select("customer_unique_id", "activity_month", first.alias("cohort_month"),
                         (F.col("_paid") > 0).alias("paid"), "monthly_revenue")


def cohort_data(st: Star) -> DataFrame:
    """cohort_month, month_number, active_customers, cohort_revenue.

    One scan of orders, customers and payments gives both the cohort (first delivered month, paid or
    not) and the activity (paid months).  A customer has one row a month, so each row is a distinct
    customer of its (cohort, month) cell."""
    active = monthly_activity(st).where("paid")
    return (active.groupBy("cohort_month", month_diff("activity_month", "cohort_month").cast("int")
                           .alias("month_number"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("active_customers"),
                 F.sum("monthly_revenue").alias("_rev")))


def cohort_retention(st: Star, max_month: int = 6) -> DataFrame:
    """Cohort retention for months 0..max_month.  Cohort size is month-0
    paying activity; a cohort without month 0 vanishes (inner self-join)."""
    cd = cohort_data(st)
    size = F.max(F.when(F.col("month_number") == 0, F.col("active_customers"))).over(
        Window.partitionBy("cohort_month"))
    return (cd.withColumn("cohort_size", size)
            .where(F.col("cohort_size").isNotNull() & (F.col("month_number") <= max_month))
            .select("cohort_month", "cohort_size", "month_number", "active_customers",
                    pct("active_customers", "cohort_size", 1).alias("retention_pct"),
                    half_up("_rev", 2).alias("cohort_revenue"))
            .orderBy("cohort_month", "month_number"))


# I10 / I11 / I12 ---------------------------------------------------------
def _delivered_items_with_customer(st: Star) -> DataFrame:
    o = delivered_orders(st, "customer_id")
    c = st.dim_customers.select("customer_id", "customer_unique_id")
    oc = o.join(c, "customer_id").select("order_id", "customer_unique_id")
    i = st.fact_order_items.select("order_id", "product_id", "price")
    p = (st.dim_products.where(F.col("category_name_english").isNotNull())
         .select("product_id", "category_name_english"))
    return i.join(oc, "order_id").join(p, "product_id")


def top_categories_per_segment(st: Star, k: int = 5, churn: DataFrame | None = None) -> DataFrame:
    """Top-k categories by revenue per RFM segment (RANK: ties share, so a
    segment may return more than k rows)."""
    ch = (churn if churn is not None else st.ml_churn_predictions).select("customer_unique_id", "rfm_segment")
    b = _delivered_items_with_customer(st).join(ch, "customer_unique_id")
    agg = b.groupBy("rfm_segment", "category_name_english").agg(
        F.count_distinct("order_id").cast("bigint").alias("orders"),
        F.sum("price").alias("_rev"))
    rnk = F.rank().over(Window.partitionBy("rfm_segment").orderBy(F.desc("_rev")))
    return (agg.withColumn("rnk", rnk).where(F.col("rnk") <= k)
            .select("rfm_segment", F.col("category_name_english").alias("category"), "orders",
                    half_up("_rev", 2).alias("revenue"), F.col("rnk").cast("bigint").alias("rnk"))
            .orderBy("rfm_segment", "rnk", "category"))


def category_clv_top15(st: Star, k: int = 15, min_buyers: int = 50,
                       clv: DataFrame | None = None, churn: DataFrame | None = None) -> DataFrame:
    """Average predicted CLV / churn per category (item-weighted), buyers >=
    min_buyers, top k by average CLV with NULL averages first."""
    cl = (clv if clv is not None else st.ml_clv_predictions).select("customer_unique_id", "predicted_clv")
    ch = (churn if churn is not None else st.ml_churn_predictions).select("customer_unique_id",
                                                                            "churn_probability")
    b = (_delivered_items_with_customer(st)
         .join(cl, "customer_unique_id", "left").join(ch, "customer_unique_id", "left"))
    agg = b.groupBy("category_name_english").agg(
        F.count_distinct("customer_unique_id").cast("bigint").alias("unique_buyers"),
        F.avg("predicted_clv").alias("_clv"),
        F.avg("churn_probability").alias("_churn"),
        F.sum("price").alias("_rev"))
    return (agg.where(F.col("unique_buyers") >= min_buyers)
            .select(F.coalesce("category_name_english", F.lit("unknown")).alias("category"),
                    "unique_buyers",
                    half_up("_clv", 2).alias("avg_predicted_clv"),
                    half_up("_churn", 4).alias("avg_churn_probability"),
                    half_up("_rev", 2).alias("total_revenue"))
            .orderBy(F.desc_nulls_first("avg_predicted_clv"), "category").limit(k))


def churn_prediction_summary(st: Star, churn: DataFrame | None = None) -> DataFrame:
    """Prediction audit by segment x label."""
    ch = churn if churn is not None else st.ml_churn_predictions
    return (ch.groupBy("rfm_segment", "churn_label").agg(
        F.count(F.lit(1)).cast("bigint").alias("customers"),
        half_up(F.avg("churn_probability"), 4).alias("avg_churn_prob"),
        half_up(F.avg("monetary"), 2).alias("avg_monetary"))
        .orderBy("rfm_segment", "churn_label"))
