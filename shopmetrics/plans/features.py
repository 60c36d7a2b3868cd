"""Customer feature table and labels.

The three feature frames are per-customer aggregates keyed by
``customer_unique_id``; they are left-joined on that key (each side already
hash-partitioned on it by its aggregation), imputed and derived with
column expressions only.  The table is meant to be built once and cached /
checkpointed by callers that reuse it (labels, segments, models).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmetrics.functions.core import half_even, half_up, whole_days
from shopmetrics.operators.bucketing import buckets, exact_percentiles, qcut_values_expr
from shopmetrics.operators.selection import Order, linear_quantiles, qcut_starts
from shopmetrics.plans.common import delivered_orders, payments_per_order, reviews_per_order
from shopmetrics.plans.rfm import CUID, customer_order_stats, segment_expr
from shopmetrics.session import ensure_checkpoint_dir
from shopmetrics.sources.binding import Star

# Model feature lists.
FEATURE_COLS = [
    "recency_days", "frequency", "monetary", "avg_order_value", "max_order_value",
    "min_order_value", "std_order_value", "review_count", "avg_review_score",
    "unique_categories", "customer_age_days", "orders_per_month", "revenue_per_day",
]
CLV_FEATURES = [
    "recency_days", "frequency", "avg_order_value", "max_order_value", "min_order_value",
    "std_order_value", "review_count", "avg_review_score", "unique_categories",
    "customer_age_days", "orders_per_month",
]
CHURN_TARGET = "churned"
CLV_TARGET = "monetary"
CHURN_QUANTILE = 0.75
BASELINE_CHURN_DAYS = 180


def rfm_feature_base(st: Star, as_of: _dt.datetime | None = None) -> DataFrame:
    s = customer_order_stats(st, as_of)
    return s.select(
        CUID,
        F.col("recency_days").cast("double").alias("recency_days"),
        "frequency",
        half_up("monetary_dec", 2).alias("monetary"),
        half_up("_avg", 2).alias("avg_order_value"),
        half_up("_max", 2).alias("max_order_value"),
        half_up("_min", 2).alias("min_order_value"),
        half_up("_std", 2).alias("std_order_value"),
        F.col("last_purchase").alias("last_purchase_date"),
        F.col("first_purchase").alias("first_purchase_date"))


def review_features(st: Star) -> DataFrame:
    o = delivered_orders(st, "customer_id")
    c = st.dim_customers.select("customer_id", CUID)
    r = st.fact_reviews.select("order_id", "review_id", "review_score")
    return (o.join(r, "order_id").join(c, "customer_id").groupBy(CUID)
            .agg(F.count("review_id").cast("bigint").alias("review_count"),
                 half_up(F.avg("review_score"), 2).alias("avg_review_score")))


def category_features(st: Star) -> DataFrame:
    o = delivered_orders(st, "customer_id")
    c = st.dim_customers.select("customer_id", CUID)
    i = st.fact_order_items.select("order_id", "product_id")
    p = (st.dim_products.where(F.col("category_name_english").isNotNull())
         .select("product_id", "category_name_english"))
    return (i.join(o, "order_id").join(p, "product_id").join(c, "customer_id").groupBy(CUID)
            .agg(F.count_distinct("category_name_english").cast("bigint").alias("unique_categories")))


def customer_activity(st: Star, as_of: _dt.datetime | None = None) -> DataFrame:
    """RFM and review features of every customer with a paid delivered order,
    from ONE ``groupBy(customer)``.

    Delivered orders are joined once to their customer and, 1:1 on
    ``order_id``, to their per-order payment and review pre-aggregates.
    RFM aggregates are conditional on the order being paid (the reference's
    inner payment join); review sums run over every delivered order (its
    separate review query); customers without a paid order are dropped."""
    from shopmetrics.functions.core import as_of_lit
    o = delivered_orders(st, "customer_id", "purchase_date")
    c = st.dim_customers.select("customer_id", CUID)
    pay = payments_per_order(st).select("order_id", F.col("pay_sum").alias("order_value"), "pay_rows")
    rev = reviews_per_order(st).select("order_id", "review_ids", "score_sum", "score_n")
    b = o.join(c, "customer_id").join(pay, "order_id", "left").join(rev, "order_id", "left")
    paid = F.col("pay_rows").isNotNull()
    ov = F.when(paid, F.col("order_value"))
    agg = b.groupBy(CUID).agg(
        F.max(F.when(paid, F.col("purchase_date"))).alias("last_purchase_date"),
        F.min(F.when(paid, F.col("purchase_date"))).alias("first_purchase_date"),
        F.count(F.when(paid, F.lit(1))).cast("bigint").alias("frequency"),
        F.round(F.sum(ov), 2).alias("_monetary"),
        F.avg(ov).alias("_avg"), F.max(ov).alias("_max"), F.min(ov).alias("_min"),
        F.stddev_samp(ov.cast("double")).alias("_std"),
        F.sum("review_ids").alias("_review_ids"),
        F.sum("score_sum").alias("_score_sum"),
        F.sum("score_n").alias("_score_n"))
    return agg.where(F.col("frequency") > 0).select(
        CUID,
        whole_days(as_of_lit(as_of), "last_purchase_date").cast("double").alias("recency_days"),
        "frequency",
        half_up("_monetary", 2).alias("monetary"),
        half_up("_avg", 2).alias("avg_order_value"),
        half_up("_max", 2).alias("max_order_value"),
        half_up("_min", 2).alias("min_order_value"),
        half_up("_std", 2).alias("std_order_value"),
        "last_purchase_date", "first_purchase_date",
        F.col("_review_ids").cast("bigint").alias("review_count"),
        half_up(F.col("_score_sum").cast("decimal(38,6)") / F.nullif(F.col("_score_n"), F.lit(0)), 2)
        .alias("avg_review_score"))


def feature_matrix(st: Star, as_of: _dt.datetime | None = None,
                   churn_quantile: float = CHURN_QUANTILE) -> DataFrame:
    """J4 + J5: merged, imputed and derived features plus the churn label
    (recency strictly above its linear-interpolated quantile)."""
    # The facts are read once: the label's quantile comes from the written activity.
    ensure_checkpoint_dir(st.fact_orders.sparkSession)
    activity = customer_activity(st, as_of).checkpoint()
    threshold = linear_quantiles(activity, {"recency_days": [churn_quantile]})["recency_days"][0]
    df = (activity.join(category_features(st), CUID, "left")
          .fillna({"review_count": 0, "avg_review_score": 3.0, "unique_categories": 1,
                   "std_order_value": 0.0}))
    age = whole_days("last_purchase_date", "first_purchase_date")
    df = df.withColumn("customer_age_days", F.coalesce(age, F.lit(0)).cast("bigint"))
    positive = F.col("customer_age_days") > 0
    df = df.withColumns({
        "orders_per_month": half_even(
            F.when(positive, F.col("frequency") / (F.col("customer_age_days") / 30.0))
            .otherwise(F.col("frequency").cast("double")), 4),
        "revenue_per_day": half_even(
            F.when(positive, F.col("monetary") / F.col("customer_age_days"))
            .otherwise(F.col("monetary")), 4),
    })
    return with_churn_label(df, churn_quantile, threshold)


def churn_threshold(df: DataFrame, q: float = CHURN_QUANTILE) -> float | None:
    """Linear-interpolated quantile of recency ."""
    return exact_percentiles(df, "recency_days", [q])[0]


def with_churn_label(df: DataFrame, q: float = CHURN_QUANTILE, threshold: float | None = None) -> DataFrame:
    thr = threshold if threshold is not None else churn_threshold(df, q)
    label = F.when(F.col("recency_days") > F.lit(thr), 1).otherwise(0) if thr is not None else F.lit(0)
    return df.withColumn(CHURN_TARGET, label.cast("int"))


def rfm_segments_features(features: DataFrame) -> DataFrame:
    """J7: quantile-bin RFM scores as the pandas pipeline computes them.

    r: qcut of recency values (labels 5..1, recent = 5, duplicate edges raise);
    f, m: qcut of the first-occurrence rank (ties broken by customer id)."""
    ensure_checkpoint_dir(features.sparkSession)
    once = features.checkpoint()
    edges = linear_quantiles(once, {"recency_days": [j / 5 for j in range(6)]})["recency_days"]
    df = buckets(once, {"f_score": (Order("frequency", id=CUID), qcut_starts(5)),
                        "m_score": (Order("monetary", id=CUID), qcut_starts(5))})
    df = df.withColumn("r_score", qcut_values_expr("recency_days", edges, [5, 4, 3, 2, 1]).cast("int"))
    return df.withColumn("rfm_segment", segment_expr())


def churn_baseline(st: Star, as_of: _dt.datetime | None = None, days: int = BASELINE_CHURN_DAYS) -> DataFrame:
    """J6: fixed-threshold churn over all delivered customers (paid or not)."""
    o = delivered_orders(st, "customer_id", "purchase_date")
    c = st.dim_customers.select("customer_id", CUID)
    from shopmetrics.functions.core import as_of_lit
    per = (o.join(c, "customer_id").groupBy(CUID)
           .agg(whole_days(as_of_lit(as_of), F.max("purchase_date")).alias("recency_days")))
    agg = per.agg(F.sum(F.when(F.col("recency_days") > days, 1).otherwise(0)).cast("bigint").alias("churned"),
                  F.count(F.lit(1)).cast("bigint").alias("total"))
    from shopmetrics.functions.core import pct
    return agg.withColumn("churn_rate_pct", pct("churned", "total", 1))


def recency_days(st: Star, as_of: _dt.datetime | None = None) -> DataFrame:
    """H4: whole days from each delivered customer's last purchase to as-of."""
    from shopmetrics.functions.core import as_of_lit
    o = delivered_orders(st, "customer_id", "purchase_date")
    c = st.dim_customers.select("customer_id", CUID)
    return (o.join(c, "customer_id").groupBy(CUID)
            .agg(F.max("purchase_date").alias("last_purchase"))
            .withColumn("recency_days", whole_days(as_of_lit(as_of), "last_purchase")))
