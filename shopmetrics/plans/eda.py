"""EDA tables: the data behind the reference's charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmetrics.functions.core import half_up, month_start, pct
from shopmetrics.operators import stats
from shopmetrics.plans.common import delivered_orders, payments_per_order
from shopmetrics.session import ensure_checkpoint_dir
from shopmetrics.sources.binding import Star

HIST_BINS = 60
CLASS_HIST_BINS = 40
# Features plotted per churn class.
KEY_FEATURES = ["recency_days", "frequency", "monetary", "avg_order_value",
                "review_count", "avg_review_score", "unique_categories", "customer_age_days"]


def order_status_counts(st: Star) -> DataFrame:
    agg = st.fact_orders.groupBy("order_status").agg(F.count(F.lit(1)).cast("bigint").alias("orders"))
    return (agg.withColumn("share_pct", pct("orders", F.sum("orders").over(Window.partitionBy()), 1))
            .orderBy(F.desc("orders"), "order_status"))


def eda_monthly_revenue(st: Star) -> DataFrame:
    o = delivered_orders(st, "purchase_date")
    b = o.join(payments_per_order(st), "order_id")
    return (b.groupBy(month_start("purchase_date").alias("month"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("orders"),
                 F.round(F.sum("pay_sum"), 2).alias("_rev"))
            .select("month", "orders", half_up("_rev", 2).alias("revenue"), "_rev").orderBy("month"))


def eda_revenue_totals(st: Star) -> DataFrame:
    m = eda_monthly_revenue(st)
    return m.agg(half_up(F.sum("_rev"), 2).alias("total_revenue"),
                 F.sum("orders").cast("bigint").alias("total_orders"),
                 half_up(F.max("_rev"), 2).alias("peak_month_revenue"))


def order_values(st: Star) -> DataFrame:
    """Sum of payments per order (all payments, no status filter)."""
    return payments_per_order(st).select("order_id", half_up("pay_sum", 2).alias("order_value"))


def order_values_once(st: Star) -> DataFrame:
    """The order values written once: quantiles, ranges and bins each read them."""
    ensure_checkpoint_dir(st.fact_orders.sparkSession)
    return order_values(st).checkpoint()


def order_value_describe(st: Star) -> DataFrame:
    return stats.describe(order_values_once(st), "order_value")


def order_value_trim_p99(st: Star) -> DataFrame:
    return stats.trim_at_quantile(order_values_once(st), "order_value", 0.99)


def order_value_histogram(st: Star) -> DataFrame:
    return stats.histogram(order_value_trim_p99(st), "order_value", HIST_BINS)


def order_value_boxplot(st: Star) -> DataFrame:
    return stats.boxplot_stats(order_value_trim_p99(st), "order_value")


def eda_top_categories(st: Star, k: int = 15) -> DataFrame:
    i = st.fact_order_items.select("order_id", "product_id", "price")
    p = st.dim_products.select("product_id", "category_name_english")
    b = i.join(delivered_orders(st), "order_id").join(p, "product_id")
    agg = b.groupBy(F.coalesce("category_name_english", F.lit("unknown")).alias("category")).agg(
        F.count(F.lit(1)).cast("bigint").alias("items_sold"), F.sum("price").alias("_rev"))
    return (agg.select("category", "items_sold", half_up("_rev", 2).alias("revenue"))
            .orderBy(F.desc("revenue"), "category").limit(k))


def review_score_distribution(st: Star) -> DataFrame:
    return (st.fact_reviews.groupBy("review_score").agg(F.count(F.lit(1)).cast("bigint").alias("reviews"))
            .orderBy("review_score"))


def review_score_summary(st: Star) -> DataFrame:
    s = F.col("review_score")
    return st.fact_reviews.agg(
        F.count(F.lit(1)).cast("bigint").alias("reviews"),
        half_up(F.avg(s), 2).alias("avg_score"),
        pct(F.sum(F.when(s == 5, 1).otherwise(0)), F.count(F.lit(1)), 1).alias("pct_5_star"),
        pct(F.sum(F.when(s == 1, 1).otherwise(0)), F.count(F.lit(1)), 1).alias("pct_1_star"))


def eda_state_top12(st: Star, k: int = 12) -> DataFrame:
    o = delivered_orders(st, "customer_id")
    c = st.dim_customers.select("customer_id", "customer_unique_id", "state")
    b = o.join(payments_per_order(st), "order_id").join(c, "customer_id")
    agg = b.groupBy("state").agg(
        F.count_distinct("customer_unique_id").cast("bigint").alias("customers"),
        F.count(F.lit(1)).cast("bigint").alias("orders"),
        F.sum("pay_sum").alias("_rev"))
    return (agg.select("state", "customers", "orders", half_up("_rev", 2).alias("revenue"))
            .orderBy(F.desc("revenue"), "state").limit(k))


def monetary_describe(features: DataFrame) -> DataFrame:
    return stats.describe(features, "monetary")


def monetary_trim_p95(features: DataFrame) -> DataFrame:
    return stats.trim_at_quantile(features.select("customer_unique_id", "monetary"), "monetary", 0.95)


def monetary_histograms(features: DataFrame) -> DataFrame:
    raw = stats.histogram(monetary_trim_p95(features), "monetary", HIST_BINS, label="raw_p95")
    logged = features.select(half_up(F.log1p("monetary"), 9).alias("log_monetary"))
    return raw.unionByName(stats.histogram(logged, "log_monetary", HIST_BINS, label="log1p"))


def feature_histograms_by_class(features: DataFrame, cols: list[str] | None = None,
                                bins: int = CLASS_HIST_BINS) -> DataFrame:
    """Per (feature, churn class) density histograms: unpivot with ``stack``
    then one grouped histogram job."""
    cols = cols or KEY_FEATURES
    long_df = features.select(
        F.col("churned").alias("churned"),
        F.expr("stack({n}, {pairs}) as (feature, value)".format(
            n=len(cols), pairs=", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols))))
    return stats.grouped_density_histograms(long_df, ["feature", "churned"], "value", bins)
