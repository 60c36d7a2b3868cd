"""RFM scoring.

order totals -> per-customer RFM aggregates -> three NTILE(5) scores by
boundary search -> eight-way segment rule.  Ties in every ordering are broken by
``customer_unique_id`` (the reference leaves them to the engine).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopmetrics.functions.core import as_of_lit, half_up, pct, whole_days
from shopmetrics.operators.bucketing import buckets
from shopmetrics.operators.selection import Order, ntile_starts
from shopmetrics.plans.common import delivered_orders, payments_per_order
from shopmetrics.session import ensure_checkpoint_dir
from shopmetrics.sources.binding import Star

CUID = "customer_unique_id"

# Segment names of the eight-way rule, in rule order.
SEGMENTS = ["Champions", "Loyal Customers", "Recent Customers", "Potential Loyalists",
            "At Risk", "Cannot Lose Them", "Lost", "Needs Attention"]


def segment_expr(r="r_score", f="f_score", m="m_score") -> Column:
    """First matching rule wins (searched CASE)."""
    r, f, m = F.col(r), F.col(f), F.col(m)
    return (F.when((r >= 4) & (f >= 4), SEGMENTS[0])
            .when((r >= 3) & (f >= 3), SEGMENTS[1])
            .when((r >= 4) & (f <= 2), SEGMENTS[2])
            .when((r >= 3) & (f <= 2), SEGMENTS[3])
            .when((r <= 2) & (f >= 3), SEGMENTS[4])
            .when((r <= 2) & (m >= 4), SEGMENTS[5])
            .when((r == 1) & (f == 1), SEGMENTS[6])
            .otherwise(SEGMENTS[7]))


def order_totals(st: Star) -> DataFrame:
    """One row per paid delivered order: order_id, customer, purchase_date,
    order_value (exact decimal sum of its payments)."""
    o = delivered_orders(st, "customer_id", "purchase_date")
    c = st.dim_customers.select("customer_id", CUID)
    pay = payments_per_order(st).select("order_id", F.col("pay_sum").alias("order_value"))
    return o.join(pay, "order_id").join(c, "customer_id").select("order_id", CUID, "purchase_date", "order_value")


def customer_order_stats(st: Star, as_of: _dt.datetime | None = None) -> DataFrame:
    """Per-customer aggregates of order totals (one partial+final hash agg)."""
    ot = order_totals(st)
    agg = ot.groupBy(CUID).agg(
        F.max("purchase_date").alias("last_purchase"),
        F.min("purchase_date").alias("first_purchase"),
        F.count(F.lit(1)).cast("bigint").alias("frequency"),
        F.round(F.sum("order_value"), 2).alias("monetary_dec"),
        F.avg("order_value").alias("_avg"),
        F.max("order_value").alias("_max"),
        F.min("order_value").alias("_min"),
        F.stddev_samp(F.col("order_value").cast("double")).alias("_std"))
    return agg.withColumn("recency_days", whole_days(as_of_lit(as_of), "last_purchase"))


def rfm_raw(st: Star, as_of: _dt.datetime | None = None) -> DataFrame:
    s = customer_order_stats(st, as_of)
    return s.select(CUID, F.col("recency_days").cast("bigint").alias("recency_days"), "frequency",
                    half_up("monetary_dec", 2).alias("monetary"),
                    half_up("_avg", 2).alias("avg_order_value"),
                    half_up("_max", 2).alias("max_order_value"),
                    "last_purchase", "first_purchase", "monetary_dec")


def rfm_scored(st: Star, as_of: _dt.datetime | None = None) -> DataFrame:
    """rfm_raw plus NTILE(5) r/f/m scores (recency DESC, frequency and
    monetary ASC; NULLs first on DESC and last on ASC as PostgreSQL)."""
    return _score(rfm_raw(st, as_of))


def _score(raw: DataFrame) -> DataFrame:
    """The customers are written once; the twelve boundaries of the three orders are searched in
    them together, and one projection gives all scores."""
    ensure_checkpoint_dir(raw.sparkSession)
    return buckets(raw.checkpoint(), {
        "r_score": (Order("recency_days", ascending=False, nulls_first=True, id=CUID), ntile_starts(5)),
        "f_score": (Order("frequency", id=CUID), ntile_starts(5)),
        "m_score": (Order("monetary_dec", id=CUID), ntile_starts(5))})


def rfm_labelled(st: Star, as_of: _dt.datetime | None = None) -> DataFrame:
    return rfm_scored(st, as_of).withColumn("rfm_segment", segment_expr())


_RFM_COLS = [CUID, "recency_days", "frequency", "monetary", "avg_order_value", "max_order_value",
             "last_purchase", "first_purchase", "r_score", "f_score", "m_score"]


def rfm_segments_sql(st: Star, as_of=None) -> DataFrame:
    """Every customer with scores and segment (the SQL scoring variant)."""
    return rfm_labelled(st, as_of).select(*_RFM_COLS, "rfm_segment")


# The three NTILE orders of the scoring, as (column, ascending, nulls_first).
SCORE_ORDERS = {
    "r": [("recency_days", False, True), (CUID, True, False)],
    "f": [("frequency", True, False), (CUID, True, False)],
    "m": [("monetary_dec", True, False), (CUID, True, False)],
}


def st_spark(st):
    return st.fact_orders.sparkSession


def rfm_top_customers(st: Star, k: int = 20, as_of=None) -> DataFrame:
    """Top k customers by monetary with their NTILE(5) scores.

    The per-customer table is materialised once, and only the k reported rows
    are ranked, by counting in one aggregation pass the customers that sort
    before each of them (``ranks_of_rows``): exactly the NTILE of a full
    ranking, at every size."""
    ensure_checkpoint_dir(st_spark(st))
    raw = rfm_raw(st, as_of).checkpoint()
    out_cols = [CUID, "recency_days", "frequency", "monetary", "avg_order_value",
                "r_score", "f_score", "m_score", "rfm_segment", "last_purchase"]
    top_order = [F.desc_nulls_first("monetary_dec"), F.col(CUID)]
    return _top_by_counting(raw, k, top_order, out_cols)


def _top_by_counting(raw: DataFrame, k: int, top_order, out_cols) -> DataFrame:
    from pyspark.sql import types as T

    from shopmetrics.operators.bucketing import ntile_of_rank, ranks_of_rows
    cols = [CUID, "recency_days", "frequency", "monetary", "avg_order_value", "last_purchase", "monetary_dec"]
    top_df = raw.orderBy(*top_order).limit(k).select(*cols)
    top = [r.asDict() for r in top_df.collect()]          # the report itself: k rows
    ranks, n = ranks_of_rows(raw, SCORE_ORDERS, top)
    scored = [(*[row[c] for c in cols], ntile_of_rank(rk["r"], n, 5), ntile_of_rank(rk["f"], n, 5),
               ntile_of_rank(rk["m"], n, 5)) for row, rk in zip(top, ranks)]
    schema = T.StructType(top_df.schema.fields + [T.StructField(c, T.IntegerType())
                                                  for c in ("r_score", "f_score", "m_score")])
    out = raw.sparkSession.createDataFrame(scored, schema).withColumn("rfm_segment", segment_expr())
    return out.orderBy(*top_order).select(*out_cols)


def rfm_segment_summary(st: Star, as_of=None) -> DataFrame:
    """Segment summary over the labelled customers (fixes the reference's
    out-of-scope CTE by reusing the same labelled DataFrame)."""
    lab = rfm_labelled(st, as_of)
    agg = lab.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).cast("bigint").alias("customers"),
        F.avg("monetary_dec").alias("_avg_m"),
        F.sum("monetary_dec").alias("_sum_m"),
        F.avg("recency_days").alias("_rec"),
        F.avg("frequency").alias("_freq"))
    everything = Window.partitionBy()  # over <= 8 aggregated rows
    return agg.select(
        "rfm_segment", "customers",
        pct("customers", F.sum("customers").over(everything), 1).alias("pct_customers"),
        half_up("_avg_m", 2).alias("avg_monetary"),
        half_up("_sum_m", 2).alias("total_monetary"),
        pct("_sum_m", F.sum("_sum_m").over(everything), 1).alias("pct_revenue"),
        half_up("_rec", 0).alias("avg_recency_days"),
        half_up("_freq", 2).alias("avg_frequency"),
    ).orderBy(F.desc("avg_monetary"), "rfm_segment")
