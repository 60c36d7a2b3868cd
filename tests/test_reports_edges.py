"""Edge semantics of the standing reports on hand-made stars."""

import datetime as dt

import pytest

from shopmetrics.plans import features, reports, rfm
from tests.fixtures import cust, item, order, pay, product, review, star


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_fan_out_faithful_and_dedup(spark):
    st = star(spark, [cust("c1", "u1")],
              [order("o1", "c1", "2020-01-05")],
              items=[item(1, "o1", "p1", 100, 5), item(2, "o1", "p1", 50, 7)],
              payments=[pay(1, "o1", 90), pay(2, "o1", 60, seq=2)])
    faithful = reports.monthly_revenue_rollup(st).first()
    # each payment repeats per item (2x), each freight per payment (2x)
    assert faithful["gross_revenue"] == 300.0
    assert faithful["total_freight"] == 24.0
    assert faithful["avg_order_value"] == 75.0
    assert faithful["total_orders"] == 1
    dedup = reports.monthly_revenue_rollup_dedup(st).first()
    assert dedup["gross_revenue"] == 150.0 and dedup["total_freight"] == 12.0
    assert dedup["net_revenue"] == 138.0


def test_mom_growth_first_month_and_zero_previous(spark):
    st = star(spark, [cust("c1", "u1")],
              [order("o1", "c1", "2020-01-05"), order("o2", "c1", "2020-02-05"), order("o3", "c1", "2020-03-05")],
              items=[item(1, "o1", "p", 1), item(2, "o2", "p", 1), item(3, "o3", "p", 1)],
              payments=[pay(1, "o1", 100), pay(2, "o2", 0), pay(3, "o3", 50)])
    got = rows(reports.monthly_revenue_rollup(st), "month", "mom_growth_pct")
    assert got == [(1, None), (2, -100.0), (3, None)]


def test_delivery_rules(spark):
    st = star(spark, [cust("c1", "u1")], [
        order("o1", "c1", "2020-01-01", delivered="2020-01-09 23:00:00", estimated="2020-01-09 23:00:00"),
        order("o2", "c1", "2020-01-02", delivered="2020-01-05"),            # NULL estimate: late
        order("o3", "c1", "2020-01-03"),                                    # not delivered: dropped
    ], reviews=[review("r1", "o1", 5), review("r2", "o1", 3)])
    r = reports.delivery_by_month(st).first()
    # o1 counted once per review (2x), o2 once
    assert r["delivered_orders"] == 3
    assert r["on_time_pct"] == pytest.approx(66.7)
    # 8 days 23 hours counts 8 whole days: (8 + 8 + 3) / 3
    assert r["avg_delivery_days"] == pytest.approx(6.3)
    assert r["avg_review_score"] == 4.0


def test_category_review_fan_out(spark):
    st = star(spark, [cust("c1", "u1")], [order("o1", "c1", "2020-01-01")],
              items=[item(1, "o1", "p1", 10)], products=[product("p1", "toys")],
              reviews=[review("r1", "o1", 5), review("r2", "o1", 1)])
    r = reports.category_revenue_top20(st).first()
    assert (r["items_sold"], r["revenue"], r["avg_review_score"]) == (2, 20.0, 3.0)


def test_cohort_unpaid_first_order_and_gaps(spark):
    st = star(spark, [cust("c1", "u1"), cust("c2", "u2")], [
        order("o1", "c1", "2020-01-10"), order("o2", "c1", "2020-03-10"), order("o3", "c1", "2020-08-01"),
        order("o4", "c2", "2020-01-15"), order("o5", "c2", "2020-02-15"),
    ], payments=[pay(1, "o1", 10), pay(2, "o2", 20), pay(3, "o3", 30), pay(5, "o5", 40)])
    got = rows(reports.cohort_retention(st), "cohort_month", "cohort_size", "month_number", "active_customers")
    jan = dt.date(2020, 1, 1)
    # u2's first (January) order is unpaid: not in the month-0 size, active in month 1
    assert got == [(jan, 1, 0, 1), (jan, 1, 1, 1), (jan, 1, 2, 1)]  # month 7 (August) is cut


def test_top_k_rank_ties(spark):
    prods = [product(f"p{i}", f"cat{i}") for i in range(7)]
    its = [item(i, "o1", f"p{i}", 10 if i < 6 else 5) for i in range(7)]
    churn = [("u1", "Champions", None, None, None, None, None, None)]
    st = star(spark, [cust("c1", "u1")], [order("o1", "c1", "2020-01-01")], items=its, products=prods,
              churn=churn)
    got = reports.top_categories_per_segment(st).collect()
    assert len(got) == 6 and {r["rnk"] for r in got} == {1}


def test_customer_identity_and_recency(spark):
    st = star(spark, [cust("c1", "u1"), cust("c2", "u1")],
              [order("o1", "c1", "2001-07-24 01:00:00"), order("o2", "c2", "2001-06-01")],
              payments=[pay(1, "o1", 10), pay(2, "o2", 30)])
    r = rfm.rfm_raw(st).first()
    assert r["frequency"] == 2 and r["monetary"] == 40.0
    assert r["recency_days"] == 8  # 8 days 23 hours before the as-of instant


def test_one_order_customer_features(spark):
    st = star(spark, [cust("c1", "u1")], [order("o1", "c1", "2001-07-01")], payments=[pay(1, "o1", 12.5)],
              products=[product("p", None)])
    f = features.feature_matrix(st).first()
    assert f["std_order_value"] == 0.0 and f["customer_age_days"] == 0
    assert f["orders_per_month"] == 1.0 and f["revenue_per_day"] == 12.5
    assert f["review_count"] == 0 and f["avg_review_score"] == 3.0 and f["unique_categories"] == 1
    assert f["churned"] == 0  # exactly at the quantile is not churned


@pytest.mark.parametrize("r,f,m,label", [
    (4, 4, 1, "Champions"), (3, 3, 1, "Loyal Customers"), (5, 2, 1, "Recent Customers"),
    (3, 1, 1, "Potential Loyalists"), (2, 3, 1, "At Risk"), (2, 2, 4, "Cannot Lose Them"),
    (1, 1, 1, "Lost"), (2, 2, 2, "Needs Attention"), (1, 1, 5, "Cannot Lose Them"),
])
def test_segment_rule_order(spark, r, f, m, label):
    df = spark.createDataFrame([(r, f, m)], "r_score int, f_score int, m_score int")
    assert df.select(rfm.segment_expr()).first()[0] == label


def test_features_unpaid_order_reviews_still_count(spark):
    st = star(spark, [cust("c1", "u1"), cust("c2", "u2")],
              [order("o1", "c1", "2001-07-01"), order("o2", "c1", "2001-07-20"), order("o3", "c2", "2001-07-05")],
              payments=[pay(1, "o1", 10)],
              reviews=[review("r1", "o2", 4), review("r2", "o2", 2)],
              products=[product("p", None)])
    rows = {r["customer_unique_id"]: r for r in features.feature_matrix(st).collect()}
    assert set(rows) == {"u1"}                     # u2 has no paid order
    f = rows["u1"]
    assert f["frequency"] == 1 and f["recency_days"] == 32.0   # last *paid* order, 2001-07-01
    assert f["review_count"] == 2 and f["avg_review_score"] == 3.0
    base = {r["customer_unique_id"]: r for r in features.rfm_feature_base(st).collect()}
    assert base["u1"]["frequency"] == 1


def test_category_clv_null_average_sorts_first(spark):
    prods = [product("p1", "toys"), product("p2", "tools")]
    churn = [("u1", "Champions", None, None, None, None, None, None)]
    from decimal import Decimal
    clv = [("u2", "Lost", None, Decimal("500.00"), None, None, None, None)]
    st = star(spark, [cust("c1", "u1"), cust("c2", "u2")],
              [order("o1", "c1", "2020-01-01"), order("o2", "c2", "2020-01-02")],
              items=[item(1, "o1", "p1", 10), item(2, "o2", "p2", 20)], products=prods, churn=churn, clv=clv)
    got = rows(reports.category_clv_top15(st, min_buyers=1), "category", "avg_predicted_clv")
    assert got == [("toys", None), ("tools", 500.0)]   # PostgreSQL DESC puts NULLs first


def test_rfm_top_k_counting_equals_full_ranking(spark):
    from pyspark.sql import functions as F

    from shopmetrics.sources.binding import star as bound
    st = bound(spark, "/root/testdata/sf0.001")
    counted = rfm.rfm_top_customers(st, k=20)
    full = (rfm.rfm_labelled(st).orderBy(F.desc_nulls_first("monetary_dec"), "customer_unique_id").limit(20)
            .select(*counted.columns))
    assert full.collect() == counted.collect()
