"""DuckDB oracle SQL for RFM scoring, bucketing and the feature table."""

from __future__ import annotations

from shopmetrics.plans.oracle_views import AS_OF_SQL, DAYS, HE, PCT, R

ORACLE = {}

# Every delivered order with its buyer, and what was paid for it.
DELIVERED = """
delivered AS (
    SELECT order_id, purchase_date, (SELECT any_value(customer_unique_id) FROM dim_customers d WHERE d.customer_id = f.customer_id) AS buyer
    FROM fact_orders f WHERE order_status = 'delivered')"""

PAID = f"""{DELIVERED},
paid AS (
    SELECT buyer, order_id, purchase_date, due
    FROM delivered SEMI JOIN dim_customers ON buyer = customer_unique_id
    JOIN (SELECT order_id, SUM(payment_value) AS due FROM fact_payments GROUP BY ALL) USING (order_id))"""

# One row a buyer: lists of order values and days, from which every figure is read.
BUYERS = f"""{PAID},
buyers AS (
    SELECT buyer, list(due) AS spent, list(CAST(due AS DOUBLE)) AS spent_f, max(purchase_date) AS newest, min(purchase_date) AS oldest
    FROM paid GROUP BY buyer),
measures AS (
    SELECT buyer AS customer_unique_id, {DAYS(AS_OF_SQL, 'newest')} AS recency_days, len(spent) AS frequency,
           round(list_sum(spent), 2) AS monetary_dec, {R('list_avg(spent)', 2)} AS avg_order_value,
           {R('list_max(spent)', 2)} AS max_order_value, {R('list_min(spent)', 2)} AS min_order_value,
           {R('list_stddev_samp(spent_f)', 2)} AS std_order_value, newest, oldest
    FROM buyers)"""


def fifth(order: str) -> str:
    """Which of five shares, the first ones larger by a row, a row's place in ``order`` falls into."""
    at = f"(ROW_NUMBER() OVER (ORDER BY {order}, customer_unique_id) - 1)"
    n = "(COUNT(*) OVER ())"
    return (f"CAST(CASE WHEN {at} < ({n} % 5) * ({n} // 5 + 1) THEN {at} // ({n} // 5 + 1) "
            f"ELSE {n} % 5 + ({at} - ({n} % 5) * ({n} // 5 + 1)) // ({n} // 5) END + 1 AS INTEGER)")


SCORES = f"""{BUYERS},
scores AS (
    SELECT *, {fifth('recency_days DESC NULLS FIRST')} AS r_score, {fifth('frequency NULLS LAST')} AS f_score,
           {fifth('monetary_dec NULLS LAST')} AS m_score
    FROM measures)"""

# Segments in order of precedence, with the least and greatest scores that they admit.
RULES = """
rules(place, segment, r_least, r_most, f_least, f_most, m_least) AS (VALUES
    (1, 'Champions', 4, 5, 4, 5, 1),
    (2, 'Loyal Customers', 3, 5, 3, 5, 1),
    (3, 'Recent Customers', 4, 5, 1, 2, 1),
    (4, 'Potential Loyalists', 3, 5, 1, 2, 1),
    (5, 'At Risk', 1, 2, 3, 5, 1),
    (6, 'Cannot Lose Them', 1, 2, 1, 5, 4),
    (7, 'Lost', 1, 1, 1, 1, 1))"""


def segmented(scored: str, name: str) -> str:
    """CTEs that add the first admitting rule's segment to the rows of ``scored``."""
    return f"""{RULES},
{name} AS (
    SELECT s.*, coalesce((SELECT arg_min(segment, place) FROM rules
        WHERE s.r_score BETWEEN r_least AND r_most AND s.f_score BETWEEN f_least AND f_most AND s.m_score >= m_least), 'Needs Attention') AS rfm_segment
    FROM {scored} s)"""


SEGMENTED = f"{SCORES}, {segmented('scores', 'segmented')}"

_RFM_OUT = """customer_unique_id, recency_days, CAST(frequency AS BIGINT) AS frequency, CAST(monetary_dec AS DOUBLE) AS monetary,
    avg_order_value, max_order_value, newest AS last_purchase, oldest AS first_purchase"""
_SCORES_OUT = "r_score, f_score, m_score"

ORACLE["order_totals"] = f"""WITH {PAID}
SELECT order_id, buyer AS customer_unique_id, purchase_date, {R('due', 2)} AS order_value FROM paid"""

ORACLE["rfm_raw"] = f"WITH {BUYERS} SELECT {_RFM_OUT} FROM measures"
ORACLE["rfm_scored"] = f"WITH {SCORES} SELECT {_RFM_OUT}, {_SCORES_OUT} FROM scores"
ORACLE["rfm_segments_sql"] = f"WITH {SEGMENTED} SELECT {_RFM_OUT}, {_SCORES_OUT}, rfm_segment FROM segmented"

ORACLE["rfm_top_customers"] = f"""WITH {SEGMENTED},
placed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY monetary_dec DESC NULLS FIRST, customer_unique_id) AS place FROM segmented)
SELECT customer_unique_id, recency_days, CAST(frequency AS BIGINT) AS frequency, CAST(monetary_dec AS DOUBLE) AS monetary,
       avg_order_value, {_SCORES_OUT}, rfm_segment, newest AS last_purchase
FROM placed WHERE place <= 20"""

ORACLE["rfm_segment_summary"] = f"""WITH {SEGMENTED},
whole AS (SELECT COUNT(*) AS n, SUM(monetary_dec) AS money FROM segmented),
parts AS (
    SELECT rfm_segment, COUNT(*) AS n, SUM(monetary_dec) AS money, AVG(monetary_dec) AS mean, AVG(recency_days) AS days, AVG(frequency) AS orders
    FROM segmented GROUP BY rfm_segment)
SELECT rfm_segment, CAST(parts.n AS BIGINT) AS customers, {PCT('parts.n', 'whole.n')} AS pct_customers,
       {R('mean', 2)} AS avg_monetary, {R('parts.money', 2)} AS total_monetary,
       {PCT('parts.money', 'whole.money')} AS pct_revenue, {R('days', 0)} AS avg_recency_days, {R('orders', 2)} AS avg_frequency
FROM parts, whole"""

# Distributed NTILE on a larger input: deciles of all order values.
ORACLE["ntile_distributed"] = f"""
WITH ov AS (SELECT order_id, SUM(payment_value) AS v FROM fact_payments GROUP BY order_id)
SELECT order_id, {R('v', 2)} AS order_value,
       CAST(NTILE(10) OVER (ORDER BY v, order_id) AS INTEGER) AS decile
FROM ov"""

_BASE = f"""{BUYERS},
base AS (
    SELECT * EXCLUDE (recency_days, frequency, monetary_dec, newest, oldest), CAST(recency_days AS DOUBLE) AS recency_days,
           CAST(frequency AS BIGINT) AS frequency, CAST(monetary_dec AS DOUBLE) AS monetary,
           newest AS last_purchase_date, oldest AS first_purchase_date
    FROM measures)"""

# Reviews are summed by order, then by buyer.
_REVIEWS = f"""
reviewed AS (
    SELECT buyer, SUM(n) AS n, SUM(points) AS points, SUM(rated) AS rated
    FROM delivered JOIN (SELECT order_id, COUNT(review_id) AS n, SUM(review_score) AS points, COUNT(review_score) AS rated
                         FROM fact_reviews GROUP BY order_id) USING (order_id)
    GROUP BY buyer),
opinions AS (
    SELECT buyer AS customer_unique_id, CAST(n AS BIGINT) AS review_count,
           {R('CAST(points AS DOUBLE) / nullif(rated, 0)', 2)} AS avg_review_score FROM reviewed)"""

_BREADTH = """
bought AS (
    SELECT DISTINCT buyer, category_name_english FROM delivered JOIN fact_order_items USING (order_id) JOIN dim_products USING (product_id)),
breadth AS (
    SELECT buyer AS customer_unique_id, COUNT(category_name_english) AS unique_categories
    FROM bought GROUP BY buyer HAVING COUNT(category_name_english) > 0)"""

_FEATURES = f"""
filled AS (
    SELECT * REPLACE (coalesce(std_order_value, 0.0) AS std_order_value, coalesce(review_count, 0) AS review_count,
                      coalesce(avg_review_score, 3.0) AS avg_review_score, coalesce(unique_categories, 1) AS unique_categories),
           coalesce({DAYS('last_purchase_date', 'first_purchase_date')}, 0) AS customer_age_days,
           (SELECT quantile_cont(recency_days, 0.75) FROM base) AS late
    FROM base LEFT JOIN opinions USING (customer_unique_id) LEFT JOIN breadth USING (customer_unique_id)),
features AS (
    SELECT * EXCLUDE (late),
        {HE("coalesce(frequency / (nullif(greatest(customer_age_days, 0), 0) / 30.0), CAST(frequency AS DOUBLE))", 4)} AS orders_per_month,
        {HE("coalesce(monetary / nullif(greatest(customer_age_days, 0), 0), monetary)", 4)} AS revenue_per_day,
        CAST(coalesce(recency_days > late, false) AS INTEGER) AS churned
    FROM filled)"""

FEATURES_CTES = f"{_BASE}, {_REVIEWS}, {_BREADTH}, {_FEATURES}"

ORACLE["rfm_feature_base"] = f"WITH {_BASE} SELECT * FROM base"
ORACLE["review_features"] = f"WITH {DELIVERED}, {_REVIEWS} SELECT * FROM opinions"
ORACLE["category_features"] = f"WITH {DELIVERED}, {_BREADTH} SELECT * FROM breadth"
ORACLE["feature_matrix"] = f"WITH {FEATURES_CTES} SELECT * FROM features"
ORACLE["churn_label_quantile"] = f"""WITH {FEATURES_CTES}
SELECT customer_unique_id, recency_days, churned FROM features"""

ORACLE["recency_days"] = f"""
SELECT c.customer_unique_id, MAX(o.purchase_date) AS last_purchase,
       {DAYS(AS_OF_SQL, 'MAX(o.purchase_date)')} AS recency_days
FROM fact_orders o JOIN dim_customers c ON c.customer_id = o.customer_id
WHERE o.order_status = 'delivered' GROUP BY c.customer_unique_id"""

ORACLE["churn_baseline"] = f"""
SELECT CAST(SUM(CASE WHEN recency_days > 180 THEN 1 ELSE 0 END) AS BIGINT) AS churned,
       CAST(COUNT(*) AS BIGINT) AS total,
       {PCT('SUM(CASE WHEN recency_days > 180 THEN 1 ELSE 0 END)', 'COUNT(*)')} AS churn_rate_pct
FROM (SELECT c.customer_unique_id, {DAYS(AS_OF_SQL, 'MAX(o.purchase_date)')} AS recency_days
      FROM fact_orders o JOIN dim_customers c ON c.customer_id = o.customer_id
      WHERE o.order_status = 'delivered' GROUP BY c.customer_unique_id) t"""

_SEGMENTS_FEATURES = """
edges AS (SELECT quantile_cont(recency_days, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e FROM features),
qf AS (
    SELECT f.*,
        CAST(CASE WHEN recency_days <= e[2] THEN 5 WHEN recency_days <= e[3] THEN 4
                  WHEN recency_days <= e[4] THEN 3 WHEN recency_days <= e[5] THEN 2
                  WHEN recency_days <= e[6] THEN 1 END AS INTEGER) AS r_score,
        ROW_NUMBER() OVER (ORDER BY frequency NULLS LAST, customer_unique_id) AS fr,
        ROW_NUMBER() OVER (ORDER BY monetary NULLS LAST, customer_unique_id) AS mr,
        COUNT(*) OVER () AS n
    FROM features f, edges),
segs AS (
    SELECT *,
        CAST(CASE WHEN n <= 1 THEN 1 ELSE greatest(1, CAST(ceil(5.0 * (fr - 1) / (n - 1)) AS INTEGER)) END
             AS INTEGER) AS f_score,
        CAST(CASE WHEN n <= 1 THEN 1 ELSE greatest(1, CAST(ceil(5.0 * (mr - 1) / (n - 1)) AS INTEGER)) END
             AS INTEGER) AS m_score
    FROM qf)"""

SEGMENTS_CTES = f"{FEATURES_CTES}, {_SEGMENTS_FEATURES}, {segmented('segs', 'labelled')}"

ORACLE["rfm_segments_features"] = f"""WITH {SEGMENTS_CTES}
SELECT customer_unique_id, recency_days, frequency, monetary, r_score, f_score, m_score, rfm_segment
FROM labelled"""

ORACLE["qcut_rank"] = f"""WITH {SEGMENTS_CTES}
SELECT customer_unique_id, frequency, f_score FROM labelled"""

ORACLE["qcut_values"] = f"""WITH {SEGMENTS_CTES}
SELECT customer_unique_id, recency_days, r_score FROM labelled"""

ORACLE["churn_label_bins"] = """
SELECT customer_unique_id, CAST(churn_probability AS DOUBLE) AS churn_probability,
       CASE WHEN churn_probability <= 0.33 THEN 'Low' WHEN churn_probability <= 0.66 THEN 'Medium'
            WHEN churn_probability <= 1.0 THEN 'High' END AS churn_label
FROM ml_churn_predictions"""

ORACLE["segment_churn_stats"] = f"""WITH {SEGMENTS_CTES},
s AS (SELECT rfm_segment, COUNT(*) AS customers, AVG(monetary) AS am, AVG(recency_days) AS ar,
             AVG(churned) AS cr FROM labelled GROUP BY rfm_segment)
SELECT rfm_segment, CAST(customers AS BIGINT) AS customers,
       {HE('am', 2)} AS avg_monetary, {HE('ar', 2)} AS avg_recency,
       {HE('cr', 2)} AS churn_rate,
       {HE('customers * 100.0 / SUM(customers) OVER ()', 1)} AS pct_customers
FROM s ORDER BY avg_monetary DESC"""
