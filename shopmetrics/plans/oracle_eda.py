"""DuckDB oracle SQL for the EDA tables."""

from __future__ import annotations

from shopmetrics.plans.oracle_rfm import FEATURES_CTES
from shopmetrics.plans.oracle_views import HE, PCT, R

ORACLE = {}

ORACLE["order_status_counts"] = f"""
SELECT order_status, CAST(COUNT(*) AS BIGINT) AS orders,
       {PCT('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS share_pct
FROM fact_orders GROUP BY order_status"""

_MONTHLY = """
monthly AS (
    SELECT CAST(date_trunc('month', o.purchase_date) AS DATE) AS month,
           COUNT(DISTINCT o.order_id) AS orders, round(SUM(p.payment_value), 2) AS revenue
    FROM fact_orders o JOIN fact_payments p ON p.order_id = o.order_id
    WHERE o.order_status = 'delivered' GROUP BY 1)"""

ORACLE["eda_monthly_revenue"] = f"""WITH {_MONTHLY}
SELECT month, CAST(orders AS BIGINT) AS orders, {R('revenue', 2)} AS revenue FROM monthly ORDER BY month"""

ORACLE["eda_revenue_totals"] = f"""WITH {_MONTHLY}
SELECT {R('SUM(revenue)', 2)} AS total_revenue, CAST(SUM(orders) AS BIGINT) AS total_orders,
       {R('MAX(revenue)', 2)} AS peak_month_revenue FROM monthly"""

_ORDER_VALUES = f"""
ov AS (SELECT order_id, {R('SUM(payment_value)', 2)} AS order_value FROM fact_payments GROUP BY order_id)"""
_TRIM99 = f"""{_ORDER_VALUES},
clean AS (SELECT * FROM ov WHERE order_value <= (SELECT quantile_cont(order_value, 0.99) FROM ov))"""

ORACLE["order_values"] = f"WITH {_ORDER_VALUES} SELECT * FROM ov"
ORACLE["order_value_trim_p99"] = f"WITH {_TRIM99} SELECT * FROM clean"


def _describe(src: str, col: str) -> str:
    return f"""SELECT CAST(COUNT({col}) AS BIGINT) AS count, {HE(f'AVG({col})', 2)} AS mean,
       {HE(f'stddev_samp({col})', 2)} AS std, {HE(f'MIN({col})', 2)} AS min,
       {HE(f'quantile_cont({col}, 0.25)', 2)} AS p25, {HE(f'quantile_cont({col}, 0.5)', 2)} AS p50,
       {HE(f'quantile_cont({col}, 0.75)', 2)} AS p75, {HE(f'MAX({col})', 2)} AS max FROM {src}"""


ORACLE["order_value_describe"] = f"WITH {_ORDER_VALUES} {_describe('ov', 'order_value')}"


def _histogram(src: str, col: str, bins: int, kind: str | None = None) -> str:
    kind_col = f"'{kind}' AS kind, " if kind else ""
    return f"""(WITH mm AS (SELECT MIN(CAST({col} AS DOUBLE)) AS lo, MAX(CAST({col} AS DOUBLE)) AS hi FROM {src}),
b AS (SELECT CASE WHEN mm.hi = mm.lo THEN 0 ELSE
             LEAST(CAST(floor((CAST({col} AS DOUBLE) - mm.lo) / (mm.hi - mm.lo) * {bins}) AS INTEGER), {bins - 1})
             END AS bin
      FROM {src}, mm WHERE {col} IS NOT NULL),
c AS (SELECT bin, COUNT(*) AS n FROM b GROUP BY bin)
SELECT {kind_col}CAST(r.range AS INTEGER) AS bin,
       {R(f'mm.lo + r.range * ((mm.hi - mm.lo) / {bins})', 6)} AS bin_start,
       {R(f'mm.lo + (r.range + 1) * ((mm.hi - mm.lo) / {bins})', 6)} AS bin_end,
       CAST(COALESCE(c.n, 0) AS BIGINT) AS count
FROM range({bins}) r CROSS JOIN mm LEFT JOIN c ON c.bin = r.range)"""


ORACLE["order_value_histogram"] = f"WITH {_TRIM99} SELECT * FROM {_histogram('clean', 'order_value', 60)}"


def _boxplot(src: str, col: str) -> str:
    return f"""
q AS (SELECT quantile_cont(CAST({col} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({col} AS DOUBLE), 0.5) AS med,
             quantile_cont(CAST({col} AS DOUBLE), 0.75) AS q3 FROM {src}),
f AS (SELECT q1, med, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT CAST(COUNT({col}) AS BIGINT) AS n, {R('ANY_VALUE(f.q1)', 4)} AS q1, {R('ANY_VALUE(f.med)', 4)} AS median,
       {R('ANY_VALUE(f.q3)', 4)} AS q3, {R('ANY_VALUE(f.iqr)', 4)} AS iqr,
       {R(f'MIN(CASE WHEN {col} >= f.lo_f THEN CAST({col} AS DOUBLE) END)', 4)} AS whisker_low,
       {R(f'MAX(CASE WHEN {col} <= f.hi_f THEN CAST({col} AS DOUBLE) END)', 4)} AS whisker_high,
       CAST(SUM(CASE WHEN {col} < f.lo_f OR {col} > f.hi_f THEN 1 ELSE 0 END) AS BIGINT) AS outliers
FROM {src}, f"""


ORACLE["order_value_boxplot"] = f"WITH {_TRIM99}, {_boxplot('clean', 'order_value')}"

ORACLE["eda_top_categories"] = f"""
SELECT COALESCE(p.category_name_english, 'unknown') AS category,
       CAST(COUNT(i.item_id) AS BIGINT) AS items_sold, {R('SUM(i.price)', 2)} AS revenue
FROM fact_order_items i JOIN dim_products p ON p.product_id = i.product_id
JOIN fact_orders o ON o.order_id = i.order_id
WHERE o.order_status = 'delivered' GROUP BY 1 ORDER BY revenue DESC, category LIMIT 15"""

ORACLE["review_score_distribution"] = """
SELECT review_score, CAST(COUNT(*) AS BIGINT) AS reviews FROM fact_reviews GROUP BY review_score"""

ORACLE["review_score_summary"] = f"""
SELECT CAST(COUNT(*) AS BIGINT) AS reviews, {R('AVG(review_score)', 2)} AS avg_score,
       {PCT('SUM(CASE WHEN review_score = 5 THEN 1 ELSE 0 END)', 'COUNT(*)')} AS pct_5_star,
       {PCT('SUM(CASE WHEN review_score = 1 THEN 1 ELSE 0 END)', 'COUNT(*)')} AS pct_1_star
FROM fact_reviews"""

ORACLE["eda_state_top12"] = f"""
SELECT c.state, CAST(COUNT(DISTINCT c.customer_unique_id) AS BIGINT) AS customers,
       CAST(COUNT(DISTINCT o.order_id) AS BIGINT) AS orders, {R('SUM(p.payment_value)', 2)} AS revenue
FROM fact_orders o JOIN dim_customers c ON c.customer_id = o.customer_id
JOIN fact_payments p ON p.order_id = o.order_id
WHERE o.order_status = 'delivered' GROUP BY c.state ORDER BY revenue DESC, c.state LIMIT 12"""

ORACLE["monetary_describe"] = f"WITH {FEATURES_CTES} {_describe('features', 'monetary')}"

_TRIM95 = """
m95 AS (SELECT customer_unique_id, monetary FROM features
        WHERE monetary <= (SELECT quantile_cont(monetary, 0.95) FROM features))"""
ORACLE["monetary_trim_p95"] = f"WITH {FEATURES_CTES}, {_TRIM95} SELECT * FROM m95"

ORACLE["monetary_histograms"] = f"""WITH {FEATURES_CTES}, {_TRIM95},
lg AS (SELECT {R('ln(1 + monetary)', 9)} AS log_monetary FROM features)
SELECT * FROM {_histogram('m95', 'monetary', 60, 'raw_p95')}
UNION ALL SELECT * FROM {_histogram('lg', 'log_monetary', 60, 'log1p')}"""


# Per (feature, churn class) density histograms: 40 bins, each class its own range.
_KEY_FEATURES = ["recency_days", "frequency", "monetary", "avg_order_value",
                 "review_count", "avg_review_score", "unique_categories", "customer_age_days"]
_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, churned, CAST({c} AS DOUBLE) AS value FROM features" for c in _KEY_FEATURES)

ORACLE["feature_histograms_by_class"] = f"""WITH {FEATURES_CTES},
long AS ({_LONG}),
rng AS (SELECT feature, churned, MIN(value) AS lo, MAX(value) AS hi, COUNT(value) AS n
        FROM long GROUP BY feature, churned),
b AS (SELECT l.feature, l.churned,
             CASE WHEN r.hi - r.lo = 0 THEN 0
                  ELSE LEAST(CAST(floor((l.value - r.lo) / (r.hi - r.lo) * 40) AS INTEGER), 39) END AS bin
      FROM long l JOIN rng r ON r.feature = l.feature AND r.churned = l.churned
      WHERE l.value IS NOT NULL),
c AS (SELECT feature, churned, bin, COUNT(*) AS count FROM b GROUP BY feature, churned, bin)
SELECT r.feature, r.churned, g.bin,
       r.lo + g.bin * (CASE WHEN r.hi - r.lo = 0 THEN 1.0 ELSE (r.hi - r.lo) / 40 END) AS bin_start,
       r.lo + (g.bin + 1) * (CASE WHEN r.hi - r.lo = 0 THEN 1.0 ELSE (r.hi - r.lo) / 40 END) AS bin_end,
       CAST(coalesce(c.count, 0) AS BIGINT) AS count,
       coalesce(c.count, 0) / (r.n * (CASE WHEN r.hi - r.lo = 0 THEN 1.0 ELSE (r.hi - r.lo) / 40 END)) AS density
FROM rng r CROSS JOIN (SELECT CAST(unnest(range(0, 40)) AS INTEGER) AS bin) g
LEFT JOIN c ON r.feature = c.feature AND r.churned = c.churned AND c.bin = g.bin WHERE r.n > 0"""
