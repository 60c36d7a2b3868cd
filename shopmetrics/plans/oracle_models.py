"""DuckDB oracle SQL for the model-evaluation keys on fixed (bound) scores."""

from __future__ import annotations

from shopmetrics.plans.oracle_rfm import FEATURES_CTES
from shopmetrics.plans.oracle_views import R

ORACLE = {}

_CHURN_SCORED = f"""{FEATURES_CTES},
s AS (SELECT f.customer_unique_id, f.churned AS y, CAST(p.churn_probability AS DOUBLE) AS score,
             CASE WHEN p.churn_probability >= 0.5 THEN 1 ELSE 0 END AS pred
      FROM features f JOIN ml_churn_predictions p ON p.customer_unique_id = f.customer_unique_id)"""

ORACLE["binary_auc"] = f"""WITH {_CHURN_SCORED},
r AS (SELECT y, RANK() OVER (ORDER BY score) AS rk, COUNT(*) OVER (PARTITION BY score) AS t FROM s),
a AS (SELECT SUM(CASE WHEN y = 1 THEN rk + (t - 1) / 2.0 ELSE 0 END) AS sr, SUM(y) AS npos,
             COUNT(*) - SUM(y) AS nneg FROM r)
SELECT {R('(sr - npos * (npos + 1) / 2.0) / (npos * nneg)', 6)} AS auc,
       CAST(npos AS BIGINT) AS n_pos, CAST(nneg AS BIGINT) AS n_neg FROM a"""

ORACLE["confusion_matrix"] = f"""WITH {_CHURN_SCORED}
SELECT CAST(y AS INTEGER) AS actual, CAST(pred AS INTEGER) AS predicted, CAST(COUNT(*) AS BIGINT) AS count
FROM s GROUP BY 1, 2"""

_P = {"p0": "CASE WHEN c00 + c10 = 0 THEN 0.0 ELSE c00 / (c00 + c10) END",
      "p1": "CASE WHEN c11 + c01 = 0 THEN 0.0 ELSE c11 / (c11 + c01) END",
      "r0": "CASE WHEN c00 + c01 = 0 THEN 0.0 ELSE c00 / (c00 + c01) END",
      "r1": "CASE WHEN c11 + c10 = 0 THEN 0.0 ELSE c11 / (c11 + c10) END"}

ORACLE["classification_report"] = f"""WITH {_CHURN_SCORED},
c AS (SELECT {', '.join(f"CAST(SUM(CASE WHEN y = {a} AND pred = {b} THEN 1 ELSE 0 END) AS DOUBLE) AS c{a}{b}"
                        for a in (0, 1) for b in (0, 1))} FROM s),
m AS (SELECT *, {_P['p0']} AS p0, {_P['p1']} AS p1, {_P['r0']} AS r0, {_P['r1']} AS r1,
             c00 + c01 AS s0, c10 + c11 AS s1, c00 + c01 + c10 + c11 AS n FROM c),
g AS (SELECT *, CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0,
                CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1 FROM m),
t AS (
    SELECT 'Active' AS label, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM g
    UNION ALL SELECT 'Churned', p1, r1, f1, s1 FROM g
    UNION ALL SELECT 'accuracy', NULL, NULL, CASE WHEN n = 0 THEN 0.0 ELSE (c00 + c11) / n END, n FROM g
    UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM g
    UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n
    FROM g)
SELECT label, {R('precision', 4)} AS precision, {R('recall', 4)} AS recall, {R('f1_score', 4)} AS f1_score,
       CAST(support AS BIGINT) AS support FROM t"""

ORACLE["regression_metrics"] = f"""WITH {FEATURES_CTES},
s AS (SELECT f.monetary AS a, greatest(CAST(p.predicted_clv AS DOUBLE), 0.0) AS p
      FROM features f JOIN ml_clv_predictions p ON p.customer_unique_id = f.customer_unique_id)
SELECT CAST(COUNT(*) AS BIGINT) AS n, {R('AVG(abs(a - p))', 6)} AS mae, {R('sqrt(AVG((a - p) * (a - p)))', 6)} AS rmse,
       {R('1 - SUM((a - p) * (a - p)) / (var_pop(a) * COUNT(*))', 6)} AS r2,
       {R('AVG(abs((a - p) / greatest(a, 1.0))) * 100.0', 6)} AS mape
FROM s"""

ORACLE["clv_tiers"] = """
WITH v AS (SELECT customer_unique_id, CAST(predicted_clv AS DOUBLE) AS x FROM ml_clv_predictions),
e AS (SELECT quantile_cont(x, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM v)
SELECT customer_unique_id, x AS predicted_clv,
       CASE WHEN x >= q[1] AND x <= q[2] THEN 'Bronze' WHEN x <= q[3] THEN 'Silver'
            WHEN x <= q[4] THEN 'Gold' WHEN x <= q[5] THEN 'Platinum' END AS clv_segment
FROM v, e"""

ORACLE["stratified_split"] = f"""WITH {FEATURES_CTES},
r AS (SELECT customer_unique_id, churned,
             ROW_NUMBER() OVER (PARTITION BY churned
                                ORDER BY md5(customer_unique_id || '#42'), customer_unique_id) AS k,
             COUNT(*) OVER (PARTITION BY churned) AS n
      FROM features)
SELECT customer_unique_id, churned, CASE WHEN k <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r"""

ORACLE["random_split"] = f"""WITH {FEATURES_CTES},
r AS (SELECT customer_unique_id,
             ROW_NUMBER() OVER (ORDER BY md5(customer_unique_id || '#42'), customer_unique_id) AS k,
             COUNT(*) OVER () AS n
      FROM features)
SELECT customer_unique_id, CASE WHEN k <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r"""
