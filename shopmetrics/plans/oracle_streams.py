"""DuckDB oracle SQL for the batch twins of the stream transforms."""

from __future__ import annotations

from shopmetrics.plans.oracle_views import R

ORACLE = {}

_DECODED = """
decoded AS (
    SELECT CAST(event_id AS VARCHAR) AS order_id, event_type AS product_category,
           CAST(value AS DECIMAL(12,2)) AS order_value,
           CASE WHEN event_id % 4 <> 0 THEN CAST(floor(value) AS DECIMAL(12,2))
                ELSE CAST(0 AS DECIMAL(12,2)) END AS freight_value,
           CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS payment_type,
           CAST(NULL AS INTEGER) AS review_score, CAST(ts AS TIMESTAMP) AS event_timestamp
    FROM events)"""

ORACLE["stream_decode_orders"] = f"WITH {_DECODED} SELECT * FROM decoded"
ORACLE["stream_dashboard_feed"] = f"""WITH {_DECODED}
SELECT order_id, product_category, order_value, state, payment_type, event_timestamp AS timestamp FROM decoded"""
ORACLE["stream_running_totals"] = f"""WITH {_DECODED}
SELECT CAST(COUNT(*) AS BIGINT) AS events, {R('SUM(order_value)', 2)} AS total_value FROM decoded"""

# The message text: Spark's to_json of the live-order struct (NULL freight
# omitted), restated field by field.
_MESSAGES = """
msgs AS (
    SELECT event_type,
           '{"order_id":"' || CAST(event_id AS VARCHAR) || '","product_category":"' || event_type
           || '","order_value":' || CAST(value AS VARCHAR)
           || CASE WHEN event_id % 4 <> 0 THEN ',"freight_value":' || CAST(floor(value) AS VARCHAR) ELSE '' END
           || ',"timestamp":"' || replace(CAST(ts AS VARCHAR), ' ', 'T') || '"}' AS js
    FROM events)"""

ORACLE["stream_source"] = f"WITH {_MESSAGES} SELECT js AS value FROM msgs"
ORACLE["stream_dead_letter"] = f"""WITH {_MESSAGES}
SELECT substring(js, 1, length(js) // 2) AS message FROM msgs WHERE event_type = 'error'"""
ORACLE["stream_append_orders"] = f"""WITH {_DECODED}
SELECT * FROM decoded"""
