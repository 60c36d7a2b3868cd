"""shopmetrics: Spark-native retail customer analytics.

Star-schema loads and audits, standing business reports (RFM, cohorts,
revenue, delivery, payment mix, product affinity), the customer feature
table with MLlib churn/CLV scoring, EDA summaries, and a Structured
Streaming live-order pipeline. Every job is DataFrame / Spark SQL / MLlib /
Structured Streaming; nothing is pulled whole through the driver.
"""

__version__ = "0.1.0"
