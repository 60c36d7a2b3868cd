"""Plan properties the design relies on (guards against regressions)."""

import re

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.plan_report import plan_text


def test_status_filter_reaches_the_scan(spark):
    for key in ["monthly_revenue_rollup", "delivery_by_month", "category_revenue_top20", "state_revenue"]:
        plan = plan_text(E.queries()[key](spark, SF_SMALL))
        assert "EqualTo(o_orderstatus,F)" in plan, key


def test_scans_read_only_needed_columns(spark):
    plan = plan_text(E.queries()["payment_mix"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("o_custkey" not in s and "o_orderdate" not in s for s in schemas)


def test_distributed_ntile_has_no_single_partition_window(spark):
    from pyspark.sql import functions as F
    from shopmetrics.operators.bucketing import ntile
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    plan = plan_text(ntile(df, [F.col("k"), F.col("id")], 5, "b"))
    assert "SinglePartition" not in plan and "Window" not in plan


def test_first_row_dedupe_is_a_partial_aggregate(spark):
    from pyspark.sql import functions as F
    from shopmetrics.sources.ingest import INGEST_SEQ, first_per_key
    # one key holds a third of the rows
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                  F.col("id").alias("v"), F.col("id").alias(INGEST_SEQ))
    out = first_per_key(df, ["k"])
    plan = plan_text(out)
    assert "Window" not in plan
    assert plan.count("min_by") >= 2          # partial (map side) + final
    assert out.where("k = 0").first()["v"] == 0
    assert out.count() == 2001
