"""Bucketed star tables: the order-key joins and pre-aggregates plan no shuffle."""

import os

from shopmetrics.plans import loads, reports
from shopmetrics.sources import ingest
from shopmetrics.sources.binding import star
from shopmetrics.sources.frames import TableStar
from tests.conftest import SF_SMALL


def test_bucketed_star_joins_without_order_shuffle(spark, tmp_dir):
    built = loads.star_from_driver(star(spark, SF_SMALL))
    names = ingest.save_star_tables(built, "shop_bucketed", buckets=4, location=os.path.join(tmp_dir, "wh"))
    assert len(names) == len(built)
    st = TableStar.from_catalog(spark, "shop_bucketed", list(built))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force sort-merge joins
    try:
        df = reports.monthly_revenue_rollup(st)
        from tools.plan_report import plan_text
        plan = plan_text(df)
        assert "SortMergeJoin" in plan
        assert "hashpartitioning(order_id" not in plan             # co-partitioned buckets
        expected = reports.monthly_revenue_rollup(star(spark, SF_SMALL))
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, expected.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
