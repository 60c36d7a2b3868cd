"""Registered queries: key -> (spark callable, oracle SQL or None).

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the whole driver tables.  Oracle SQL strings are DuckDB restatements over
the driver's pre-registered views, prefixed with the star-view CTEs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopmetrics.plans import reports
from shopmetrics.plans.oracle_reports import ORACLE as _REPORT_SQL
from shopmetrics.plans.oracle_views import with_views
from shopmetrics.sources.binding import star

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, as_double: list[str] | None = None):
    """Register a query; ``as_double`` lists decimal money columns emitted as
    DOUBLE on both sides (measures are compared as DOUBLE)."""
    def deco(fn):
        if as_double:
            from pyspark.sql import functions as F

            def wrapped(spark, sf_dir, _fn=fn):
                df = _fn(spark, sf_dir)
                return df.withColumns({c: F.col(c).cast("double") for c in as_double})
            QUERIES[name] = wrapped
        else:
            QUERIES[name] = fn
        if sql is not None:
            body = with_views(sql)
            if as_double:
                repl = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in as_double)
                body = f"SELECT * REPLACE ({repl}) FROM ({body}) AS q"
            ORACLES[name] = body
        return fn
    return deco


def _st(spark, sf_dir):
    return star(spark, sf_dir)


def _report(name: str, fn):
    register(name, _REPORT_SQL.get(name))(lambda spark, sf_dir: fn(_st(spark, sf_dir)))


for _name in ["payment_mix", "monthly_revenue_rollup", "monthly_revenue_rollup_dedup", "state_revenue",
              "category_revenue_top20", "delivery_by_month", "cohort_retention", "first_purchase",
              "top_categories_per_segment", "category_clv_top15", "churn_prediction_summary"]:
    _report(_name, getattr(reports, _name))


@register("cohort_data", _REPORT_SQL["cohort_data"])
def _cohort_data(spark, sf_dir):
    from shopmetrics.functions.core import half_up
    return reports.cohort_data(_st(spark, sf_dir)).select(
        "cohort_month", "month_number", "active_customers", half_up("_rev", 2).alias("cohort_revenue"))


def _load_all() -> None:
    # Importing these modules registers their queries.
    from shopmetrics.plans import registry_more  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)
