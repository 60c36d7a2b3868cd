"""Tiny hand-made star schemas with the edge rows of FIXTURES.md section 4."""

import datetime as dt
from decimal import Decimal as D

from shopmetrics import schema as S
from shopmetrics.sources.frames import TableStar


def ts(s):
    return dt.datetime.fromisoformat(s)


def loose(schema):
    """Nullable copy of a schema: fixtures may carry dirty rows on purpose."""
    from pyspark.sql import types as T
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def star(spark, customers, orders, items=(), payments=(), reviews=(), products=(), churn=(), clv=()):
    from shopmetrics.sources.ingest import derive_dim_date
    fo = spark.createDataFrame(list(orders), loose(S.FACT_ORDERS))
    return TableStar(
        dim_customers=spark.createDataFrame(list(customers), loose(S.DIM_CUSTOMERS)),
        dim_products=spark.createDataFrame(list(products), loose(S.DIM_PRODUCTS)),
        dim_date=derive_dim_date(fo, "purchase_date"),
        fact_orders=fo,
        fact_order_items=spark.createDataFrame(list(items), loose(S.FACT_ORDER_ITEMS)),
        fact_payments=spark.createDataFrame(list(payments), loose(S.FACT_PAYMENTS)),
        fact_reviews=spark.createDataFrame(list(reviews), loose(S.FACT_REVIEWS)),
        ml_churn_predictions=spark.createDataFrame(list(churn), loose(S.ML_CHURN_PREDICTIONS)),
        ml_clv_predictions=spark.createDataFrame(list(clv), loose(S.ML_CLV_PREDICTIONS)),
    )


def order(oid, cid, purchase, status="delivered", delivered=None, estimated=None):
    p = ts(purchase)
    return (oid, cid, status, p, p, p, ts(delivered) if delivered else None,
            ts(estimated) if estimated else None, p.date())


def cust(cid, uid, state="SP"):
    return (cid, uid, None, "city", state)


def pay(pid, oid, value, seq=1, ptype="credit_card", inst=1):
    return (pid, oid, seq, ptype, inst, D(str(value)))


def item(iid, oid, pid, price, freight=0):
    return (iid, oid, pid, "s1", None, D(str(price)), D(str(freight)))


def review(rid, oid, score):
    return (rid, oid, score, None, None)


def product(pid, cat):
    return (pid, cat, None, None, None, None, None, None, None)
