"""Every registered key with an SQL oracle equals DuckDB on the driver data
(row count, column names, order-insensitive values)."""

import duckdb
import pytest

import __spark_entry__ as E
from shopmetrics.plans import registry
from tests.conftest import SF_SMALL
from tools.check_oracles import TABLES, canon

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_duckdb(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLES[key])
    d_cols, d_rows = canon([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_every_key_registered():
    assert len(registry.queries()) == 89
    assert len(registry.oracle_sql()) == 80
    assert set(registry.queries()) <= set(E.queries()) and set(ORACLES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["rfm_segment", "customers", "pct_customers", "avg_monetary", "total_monetary",
                          "pct_revenue", "avg_recency_days", "avg_frequency"]
