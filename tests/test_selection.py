"""Order statistics without a sort equal the sorted rows, quantiles equal numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopmetrics.operators import selection as S
from shopmetrics.operators.bucketing import buckets
from tests.test_plans import plan_text


@pytest.fixture
def small_scopes(monkeypatch):
    """Rounds go on down to single rows, also on a few rows."""
    monkeypatch.setattr(S, "FETCH", 3)
    monkeypatch.setattr(S, "ACCURACY", 50)


def frame(spark, n):
    rng = np.random.default_rng(n)
    few = [None if x < 0.2 else int(x * 6) for x in rng.random(n)]           # nulls and ties
    rows = [(f"same-long-prefix-{'é' * (i % 3)}{i:05d}", i, few[i], float(rng.normal()), 7) for i in rng.permutation(n).tolist()]
    return spark.createDataFrame(rows, "name string, number bigint, few bigint, money double, one int").checkpoint()


@pytest.mark.parametrize("n,k", [(0, 5), (1, 5), (3, 5), (7, 5), (11, 5), (400, 7)])
def test_tiles_of_several_orders_match_window_ntile(spark, small_scopes, n, k):
    df = frame(spark, n)
    orders = {"a": S.Order("few", id="name"), "b": S.Order("few", ascending=False, nulls_first=True, id="name"),
              "c": S.Order("money", ascending=False, id="number"), "d": S.Order("one", id="name"),
              "e": S.Order("few", nulls_first=True, id="number")}
    ours = buckets(df, {name: (order, S.ntile_starts(k)) for name, order in orders.items()})
    windows = {"a": [F.asc_nulls_last("few"), "name"], "b": [F.desc_nulls_first("few"), "name"],
               "c": [F.desc("money"), "number"], "d": ["one", "name"], "e": [F.asc_nulls_first("few"), "number"]}
    theirs = df.withColumns({name: F.ntile(k).over(Window.orderBy(*by)) for name, by in windows.items()})
    columns = ["name", *orders]
    assert sorted(ours.select(columns).collect()) == sorted(theirs.select(columns).collect())


@pytest.mark.parametrize("n", [1, 2, 7, 10, 93])
def test_rank_buckets_match_pandas(spark, small_scopes, n):
    df = frame(spark, n)
    ours = {r["name"]: r["q"] for r in buckets(df, {"q": (S.Order("money", id="name"), S.qcut_starts(5))}).collect()}
    pdf = df.toPandas().sort_values(["money", "name"]).reset_index(drop=True)
    bins = [1] if n == 1 else pd.qcut(pdf["money"].rank(method="first"), q=5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert ours == dict(zip(pdf["name"], bins))


def test_quantiles_of_distinct_values_and_ties_match_numpy(spark, small_scopes):
    df = frame(spark, 500)
    probs = [0.0, 0.01, 0.25, 0.5, 0.753, 0.99, 1.0]
    got = S.linear_quantiles(df, {"money": probs, "few": probs, "one": probs})
    pdf = df.toPandas()
    for column in got:
        assert got[column] == pytest.approx(np.quantile(pdf[column].dropna().astype(float), probs))
    assert S.linear_quantiles(df.limit(0), {"money": [0.5]}) == {"money": [None]}
    assert S.linear_quantiles(df.withColumn("money", F.lit(None).cast("double")), {"money": [0.5]}) == {"money": [None]}


def test_production_bounds_find_the_rows_of_many_distinct_values(spark):
    df = spark.range(60_000).select("id", (F.xxhash64("id") % 1_000_003).cast("decimal(12,2)").alias("v")).checkpoint()
    found, n = S.rows_at(df, {"v": (S.Order("v", id="id"), lambda n: [1, n // 3, n // 2, n])})
    by = sorted((r["v"], r["id"]) for r in df.collect())
    assert n == 60_000 and found["v"] == [by[0], by[n // 3 - 1], by[n // 2 - 1], by[-1]]


def test_repeated_ids_are_an_error_not_a_loop(spark, small_scopes):
    for id_ in ("1", "'x'"):
        df = spark.range(50).selectExpr("1 as v", f"{id_} as k").checkpoint()
        with pytest.raises(ValueError, match="break ties"):
            S.rows_at(df, {"v": (S.Order("v", id="k"), lambda n: [25])})


def test_no_range_sort_in_the_scores(spark):
    import __spark_entry__ as E
    plan = plan_text(E.queries()["rfm_scored"](spark, "/root/testdata/sf0.001"))
    assert "rangepartitioning" not in plan and "Sort" not in plan and "Window" not in plan
