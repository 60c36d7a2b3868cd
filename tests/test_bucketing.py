"""K1-K4: distributed NTILE equals SQL NTILE; qcut formulas equal pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopmetrics.operators.bucketing import (
    cut_fixed_expr, exact_percentiles, global_rank, ntile, qcut_rank, qcut_values,
)


@pytest.mark.parametrize("n,k", [(1, 5), (3, 5), (7, 5), (10, 5), (11, 5), (93, 5), (1000, 7)])
def test_ntile_matches_window_ntile(spark, n, k):
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"id": np.arange(n), "v": rng.integers(0, 5, n)})  # many ties
    df = spark.createDataFrame(pdf)
    ours = ntile(df, [F.col("v"), F.col("id")], k, "b").select("id", "b")
    ref = df.select("id", F.ntile(k).over(Window.orderBy("v", "id")).alias("b"))
    assert sorted(ours.collect()) == sorted(ref.collect())


def test_global_rank_is_dense_and_total(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), "id")
    ranked, n = global_rank(df, [F.desc("k"), F.col("id")], "r")
    assert n == 5000
    got = [r["r"] for r in ranked.orderBy(F.desc("k"), "id").collect()]
    assert got == list(range(1, 5001))


def test_global_rank_hot_key_spreads_over_partitions(spark):
    # one key holds every row: the id tie-break still splits it
    df = spark.range(20000).select(F.lit(1).alias("k"), "id")
    ranked, n = global_rank(df, [F.col("k"), F.col("id")], "r", num_partitions=8)
    parts = ranked.groupBy(F.spark_partition_id()).count().collect()
    assert n == 20000 and len(parts) > 1


@pytest.mark.parametrize("n", [1, 2, 7, 10, 11, 93, 1429])
def test_qcut_rank_matches_pandas(spark, n):
    rng = np.random.default_rng(7)
    vals = rng.integers(1, 4, n)
    pdf = pd.DataFrame({"id": [f"c{i:05d}" for i in range(n)], "v": vals})
    ours = {r["id"]: r["q"] for r in qcut_rank(spark.createDataFrame(pdf), [F.col("v"), F.col("id")], 5, "q")
            .collect()}
    ordered = pdf.sort_values(["v", "id"]).reset_index(drop=True)
    if n == 1:
        expected = {ordered.id[0]: 1}
    else:
        bins = pd.qcut(ordered["v"].rank(method="first"), q=5, labels=[1, 2, 3, 4, 5]).astype(int)
        expected = dict(zip(ordered.id, bins))
    assert ours == expected


def test_qcut_values_matches_pandas_and_reverses_labels(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": range(500), "v": rng.normal(100, 30, 500).round(1)})
    ours = {r["id"]: r["r"] for r in qcut_values(spark.createDataFrame(pdf), "v", 5, [5, 4, 3, 2, 1], "r")
            .collect()}
    expected = dict(zip(pdf.id, pd.qcut(pdf.v, q=5, labels=[5, 4, 3, 2, 1]).astype(int)))
    assert ours == expected


def test_qcut_values_duplicate_edges_raise(spark):
    df = spark.createDataFrame([(i, 1.0 if i < 90 else float(i)) for i in range(100)], "id int, v double")
    with pytest.raises(ValueError, match="unique"):
        qcut_values(df, "v", 5, [1, 2, 3, 4, 5], "b")


def test_exact_percentile_is_linear(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 4, 7]], "v double")
    assert exact_percentiles(df, "v", [0.3])[0] == pytest.approx(np.quantile([1, 2, 4, 7], 0.3))


def test_cut_fixed_bins(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 0.33, 0.34, 0.66, 1.0]], "p double")
    got = [r[0] for r in df.select(cut_fixed_expr(F.col("p"), [0.0, 0.33, 0.66, 1.0],
                                                  ["Low", "Medium", "High"], lowest_label="Low")).collect()]
    assert got == ["Low", "Low", "Medium", "Medium", "High"]


def test_ranks_of_rows_matches_global_rank_with_nulls_and_ties(spark):
    from shopmetrics.operators.bucketing import ntile_of_rank, ranks_of_rows
    rng = np.random.default_rng(11)
    vals = [None if x < 0.1 else int(x * 10) for x in rng.random(400)]
    df = spark.createDataFrame([(f"k{i:04d}", v) for i, v in enumerate(vals)], "id string, v bigint")
    orders = {"desc_nf": [("v", False, True), ("id", True, False)],
              "asc_nl": [("v", True, False), ("id", True, False)]}
    targets = [r.asDict() for r in df.orderBy(F.rand(3)).limit(15).collect()]
    ranks, n = ranks_of_rows(df, orders, targets)
    full = {
        "desc_nf": global_rank(df, [F.desc_nulls_first("v"), F.col("id")], "r")[0],
        "asc_nl": global_rank(df, [F.asc_nulls_last("v"), F.col("id")], "r")[0],
    }
    for name, ranked in full.items():
        m = {r["id"]: r["r"] for r in ranked.collect()}
        assert [m[t["id"]] for t in targets] == [rk[name] for rk in ranks]
    assert n == 400
    assert [ntile_of_rank(r, 11, 5) for r in range(1, 12)] == [1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
