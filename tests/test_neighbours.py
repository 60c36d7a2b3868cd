"""Nearest neighbours against brute force."""

import re

import numpy as np
from pyspark.sql import functions as F

from shopmetrics.operators import neighbours as N


def brute(x: np.ndarray, k: int) -> np.ndarray:
    gap = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(gap, np.inf)
    return np.sort(gap, axis=1)[:, :k]


def found(spark, x: np.ndarray, k: int) -> dict:
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, z array<double>")
    return {r["id"]: r["neighbours"] for r in N.nearest_neighbours(df, "id", "z", k).collect()}


def test_one_leaf_is_exact_whatever_its_blocks(spark, monkeypatch):
    x = np.random.default_rng(0).normal(size=(200, 13))
    x[50:60] = x[40]
    monkeypatch.setattr(N, "BLOCK", 40)
    got, want = found(spark, x, 5), brute(x, 5)
    for i in range(len(x)):
        assert np.allclose([n["distance"] for n in got[i]], want[i]) and i not in [n["id"] for n in got[i]]


def test_many_leaves_come_close(spark, monkeypatch):
    x = np.random.default_rng(1).normal(size=(1500, 13))
    monkeypatch.setattr(N, "LEAF", 200)
    got, want = found(spark, x, 5), brute(x, 5)
    hits = sum(np.isclose(n["distance"], want[i]).any() for i in got for n in got[i])
    assert len(got) == len(x) and all(len(v) == 5 for v in got.values())
    mean = np.mean([[n["distance"] for n in got[i]] for i in range(len(x))])
    assert hits / want.size > 0.7 and mean < 1.06 * want.mean()


def test_smote_neighbours_in_all_standardised_features(spark):
    """Distances of the customers' neighbours against brute force, nothing clipped."""
    from shopmetrics.plans import modeling as ml
    from shopmetrics.plans.features import CHURN_TARGET, FEATURE_COLS
    from shopmetrics.plans.registry_more import features_df
    df = features_df(spark, "/root/testdata/sf0.01").where(F.col(CHURN_TARGET) == 1)
    z = df.select("customer_unique_id", ml.standardised(df, FEATURE_COLS).alias("z"))
    rows = sorted(z.collect())
    x = np.array([r["z"] for r in rows])
    assert np.abs(x).max() > 3  # far rows keep their distance
    got = {r["id"]: r["neighbours"] for r in N.nearest_neighbours(z, "customer_unique_id", "z", 5).collect()}
    want = brute(x, 5)
    mine = np.array([[n["distance"] for n in got[r[0]]] for r in rows])
    assert (mine >= want - 1e-9).all() and mine.mean() < 1.05 * want.mean()


def test_distances_are_sums_over_the_last_axis_to_the_bit():
    rng = np.random.default_rng(2)
    for n in (0, 1, 7, 8, 13, 16, 29):
        a, b = rng.normal(size=(20, n)), rng.normal(size=(30, n))
        assert np.array_equal(N._gaps(a, b), np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)))


def test_few_rows(spark):
    got = found(spark, np.array([[0.0], [0.0], [1.0]]), 5)
    assert [n["id"] for n in got[0]] == [1, 2] and len(got[2]) == 2
    assert found(spark, np.array([[0.0]]), 5) == {}


def test_only_leaf_sizes_are_broadcast_and_cells_are_dealt_to_tasks(spark):
    """Whatever Spark guesses of the sizes: rows are shuffled once, by the cell they meet in."""
    df = spark.createDataFrame([(i, [float(i % 97), float(i % 31)]) for i in range(3000)], "id long, z array<double>")
    near = N.nearest_neighbours(df, "id", "z", 5)
    plan = re.sub(r"#\d+L?", "", near._jdf.queryExecution().executedPlan().toString())
    assert re.search(r"BroadcastHashJoin \[tree, leaf\], \[tree, leaf\], Inner, BuildRight", plan)
    assert re.search(r"hashpartitioning\(tree, leaf, q, m, \d+\)", plan)
