"""Boosted trees: sums, splits, stopping, and independence of the blocks."""

import pickle
from dataclasses import replace

import numpy as np
import pytest

from shopmetrics.operators import boosting as B

P = B.Params(rounds=12, depth=3, rate=0.3, loss="logistic", watch="auc", patience=4, row_share=0.8, column_share=0.7,
             l1=0.1, l2=1.0, min_gain=0.05, min_weight=1.0)


def table(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + rng.normal(size=n) * 0.3 > 0.3).astype(int)
    rows = [(f"r{i}", *(None if i % 50 == 0 else float(v) for v in x[i]), int(y[i]), int(i % 5)) for i in range(n)]
    return spark.createDataFrame(rows, "id string, a double, b double, c double, y int, fold int")


def same(a: B.Model, b: B.Model) -> bool:
    return all(np.array_equal(getattr(a.trees, f), getattr(b.trees, f)) for f in ("feature", "bin", "gain", "value")) and a.history == b.history


@pytest.mark.parametrize("loss", ["logistic", "squared"])
def test_many_blocks_give_the_same_trees(spark, monkeypatch, loss):
    p = replace(P, loss=loss, rounds=4, depth=2, watch="auc" if loss == "logistic" else "loss")
    df = table(spark).cache()
    one = B.fit(df, ["a", "b", "c"], "y", "fold", "id", [0, 2], p)
    monkeypatch.setattr(B, "BLOCK_ROWS", 130)
    many = B.fit(df.repartition(3), ["a", "b", "c"], "y", "fold", "id", [0, 2], p)
    assert same(one[0], many[0]) and same(one[2], many[2]) and not same(one[0], one[2])


def test_a_worker_without_margins_gives_the_same_answer(spark):
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 20, size=(3, 400)).astype(np.uint8), rng.random(400).round(), rng.integers(0, 2, 400).astype(np.int32), rng.integers(0, 2**62, 400).astype(np.uint64)
    kept = B.Block(*rows)
    used = B.boost(kept.answer, 3, 20, [0], replace(P, patience=None))
    fresh = B.boost(lambda req: B.Block(*rows).answer(req), 3, 20, [0], replace(P, patience=None))
    assert all(np.array_equal(getattr(used[0][1], f), getattr(fresh[0][1], f)) for f in ("feature", "bin", "value")) and used[0][2] == fresh[0][2]


def brute_split(x, g, h, p):
    """Best (gain, feature, bin) by trying every cut on the rows themselves."""
    def strength(rows):
        s = max(abs(g[rows].sum()) - p.l1, 0)
        return s * s / (h[rows].sum() + p.l2)
    best = (max(p.min_gain, 1e-9), None, None)
    every = np.ones(len(g), dtype=bool)
    for f in range(len(x)):
        for b in range(int(x.max())):
            left = x[f] <= b
            if h[left].sum() >= p.min_weight and h[~left].sum() >= p.min_weight:
                gain = strength(left) + strength(~left) - strength(every)
                if gain > best[0] + 1e-9:
                    best = (gain, f, b)
    return best


def test_first_split_and_leaf_values_are_the_best_ones():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 15, size=(4, 300)).astype(np.uint8)
    y = ((x[2] > 6) ^ (rng.random(300) < 0.1)).astype(float)
    p = replace(P, rounds=1, depth=1, row_share=1.0, column_share=1.0, patience=None, watch="loss")
    fold = np.ones(300, dtype=np.int32)
    base, trees, _ = B.boost(B.Block(x, y, fold, np.arange(300, dtype=np.uint64)).answer, 4, 15, [0], p)[0]
    prob = B.sigmoid(np.full(300, base))
    g, h = prob - y, prob * (1 - prob)
    gain, f, b = brute_split(x, g, h, p)
    assert (trees.feature[0, 0], trees.bin[0, 0]) == (f, b) and abs(trees.gain[0, 0] - gain) < 1e-3
    for side, rows in enumerate((x[f] <= b, x[f] > b)):
        s = g[rows].sum()
        want = -p.rate * np.sign(s) * max(abs(s) - p.l1, 0) / (h[rows].sum() + p.l2)
        assert abs(trees.value[0, side] - want) < 1e-4


def test_min_gain_stops_splits_and_stopping_keeps_the_best_round(spark):
    df = table(spark)
    stump = B.fit(df, ["a", "b"], "y", "fold", "id", [0], replace(P, min_gain=1e9))[0]
    assert (stump.trees.bin == B.MAX_BINS).all()
    model = B.fit(df, ["a", "b", "c"], "y", "fold", "id", [0], replace(P, rounds=60, watch="loss"))[0]
    assert len(model.history) < 60 and len(model.trees) == int(np.argmin(model.history)) + 1
    assert len(model.history) - len(model.trees) == P.patience


def test_odd_tables(spark):
    schema = "id string, a double, b double, c double, y int, fold int"
    with pytest.raises(ValueError, match="no rows"):
        B.fit(spark.createDataFrame([], schema), ["a"], "y", "fold", "id", [0], P)
    flat = spark.createDataFrame([(f"r{i}", None, 1.0, float("nan"), i % 2, 1) for i in range(20)], schema)
    model = B.fit(flat, ["a", "b", "c"], "y", "fold", "id", [0], replace(P, rounds=2, row_share=1.0))[0]  # nothing held out, nothing to split
    assert {r[0] for r in flat.select(model.score()).collect()} == {0.5}


def test_many_blocks_send_splits_and_settled_margins(spark, monkeypatch):
    """The driver gets a split a feature and node, not the cells of the histograms or scores, and
    a request never carries more than SETTLE trees, however many rounds and rows there are."""
    monkeypatch.setattr(B, "SETTLE", 3)
    p = replace(P, rounds=8, depth=2, patience=None)
    df = table(spark).cache()
    one = B.fit(df, ["a", "b", "c"], "y", "fold", "id", [0, 2], p)
    asked, got, ask = [], [], B.SparkBlocks.__call__

    def seen(self, req):
        replies = ask(self, req)
        asked.append(max(len(t) - self.settled for t in req.trees.values()))
        got.append(len(pickle.dumps(replies)))
        return replies

    monkeypatch.setattr(B.SparkBlocks, "__call__", seen)
    monkeypatch.setattr(B, "BLOCK_ROWS", 130)
    many = B.fit(df.repartition(3), ["a", "b", "c"], "y", "fold", "id", [0, 2], p)
    assert same(one[0], many[0]) and same(one[2], many[2])
    assert max(asked) < 3 and max(got) < 4_000


@pytest.mark.parametrize("levels", [1, 3, 6, 8])
def test_rows_go_down_the_tree_like_one_by_one(levels):
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 255, size=(4, 200)).astype(np.uint8)
    feature, cut = rng.integers(0, 4, (1 << levels) - 1), rng.choice([0, 60, 128, 200, 254, B.MAX_BINS], (1 << levels) - 1)
    want = []
    for row in bins.T:
        node = 0
        for level in range(levels):
            at = node + (1 << level) - 1
            node = 2 * node + int(row[feature[at]] > cut[at])
        want.append(node)
    assert B.descend(bins, feature, cut, levels).tolist() == want


def test_many_blocks_run_in_one_wave_and_read_margins_as_they_are(spark, monkeypatch):
    """However many blocks there are, a level is one task a core; no request carries trees to catch
    up on, and one checkpoint of the blocks is left at most, none at the end."""
    monkeypatch.setattr(B, "SETTLE", 2)
    monkeypatch.setattr(B, "BLOCK_ROWS", 40)
    tasks, carried, kept, ask = set(), set(), [], B.SparkBlocks.__call__

    def seen(self, req):
        replies = ask(self, req)
        tasks.add(self.blocks.getNumPartitions())
        carried.update(len(t) - self.settled for t in req.trees.values())
        kept.append(self.written)
        return replies

    monkeypatch.setattr(B.SparkBlocks, "__call__", seen)
    p = replace(P, loss="squared", watch="loss", rounds=5, depth=2, patience=None, row_share=1.0)
    df = table(spark).cache()
    many = B.fit(df, ["a", "b", "c"], "y", "fold", "id", [0], p)[0]
    monkeypatch.setattr(B, "BLOCK_ROWS", 1 << 18)
    assert same(B.fit(df, ["a", "b", "c"], "y", "fold", "id", [0], p)[0], many)
    assert tasks == {spark.sparkContext.defaultParallelism} and carried == {0}
    written = dict.fromkeys(folder for folder in kept if folder)
    assert len(written) == 2
    for folder in written:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
