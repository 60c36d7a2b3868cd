"""Gradient-boosted trees over a byte-binned matrix, stopping early inside the loop.

The feature matrix is binned once: at most ``MAX_BINS`` bins a feature, edges from a hash
sample of ``EDGE_ROWS`` rows.  It is kept as blocks of up to ``BLOCK_ROWS`` rows, one byte a
feature.  Trees grow level by level.  A level needs one sum over all rows, the gradient
histograms of its nodes; the sum for a root also carries the held-out metric of the trees so
far, so watching costs no pass of its own.

Several fits share a pass: run r trains on the rows whose fold is not r and is watched on
fold r.  One fit with a validation slice is run 0 with that slice as fold 0; k-fold cross
validation is k runs over the same blocks.

Gradients are rounded to integers (2^-20) and rows are sampled by a hash of row and round, so
sums do not depend on their order: any number of blocks gives the same trees.  ``answer`` and
``shares`` are pure functions of a block and a request (which holds the trees that the block's
margins lack).

Where the rows fill a single block, the loop runs in that block's task, since there is nothing
to sum across tasks.  With more, every core has one task's blocks, and each level is one small
job: tasks add up the blocks' histograms by run and feature and search the splits there, so that
the driver gets one split for each feature and node, whatever the number of rows or blocks.  The
first job of a round also adds the last tree to the margins in the cached blocks; the jobs of the
deeper levels read them as they are, so no worker keeps anything, and a lost executor costs its
tasks.  Every ``SETTLE`` rounds the blocks are checkpointed, which cuts their lineage.

A null or NaN feature falls into the lowest bin.
"""

from __future__ import annotations

import gc
import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmetrics.session import ensure_checkpoint_dir

MAX_BINS = 255
EDGE_ROWS = 50_000
BLOCK_ROWS = 1 << 18
TASK_BLOCKS = 8
TASK_SUMS = 4
SETTLE = 16
UNIT = float(1 << 20)
AUC_BINS = 1 << 16
BLOCK = "n int, bins binary, label binary, fold binary, key binary"


@dataclass(frozen=True)
class Params:
    """Names of the usual boosted-tree parameters, by what they do."""

    rounds: int
    depth: int
    rate: float
    loss: str  # "logistic" or "squared"
    watch: str = "loss"  # or "auc"
    patience: int | None = None
    row_share: float = 1.0
    column_share: float = 1.0
    l1: float = 0.0
    l2: float = 1.0
    min_gain: float = 0.0
    min_weight: float = 1.0
    seed: int = 42


@dataclass
class Trees:
    """Complete binary trees: a row goes right at a node where its bin exceeds ``bin``."""

    feature: np.ndarray  # (trees, 2^depth - 1)
    bin: np.ndarray
    gain: np.ndarray
    value: np.ndarray  # (trees, 2^depth)

    @staticmethod
    def none(depth: int) -> Trees:
        inner = (0, (1 << depth) - 1)
        return Trees(np.zeros(inner, np.int32), np.zeros(inner, np.int32), np.zeros(inner), np.zeros((0, 1 << depth)))

    def __len__(self) -> int:
        return len(self.value)

    def first(self, n: int) -> Trees:
        return Trees(self.feature[:n], self.bin[:n], self.gain[:n], self.value[:n])

    def after(self, n: int) -> Trees:
        return Trees(self.feature[n:], self.bin[n:], self.gain[n:], self.value[n:])

    def add(self, feature: np.ndarray, cut: np.ndarray, gain: np.ndarray, value: np.ndarray) -> Trees:
        return Trees(*[np.concatenate([a, b[None]]) for a, b in ((self.feature, feature), (self.bin, cut), (self.gain, gain), (self.value, value))])


def descend(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """Node of every row (column of ``bins``) after ``levels`` levels, numbered within its level."""
    if levels > 6:
        node, rows = np.zeros(bins.shape[1], dtype=np.int64), np.arange(bins.shape[1])
        for level in range(levels):
            at = node + (1 << level) - 1
            node = 2 * node + (bins[feature[at], rows] > cut[at])
        return node
    small = np.zeros(bins.shape[1], dtype=np.uint8)  # few nodes: whole columns byte by byte are faster than picked cells
    for level in range(levels):
        right = np.zeros(len(small), dtype=bool)
        for i in range(1 << level):
            at = (1 << level) - 1 + i
            if cut[at] < MAX_BINS:
                right |= (bins[feature[at]] > np.uint8(cut[at])) & (small == i)
        small = 2 * small + right
    return small.astype(np.int64)


def add_scores(total: np.ndarray, bins: np.ndarray, trees: Trees, start: int = 0) -> np.ndarray:
    """``total`` plus the leaf values of ``trees`` from number ``start`` on, one by one (so that
    margins are the same however often they were continued)."""
    depth = trees.value.shape[1].bit_length() - 1
    for t in range(start, len(trees)):
        total = total + trees.value[t][descend(bins, trees.feature[t], trees.bin[t], depth)]
    return total


def sampled(key: np.ndarray, seed: int, turn: int, share: float) -> np.ndarray:
    """Rows drawn in round ``turn``: a keyed hash of the row, whatever block it lies in."""
    x = key ^ np.uint64(((seed * 0x9E3779B97F4A7C15) ^ ((turn + 1) * 0xBF58476D1CE4E5B9)) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) < share * float(1 << 53)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


# ---- one block's share of a sum ----------------------------------------------------------
@dataclass
class Request:
    """What the loop asks of every block: run by run the trees so far (but the first ``settled``
    ones, which the blocks' margins hold), the drawn columns and, from the second level on, the
    splits of the tree in work."""

    params: Params
    n_bins: int
    runs: list[int]
    base: dict[int, float] | None  # None: ask for label sums
    trees: dict[int, Trees]
    level: int = 0
    splits: dict[int, tuple[np.ndarray, np.ndarray]] | None = None
    watch_only: bool = False
    columns: dict[int, np.ndarray] | None = None
    settled: int = 0


class Block:
    """Rows of the binned matrix (features x rows) with labels, folds and row hashes."""

    def __init__(self, bins: np.ndarray, label: np.ndarray, fold: np.ndarray, key: np.ndarray):
        self.bins, self.label, self.fold, self.key = bins, label, fold, key
        self.margin: dict[int, tuple[int, np.ndarray]] = {}
        self.drawn: tuple[int, np.ndarray] | None = None
        self.gradient: dict[int, tuple[int, slice | np.ndarray, np.ndarray, np.ndarray | None]] = {}

    @staticmethod
    def unpack(row: dict) -> Block:
        n = row["n"]
        block = Block(np.frombuffer(row["bins"], np.uint8).reshape(-1, n), np.frombuffer(row["label"], np.float64),
                      np.frombuffer(row["fold"], np.int8 if len(row["fold"]) == n else np.int32), np.frombuffer(row["key"], np.uint64))
        for run, (done, margin) in row.get("margin", {}).items():
            block.margin[run] = (done, np.frombuffer(margin, np.float64))
        return block

    def _margin(self, run: int, req: Request) -> np.ndarray:
        trees, total = req.trees[run], req.settled + len(req.trees[run])
        done, margin = self.margin.get(run, (0, None))
        if margin is None or done > total:
            if req.settled:
                raise ValueError(f"no margins of the {req.settled} settled trees")
            done, margin = 0, np.full(len(self.label), req.base[run])
        if done < total:
            margin = add_scores(margin, self.bins, trees, done - req.settled)
        self.margin[run] = (total, margin)
        return margin

    def _drawn(self, run: int, turn: int, p: Params) -> slice | np.ndarray:
        """The run's drawn training rows; a slice where they lie together, which spares copies."""
        train = self.fold != run
        if p.row_share < 1:
            if self.drawn is None or self.drawn[0] != turn:
                self.drawn = (turn, sampled(self.key, p.seed, turn, p.row_share))
            train &= self.drawn[1]
        rows = np.flatnonzero(train)
        return slice(rows[0], rows[-1] + 1) if len(rows) and rows[-1] - rows[0] + 1 == len(rows) else rows

    def _nodes(self, rows: slice | np.ndarray, splits: tuple[np.ndarray, np.ndarray], level: int) -> np.ndarray:
        if isinstance(rows, slice):
            return descend(self.bins[:, rows], *splits, level)
        return descend(self.bins, *splits, level)[rows]

    def _gradients(self, run: int, req: Request) -> tuple[slice | np.ndarray, np.ndarray, np.ndarray | None]:
        """The run's drawn training rows with a curvature, their integer-valued gradients and
        curvatures (``None``: one each)."""
        turn = req.settled + len(req.trees[run])
        done, rows, g, h = self.gradient.get(run, (-1, None, None, None))
        if done != turn:
            margin, p = self._margin(run, req), req.params
            rows = self._drawn(run, turn, p)
            margin, label = margin[rows], self.label[rows]
            if p.loss == "logistic":
                prob = sigmoid(margin)
                g, h = np.rint((prob - label) * UNIT), np.rint(prob * (1 - prob) * UNIT)
                if not h.all():
                    some = np.flatnonzero(h)
                    rows, g, h = np.arange(len(self.label))[rows][some], g[some], h[some]
            else:
                g, h = np.rint((margin - label) * UNIT), None
            self.gradient[run] = (turn, rows, g, h)
        return rows, g, h

    def _watch(self, run: int, req: Request) -> np.ndarray:
        """Additive parts of the held-out metric: loss and rows, or rows by class and score."""
        held = self.fold == run
        margin, label = self._margin(run, req)[held], self.label[held]
        if req.params.watch == "auc":
            score = np.minimum((sigmoid(margin) * AUC_BINS).astype(np.int64), AUC_BINS - 1)
            return np.bincount(score + AUC_BINS * (label > 0.5), minlength=2 * AUC_BINS).astype(np.int64)
        if req.params.loss == "logistic":
            loss = np.logaddexp(0, np.where(label > 0.5, -margin, margin))
        else:
            loss = (margin - label) ** 2
        return np.array([np.rint(loss * UNIT).sum(), held.sum()], dtype=np.int64)

    def answer(self, req: Request) -> np.ndarray:
        """This block's part of the sum, as one flat integer array."""
        parts = []
        for run in req.runs:
            if req.base is None:
                parts.append(self._label_sums(run))
                continue
            if req.level == 0:
                parts.append(self._watch(run, req))
            if req.watch_only:
                continue
            rows, g, h = self._gradients(run, req)
            node, n = np.zeros(len(g), dtype=np.int64), 1
            if req.level:  # left children; right ones follow from the parent
                node = self._nodes(rows, req.splits[run], req.level)
                left = np.flatnonzero(node % 2 == 0)
                rows, g, h = np.arange(len(self.label))[rows][left], g[left], h if h is None else h[left]
                node, n = node[left] >> 1, 1 << (req.level - 1)
            cell = node * req.n_bins
            parts += [histogram(cell + column[rows], g, h, n * req.n_bins).ravel() for column in self.bins]
        return np.concatenate(parts)

    def shares(self, req: Request) -> Iterator[tuple[int, np.ndarray]]:
        """This block's part of the sums by key: ``run's place * (features + 1)`` for the label
        sums or the metric, and 1 + feature on top of that for the histograms of all nodes."""
        for i, run in enumerate(req.runs):
            key = i * (len(self.bins) + 1)
            if req.base is None:
                yield key, self._label_sums(run)
                continue
            if req.level == 0:
                yield key, self._watch(run, req)
            if req.watch_only:
                continue
            rows, g, h = self._gradients(run, req)
            cell = self._nodes(rows, req.splits[run], req.level) * req.n_bins if req.level else np.zeros(len(g), dtype=np.int64)
            for f in np.flatnonzero(req.columns[run]).tolist():
                yield key + 1 + f, histogram(cell + self.bins[f][rows], g, h, req.n_bins << req.level)

    def _label_sums(self, run: int) -> np.ndarray:
        train = self.fold != run
        return np.array([np.rint(self.label[train] * UNIT).sum(), train.sum()], dtype=np.int64)


def histogram(at: np.ndarray, g: np.ndarray, h: np.ndarray | None, n: int) -> np.ndarray:
    """Sums of gradient and curvature by cell."""
    out = np.empty((2, n), dtype=np.int64)
    out[0] = np.bincount(at, weights=g, minlength=n)
    out[1] = np.bincount(at, minlength=n) * int(UNIT) if h is None else np.bincount(at, weights=h, minlength=n)
    return out


# ---- the loop ---------------------------------------------------------------------------
def metric_of(parts: np.ndarray, params: Params) -> float:
    """Smaller is better; NaN without held-out rows (or without both classes for AUC)."""
    if params.watch != "auc":
        return parts[0] / UNIT / parts[1] if parts[1] else math.nan
    neg, pos = parts[:AUC_BINS].astype(np.float64), parts[AUC_BINS:].astype(np.float64)
    if not neg.sum() or not pos.sum():
        return math.nan
    below = np.cumsum(neg) - neg
    return -float((pos * (below + neg / 2)).sum() / (pos.sum() * neg.sum()))


def cuts(hist: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gain, bin, sums left, sums of all) of the best cut of each feature and node; a gain of
    minus infinity where none is allowed.  ``hist`` is (features, 2, nodes, bins)."""
    def strength(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        t = np.maximum(np.abs(g) - p.l1, 0)
        return t * t / (h + p.l2)

    left = hist.cumsum(axis=3)
    total = left[:, :, :, -1]
    g_l, h_l = left[:, 0], left[:, 1]
    g_r, h_r = total[:, 0, :, None] - g_l, total[:, 1, :, None] - h_l
    gain = strength(g_l, h_l) + strength(g_r, h_r) - strength(total[:, 0], total[:, 1])[:, :, None]
    gain = np.where((h_l >= p.min_weight) & (h_r >= p.min_weight) & (gain > max(p.min_gain, 1e-9)), gain, -np.inf)
    cut = gain.argmax(axis=2)
    at = cut[:, :, None]
    kept = np.stack([np.take_along_axis(x, at, axis=2)[:, :, 0] for x in (g_l, h_l)], axis=1)
    return np.take_along_axis(gain, at, axis=2)[:, :, 0], cut, kept, total


def best_splits(found: tuple, columns: np.ndarray):
    """(feature, bin, gain, sums left, sums right) of the best split of each node, from the
    ``cuts`` of the features in gradient units.  A node without an allowed split sends
    everything left."""
    gain, cut, kept, total = found
    gain = np.where(columns[:, None], gain, -np.inf)
    node, feature = np.arange(gain.shape[1]), gain.argmax(axis=0)
    some = np.isfinite(gain[feature, node])
    total = total[np.flatnonzero(columns)[0]]  # every feature has the same totals
    low = np.where(some, kept[feature, :, node].T, total)
    return (np.where(some, feature, 0), np.where(some, cut[feature, node], MAX_BINS),
            np.where(some, gain[feature, node], 0.0), low, total - low)


def boost(answer: Callable[[Request], np.ndarray], n_features: int, n_bins: int, runs: list[int], p: Params) -> dict[int, tuple[float, Trees, list[float]]]:
    """(base, kept trees, metric by round) of every run; ``answer`` sums over all blocks."""
    return grow(_from_sums(answer, n_features), n_features, n_bins, runs, p)


def _from_sums(answer: Callable[[Request], np.ndarray], n_features: int) -> Callable[[Request], dict[int, tuple]]:
    """Replies from flat sums, which hold the histograms of left children alone."""
    hist = {}

    def ask(req: Request) -> dict[int, tuple]:
        parts, replies = answer(req).reshape(len(req.runs), -1), {}
        n_watch = (2 * AUC_BINS if req.params.watch == "auc" else 2) if req.level == 0 else 0
        for run, part in zip(req.runs, parts, strict=True):
            if req.base is None:
                replies[run] = tuple(part)
                continue
            metric, splits = metric_of(part[:n_watch], req.params) if n_watch else None, None
            if not req.watch_only:
                part = part[n_watch:].reshape(n_features, 2, -1, req.n_bins) / UNIT
                if req.level:  # left children are new, right ones are what the parent has besides
                    both = np.empty((n_features, 2, 2 * part.shape[2], req.n_bins))
                    both[:, :, 0::2], both[:, :, 1::2] = part, hist[run] - part
                    part = both
                hist[run] = part
                splits = best_splits(cuts(part, req.params), req.columns[run])
            replies[run] = metric, splits
        return replies
    return ask


def grow(ask: Callable[[Request], dict[int, tuple]], n_features: int, n_bins: int, runs: list[int], p: Params) -> dict[int, tuple[float, Trees, list[float]]]:
    """The loop of ``boost``.  ``ask`` gives for every run of a request (label sum, rows) at
    first, then (metric, ``best_splits``)."""
    req = Request(p, n_bins, runs, None, {r: Trees.none(p.depth) for r in runs})
    base = {}
    for run, (s, n) in ask(req).items():
        mean = s / UNIT / n if n else 0.0
        base[run] = float(np.log(np.clip(mean, 1e-6, 1 - 1e-6) / (1 - np.clip(mean, 1e-6, 1 - 1e-6)))) if p.loss == "logistic" else float(mean)
    trees, history = dict(req.trees), {r: [] for r in runs}
    active = list(runs)

    def stopped(run: int) -> bool:
        seen = history[run]
        return p.patience is not None and len(seen) - 1 - best_round(seen) >= p.patience

    for turn in range(p.rounds + 1):
        last = turn == p.rounds
        req = Request(p, n_bins, active, base, {r: trees[r] for r in active}, watch_only=last,
                      columns={run: drawn_columns(n_features, p, run, turn) for run in active})
        replies = ask(req)
        if turn:
            for run in active:
                history[run].append(replies[run][0])
        active = [run for run in active if not stopped(run)]
        if last or not active:
            break
        shape = {run: (np.zeros((1 << p.depth) - 1, np.int32), np.zeros((1 << p.depth) - 1, np.int32), np.zeros((1 << p.depth) - 1)) for run in active}
        leaf = {}
        for level in range(p.depth):
            if level:
                replies = ask(replace(req, runs=active, level=level, splits={r: shape[r][:2] for r in active}))
            for run in active:
                feature, cut, gain, low, high = replies[run][1]
                at = slice((1 << level) - 1, (1 << (level + 1)) - 1)
                shape[run][0][at], shape[run][1][at], shape[run][2][at] = feature, cut, gain
                leaf[run] = np.stack([low, high], axis=2).reshape(2, -1)
        for run in active:
            g, h = leaf[run]
            value = -p.rate * np.sign(g) * np.maximum(np.abs(g) - p.l1, 0) / (h + p.l2)
            trees[run] = trees[run].add(*shape[run], value)
    return {run: (base[run], trees[run].first(best_round(history[run]) + 1) if p.patience is not None else trees[run], history[run]) for run in runs}


def best_round(metrics: list[float]) -> int:
    """The first round with the least metric; the last one where nothing was held out."""
    known = [(m, i) for i, m in enumerate(metrics) if not math.isnan(m)]
    return min(known)[1] if known else len(metrics) - 1


def drawn_columns(n: int, p: Params, run: int, turn: int) -> np.ndarray:
    some = max(1, round(p.column_share * n))
    out = np.zeros(n, dtype=bool)
    out[np.random.default_rng([p.seed, run, turn]).permutation(n)[:some]] = True
    return out


# ---- Spark: binning, sums, scoring ----------------------------------------------------------
def bin_edges(rows: DataFrame, cols: list[str], key: Column, n: int) -> list[np.ndarray]:
    """Upper bounds of the bins but the last of every feature, from a hash sample of the rows."""
    share = min(1.0, EDGE_ROWS / max(n, 1))
    some = rows.filter(F.shiftrightunsigned(key, 11) < F.lit(int(share * (1 << 53)))).select(*cols).toPandas()
    edges = []
    for c in cols:
        x = np.sort(some[c].dropna().to_numpy(dtype=np.float64))
        cuts = np.unique(x) if len(np.unique(x)) < MAX_BINS else np.unique(x[(np.arange(1, MAX_BINS) * len(x)) // MAX_BINS])
        edges.append(cuts[:MAX_BINS - 1])
    return edges


def to_bins(columns: list[np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty((len(edges), len(columns[0]) if columns else 0), dtype=np.uint8)
    for f, (x, e) in enumerate(zip(columns, edges, strict=True)):
        out[f] = np.where(np.isnan(x), 0, np.searchsorted(e, x, side="left"))
    return out


def _packer(edges: list[np.ndarray], n_features: int, keyed: bool):
    """Blocks with their rows ordered by fold, so that one run's training rows lie together."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            cols = [t.column(i).to_numpy().astype(np.float64) for i in range(n_features)]
            label, fold, key = (t.column(n_features + i).to_numpy() for i in range(3))
            order = np.argsort(fold, kind="stable")
            fold = fold[order]
            fold = fold.astype(np.int8 if -128 <= fold[0] and fold[-1] <= 127 else np.int32)
            row = {"n": len(label), "bins": to_bins(cols, edges)[:, order].tobytes(), "label": label[order].astype(np.float64).tobytes(),
                   "fold": fold.tobytes(), "key": key[order].astype(np.int64).tobytes() if keyed else b""}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema(
                [("n", pa.int32()), ("bins", pa.binary()), ("label", pa.binary()), ("fold", pa.binary()), ("key", pa.binary())]))

        held, n = [], 0
        for b in batches:
            while n + b.num_rows > BLOCK_ROWS:
                held.append(b.slice(0, BLOCK_ROWS - n))
                b = b.slice(BLOCK_ROWS - n)
                yield block(held)
                held, n = [], 0
            if b.num_rows:
                held.append(b)
                n += b.num_rows
        if held:
            yield block(held)
    return pack


@cache
def _freeze() -> None:
    """Once a worker: PySpark collects garbage after each task, 40-60 ms over all that was imported;
    frozen objects are left out of that."""
    gc.freeze()


def _shares(packed: bytes, rows: Iterator[dict]) -> Iterator[tuple[int, np.ndarray]]:
    _freeze()
    return iter(_summed(pickle.loads(packed), rows).items())


def _summed(req: Request, rows: Iterator[dict]) -> dict[int, np.ndarray]:
    """The shares of a task's blocks, added up."""
    sums = {}
    for row in rows:
        for key, part in Block.unpack(row).shares(req):
            if key in sums:
                sums[key] += part
            else:
                sums[key] = part
    return sums


def _settled(packed: bytes, rows: Iterator[dict]) -> Iterator[dict]:
    _freeze()
    req = pickle.loads(packed)
    done = req.settled + len(next(iter(req.trees.values())))
    for row in rows:
        block = Block.unpack(row)
        yield {**row, "margin": {run: (done, block._margin(run, req).tobytes()) for run in req.runs}}


def _replies(packed: bytes, width: int, shares: Iterator[tuple[int, np.ndarray]]) -> Iterator[tuple[int, object]]:
    _freeze()
    req, sums = pickle.loads(packed), {}
    for key, part in shares:
        sums[key] = sums[key] + part if key in sums else part
    for key, total in sums.items():
        if key % width:
            yield key, cuts(total.reshape(1, 2, -1, req.n_bins) / UNIT, req.params)
        else:
            yield key, tuple(total.tolist()) if req.base is None else metric_of(total, req.params)


def _plain(row) -> dict:
    return {"n": row["n"], **{c: bytes(row[c]) for c in ("bins", "label", "fold", "key")}, "margin": {}}


class SparkBlocks:
    """Replies of many blocks to ``grow``: one job a request."""

    def __init__(self, blocks: DataFrame, n_features: int) -> None:
        ensure_checkpoint_dir(blocks.sparkSession)
        self.n_features, self.settled, self.written = n_features, 0, None
        self.blocks: RDD = blocks.rdd.map(_plain).persist(StorageLevel.MEMORY_AND_DISK)
        self.context = blocks.sparkSession.sparkContext

    def __call__(self, req: Request) -> dict[int, tuple]:
        done, before = len(next(iter(req.trees.values()))), None
        req = replace(req, settled=self.settled, trees={run: t.after(self.settled) for run, t in req.trees.items()})
        if done > self.settled:  # in the same job as this request's sums
            asked = pickle.dumps(replace(req, splits=None, columns=None))
            before, self.blocks = self.blocks, self.blocks.mapPartitions(partial(_settled, asked), True).persist(StorageLevel.MEMORY_AND_DISK)
            if done % SETTLE == 0:
                self.blocks.checkpoint()
            self.settled = done
            req = replace(req, settled=done, trees={run: t.after(len(t)) for run, t in req.trees.items()})
        replies = self._ask(req)
        if before is not None:
            before.unpersist()
            if done % SETTLE == 0:
                self._drop(self.written)
                self.written = self.blocks.getCheckpointFile()
        return replies

    def _ask(self, req: Request) -> dict[int, tuple]:
        width = self.n_features + 1
        some = sum(1 + int(req.columns[run].sum()) if req.columns else 1 for run in req.runs)
        few = replace(req, trees={}, splits=None)
        parts = min(math.ceil(some / TASK_SUMS), self.context.defaultParallelism)
        found = dict(self.blocks.mapPartitions(partial(_shares, pickle.dumps(req)))
                     .partitionBy(parts, int).mapPartitions(partial(_replies, pickle.dumps(few), width)).collect())
        if req.base is None:
            return {run: found[i * width] for i, run in enumerate(req.runs)}
        return {run: (found.get(i * width), None if req.watch_only else best_splits(self._all(found, i * width + 1, req.columns[run]), req.columns[run]))
                for i, run in enumerate(req.runs)}

    def _all(self, found: dict, start: int, columns: np.ndarray) -> tuple:
        drawn = np.flatnonzero(columns).tolist()
        return tuple(self._spread(np.concatenate(parts), drawn) for parts in zip(*(found[start + f] for f in drawn), strict=True))

    def _spread(self, some: np.ndarray, drawn: list[int]) -> np.ndarray:
        out = np.zeros((self.n_features, *some.shape[1:]), some.dtype)
        out[drawn] = some
        return out

    def _drop(self, folder: str | None) -> None:
        """Deletes a checkpoint that a later one replaces."""
        if folder:
            path = self.context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(self.context._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        self.blocks.unpersist()
        self._drop(self.written)


def _whole_loop(n_features: int, n_bins: int, runs: list[int], p: Params):
    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                fitted = boost(Block.unpack(row).answer, n_features, n_bins, runs, p)
                yield pa.RecordBatch.from_pydict({"fitted": pa.array([pickle.dumps(fitted)], pa.binary())})
    return loop


@dataclass
class Model:
    """A fitted run: scores rows of raw feature columns."""

    cols: list[str]
    edges: list[np.ndarray]
    base: float
    trees: Trees
    history: list[float]
    loss: str

    def score_rows(self, columns: list[np.ndarray]) -> np.ndarray:
        bins = to_bins(columns, self.edges)
        raw = add_scores(np.full(bins.shape[1], self.base), bins, self.trees)
        return sigmoid(raw) if self.loss == "logistic" else raw

    def score(self) -> Column:
        """Probability of the label, or the predicted value, of the row's ``cols``."""
        model = self

        @F.pandas_udf("double")
        def scored(*columns: pd.Series) -> pd.Series:
            raw = [c.to_numpy(dtype=np.float64, na_value=np.nan) for c in columns]
            return pd.Series(model.score_rows(raw))

        return scored(*[F.col(c).cast("double") for c in self.cols])

    def importances(self) -> dict[str, float]:
        """Share of each feature in the total gain."""
        total = np.bincount(self.trees.feature.ravel(), weights=self.trees.gain.ravel(), minlength=len(self.cols))
        return dict(zip(self.cols, (total / total.sum() if total.sum() else total).tolist(), strict=True))


def fit(rows: DataFrame, cols: list[str], label: str, fold: str, id_col: str, runs: list[int], p: Params) -> dict[int, Model]:
    """One model a run.  ``fold`` is an integer column; see the module's text."""
    key = F.xxhash64(F.col(id_col))
    data = rows.select(*[F.col(c).cast("double").alias(c) for c in cols], F.col(label).cast("double").alias("_label"),
                       F.col(fold).cast("int").alias("_fold"), key.alias("_key")).persist()
    n = data.count()
    if not n:
        raise ValueError("no rows to fit")
    edges = bin_edges(data, cols, F.col("_key"), n)
    n_bins = max(len(e) for e in edges) + 1
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = 1 if n <= BLOCK_ROWS else cores * math.ceil(n / (BLOCK_ROWS * TASK_BLOCKS * cores))
    blocks = data.repartition(parts, "_key").mapInArrow(_packer(edges, len(cols), p.row_share < 1), BLOCK).persist()
    if blocks.count() == 1:
        fitted = pickle.loads(blocks.mapInArrow(_whole_loop(len(cols), n_bins, runs, p), "fitted binary").first()["fitted"])
    else:
        ask = SparkBlocks(blocks, len(cols))
        fitted = grow(ask, len(cols), n_bins, runs, p)
        ask.close()
    blocks.unpersist()
    data.unpersist()
    return {run: Model(cols, edges, b, t, h, p.loss) for run, (b, t, h) in fitted.items()}
