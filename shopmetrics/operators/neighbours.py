"""Nearest neighbours among the rows of a table, by random-projection trees.

Each of ``TREES`` trees halves the rows along random directions, at medians fitted on a hash
sample, until a leaf holds about ``LEAF`` rows.  Rows of one leaf meet; a leaf with more rows
than ``BLOCK`` (many equal rows, or a small sample) is split into blocks that meet pair by pair,
so no task holds more than two blocks and no candidate is dropped.  A row's neighbours are the
nearest over all trees; distances are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TREES = 8
LEAF = 512
BLOCK = 2048
MAX_LEAVES = 8192
PER_LEAF = 32
CELLS = 12_000  # distances at a time: arrays that stay in a core's cache


def _fit_tree(sample: np.ndarray, depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(direction, limit) of the inner nodes of a complete tree, by level."""
    rng = np.random.default_rng(seed)
    directions, limits = rng.normal(size=((1 << depth) - 1, sample.shape[1])), np.zeros((1 << depth) - 1)
    node = np.zeros(len(sample), dtype=np.int64)
    for level in range(depth):
        for i in range(1 << level):
            at, rows = (1 << level) - 1 + i, np.flatnonzero(node == i)
            if len(rows):
                limits[at] = np.median(sample[rows] @ directions[at])
        node = _step(sample, node, level, directions, limits)
    return directions, limits


def _step(x: np.ndarray, node: np.ndarray, level: int, directions: np.ndarray, limits: np.ndarray) -> np.ndarray:
    at = node + (1 << level) - 1
    return 2 * node + (np.einsum("ij,ij->i", x, directions[at]) > limits[at])


def _gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``a`` to all of ``b``, a whole column at a time: several times
    faster than a sum over the short last axis, and added up in its order (eight running sums
    first), so equal to the last bit up to 128 columns."""
    def square(j: int) -> np.ndarray:
        gap = a[:, j, None] - b[None, :, j]
        return np.multiply(gap, gap, out=gap)

    n, total = a.shape[1], np.zeros((len(a), len(b)))
    if n >= 8:
        r = [square(j) for j in range(8)]
        for j in range(8, n - n % 8):
            r[j % 8] += square(j)
        total = ((r[0] + r[1]) + (r[2] + r[3])) + ((r[4] + r[5]) + (r[6] + r[7]))
    for j in range(n - n % 8 if n >= 8 else 0, n):
        total += square(j)
    return np.sqrt(total, out=total)


def nearest_neighbours(rows: DataFrame, id_col: str, vector_col: str, k: int, seed: int = 42) -> DataFrame:
    """(id, neighbours): up to ``k`` structs (distance, id) of other rows, nearest first.

    ``vector_col`` is an array of doubles without nulls; ids are distinct.
    """
    points = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    n = points.count()
    depth = 0
    while n > LEAF << depth and (2 << depth) <= MAX_LEAVES:
        depth += 1
    share = min(1.0, PER_LEAF * (1 << depth) / max(n, 1))
    sample = points.filter(F.shiftrightunsigned(F.xxhash64("id", F.lit(seed)), 11) < F.lit(int(share * (1 << 53)))).select("v").toPandas()
    x = np.array(sample["v"].tolist(), dtype=np.float64)
    trees = [_fit_tree(x, depth, seed + t) for t in range(TREES)] if depth and len(x) else [None]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = np.array(b.column("v").to_pylist(), dtype=np.float64)
            for t, tree in enumerate(trees):
                node = np.zeros(b.num_rows, dtype=np.int64)
                for level in range(depth if tree else 0):
                    node = _step(v, node, level, *tree)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, t, np.int32)), pa.array(node), b.column("id"), b.column("v")],
                                                 names=["tree", "leaf", "id", "v"])

    id_type = points.schema["id"].dataType.simpleString()
    dealt = points.mapInArrow(deal, f"tree int, leaf long, id {id_type}, v array<double>").persist()
    sizes = dealt.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    # a row a leaf, so at most TREES * MAX_LEAVES; the dealt rows, which grow with the input, stay where they are
    cells = dealt.join(F.broadcast(sizes), ["tree", "leaf"]).withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # a row asks in every cell of its own row of blocks, and is asked in every cell of its column
    both = cells.select("tree", "leaf", "id", "v", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.array(F.struct(F.col("mine").alias("q"), o.alias("m"), F.lit(True).alias("asks")),
                          F.struct(o.alias("q"), F.col("mine").alias("m"), F.lit(False).alias("asks")))))).alias("c"))

    def search(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")  # ties go to the smaller id
        asks = table.column("asks").to_numpy()
        ids, v = table.column("id").to_pylist(), np.array(table.column("v").to_pylist(), dtype=np.float64)
        q, m = np.flatnonzero(asks), np.flatnonzero(~asks)
        out = {"id": [], "distance": [], "near": []}
        step = max(4, CELLS // max(1, len(m)))
        for at in range(0, len(q), step) if len(m) else ():
            mine = q[at:at + step]
            gap = _gaps(v[mine], v[m])
            some = min(k, len(m) - 1)  # the row itself may be one of them
            for row, limit, i in zip(gap, np.partition(gap, some, axis=1)[:, some], mine, strict=True):
                below = np.flatnonzero(row < limit)
                best = np.concatenate([below, np.flatnonzero(row == limit)[:some + 1 - len(below)]])
                for j in best[[ids[m[j]] != ids[i] for j in best]]:
                    out["id"].append(ids[i])
                    out["distance"].append(float(row[j]))
                    out["near"].append(ids[m[j]])
        arrow_id = table.schema.field("id").type
        return pa.table({"id": pa.array(out["id"], arrow_id), "distance": pa.array(out["distance"], pa.float64()), "near": pa.array(out["near"], arrow_id)})

    found = (both.select("tree", "leaf", "c.q", "c.m", "c.asks", "id", "v").groupBy("tree", "leaf", "q", "m")
             .applyInArrow(search, f"id {id_type}, distance double, near {id_type}"))
    # k candidates a tree and block at most; equal ones of several trees are one
    best = F.slice(F.sort_array(F.collect_set(F.struct("distance", F.col("near").alias("id")))), 1, k)
    return found.groupBy("id").agg(best.alias("neighbours"))
