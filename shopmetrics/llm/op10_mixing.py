"""Mixing sources to target weights with a hypergeometric splitting tree.

Sizes are words.  Targets: sources by code point (null last) weigh 5, 2, 1, repeating, and
share ``SHARE`` times all words; a target stops at twice its source's size and the excess
is reshared by weight (the fixed point of resharing is the water level below).

Each source's rows are dealt by a keyed hash into blocks of about ``BLOCK_ROWS`` rows, and
its blocks are permuted.  A source draws whole passes over its blocks and then a prefix of
one more permutation; the last block drawn is cut by a row hash, so that the words taken
miss the target by about half a row.  The exact block quotas of all sources are then split
recursively among ``2^depth`` output shards: at each node, the left half's quota vector is a
multivariate hypergeometric draw, seeded by the node.  A leaf walks from the root by itself
and so knows which run of every source's draw sequence is its own: shards are disjoint,
their sizes differ by one block at most, and nothing is held in one place but one number
for each source.  Inside a shard rows are ordered by a keyed hash.

The driver sees one row for each source (its rows and words), and no row of a document.
A source with a third of all rows is only many blocks.

Defined cases: a null text has size 0; null source is the last source; a source without
words has target 0 and is never drawn (unless other rows bring its share, rows of size 0
count as taken 0); an empty table gives an empty mix; rows are told apart by the hash of all
their columns and equal ones by a number, so null or repeated ids are drawn like others; very
long texts only count; ties of hashes are drawn together; other columns stay in ``row``,
whatever their names; reruns and other partitionings agree, as only keyed hashes decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_REPEAT = 2.0
BLOCK_ROWS = 1024
DRAWS_PER_SHARD = 32
SEED = 20240613


def source_targets(sizes: pd.DataFrame) -> pd.DataFrame:
    """Adds ix, weight and target to (source, n, words), one row for each source."""
    t = sizes.copy()
    t["order"] = [(s is None or s != s, "" if s is None or s != s else s) for s in t["source"]]
    t = t.sort_values("order").drop(columns="order").reset_index(drop=True)
    t["ix"] = np.arange(len(t))
    t["weight"] = [WEIGHTS[i % len(WEIGHTS)] for i in t["ix"]]
    cap = MAX_REPEAT * t["words"].astype(float)
    left, free = SHARE * float(t["words"].sum()), np.ones(len(t), dtype=bool)
    target = np.zeros(len(t))
    while free.any():
        share = np.where(free, t["weight"] * left / t["weight"][free].sum(), 0.0)
        over = free & (share > cap)
        if not over.any():
            target[free] = share[free]
            break
        target[over] = cap[over]
        left -= cap[over].sum()
        free &= ~over
    t["target"] = target
    return t


def leaf_runs(quotas: np.ndarray, depth: int, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, count) in every source's draw sequence of one leaf of the splitting tree."""
    start, have = np.zeros_like(quotas), quotas.copy()
    node = 1
    for level in range(depth):
        right = (leaf >> (depth - 1 - level)) & 1
        draw = np.random.default_rng([SEED, node]).multivariate_hypergeometric(have, int(have.sum()) // 2, method="marginals")
        if right:
            start, have = start + draw, have - draw
        else:
            have = draw
        node = 2 * node + right
    return start, have


def _leaf_table(spark: SparkSession, quotas: np.ndarray, depth: int) -> DataFrame:
    """(ix, nth, shard): the shard of each draw of each source."""
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for leaf in b["id"]:
                start, count = leaf_runs(quotas, depth, int(leaf))
                on = count > 0
                yield pd.DataFrame({"ix": np.flatnonzero(on), "start": start[on], "count": count[on], "shard": leaf})

    leaves = spark.range(1 << depth).mapInPandas(walk, "ix int, start long, count long, shard long")
    return leaves.select("ix", "shard", F.explode(F.sequence("start", F.col("start") + F.col("count") - 1)).alias("nth"))


def _told_apart(rows: DataFrame) -> DataFrame:
    """``rows`` with ``h`` unlike for equal rows too: they are numbered from 0 and hashed again.

    Which of them gets which number is of no account, since they are equal.  They are written
    with their task's number, counted within the task, and moved up by the counts of the
    tasks before it, so that no group of equal rows is one task's work.
    """
    repeated = C.materialize(rows.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("h").alias("r_h")), "mix-repeated")
    if not repeated.limit(1).count():
        return rows
    same = C.materialize(rows.join(repeated, F.col("h") == F.col("r_h")).drop("r_h").withColumn("p", F.spark_partition_id()), "mix-equal-rows")
    counts = same.groupBy(F.col("h").alias("c_h"), F.col("p").alias("c_p")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("c_h").orderBy("c_p").rowsBetween(Window.unboundedPreceding, -1))
    counts = C.materialize(counts.select("c_h", "c_p", F.coalesce(before, F.lit(0)).alias("before")), "mix-equal-counts")
    numbered = same.withColumn("at", F.row_number().over(Window.partitionBy("h", "p").orderBy("size")))
    numbered = numbered.join(counts, (F.col("h") == F.col("c_h")) & (F.col("p") == F.col("c_p")))
    numbered = numbered.withColumn("h", F.xxhash64("h", F.col("before") + F.col("at"))).select(rows.columns)
    return rows.join(repeated, F.col("h") == F.col("r_h"), "left_anti").unionByName(numbered)


def plan_mix(docs: DataFrame, size: Column, source_col: str = "source") -> DataFrame:
    """Every row as ``row``, with size, source_size, target and ``draws`` (copy, shard)."""
    spark = docs.sparkSession
    every = [F.col(f"`{f.name}`") if "map<" not in f.dataType.simpleString() else F.to_json(F.col(f"`{f.name}`")) for f in docs.schema]
    rows = _told_apart(docs.select(F.struct("*").alias("row"), F.col(source_col).alias("source"), size.cast("long").alias("size"),
                                   F.xxhash64(*every, F.lit(SEED)).alias("h")))
    sized = C.materialize(rows.select("source", "size", "h"), "mix-sizes")
    counted = sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    sources = source_targets(counted.toPandas())
    schema = "source string, n long, words long, ix int, weight double, target double"
    known = spark.createDataFrame(
        [(None if s is None or s != s else str(s), int(n), int(w), int(i), float(g), float(t))
         for s, n, w, i, g, t in sources.itertuples(index=False)], schema)
    known = known.withColumn("n_blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("long"))
    known = known.withColumn("passes", F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0))
    known = known.withColumn("rest", F.col("target") - F.col("passes") * F.col("words")).withColumnRenamed("source", "k_source")

    def blocked(df: DataFrame) -> DataFrame:
        # one row for each source: the side Spark broadcasts when its measured size allows
        return (df.join(known, F.col("source").eqNullSafe(F.col("k_source")))
                .withColumn("block", F.pmod("h", F.col("n_blocks"))))

    cuts = sized.transform(blocked)
    blocks = (cuts.groupBy("ix", "block").agg(F.sum("size").alias("words"))
              .withColumn("turn", F.xxhash64("ix", "block", F.lit(SEED + 1))))
    order = Window.partitionBy("ix").orderBy("turn", "block")
    before = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("ix", "block", F.col("words").alias("b_words"), (F.row_number().over(order) - 1).alias("at"),
                           F.coalesce(before, F.lit(0)).alias("before"))
    blocks = blocks.join(known.select("ix", "passes", "rest", "n_blocks"), "ix")
    full = F.sequence(F.lit(0).cast("long"), F.col("passes"))  # pass numbers, the last one partial
    blocks = C.materialize(blocks.select("ix", "block", "at", "before", "b_words", "passes", "rest", "n_blocks",
                                         F.explode(full).alias("copy"))
                           .filter((F.col("copy") < F.col("passes")) | (F.col("before") < F.col("rest"))), "mix-blocks")
    # draw sequence of a source: pass by pass, each starting elsewhere in the permutation
    seq = Window.partitionBy("ix").orderBy("copy", "at")
    draws = blocks.withColumn("nth", (F.row_number().over(seq) - 1).cast("long"))
    draws = draws.withColumn("part", (F.col("copy") == F.col("passes")) & (F.col("before") + F.col("b_words") > F.col("rest")))

    # the block that a source's last pass cuts: the row hash up to which rows are taken
    edge = draws.filter("part").select("ix", "block", (F.col("rest") - F.col("before")).alias("room"))
    tied = cuts.join(edge, ["ix", "block"]).groupBy("ix", "block", "h", "room").agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(Window.partitionBy("ix", "block").orderBy("h").rowsBetween(Window.unboundedPreceding, 0))
    limit = (tied.withColumn("upto", upto).filter(F.col("upto") - F.col("size") / 2 <= F.col("room"))
             .groupBy("ix", "block").agg(F.max("h").alias("limit")))

    quota = draws.groupBy("ix").agg(F.count("*").alias("q")).toPandas()
    quotas = np.zeros(len(sources), dtype=np.int64)
    quotas[quota["ix"].to_numpy(dtype=np.int64)] = quota["q"].to_numpy(dtype=np.int64)
    depth = max(0, math.ceil(math.log2(max(1, int(quotas.sum()) / DRAWS_PER_SHARD))))
    dealt = draws.join(_leaf_table(spark, quotas, depth), ["ix", "nth"]).join(limit, ["ix", "block"], "left")
    # a cut block of which no row fits has no limit: nothing of it is taken
    dealt = dealt.filter(~F.col("part") | F.col("limit").isNotNull()).groupBy("ix", "block").agg(
        F.sort_array(F.collect_list(F.struct("copy", "shard", F.when(F.col("part"), F.col("limit")).alias("limit")))).alias("deals"))
    dealt = dealt.select(F.col("ix").alias("d_ix"), F.col("block").alias("d_block"), "deals")

    drawn = rows.transform(blocked).join(dealt, (F.col("ix") == F.col("d_ix")) & (F.col("block") == F.col("d_block")), "left")
    mine = F.filter("deals", lambda d: d["limit"].isNull() | (F.col("h") <= d["limit"]))
    mine = F.transform(mine, lambda d: F.struct(d["copy"].alias("copy"), d["shard"].alias("shard")))
    return drawn.select("row", "size", F.col("words").alias("source_size"), "target", "h",
                        F.coalesce(mine, F.array().cast("array<struct<copy:bigint,shard:bigint>>")).alias("draws"))


def mix(docs: DataFrame, size: Column, source_col: str = "source") -> DataFrame:
    """The mixed rows, gathered by shard and in the shard's shuffled order.

    Columns: ``row`` (the input row), copy, shard and ``at`` (the order key in the shard).
    """
    taken = plan_mix(docs, size, source_col).select("row", "h", F.explode("draws").alias("d"))
    taken = taken.select("row", "d.copy", "d.shard", F.xxhash64("h", "d.copy", F.lit(SEED + 2)).alias("at"))
    return taken.repartition("shard").sortWithinPartitions("shard", "at")


def word_count(text_col: str = "text") -> Column:
    return F.size(C.words_of(C.whole_text(text_col))).cast("long")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "source", word_count().alias("size"))
    return plan_mix(docs, F.col("size")).select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"))
