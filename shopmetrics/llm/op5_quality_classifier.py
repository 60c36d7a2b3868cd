"""Ordinal quality classifier: cumulative-link regression on hashed text.

Labels grade documents 0 (toxic), 1 (low quality) or 2 (good).  One weight vector over
hashed text features is shared by all grades, and ordered thresholds split its score s:

    P(grade <= k) = sigmoid(threshold_k - s).

The expected grade and the tail probability P(grade = 2) follow; a document is kept when
its tail probability reaches ``MIN_TAIL``.  Features are the distinct words and the shape of
the text (share of capital words, symbol runs and immediate repeats, in steps), hashed into
``CELLS`` weights; L1 shrinkage leaves a weight only where the labels speak.

The model is fitted on at most about ``FIT_ROWS`` labelled documents, chosen by hash, and is
``CELLS`` doubles (2 MB) and two thresholds, which travel with the scoring tasks.  Every
document is scored over its whole text: JVM functions make the cells, a Pandas UDF adds
their weights.

Defined cases: a null or empty text has only its shape features; without usable labels (or
with one grade only) every document is kept with tail probability 1; labels of a repeated
doc_id take the lowest grade; a null quality counts as 1 and a null toxic as 0; null ids
are scored but never learned from; repeated rows each get a row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

CELLS = 1 << 18
FIT_ROWS = 12000
MIN_TAIL = 0.5
GRADES = 3
L1 = 2e-4
STEPS = 150


def _cell(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(CELLS)).cast("int")


def letters(text: Column) -> Column:
    """Runs of letters of a text."""
    return F.filter(F.split(text, r"[^\p{L}]+"), lambda w: w != "")


def features(text: Column, words: Column) -> Column:
    """Distinct feature cells of a text with these runs of letters."""
    caps = F.size(F.filter(words, lambda w: (F.length(w) > 1) & (F.upper(w) == w)))
    marks = F.size(F.regexp_extract_all(text, F.lit(r"[^\p{L}\p{N}\s]{2,}+|\s[^\p{L}\p{N}\s]\s"), F.lit(0)))
    same = F.size(F.filter(F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))),
                                      lambda a, b: a.eqNullSafe(b)), lambda x: x))

    def step(name: str, n: Column) -> Column:
        share = F.floor(10 * n / F.greatest(F.size(words), F.lit(1)))
        return F.concat(F.lit(f"{name}="), F.least(share, F.lit(10)).cast("string"))

    shape = F.array(step("^caps", caps), step("^marks", marks), step("^same", same))
    return F.array_distinct(F.transform(F.concat(F.transform(words, lambda w: F.lower(w)), shape), _cell))


def fit_weights(cells: list[np.ndarray], grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by proximal AdaGrad on the cumulative-link loss."""
    index = np.concatenate(cells)
    row = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
    n = len(grades)
    share = np.cumsum(np.bincount(grades, minlength=GRADES) / n)[:-1]
    cut = np.log((share + 1e-6) / (1 - share + 1e-6))
    weights, seen, seen_cut = np.zeros(CELLS), np.full(CELLS, 1e-8), np.full(GRADES - 1, 1e-8)

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -35, 35)))

    for _ in range(STEPS):
        score = np.bincount(row, weights=weights[index], minlength=n)
        below = sigmoid(cut[None, :] - score[:, None])
        up = np.concatenate([below, np.ones((n, 1))], 1)[np.arange(n), grades]
        low = np.concatenate([np.zeros((n, 1)), below], 1)[np.arange(n), grades]
        mass = np.maximum(up - low, 1e-9)
        slope_up, slope_low = up * (1 - up), low * (1 - low)
        d_score = (slope_up - slope_low) / mass / n
        grad = np.bincount(index, weights=d_score[row], minlength=CELLS)
        d_cut = np.array([(np.where(grades == k, -slope_up / mass, 0) + np.where(grades == k + 1, slope_low / mass, 0)).sum() / n
                          for k in range(GRADES - 1)])
        seen += grad * grad
        rate = 0.3 / np.sqrt(seen)
        moved = weights - rate * grad
        weights = np.sign(moved) * np.maximum(np.abs(moved) - rate * L1, 0)
        seen_cut += d_cut * d_cut
        cut = np.maximum.accumulate(cut - 0.3 / np.sqrt(seen_cut) * d_cut)
    return weights, cut


def grade_labels(labels: DataFrame) -> DataFrame:
    """(l_id, grade) with the lowest grade of repeated labels."""
    grade = (F.when(F.coalesce("toxic", F.lit(0)) == 1, 0).when(F.coalesce("quality", F.lit(1)) == 0, 1).otherwise(2))
    return (labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("l_id")).agg(F.min(grade).alias("grade")))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Weights and thresholds from at most about ``FIT_ROWS`` labelled texts; None where no
    document has a label or all have one grade."""
    texts = docs.select(F.col("doc_id").alias("f_id"), C.whole_text("text").alias("f_text")).withColumn("f_hash", F.xxhash64("f_text"))
    # equal rows of one id are one labelled text, however many there are
    labelled = texts.select("f_id", "f_hash").join(grade_labels(labels), F.col("f_id") == F.col("l_id")).groupBy("f_id", "f_hash").agg(F.min("grade").alias("grade"))
    labelled = C.materialize(labelled, "labelled-texts")
    n = labelled.count()
    if not n:
        return None
    share = min(1.0, FIT_ROWS / n)
    chosen = labelled.filter(F.shiftrightunsigned(F.xxhash64("f_id", "f_hash", F.lit(11)), 11) < F.lit(int(share * (1 << 53))))
    # about FIT_ROWS rows: a broadcast of that fixed size
    rows = (texts.join(F.broadcast(chosen), ["f_id", "f_hash"]).groupBy("f_id", "f_hash", "grade").agg(F.min("f_text").alias("f_text"))
            .select("grade", features(F.col("f_text"), letters(F.col("f_text"))).alias("cells"))).toArrow()
    if not rows.num_rows:
        raise ValueError("no labelled text was drawn")
    grades = rows.column("grade").to_numpy().astype(np.int64)
    if len(np.unique(grades)) < 2:
        return None
    flat = rows.column("cells").combine_chunks()
    values, offsets = flat.flatten().to_numpy(), flat.offsets.to_numpy()
    offsets = offsets - offsets[0]
    return fit_weights([values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], grades)


def score(rows: DataFrame, text: Column, model: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """``rows`` with expected_grade, tail_prob and kept added as one struct, ``verdict``."""
    if model is None:
        return rows.withColumn("verdict", F.struct(F.lit(2.0).alias("expected_grade"), F.lit(1.0).alias("tail_prob"), F.lit(True).alias("kept")))
    weights, cut = model

    @F.pandas_udf("double")
    def total(cells: pd.Series) -> pd.Series:
        # every text has its shape cells, so no row is empty
        sizes = cells.map(len).to_numpy()
        return pd.Series(np.add.reduceat(weights[np.concatenate(cells.to_numpy())], np.cumsum(sizes) - sizes))

    rows = rows.withColumn("v_words", letters(text)).withColumn("v_cells", features(text, F.col("v_words")))
    rows = rows.withColumn("v_score", total("v_cells"))

    def above(k: int) -> Column:
        return 1 / (1 + F.exp(F.lit(float(cut[k])) - F.col("v_score")))

    expected, tail = F.round(above(0) + above(1), 6), F.round(above(GRADES - 2), 6)
    verdict = F.struct(expected.alias("expected_grade"), tail.alias("tail_prob"), (tail >= MIN_TAIL).alias("kept"))
    return rows.withColumn("verdict", verdict).drop("v_words", "v_cells", "v_score")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    model = fit(docs, C.table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), C.whole_text("text"), model).select("doc_id", "verdict.*")
