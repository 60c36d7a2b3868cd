"""Language identification by rank-order n-gram profiles.

A profile is the list of the ``PROFILE`` most frequent letter n-grams (one to three code
points, words padded with a space), most frequent first.  A document gets the language
whose profile is nearest by out-of-place distance: the sum over its own ranked n-grams of
how far each stands from its place in the language's list, an absent n-gram counting
``PROFILE``.

Language profiles are fitted on at most about ``FIT_DOCS`` labelled documents a language,
chosen by hash; every document's own profile is made of its whole text, inside Arrow tasks
that need no shuffle.  The model is a few lists of ``PROFILE`` numbers.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is every text
when nothing can be learned; ties go to the language first in code-point order, ties of
n-gram counts to the smaller n-gram; repeated rows and null ids each get a row (a null id
is held in neither part and never learned from); a null lang is never learned; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C

PROFILE = 400
FIT_DOCS = 2000
#: Runs of letters and of the marks on them are words; a text without a letter has none.
NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
LETTER = regex.compile(r"\p{L}")


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram keys of a text and their counts."""
    letters = NOT_LETTERS.sub(" ", text.lower()).strip()
    if not LETTER.search(letters):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = np.frombuffer(f" {letters} ".encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    gap = c == 32
    two = (c[:-1] << 21) | c[1:]
    three = (two[:-1] << 21) | c[2:]
    keys = np.concatenate([c[~gap], two, three[~gap[1:-1]]])
    return np.unique(keys, return_counts=True)


def top_grams(keys: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    return keys[np.lexsort((keys, -counts))[:most]]


def _part(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Profile of each language, from the documents that are not held out."""
    known = docs.filter((_part(id_col) != 2) & F.col(lang_col).isNotNull())
    known = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    share = F.element_at(F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(int((1 << 53) * min(1.0, FIT_DOCS / n))))]), F.col("lang"))
    chosen = known.filter(F.shiftrightunsigned(F.xxhash64("id", F.lit(7)), 11) < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                keys, counts = gram_counts(text or "")
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], names=["lang", "gram", "n"])

    grams = chosen.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    total = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = total.withColumn("rank", rank).filter(F.col("rank") <= PROFILE).orderBy("lang", "rank").collect()
    return {k: np.array([r["gram"] for r in top if r["lang"] == k], np.int64) for k in sorted({r["lang"] for r in top})}


def nearest(mine: np.ndarray, profiles: list[tuple[str, np.ndarray, np.ndarray]]) -> tuple[str, float]:
    """Language and score (1 at distance 0) for the ranked n-grams of a document."""
    best, least = "und", np.inf
    at = np.arange(len(mine))
    for lang, keys, ranks in profiles:
        spot = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
        far = np.where(keys[spot] == mine, np.abs(ranks[spot] - at), PROFILE).sum()
        if far < least:
            best, least = lang, far
    return best, float(1 - least / (PROFILE * len(mine))) if len(mine) and best != "und" else 0.0


def predict(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    ready = [(lang, np.sort(grams), np.argsort(grams, kind="stable")) for lang, grams in sorted(model.items()) if len(grams)]

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = [], []
            for text in b.column(1):
                keys, counts = gram_counts(text.as_py() or "")
                lang, score = nearest(top_grams(keys, counts), ready) if len(keys) and ready else ("und", 0.0)
                langs.append(lang)
                scores.append(score)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        guess, "doc_id long, lang_pred string, score double")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).select("doc_id", F.coalesce(_part("doc_id") == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
