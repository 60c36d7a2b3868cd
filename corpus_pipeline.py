"""Corpus pipeline: filter, deduplicate, decontaminate, redact and mix ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's
result as Parquet in the shared scratch folder and reads it again for the next.  All stages
but the last return the columns of their input, whatever these are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmetrics.llm import (
    op2_decontamination,
    op5_quality_classifier,
    op7_secrets,
    op8_jaccard_join,
    op10_mixing,
)
from shopmetrics.llm import common as C
from shopmetrics.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier grades as good."""
    model = op5_quality_classifier.fit(docs, C.table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("_d"))
    judged = op5_quality_classifier.score(rows, C.whole_text(F.col("_d.text")), model)
    return judged.filter("verdict.kept").select("_d.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked shingle sets."""
    return op8_jaccard_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return op2_decontamination.decontaminate(docs, C.table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in them replaced by its kind."""
    return op7_secrets.redact(docs, scratch_path(spark, "blob-ledger"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: documents drawn, by output shard, in shuffled order."""
    mixed = op10_mixing.mix(docs, op10_mixing.word_count())
    return mixed.select("row.*", F.col("copy").alias("mix_copy"), F.col("shard").alias("mix_shard"), F.col("at").alias("mix_order"))


STAGES = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", benchmark),
    ("secret_scans", secrets),
    ("mixing", mixing),
]

#: Fitted weights and seeded draws have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = C.materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
