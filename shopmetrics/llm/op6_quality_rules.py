"""Quality rules with a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into ``BUCKETS`` cells.  Two multinomials over the cells
are counted: one over the whole corpus, one over trusted documents (label quality 1, not
toxic).  A document's score is the mean over its n-grams of

    log P(cell | trusted) - log P(cell | corpus)      (both smoothed by ``ALPHA``),

and it is kept when no base rule fails and the score reaches ``MIN_SCORE``.  The verdict is
a fixed threshold: no sampling, so equal texts get equal verdicts.

The model is one row of ``BUCKETS`` doubles (512 KB at any corpus size), which is what the
scoring pass joins by broadcast.  Only DataFrame functions are used.

Defined cases: a null or empty text has no words, fails the base rule and scores 0; with no
labels or an empty corpus both multinomials are uniform and every score is 0; repeated rows
each get a row; repeated labels count once, as trusted only if all agree; null ids are
never trusted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

BUCKETS = 1 << 16
ALPHA = 1.0
MIN_SCORE = -0.2
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _cells(words: Column) -> Column:
    """Cells of all words and neighbouring word pairs."""
    def cell(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")

    one = F.transform(words, lambda w: cell(w))
    two = F.when(F.size(words) > 1, F.transform(
        F.sequence(F.lit(0), F.size(words) - 2), lambda i: cell(F.get(words, i), F.get(words, i + 1))))
    return F.concat(one, F.coalesce(two, F.array().cast("array<int>")))


def fit(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row: key (always 0) and ``ratio``, the log-likelihood ratio of each cell."""
    marked = trusted.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("t_id")).distinct()
    flagged = (docs.select("doc_id", C.whole_text("text").alias("text"))
               .join(marked.hint("shuffle_hash"), F.col("doc_id") == F.col("t_id"), "left")
               .select(C.words_of(F.col("text")).alias("words"), F.col("t_id").isNotNull().cast("long").alias("good")))
    # explode_outer: explode would add a filter that Spark pushes into the n-gram lambdas
    counts = (flagged.select("good", F.explode_outer(_cells(F.col("words"))).alias("cell"))
              .filter(F.col("cell").isNotNull()).groupBy("cell").agg(F.count("*").alias("n"), F.sum("good").alias("g")))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("cell"))
    full = every.join(counts, "cell", "left").select(
        "cell", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("g", F.lit(0)).alias("g"))
    gathered = full.agg(F.min("cell").alias("key"), F.sum("n").alias("n_all"), F.sum("g").alias("g_all"),
                        F.sort_array(F.collect_list(F.struct("cell", "n", "g"))).alias("cells"))

    def ratio(c: Column) -> Column:
        smooth = F.lit(ALPHA * BUCKETS)
        return (F.log((c["g"] + ALPHA) / (F.col("g_all") + smooth))
                - F.log((c["n"] + ALPHA) / (F.col("n_all") + smooth)))

    return gathered.select("key", F.transform("cells", ratio).alias("ratio"))


def _repeat_words(windows: Column, ranked: Column) -> Column:
    """Number of words inside three-word windows that occur twice or more."""
    def again(x: Column, j: Column) -> Column:
        same = (F.get(ranked, j - 1)["h"] == x["h"]) | (F.get(ranked, j + 1)["h"] == x["h"])
        return F.coalesce(same, F.lit(False))

    hit = F.transform(F.filter(ranked, again), lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2))
    return F.size(F.array_distinct(F.flatten(hit))).cast("long")


def judge(docs: DataFrame, model: DataFrame) -> DataFrame:
    """Base counts, score and verdict of every document."""
    d = docs.select("doc_id", C.whole_text("text").alias("text"))
    d = d.withColumn("words", C.words_of(F.col("text"))).withColumn("n_words", F.size("words").cast("long"))
    # an exact equi-join with the one model row: both keys are 0
    d = d.withColumn("zero", F.pmod(F.size("words"), F.lit(1))).join(F.broadcast(model), F.col("zero") == F.col("key"))
    three = F.when(F.col("n_words") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    total = F.aggregate(F.transform(_cells(F.col("words")), lambda c: F.get("ratio", c)), F.lit(0.0), lambda a, x: a + x)
    per_gram = F.when(F.col("n_words") > 0, total / (2 * F.col("n_words") - 1)).otherwise(0.0)
    d = d.select(
        "doc_id", "n_words", F.round(per_gram, 9).alias("score"),
        F.length(F.regexp_replace("text", C.SPACE_CLASS + "+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        lines.alias("lines"), F.coalesce(three, F.array().cast("array<bigint>")).alias("windows"))
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    ranked = F.sort_array(F.transform("windows", lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
    d = d.select(
        "doc_id", "n_words", "score", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "windows", F.when(repeated, ranked).alias("ranked"))
    d = d.withColumn("n_repeat_words", F.when(
        F.col("ranked").isNotNull(), _repeat_words(F.col("windows"), F.col("ranked"))).otherwise(F.lit(0).cast("long")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), (~failed & (F.col("score") >= MIN_SCORE)).alias("kept"), "score")


def trusted_ids(labels: DataFrame) -> DataFrame:
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")
    return labels.groupBy("doc_id").agg(F.min(F.coalesce(good, F.lit(0))).alias("good")).filter("good = 1").select("doc_id")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    model = fit(docs, trusted_ids(C.table(spark, sf_dir, "labels")))
    return judge(docs, C.materialize(model, "llr-model"))
