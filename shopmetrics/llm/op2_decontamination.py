"""Benchmark decontamination: size-partitioned MinHash containment search.

A document is contaminated by a test item when it holds at least ``THRESHOLD`` of the
item's distinct five-word shingles, wherever they stand.

Items are partitioned by the power of two of their shingle count.  In a partition whose
largest item has u shingles, an item's sketch is its floor((1 - THRESHOLD) u) + 1 least
shingle hashes (bottom-k MinHash).  Any document that holds THRESHOLD of an item misses at
most that many less one of its shingles, so it holds a sketch value: probing the sketches
misses no contained item, whatever the document's length.  Candidates are then verified by
exact containment on the shingles' words.

A document is probed by its whole text.  Its shingles are first tested against a bitmap of
all item shingles (fixed size, broadcast as one row; a fuller bitmap costs time, not
results), so that only a few reach a shuffle.  Only DataFrame functions are used.

Words are the runs of non-space characters, A-Z lower-cased.  Defined cases: null or empty
items and documents match nothing; an item or document of one to four words has its whole
sequence as the one shingle; an empty benchmark finds nothing; items with equal text are
each reported; repeated rows are reported once; null ids are reported as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

SHINGLE = 5
PERCENT = 80


def _words(text: str) -> Column:
    return C.words_of(C.ascii_lower(C.whole_text(text)))


def _gram(words: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)])


def _starts(words: Column) -> Column:
    """Start of each shingle; a short non-empty text has one, at 0."""
    return (F.when(F.size(words) >= SHINGLE, F.sequence(F.lit(0), F.size(words) - SHINGLE))
            .when(F.size(words) > 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>")))


def _shingle(words: Column, i: Column) -> Column:
    # a short text's words are followed by nulls, which the hash skips: its length is mixed in
    h = F.when(F.size(words) >= SHINGLE, _gram(words, i)).otherwise(F.xxhash64(_gram(words, i), F.size(words)))
    return F.struct(h.alias("h"), F.array_join(F.slice(words, i + 1, F.lit(SHINGLE)), " ").alias("s"))


def item_shingles(items: DataFrame) -> DataFrame:
    """(item_id, size, grams) with size and sketch of every item that has a word."""
    words = items.select("item_id", _words("text").alias("words")).filter(F.size("words") > 0)
    grams = F.array_distinct(F.transform(_starts(F.col("words")), lambda i: _shingle(F.col("words"), i)))
    sized = words.select("item_id", (F.size("words") < SHINGLE).alias("short"), grams.alias("grams")).withColumn("size", F.size("grams"))
    upper = F.pow(F.lit(2.0), F.floor(F.log2("size")) + 1) - 1
    k = F.floor((100 - PERCENT) * upper / 100).cast("int") + 1
    hashes = F.sort_array(F.transform("grams", lambda g: g["h"]))
    return sized.withColumn("sketch", F.slice(hashes, F.lit(1), F.least(k, F.col("size"))))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(row_key, doc_id, item_id, n_shingles, n_found) of every contained item."""
    items = C.materialize(item_shingles(items), "items")
    bits = C.materialize(C.bitmap(items.select(F.explode("grams").alias("g")).select(F.col("g.h").alias("h")), "h"), "item-bits")
    rows = docs.select("doc_id", row_key().alias("row_key"), _words("text").alias("words"))
    rows = C.with_bitmap(rows, bits, F.size("words"))
    hit = F.filter(_starts(F.col("words")), lambda i: C.maybe_in(F.col("bits"), _shingle(F.col("words"), i)["h"]))
    rows = rows.select("doc_id", "row_key", "words", hit.alias("hit")).filter(F.size("hit") > 0)
    found = F.array_distinct(F.transform("hit", lambda i: _shingle(F.col("words"), i)))
    rows = C.materialize(rows.select("doc_id", "row_key", (F.size("words") < SHINGLE).alias("d_short"), found.alias("found"))
                         .dropDuplicates(["row_key"]), "item-hits")

    sketches = items.select("item_id", "short", F.explode("sketch").alias("h"))
    pairs = (rows.select("row_key", "d_short", F.explode("found").alias("f")).select("row_key", "d_short", F.col("f.h").alias("h"))
             .join(sketches, "h").filter(F.col("d_short") == F.col("short")).select("row_key", "item_id").distinct())
    full = items.select(F.col("item_id").alias("i_id"), "size", F.transform("grams", lambda g: g["s"]).alias("want"))
    held = rows.select(F.col("row_key").alias("r_key"), "doc_id", F.transform("found", lambda g: g["s"]).alias("have"))
    both = (pairs.join(held, F.col("row_key") == F.col("r_key"))
            .join(full, F.col("item_id").eqNullSafe(F.col("i_id"))))
    n_found = F.size(F.array_intersect("want", "have"))
    return (both.select("row_key", "doc_id", "item_id", F.col("size").cast("long").alias("n_shingles"), n_found.cast("long").alias("n_found"))
            .filter(100 * F.col("n_found") >= PERCENT * F.col("n_shingles")))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a test item; all columns stay."""
    bad = C.materialize(contaminated(docs, items).select(F.col("row_key").alias("bad_key")).distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("_d"), row_key().alias("_key"))
    return rows.join(bad, F.col("_key") == F.col("bad_key"), "left_anti").select("_d.*")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_found")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SHINGLE_SQL = f"""SELECT DISTINCT id, len(w) < 5 AS short, array_to_string(w[i:i + 4], ' ') AS s FROM (
  SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM (
    SELECT {{id}} AS id, list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {{table}})
  WHERE len(w) > 0)"""

ORACLE = f"""WITH d AS ({SHINGLE_SQL.format(id='doc_id', table='documents')}),
b AS ({SHINGLE_SQL.format(id='item_id', table='benchmark')}),
n AS (SELECT id, count(*) AS n FROM b GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, any_value(n.n) AS n_shingles, count(*) AS n_found
FROM d JOIN b USING (s, short) JOIN n ON n.id = b.id GROUP BY d.id, b.id HAVING 100 * count(*) >= 80 * any_value(n.n)"""
