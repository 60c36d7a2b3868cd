"""Secret scans with an incremental blob ledger.

A document version is a blob, addressed by the SHA-256 of its whole text; a document is
a path that points to one.  The ledger remembers, by blob and rule version, what a scan
found.  ``scan`` therefore

1. addresses every version (paths are written once, without texts),
2. takes the (blob, rule version) pairs that the ledger does not hold yet,
3. scans one copy of each such blob, and appends its findings (possibly none) as a new
   ledger part,
4. joins the findings of all blobs back to every path.

A later run over a grown table scans only new blobs; a rule whose version changed is
scanned anew for all blobs, and no other rule is.

The ledger is a Parquet folder that only grows; it lives in shared storage, so a lost
executor costs only its running tasks.  One copy of a blob is chosen through its smallest
path, so copies never gather in one task.  Defined cases: a null text is the empty blob,
with no findings; very long texts are scanned whole; repeated rows and null ids each get a
result row; ties cannot matter, since equal blobs have equal findings; an empty table gives no
rows; other columns are ignored (``redact`` keeps them).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmetrics.session import scratch_path

from . import common as C

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: rule: (version, pattern, validity of a hit).  A changed rule gets a new version.
RULES: dict[str, tuple[int, str]] = {
    "assign": (1, ASSIGN),
    "access": (1, r"AKIA[A-Z0-9]{12,}+"),
    "hex": (1, r"[0-9a-f]{32,}+"),
    "github": (1, r"gh[pousr]_[A-Za-z0-9]{36,}+"),
    "pem": (1, r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    "jwt": (1, r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
}
BASE = ["assign", "access", "hex"]
#: Places and a hash of the hit: the ledger never holds a secret itself.
FINDING = "array<struct<start:int,ord:int,end:int,kind:string,hit_sha256:string>>"


def _valid(rule: str, hit: Column) -> Column:
    return F.length(F.regexp_extract(hit, ASSIGN, 1)) >= 8 if rule == "assign" else F.lit(True)


def findings_of(text: Column, rule: str) -> Column:
    """Findings of one rule in one text, in JVM functions."""
    pattern = RULES[rule][1]
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = C.match_spans(hits, text, pattern, rule, list(RULES).index(rule))
    return F.transform(F.filter(found, lambda s: _valid(rule, s["hit"])), lambda s: F.struct(
        *[s[k].alias(k) for k in ("start", "ord", "end", "kind")], F.sha2(s["hit"], 256).alias("hit_sha256")))


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    """What earlier scans left: (blob, rule, version, findings)."""
    schema = f"blob string, rule string, version int, findings {FINDING}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/ledger")
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.read.schema(schema).parquet(f"{folder}/ledger/*")
    return spark.createDataFrame([], schema)


def scan(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, blob, spans) of every row; scans what the ledger in ``folder`` lacks."""
    spark = docs.sparkSession
    versions = docs.select(F.col(id_col).alias("doc_id"), C.whole_text(text_col).alias("text"))
    versions = versions.withColumn("blob", F.sha2("text", 256))
    run = uuid.uuid4().hex[:12]
    versions.select("doc_id", "blob").write.parquet(f"{folder}/paths/{run}")
    paths = spark.read.schema("doc_id long, blob string").parquet(f"{folder}/paths/{run}")

    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(v).alias("version")) for r, (v, _) in RULES.items()])
    wanted = paths.groupBy("blob").agg(F.min("doc_id").alias("at"))
    known = _ledger(spark, folder).groupBy("blob").agg(F.collect_set(F.struct("rule", "version")).alias("known"))
    unseen = (wanted.join(known, "blob", "left")
              .withColumn("rules", F.array_except(rules, F.coalesce("known", F.array().cast("array<struct<rule:string,version:int>>"))))
              .filter(F.size("rules") > 0)
              .select(F.col("blob").alias("u_blob"), F.col("at").alias("u_at"), F.transform("rules", lambda r: r["rule"]).alias("rules")))
    # one copy of each blob: the row of its smallest path (by its address where all ids are null)
    one = (versions.join(unseen.hint("shuffle_hash"),
                         F.coalesce(F.col("doc_id").cast("string"), F.col("blob"))
                         == F.coalesce(F.col("u_at").cast("string"), F.col("u_blob")))
           .filter(F.col("blob") == F.col("u_blob")))

    def scanned(rule: str) -> Column:
        found = F.when(F.array_contains("rules", rule), findings_of(F.col("text"), rule))
        return F.struct(F.lit(rule).alias("rule"), F.lit(RULES[rule][0]).alias("version"), found.alias("findings"))

    fresh = (one.select("blob", F.explode(F.array(*[scanned(r) for r in RULES])).alias("x"))
             .select("blob", "x.*").filter(F.col("findings").isNotNull()))
    fresh.write.parquet(f"{folder}/ledger/{run}")

    current = F.array(*[F.concat_ws("@", F.lit(r), F.lit(v)) for r, (v, _) in RULES.items()])
    found = (_ledger(spark, folder)
             .filter((F.size("findings") > 0) & F.array_contains(current, F.concat_ws("@", "rule", "version")))
             .dropDuplicates(["blob", "rule", "version"])
             .groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("findings"))).alias("spans")))
    # written: broadcast if small, else Spark can split a blob of very many paths
    found = C.materialize(found, "blob-findings")
    return (paths.join(found, "blob", "left")
            .select("doc_id", "blob", F.coalesce("spans", F.array().cast(FINDING)).alias("spans")))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(C.table(spark, sf_dir, "documents"), scratch_path(spark, "blob-ledger"))
    base = F.filter("spans", lambda s: s["ord"] < len(BASE))
    return found.select(
        "doc_id", *[C.count_kind(F.col("spans"), k).alias(f"n_{k}") for k in RULES],
        F.sha2(C.joined(base), 256).alias("base_sha256"), C.joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, folder: str) -> DataFrame:
    """``docs`` with every secret replaced by its kind in brackets; all columns and rows stay."""
    spark = docs.sparkSession
    found = scan(docs, folder).filter(F.size("spans") > 0).select(F.col("blob").alias("_blob"), "spans").distinct()
    rows = docs.select(F.struct("*").alias("_d"), F.sha2(C.whole_text("text"), 256).alias("_b"))
    hit = rows.join(found, F.col("_b") == F.col("_blob"), "left")

    def step(acc: Column, s: Column) -> Column:
        # spans of two rules may overlap: text already passed is not written again
        gap = F.substring(F.col("_d.text"), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.when(s["start"] >= acc["at"], F.struct(
            s["end"].alias("at"), F.concat(acc["out"], gap, F.lit("["), s["kind"], F.lit("]")).alias("out"))).otherwise(
            F.struct(F.greatest(s["end"], acc["at"]).alias("at"), acc["out"].alias("out")))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.aggregate("spans", zero, step, lambda acc: F.concat(
        acc["out"], F.substring(F.col("_d.text"), acc["at"] + 1, F.length("_d.text"))))
    clean = F.when(F.col("spans").isNotNull(), text).otherwise(F.col("_d.text"))
    return hit.select(*[clean.alias(c) if c == "text" else F.col("_d").getField(c).alias(c) for c in docs.columns])


def _oracle() -> str:
    group2 = r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    kinds = [
        ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(?:[A-Za-z0-9+/_.=-]+)""",
         f"length(regexp_extract(m, '(?i:password|passwd|secret|token|api_?key){group2}', 1)) >= 8"),
        ("access", "AKIA[A-Z0-9]+", "length(m) >= 16"),
        ("hex", "[0-9a-f]+", "length(m) >= 32"),
        ("github", "gh[pousr]_[A-Za-z0-9]{36,}", "true"),
        ("pem", "-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", "true"),
        ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}", "true"),
    ]
    return C.span_oracle(kinds, BASE)


ORACLE = _oracle()
