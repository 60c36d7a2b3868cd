"""Column expressions and small helpers shared by the document operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmetrics.session import scratch_path

#: Word separators of every operator: space and the ASCII controls tab..carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str | Column) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the maximal runs of non-space characters."""
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage through a Parquet table in the shared scratch folder.

    The files are on storage that every executor reads, so a lost executor costs
    only its running tasks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def match_spans(matches: Column, text: Column, pattern: str, kind: str, order: int) -> Column:
    """Code-point spans of ``matches`` (all leftmost non-overlapping hits of ``pattern``).

    The text between the hits is what ``split`` returns, so running lengths of gaps and
    hits give every position without leaving the JVM.
    """
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(
        "array<struct<start:int,ord:int,end:int,kind:string,hit:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        one = F.struct(start.alias("start"), F.lit(order).alias("ord"), end.alias("end"),
                       F.lit(kind).alias("kind"), x["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
    pairs = F.zip_with(gaps, matches, lambda g, m: F.struct(g.alias("gap"), m.alias("hit")))
    found = F.aggregate(pairs, zero, step, lambda acc: acc["out"])
    return F.when(F.size(matches) > 0, found).otherwise(zero["out"])


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def span_oracle(kinds: list[tuple[str, str, str]], base: list[str], tail: str = "", extra_where: dict[str, str] | None = None) -> str:
    """DuckDB SQL for a span query: ``kinds`` lists (kind, RE2 pattern, condition on hit ``m``).

    ``extra_where`` adds, by kind, a condition that may also use ``before`` (the 48 code
    points ahead of the hit).
    """
    parts, unions = [], []
    for order, (kind, pattern, keep) in enumerate(kinds):
        p = pattern.replace("'", "''")
        parts.append(f"""
h{order} AS (SELECT doc_id, t, regexp_extract_all(t, '{p}') AS ms, string_split_regex(t, '{p}') AS gs FROM d),
i{order} AS (SELECT doc_id, t, ms, gs, unnest(range(1, len(ms) + 1)) AS i FROM h{order}),
p{order} AS (SELECT doc_id, t, ms[i] AS m,
    CAST(list_sum(list_transform(gs[1:i], lambda x: length(x)))
       + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s FROM i{order}),
b{order} AS (SELECT doc_id, m, s, lower(substr(t, greatest(s - 48, 0) + 1, least(s, 48))) AS before FROM p{order}),
s{order} AS (SELECT doc_id, '{kind}' AS kind, {order} AS ord, s, s + length(m) AS e, before FROM b{order}
    WHERE ({keep}) AND ({(extra_where or {}).get(kind, 'true')}))""")
        unions.append(f"SELECT * FROM s{order}")
    is_base = "kind IN (" + ", ".join(f"'{k}'" for k in base) + ")"
    counts = ",\n  ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k, _, _ in kinds)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), {','.join(parts)},
spans AS ({' UNION ALL '.join(unions)})
SELECT d.doc_id,
  {counts},
  sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) FILTER (WHERE {is_base}), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) FILTER (WHERE kind IS NOT NULL), '') AS spans{tail}
FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id"""


#: Bits of a key bitmap: 512 KB broadcast at any input size.
BITMAP_BITS = 1 << 22


def bitmap(keys: DataFrame, key: str) -> DataFrame:
    """One row: ``b_zero`` (0) and ``bits``, a bitmap of 64-bit ``key`` values.

    It answers "maybe in" without false negatives, in a fixed size.  A fuller bitmap only
    lets more rows through to the exact join behind it.
    """
    cells = []
    for spot in _spots(F.col(key)):
        cells.append(F.struct(F.shiftright(spot, 6).cast("int").alias("cell"),
                              F.call_function("shiftleft", F.lit(1).cast("long"), spot.bitwiseAND(63).cast("int")).alias("bit")))
    set_bits = keys.select(F.explode(F.array(*cells)).alias("x")).groupBy("x.cell").agg(F.bit_or("x.bit").alias("bit"))
    every = keys.sparkSession.range(BITMAP_BITS // 64).select(F.col("id").cast("int").alias("at"))
    return (every.join(set_bits, F.col("at") == F.col("cell"), "left")
            .agg(F.min("at").alias("b_zero"),
                 F.sort_array(F.collect_list(F.struct("at", F.coalesce("bit", F.lit(0).cast("long")).alias("bit")))).alias("x"))
            .select("b_zero", F.col("x.bit").alias("bits")))


def _spots(key: Column) -> list[Column]:
    return [key.bitwiseAND(BITMAP_BITS - 1), F.shiftrightunsigned(key, 40).bitwiseAND(BITMAP_BITS - 1)]


def maybe_in(bits: Column, key: Column) -> Column:
    def on(spot: Column) -> Column:
        cell = F.get(bits, F.shiftright(spot, 6).cast("int"))
        return F.call_function("shiftright", cell, spot.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1

    return all_of([on(s) for s in _spots(key)])


def with_bitmap(rows: DataFrame, bits: DataFrame, count: Column) -> DataFrame:
    """``rows`` with the bitmap's ``bits``: an equi-join with its one row on 0.

    ``count`` is any integer column of ``rows``; its remainder by 1 is the key.
    """
    return rows.join(F.broadcast(bits), F.pmod(count, F.lit(1)) == F.col("b_zero")).drop("b_zero")


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) of every id in ``edges`` (a, b): comp is the least id of its component.

    Each round takes the least label among a vertex and its neighbours (a pre-aggregated
    minimum, so a hub does not gather its edges) and then the label's own label, which
    halves paths.  Rounds end when no label falls.
    """
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("comp")), "cc-labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("comp").alias("m")))
        step = labels.join(near, F.col("id") == F.col("a")).select("id", "comp", F.least("comp", "m").alias("new"))
        up = labels.select(F.col("id").alias("u_id"), F.col("comp").alias("u_comp"))
        step = step.join(up, F.col("new") == F.col("u_id"), "left").select(
            "id", F.least("new", "u_comp").alias("comp"), (F.least("new", "u_comp") < F.col("comp")).alias("fell"))
        step = materialize(step, "cc-labels")
        labels = step.select("id", "comp")
        if not step.filter("fell").limit(1).count():
            return labels
