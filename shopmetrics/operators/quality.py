"""Integrity rules of the reference DDL, re-aimed as audit jobs.

Parquet enforces no keys, so each rule is a Spark job that counts violating
rows.  Every table is scanned once per audit family: all domain rules of a
table are evaluated in one aggregation and unpivoted with ``stack``; key
checks are one ``groupBy(key)`` (partial aggregation absorbs hot keys);
foreign keys are ``left_anti`` joins on the key columns only.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmetrics.schema import FOREIGN_KEYS, MAX_LENGTHS, NOT_NULL, PRIMARY_KEYS

# Fixed values: (digits, decimals) of the NUMERIC columns; review scores lie in 1..5.
SCORE_RANGE = (1, 5)
NUMERIC_COLUMNS = {
    "dim_products": {"weight_g": (10, 2), "length_cm": (6, 2), "height_cm": (6, 2), "width_cm": (6, 2)},
    "fact_order_items": {"price": (10, 2), "freight_value": (10, 2)},
    "fact_payments": {"payment_value": (10, 2)},
}


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def audit_primary_keys(tables: dict[str, DataFrame], keys: dict[str, list[str]] | None = None) -> DataFrame:
    """Per table: rows, rows with a NULL in the key, key values seen more than
    once, and the surplus rows those duplicates add.

    ``keys`` names the key columns of each table (default: the star's
    primary keys).  A key of several columns is audited whole: it is NULL if
    any of its columns is, and repeated if all are."""
    parts = []
    for name, columns in (PRIMARY_KEYS if keys is None else keys).items():
        if name not in tables:
            continue
        n, null = F.col("_n"), reduce(or_, [F.col(f"_k{i}").isNull() for i in range(len(columns))])
        again = ~null & (n > 1)
        per_key = (tables[name].groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)])
                   .agg(F.count(F.lit(1)).alias("_n")))
        parts.append(per_key.agg(
            F.sum(n).cast("bigint").alias("rows"),
            F.sum(F.when(null, n).otherwise(0)).cast("bigint").alias("null_keys"),
            F.sum(F.when(again, 1).otherwise(0)).cast("bigint").alias("duplicate_keys"),
            F.sum(F.when(again, n - 1).otherwise(0)).cast("bigint").alias("duplicate_rows"),
        ).select(F.lit(name).alias("table_name"), F.lit(", ".join(columns)).alias("key_column"),
                 F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
                 F.coalesce("null_keys", F.lit(0)).cast("bigint").alias("null_keys"),
                 F.coalesce("duplicate_keys", F.lit(0)).cast("bigint").alias("duplicate_keys"),
                 F.coalesce("duplicate_rows", F.lit(0)).cast("bigint").alias("duplicate_rows")))
    return _union(parts)


def audit_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Per foreign key: child rows whose non-NULL key has no parent row."""
    parts = []
    for child, ccol, parent, pcol in FOREIGN_KEYS:
        if child not in tables or parent not in tables:
            continue
        c = tables[child].select(F.col(ccol).alias("_k"))
        p = tables[parent].select(F.col(pcol).alias("_k")).distinct()
        orphans = c.where(F.col("_k").isNotNull()).join(p, "_k", "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).cast("bigint").alias("orphan_rows")).select(
            F.lit(child).alias("child_table"), F.lit(ccol).alias("child_column"),
            F.lit(parent).alias("parent_table"), F.lit(pcol).alias("parent_column"), "orphan_rows"))
    return _union(parts)


def domain_rules(name: str) -> list[tuple[str, str, F.Column]]:
    """(column, rule, violation predicate) for one table."""
    rules = []
    for col in NOT_NULL.get(name, []):
        rules.append((col, "not_null", F.col(col).isNull()))
    for col, limit in MAX_LENGTHS.get(name, {}).items():
        rules.append((col, f"max_length_{limit}", F.length(col) > limit))
    if name == "fact_reviews":
        lo, hi = SCORE_RANGE
        rules.append(("review_score", f"between_{lo}_{hi}", ~F.col("review_score").between(lo, hi)))
    for col, (digits, decimals) in NUMERIC_COLUMNS.get(name, {}).items():
        rules.append((col, f"fits_numeric_{digits}_{decimals}", F.abs(F.col(col)) >= 10 ** (digits - decimals)))
    return rules


def audit_domains(tables: dict[str, DataFrame]) -> DataFrame:
    """Per (table, column, rule): violating rows.  One scan per table."""
    parts = []
    for name, df in tables.items():
        rules = domain_rules(name)
        if not rules:
            continue
        sums = df.agg(*[F.sum(F.when(pred, 1).otherwise(0)).cast("bigint").alias(f"r{i}")
                        for i, (_, _, pred) in enumerate(rules)])
        stack = "stack({n}, {body}) as (column_name, rule, violations)".format(
            n=len(rules),
            body=", ".join(f"'{c}', '{r}', coalesce(r{i}, 0L)" for i, (c, r, _) in enumerate(rules)))
        parts.append(sums.select(F.lit(name).alias("table_name"), F.expr(stack)))
    return _union(parts)
