"""Global ranks and the three bucketing semantics.

``F.ntile`` / ``row_number`` over an un-partitioned window plans an
``Exchange SinglePartition``: every customer in one task.  ``global_rank``
gives the same exact ranks with the work spread over all executors:

1. ``repartitionByRange`` on the full sort key plus a unique tie-break id
   (the id splits even a single hot key value across partitions);
2. sort within partitions and tag each row with its partition id and its
   position (``monotonically_increasing_id`` keeps the in-partition row
   index in its low 33 bits);
3. ``checkpoint()`` to the shared ``spark.checkpoint.dir`` so the range
   bounds (sampled at random) are fixed and a lost executor recomputes
   nothing upstream;
4. count rows per partition (one small aggregate of at most
   ``num_partitions`` rows), turn the counts into prefix offsets, and add
   the offset of each row's partition to its in-partition index.

No row ever passes through the driver; the driver only sees one count per
partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmetrics.operators.selection import Order, linear_quantiles, rows_at
from shopmetrics.session import ensure_checkpoint_dir

_PID, _POS = "_rank_pid", "_rank_pos"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def global_rank(df: DataFrame, order: list, rank_col: str = "rank",
                num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """Dense 1..n position of each row in the total order ``order``.

    ``order`` must end with a unique column (the tie-break); it is a list of
    Columns (use ``F.desc`` for descending keys).  Returns the ranked frame
    (checkpointed) and n."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order_cols = [_as_col(c) for c in order]
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(parts, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_POS, F.monotonically_increasing_id())
              .checkpoint(eager=True))
    counts = {r[0]: r[1] for r in tagged.groupBy(_PID).count().collect()}
    offsets, running = [], 0
    for p in range(max(counts, default=-1) + 1):
        offsets.append(running)
        running += counts.get(p, 0)
    if not offsets:
        return tagged.withColumn(rank_col, F.lit(None).cast("bigint")).drop(_PID, _POS), 0
    offset = F.element_at(F.array(*[F.lit(o).cast("bigint") for o in offsets]), F.col(_PID) + 1)
    in_part = F.col(_POS) - F.shiftleft(F.col(_PID).cast("bigint"), 33)
    ranked = tagged.withColumn(rank_col, offset + in_part + 1).drop(_PID, _POS)
    return ranked, running


def ntile_from_rank(rank, n: int, k: int) -> Column:
    """SQL ``NTILE(k)``: the first ``n mod k`` buckets hold one extra row."""
    r = _as_col(rank)
    if n <= 0:
        return F.lit(None).cast("int")
    base, rem = divmod(n, k)
    big = rem * (base + 1)
    if base == 0:  # fewer rows than buckets: one row per bucket
        return r.cast("int")
    return F.when(r <= big, F.floor((r - 1) / (base + 1)) + 1) \
        .otherwise(F.floor((r - 1 - big) / base) + rem + 1).cast("int")


def ntile(df: DataFrame, order: list, k: int, out_col: str) -> DataFrame:
    """Distributed ``NTILE(k) OVER (ORDER BY order)`` (K1)."""
    ranked, n = global_rank(df, order, rank_col="_ntile_rank")
    return ranked.withColumn(out_col, ntile_from_rank("_ntile_rank", n, k)).drop("_ntile_rank")


def qcut_rank_from_rank(rank, n: int, k: int) -> Column:
    """pandas ``qcut(series.rank(method="first"), k)`` bucket (1-based, K2):
    ``max(1, ceil(k * (rank - 1) / (n - 1)))``, in exact integer arithmetic."""
    r = _as_col(rank).cast("bigint")
    if n <= 1:
        return F.lit(1)
    return F.greatest(F.lit(1), F.floor((F.lit(k) * (r - 1) + (n - 2)) / F.lit(n - 1))).cast("int")


def qcut_rank(df: DataFrame, order: list, k: int, out_col: str) -> DataFrame:
    ranked, n = global_rank(df, order, rank_col="_qcut_rank")
    return ranked.withColumn(out_col, qcut_rank_from_rank("_qcut_rank", n, k)).drop("_qcut_rank")


def exact_percentiles(df: DataFrame, col: str, probs: list[float]) -> list[float | None]:
    """Exact linear-interpolated quantiles (numpy default / ``quantile_cont``) of any column: found by
    ``selection``, from sketches and exact counts over the column, written once for its rounds."""
    ensure_checkpoint_dir(df.sparkSession)
    return linear_quantiles(df.select(col).checkpoint(), {col: probs})[col]


def bucket_of(order: Order, starts: list[tuple]) -> Column:
    """Bucket of a row, given the first row of every bucket but the first, as (value, id)."""
    expr = None
    for bucket, (value, id_) in enumerate(starts, start=1):
        before = precedes(order.keys(), {order.value: value, order.id: id_})
        expr = F.when(before, bucket) if expr is None else expr.when(before, bucket)
    return (F.lit(1) if expr is None else expr.otherwise(len(starts) + 1)).cast("int")


def buckets(df: DataFrame, wanted: dict[str, tuple[Order, object]]) -> DataFrame:
    """Several bucketings of one frame (K1, K2) without a sort: the bucket boundaries of all orders
    are searched together (``selection.rows_at``), then one projection compares each row with them.

    ``wanted``: output column -> (order, first ranks of the buckets: ``ntile_starts(k)`` or
    ``qcut_starts(k)``).  ``df`` should be materialised: each round of the search reads it."""
    starts, _ = rows_at(df, wanted)
    return df.withColumns({name: bucket_of(order, starts[name]) for name, (order, _) in wanted.items()})


def qcut_values_expr(value, edges: list[float], labels: list) -> Column:
    """pandas ``qcut`` binning on given edges: right-closed bins, lowest edge
    included.  Raises ``ValueError`` on duplicate edges, as pandas does."""
    if any(e is None for e in edges):
        raise ValueError("qcut edges are undefined on an empty column")
    if len(set(edges)) != len(edges):
        raise ValueError(f"Bin edges must be unique: {edges!r}")
    v = _as_col(value).cast("double")
    expr = None
    for j in range(1, len(edges)):
        cond = v <= F.lit(float(edges[j]))
        if j == 1:
            cond = cond & (v >= F.lit(float(edges[0])))
        expr = F.when(cond, F.lit(labels[j - 1])) if expr is None else expr.when(cond, F.lit(labels[j - 1]))
    return expr


def qcut_values(df: DataFrame, col: str, k: int, labels: list, out_col: str) -> DataFrame:
    """pandas ``qcut(df[col], q=k, labels=labels)`` (K3), exact edges."""
    probs = [j / k for j in range(k + 1)]
    edges = exact_percentiles(df, col, probs)
    return df.withColumn(out_col, qcut_values_expr(col, edges, labels))


def cut_fixed_expr(value, edges: list[float], labels: list, lowest_label=None) -> Column:
    """pandas ``cut`` on fixed edges (right-closed).  Values at the lowest
    edge get ``lowest_label`` (pandas gives NaN)."""
    v = _as_col(value)
    expr = F.when(v == F.lit(edges[0]), F.lit(lowest_label)) if lowest_label is not None else None
    for j in range(1, len(edges)):
        cond = (v > F.lit(edges[j - 1])) & (v <= F.lit(edges[j]))
        expr = F.when(cond, F.lit(labels[j - 1])) if expr is None else expr.when(cond, F.lit(labels[j - 1]))
    return expr


def _before(key: str, value, ascending: bool, nulls_first: bool) -> Column:
    """Rows whose ``key`` sorts strictly before ``value`` in this direction."""
    x = F.col(key)
    if value is None:
        return F.lit(False) if nulls_first else x.isNotNull()
    cmp = x < F.lit(value) if ascending else x > F.lit(value)
    return (x.isNull() | cmp) if nulls_first else (x.isNotNull() & cmp)


def _same(key: str, value) -> Column:
    return F.col(key).isNull() if value is None else (F.col(key) == F.lit(value))


def precedes(order: list[tuple[str, bool, bool]], values: dict) -> Column:
    """Rows strictly before ``values`` in the lexicographic ``order``
    [(column, ascending, nulls_first), ...] (last column unique)."""
    expr = None
    for key, asc, nf in reversed(order):
        here = _before(key, values[key], asc, nf)
        expr = here if expr is None else (here | (_same(key, values[key]) & expr))
    return expr


def ranks_of_rows(df: DataFrame, orders: dict[str, list[tuple[str, bool, bool]]],
                  rows: list[dict]) -> tuple[list[dict], int]:
    """Exact 1-based rank of a few given rows under several total orders,
    in one aggregation pass with no sort and no range shuffle.

    Per order the k target rows are sorted; every row of ``df`` finds the
    first target it sorts before (a short-circuit CASE over k predicates),
    and ``groupBy(order, slot).count()`` yields a (k+1)-bucket histogram
    whose prefix sums are the targets' ranks.  For top-k reports, where only
    k rows need their global position."""
    import functools
    slots, sorted_idx = [], {}
    for name, order in orders.items():
        idx = sorted(range(len(rows)),
                     key=functools.cmp_to_key(lambda a, b, o=order: _cmp_rows(o, rows[a], rows[b])))
        sorted_idx[name] = idx
        case = None
        for pos, i in enumerate(idx):
            cond = precedes(order, rows[i])
            case = F.when(cond, F.lit(pos)) if case is None else case.when(cond, F.lit(pos))
        slots.append(F.struct(F.lit(name).alias("o"), case.otherwise(F.lit(len(rows))).alias("s")))
    hist = (df.select(F.explode(F.array(*slots)).alias("x"))
            .groupBy(F.col("x.o").alias("o"), F.col("x.s").alias("s")).count().collect())
    counts = {(r["o"], r["s"]): r["count"] for r in hist}
    n = sum(c for (o, _), c in counts.items() if o == next(iter(orders)))
    ranks = [dict() for _ in rows]
    for name in orders:
        # rows in slots <= pos sort before the target at sorted position pos
        # (a target never precedes itself, so it is not counted)
        before = 0
        for pos, i in enumerate(sorted_idx[name]):
            before += counts.get((name, pos), 0)
            ranks[i][name] = before + 1
    return ranks, n


def _cmp_rows(order, a, b):
    for col, asc, nulls_first in order:
        x, y = a[col], b[col]
        if x == y:
            continue
        if x is None or y is None:
            first_is_null = x is None
            return -1 if first_is_null == nulls_first else 1
        lt = x < y if asc else x > y
        return -1 if lt else 1
    return 0


def ntile_of_rank(rank: int, n: int, k: int) -> int:
    """NTILE(k) bucket of a 1-based rank among n rows (Python twin of
    :func:`ntile_from_rank`)."""
    base, rem = divmod(n, k)
    if base == 0:
        return rank
    big = rem * (base + 1)
    return (rank - 1) // (base + 1) + 1 if rank <= big else (rank - 1 - big) // base + rem + 1
