"""Product codes of vectors with exact integer arithmetic (limb-split GEMM).

Every component x becomes the integer floor(256 * x); vectors are cut into ``PARTS`` equal
consecutive parts, and each part position has a codebook of at most ``ENTRIES`` entries.
The nearest entry of a part is the first argmin of ``|c|^2 - 2 x.c``.  The dot products are
exact: both factors are split into limbs so narrow that every sum of limb products stays
below 2^53, where float64 BLAS adds integers without rounding; the limb products are then
shifted and summed in int64.

The codebooks start as the parts of the ``ENTRIES`` smallest kept ids and are refined by
``ROUNDS`` passes: each task adds up its rows by (part, entry), Spark sums these partial sums,
and the driver sees one number for each codebook component.  Codebooks are the only thing
broadcast: PARTS * ENTRIES entries whatever the input.  A last pass writes codes and errors,
from which errors are summed by label; a label with a third of the rows is one partial sum a
task, and the join back is to one row a label, which Spark may split.

Defined cases: null and empty vectors and those with a null or non-finite component are
dropped; fewer kept rows than ``ENTRIES`` give as many entries; repeated rows count as rows;
a null id sorts last; equal ids are ordered by their vectors; null labels are one label; an
empty table gives no rows; other columns are ignored; a kept vector whose length differs from
the first one's, or is no multiple of ``PARTS``, or with components so large that a distance
might leave the range of a long, is an error that names it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256.0
#: Rows compared at once: PARTS * ENTRIES distances of 8 bytes for each.
CHUNK = 1024
#: float64 holds integers exactly up to this many bits.
EXACT_BITS = 53


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """``values`` (int64) as float64 limbs of ``bits`` bits, lowest first; the last one has the sign."""
    out, rest = [], values
    while True:
        if -(1 << bits) < rest.min(initial=0) and rest.max(initial=0) < (1 << bits):
            return [*out, rest.astype(np.float64)]
        out.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits


def exact_matmul(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 arrays (stacks of matrices), exact if it fits int64."""
    inner = a.shape[-1]
    bits = (EXACT_BITS - 1 - max(inner - 1, 0).bit_length()) // 2
    total = np.zeros(np.broadcast_shapes(a.shape[:-2], b.shape[:-2]) + (a.shape[-2], b.shape[-1]), dtype=np.int64)
    b_limbs = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(b_limbs):
            total += np.matmul(x, y).astype(np.int64) << ((i + j) * bits)
    return total


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of parts ``x`` (parts, n, d) in ``books`` (parts, entries, d)."""
    dots = exact_matmul(x, books.transpose(0, 2, 1))
    gain = (books * books).sum(axis=2)[:, None, :] - 2 * dots
    best = gain.argmin(axis=2)
    least = np.take_along_axis(gain, best[:, :, None], axis=2)[:, :, 0]
    return best, least + (x * x).sum(axis=2)


def to_integers(batch: pa.ListArray, dim: int) -> np.ndarray:
    """(PARTS, n, dim / PARTS) int64 of a column of kept vectors."""
    sizes = np.asarray(batch.value_lengths())
    if (sizes != dim).any():
        raise ValueError(f"vectors of {dim} and of {sizes[sizes != dim][0]} components in one table")
    scaled = np.floor(np.asarray(batch.flatten()).astype(np.float64) * SCALE)
    # (2 m)^2 * dim < 2^63 bounds a vector's whole error
    if scaled.size and np.abs(scaled).max() >= np.sqrt(2.0 ** 61 / dim):
        raise ValueError("components too large: squared distances may leave the range of a long")
    return scaled.astype(np.int64).reshape(len(batch), PARTS, dim // PARTS).transpose(1, 0, 2)


def is_kept(vector: Column) -> Column:
    # NaN sorts above infinity, so one comparison excludes both
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def _partial_sums(books: np.ndarray, dim: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, dtype=np.int64), np.zeros(books.shape[:2], dtype=np.int64)
        part = np.arange(PARTS)[:, None]
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                x = to_integers(b.column("vector").slice(at, CHUNK), dim)
                entry, _ = nearest(x, books)
                np.add.at(sums, (part, entry), x)
                np.add.at(counts, (part, entry), 1)
        p, e = np.nonzero(counts)
        pos = np.arange(books.shape[2])
        yield pa.RecordBatch.from_pydict({
            "part": np.repeat(p, len(pos)).astype(np.int32), "entry": np.repeat(e, len(pos)).astype(np.int32),
            "pos": np.tile(pos, len(p)).astype(np.int32), "total": sums[p, e].ravel(), "n": np.repeat(counts[p, e], len(pos))})
    return add


def fit(kept: DataFrame) -> np.ndarray | None:
    """Codebooks (parts, entries, d) of the kept (id, vector) rows; None without rows."""
    first = kept.orderBy(F.asc_nulls_last("id"), "vector").limit(ENTRIES).toArrow()
    if not first.num_rows:
        return None
    vectors = pa.array(first.column("vector").combine_chunks())
    dim = len(vectors[0])
    if dim % PARTS:
        raise ValueError(f"vectors of {dim} components cannot be cut into {PARTS} equal parts")
    books = to_integers(vectors, dim).copy()
    for _ in range(ROUNDS):
        partial = kept.select("vector").mapInArrow(_partial_sums(books, dim), "part int, entry int, pos int, total long, n long")
        sums = partial.groupBy("part", "entry", "pos").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        # PARTS * ENTRIES * d rows at any size of the input
        for r in sums.collect():
            books[r.part, r.entry, r.pos] = int(r.total) // r.n
    return books


def _encode(books: np.ndarray, dim: int):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                rows = b.slice(at, CHUNK)
                entry, distance = nearest(to_integers(rows.column("vector"), dim), books)
                texts = [row.tobytes().hex() for row in np.ascontiguousarray(entry.T).astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("label"), pa.array(texts, pa.string()), pa.array(distance.sum(axis=0))],
                    names=["id", "label", "code", "error"])
    return code


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray | None]:
    """((id, label, code, error) of every kept row, codebooks)."""
    kept = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label")).filter(is_kept(F.col("vector")))
    books = fit(kept)
    types = {f.name: f.dataType.simpleString() for f in kept.schema}
    schema = f"id {types['id']}, label {types['label']}, code string, error long"
    if books is None:
        return rows.sparkSession.createDataFrame([], schema), None
    return kept.mapInArrow(_encode(books, PARTS * books.shape[2]), schema), books


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = encode(C.table(spark, sf_dir, "embeddings"))
    coded = C.materialize(coded, "vector-codes")
    totals = coded.groupBy(F.col("label").alias("t_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("t_label"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(digest(books) if books is not None else None).cast("string").alias("codebooks_sha256"))


def _oracle() -> str:
    steps = [f"""WITH kept AS (
  SELECT vec_id, label, embedding AS v FROM embeddings
  WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
comps AS (
  SELECT vec_id, label, i - 1 AS i, (i - 1) // (len(v) // {PARTS}) AS part, (i - 1) % (len(v) // {PARTS}) AS pos,
         CAST(floor({int(SCALE)} * CAST(v[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM kept)),
firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {ENTRIES}),
book0 AS (SELECT part, entry, pos, x AS c FROM comps JOIN firsts USING (vec_id))"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""d{i} AS (SELECT vec_id, part, entry, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d
  FROM comps JOIN book{i} USING (part, pos) GROUP BY vec_id, part, entry),
a{i} AS (SELECT vec_id, part, entry, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1)""")
        if i < ROUNDS:
            steps.append(f"""mean{i} AS (SELECT part, entry, pos, sum(x) AS s, count(*) AS n FROM comps JOIN a{i} USING (vec_id, part) GROUP BY part, entry, pos),
book{i + 1} AS (SELECT part, entry, pos,
    CASE WHEN n IS NULL THEN c ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS c
  FROM book{i} LEFT JOIN mean{i} USING (part, entry, pos))""")
    steps.append(f"""coded AS (SELECT vec_id, string_agg(lpad(lower(hex(entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY vec_id),
whole AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS s FROM book{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s AS codebooks_sha256
FROM coded JOIN kept USING (vec_id), whole""")
    return ",\n".join(steps)


ORACLE = _oracle()
