"""Vector codes against exact Python integers."""

import hashlib

import numpy as np
import pytest

from shopmetrics.llm import op12_vector_codes as V
from tests.conftest import SF_SMALL


def brute(rows: list[tuple], parts: int = V.PARTS, entries: int = V.ENTRIES, rounds: int = V.ROUNDS) -> dict:
    kept = [(i, [int(np.floor(256 * float(x))) for x in v], lab) for i, v, lab in rows
            if v and all(x is not None and np.isfinite(x) for x in v)]
    d = len(kept[0][1]) // parts
    cut = {i: [v[p * d:(p + 1) * d] for p in range(parts)] for i, v, _ in kept}
    first = sorted(cut)[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        held: dict = {}
        for i in cut:
            for p in range(parts):
                held.setdefault((p, near(p, cut[i][p])[1]), []).append(cut[i][p])
        for (p, e), xs in held.items():
            books[p][e] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    code = {i: [near(p, cut[i][p]) for p in range(parts)] for i in cut}
    error = {i: sum(x for x, _ in code[i]) for i in code}
    label = {i: lab for i, _, lab in kept}
    return {i: ("".join(f"{e:02x}" for _, e in code[i]), error[i], sum(error[j] for j in error if label[j] == label[i]), sha) for i in code}


def run(spark, tmp_dir, rows, schema="vec_id long, embedding array<double>, label int"):
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/embeddings.parquet")
    got = V.op12_vector_codes(spark, tmp_dir).collect()
    return {r["vec_id"]: (r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got}


@pytest.mark.parametrize("scale", [1.0, 1e-3, 40_000.0])
def test_equals_exact_integers(spark, tmp_dir, scale):
    rng = np.random.default_rng(5)
    rows = [(int(i), (rng.normal(size=48) * scale).tolist(), int(i % 3) if i % 7 else None) for i in rng.permutation(200)]
    rows += [(900, None, 1), (901, [], 1), (902, [None] + [0.0] * 47, 1), (903, [float("nan")] + [0.0] * 47, 1),
             (904, [float("-inf")] + [0.0] * 47, None), (905, rows[0][1], 1), (906, rows[0][1], None)]
    assert run(spark, tmp_dir, rows) == brute(rows)


def test_whole_table_equals_exact_integers(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = V.op12_vector_codes(spark, SF_SMALL).collect()
    assert {r["vec_id"]: (r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got} == brute(rows)


def test_few_rows_repeated_rows_and_clashing_columns(spark, tmp_dir):
    rows = [(1, [0.5] * 16, 1, 9, 9, 9), (1, [0.5] * 16, 1, 9, 9, 9), (None, [1.0] * 16, None, 9, 9, 9)]
    got = run(spark, tmp_dir, rows, "vec_id long, embedding array<float>, label int, id int, vector int, error int")
    assert got[1][:3] == ("00" * 16, 0, 0) and got[None][0] == "02" * 16


def test_empty_and_dropped_only(spark, tmp_dir):
    assert run(spark, tmp_dir, [(1, None, 2)]) == {}
    assert V.encode(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))[0].count() == 0


def test_unequal_lengths_are_named(spark, tmp_dir):
    with pytest.raises(Exception, match="components in one table"):
        run(spark, tmp_dir, [(1, [0.0] * 16, 1), (2, [0.0] * 32, 1)])


@pytest.mark.parametrize("bits", [5, 24, 30])
def test_limb_products_are_exact(bits):
    rng = np.random.default_rng(bits)
    a, b = (rng.integers(-(1 << bits), 1 << bits, size=s) for s in ((3, 50, 4), (3, 4, 7)))
    a[0, 0], b[0, :, 0] = -(1 << bits), (1 << bits) - 1
    want = np.einsum("pnd,pdk->pnk", a.astype(object), b.astype(object))
    assert (V.exact_matmul(a, b) == want).all()
    bits_used = (V.EXACT_BITS - 1 - 2) // 2
    assert all(np.abs(x).max() < 2 ** bits_used for x in V.limbs(a, bits_used))
