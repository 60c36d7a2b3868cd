"""Repeated strings, Jaccard components and containment against brute force."""

import random

from shopmetrics.llm import op2_decontamination as op2
from shopmetrics.llm import op4_suffix_dedup as op4
from shopmetrics.llm import op8_jaccard_join as op8

SCHEMA = "doc_id long, text string, lang string, source string, rid long"


def fixture(seed=5):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = text(110)
    rows = [None, "", "  ", "one two", "ONE two", "x" * 1500, text(60)]
    for _ in range(12):
        rows.append(text(r.randint(5, 80)) + " " + shared + " " + text(r.randint(5, 80)))
    base = text(150).split()
    for _ in range(15):
        w = list(base)
        for _ in range(r.randint(0, 9)):
            w[r.randrange(len(w))] = word()
        rows.append(" ".join(w))
    rows += [rows[8]] * 3 + [rows[-1].upper()]
    return [(i, t, None, None, 1) for i, t in enumerate(rows)] + [(7, rows[7], None, None, 1)]


def brute_removed(texts, w=400):
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for b in raws:
        for p in range(len(b) - w + 1):
            seen[b[p:p + w]] = seen.get(b[p:p + w], 0) + 1
    out = []
    for b in raws:
        mark = bytearray(len(b))
        for p in range(len(b) - w + 1):
            if seen[b[p:p + w]] > 1:
                mark[p:p + w] = b"\1" * w
        out.append(bytes(c for c, m in zip(b, mark) if not m))
    return out


def test_suffix_dedup(spark):
    rows = fixture()
    docs = spark.createDataFrame(rows, SCHEMA)
    want = sorted((i, k) for (i, *_), k in zip(rows, brute_removed([t for _, t, *_ in rows])))
    for hot in (4096, 2):
        got = op4.remove_repeats(docs, hot).collect()
        assert sorted((r["doc_id"], bytes(r["kept"])) for r in got) == want
    assert op4.remove_repeats(docs.limit(0)).count() == 0


def test_merge_runs_is_a_merge():
    r = random.Random(1)
    runs = [sorted(bytes(r.choice(b"ab") for _ in range(r.randint(1, 12))) for _ in range(n)) for n in (5, 0, 9, 1, 30)]
    coded = [op4.decode_run(op4.encode_run([(k, (0, 0, 0, 0, False)) for k in run])) for run in runs]
    out = list(op4.merge_runs(coded))
    assert [k for k, _, _ in out] == sorted(k for run in runs for k in run)
    assert all(p == op4.shared_prefix(a, b) for (a, _, _), (b, p, _) in zip(out, out[1:]))


def shingles(t):
    w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split()]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_jaccard_components(spark):
    rows = fixture()
    sets = {i: shingles(t) for i, t, *_ in rows}
    comp = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    got = op8.linked_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == {(i, len(sets[i]), comp[i]) for i in sets}
    empty = spark.createDataFrame([], SCHEMA)
    assert op8.linked_components(empty).count() == 0


def test_containment(spark):
    r = random.Random(3)
    text = lambda n: " ".join(str(r.randrange(10**6)) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate((3, 5, 14, 40, 59))] + [(8, None), (9, "")]
    rows = [(0, None), (1, ""), (2, items[0][1]), (3, "pre " + items[0][1])]
    for i, t in items[1:5]:
        w = t.split()
        cut = w[:max(5, int(len(w) * 0.9))]
        rows += [(10 + i, text(300) + " " + t + " " + text(3000)), (20 + i, " ".join(cut)), (30 + i, " ".join(w[:len(w) // 2]))]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA)
    got = {(x["doc_id"], x["item_id"]) for x in op2.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {(d, i) for d, t in rows for i, q in items if shingles(q) and len(shingles(t) & shingles(q)) >= 0.8 * len(shingles(q))}
    assert got == want
    assert op2.contaminated(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_jaccard_counts_all_links(spark, monkeypatch):
    rows = fixture()
    # a family of mutually linked texts: far more links than connect it
    base = [f"w{i}" for i in range(200)]
    rows += [(500 + i, " ".join([*base[:i], f"x{i}", *base[i + 1:]]), None, None, 1) for i in range(0, 200, 9)]
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    want = sorted((i, sum(1 for y, (_, b) in enumerate(sets) if x != y and a and b and 100 * len(a & b) >= 80 * len(a | b)))
                  for x, (i, a) in enumerate(sets))
    docs = spark.createDataFrame(rows, SCHEMA)
    for size in (op8.BLOCK_SETS, 3):
        monkeypatch.setattr(op8, "BLOCK_SETS", size)
        monkeypatch.setattr(op8, "COLUMNS", 2 * size)
        assert sorted((r["doc_id"], r["n_links"]) for r in op8.linked_components(docs).collect()) == want


def test_keep_one_decides_by_row(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(3, a), (3, a), (5, a), (None, a), (None, b), (None, b), (1, c), (7, c), (7, d), (9, ""), (9, "")]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA)
    got = [(r["doc_id"], r["text"]) for r in op8.keep_one(docs).collect()]
    assert sorted(got, key=str) == sorted([(3, a), (None, b), (1, c), (7, d), (9, ""), (9, "")], key=str)
