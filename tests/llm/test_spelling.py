"""Spelling variants against brute force, and the search's parts."""

import zlib
from collections import Counter

import numpy as np
import pytest

from shopmetrics.llm import op11_spelling as S
from tests.conftest import SF_SMALL

RUN_SCHEMA = "doc_id long, text string, word string, n long, length int"


def edits_one(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(docs: list[tuple]) -> dict[str, tuple]:
    import re
    count: Counter = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    near = {w: [x for x in words if edits_one(w, x)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def as_dict(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def texts(rng) -> list[tuple]:
    base = ["".join(rng.choice(list("abcdeéÀ"), size=rng.integers(6, 10))) for _ in range(60)]
    docs = []
    for i in range(300):
        words = []
        for w in rng.choice(base, size=30, p=np.arange(1, 61) ** 3 / (np.arange(1, 61) ** 3).sum()):
            if rng.random() < 0.2:
                at = int(rng.integers(0, len(w)))
                w = w[:at] + rng.choice(["", "a", "é"]) + w[at + int(rng.integers(0, 2)):]
            words.append(str(w).upper() if rng.random() < 0.1 else str(w))
        docs.append((i, " ".join(words)))
    return docs


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:  # many leaves, blocks and local leaves
        for name, value in (("LEAF", 8), ("LOCAL", 3), ("MEMBERS", 5), ("VISITORS", 7), ("PAIRS", 10)):
            monkeypatch.setattr(S, name, value)
    docs = texts(np.random.default_rng(3))
    long_run = "abcdefghij" * 400  # longer than a tree's words
    docs += [(None, "Straßenbahn straßenbahn"), (None, None), (7, ""), (8, f"{long_run} {long_run} {long_run}x"), (9, f"{long_run}x")]
    got = as_dict(S.variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == brute(docs) and any(v[0] for v in got.values())


def test_whole_table_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert as_dict(S.op11_spelling(spark, SF_SMALL)) == brute(docs)


def test_empty_and_clashing_columns(spark):
    empty = S.variants(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.columns == ["word", "form", "root", "n", "n_near", "form_n"] and not empty.count()
    rows = spark.createDataFrame([(1, "wonderful wonderful", "x", 5, 6)] * 2, RUN_SCHEMA)
    assert as_dict(S.variants(rows)) == brute([(1, "wonderful wonderful")] * 2)


def test_tree_visits_every_box_in_reach():
    rng = np.random.default_rng(1)
    points = rng.integers(0, 3, size=(400, S.N_LETTERS)) * (rng.random(S.N_LETTERS) < 0.1)
    tree = S.Tree(points, leaf_size=5)
    home = np.empty(len(points), dtype=int)
    for leaf, rows in enumerate(tree.members):
        home[rows] = leaf
    reached = [set() for _ in points]
    for leaf, rows in tree.visits(points, True, True):
        for r in rows:
            assert leaf not in reached[r]
            reached[r].add(leaf)
    gap = points[:, None, :] - points[None, :, :]
    close = (np.maximum(gap, 0).sum(2) <= 1) & (np.maximum(-gap, 0).sum(2) <= 1)
    assert all(home[j] in reached[i] for i, j in zip(*np.nonzero(close), strict=True))
    assert max(map(len, reached)) < len(tree.members)  # boxes out of reach are pruned
