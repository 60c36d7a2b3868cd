"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

One replaced letter changes a word's letter counts by +1 and -1 (L1 distance 2), one inserted
letter by +1 (distance 1).  So near words are searched as points, by pair of lengths:

1. Words and their occurrences are counted in the JVM.
2. Every length with more than ``LEAF`` words gets a k-d tree whose splits (letter, count) are
   fitted on a hash sample of at most ``PER_LEAF * MAX_LEAVES`` words; every word is dealt to
   its leaf, whatever the sample held.
3. A word visits each leaf whose box it can reach: in its own length's tree one letter may rise
   by one and one may fall by one, in the tree of the next length one may rise.  Of two leaves
   of one tree only the later is visited, so that a pair of words meets once.
4. A leaf's members and visitors are dealt in blocks of bounded size.  Each pair of blocks is
   a task's work: a k-d tree over the members is searched the same way down to ``LOCAL`` words,
   where an integer matrix product leaves the pairs at the exact distance, whose letter order
   is then verified.
5. Counts of near words and each word's best form are folded in the task and once more by
   Spark.  Forms are followed to their last by pointer doubling: occurrences grow tenfold by
   step, so a chain has fewer than 20 of them.

The driver sees lengths with more than ``LEAF`` words (at most ``MAX_LEAVES``) and the sample;
trees have at most ``MAX_LEAVES`` leaves plus one a length.  Words longer than ``TREE_LENGTH``
have one leaf a length; blocks keep it exact and bounded.

Defined cases: a null text has no words; a null id counts as an empty one; repeated rows count
as rows; empty tables give no rows; words of any length are compared whole; ties go to the
smallest word by code point; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

MIN_LENGTH = 7
MIN_COUNT = 2
#: The contract's misspellings: one run in ``DELETE_ONE_IN``, chosen by hash, loses a letter.
DELETE_ONE_IN = 31
#: A form occurs this many times as often as its variant.
RATIO = 10
LEAF = 8192
MAX_LEAVES = 16_384
PER_LEAF = 64
TREE_LENGTH = 64
#: Members and visitors of one block; long words make blocks of fewer.
MEMBERS, VISITORS, BLOCK_CHARS = 8192, 32_768, 1 << 22
#: Words of a leaf of a task's own tree, and pairs compared at once.
LOCAL, PAIRS = 192, 1 << 20
N_LETTERS = 26 + 64
MEMBER, OWN, SAME, SHORTER = 0, 1, 2, 3


# ---- words -----------------------------------------------------------------------------
def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words with ``MIN_LENGTH`` letters and ``MIN_COUNT`` occurrences."""
    # shorter runs cannot give a word
    runs = F.regexp_extract_all(F.col(text_col), F.lit(r"[A-Za-zÀ-ÿ]{%d,}" % MIN_LENGTH), F.lit(0))
    run = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    ascii_only = F.octet_length("run") == F.length("run")
    run = run.select("id", F.when(ascii_only, F.lower("run")).otherwise(C.ascii_lower(F.col("run"))).alias("run"))
    run = run.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = run.select(F.when(F.col("h") % DELETE_ONE_IN == 0, cut).otherwise(F.col("run")).alias("word"))
    return (word.filter(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= MIN_COUNT))


# ---- k-d trees over letter counts ------------------------------------------------------
def letters(words: list[str], length: int) -> np.ndarray:
    """(words, length) code points; all of them are below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(-1, length)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    n = len(codes)
    letter = np.where(codes >= 0xC0, codes.astype(np.int64) - 0xC0 + 26, codes.astype(np.int64) - ord("a"))
    flat = (letter + np.arange(n)[:, None] * N_LETTERS).ravel()
    return np.bincount(flat, minlength=n * N_LETTERS).reshape(n, N_LETTERS)


def _best_split(counts: np.ndarray) -> tuple[int, int] | None:
    """(letter, count): words with at most that count go left; the most even split."""
    middle = np.median(counts, axis=0).astype(counts.dtype)
    best, split = 0, None
    for shift in (-1, 0):
        left = (counts <= middle + shift).sum(axis=0)
        even = np.minimum(left, len(counts) - left)
        letter = int(even.argmax())
        if even[letter] > best:
            best, split = even[letter], (letter, int(middle[letter]) + shift)
    return split


class Tree:
    """Nodes in lists: ``letter`` (-1 in a leaf), ``count``, ``left`` and ``right`` (a leaf's number in ``left``)."""

    def __init__(self, counts: np.ndarray, leaves: float | None = None, leaf_size: int = 1):
        self.letter, self.count, self.left, self.right = [], [], [], []
        self.members: list[np.ndarray] = []
        self._grow(counts, np.arange(len(counts)), leaves, leaf_size)

    def _grow(self, counts: np.ndarray, rows: np.ndarray, leaves: float | None, leaf_size: int) -> int:
        node = len(self.letter)
        for column in (self.letter, self.count, self.left, self.right):
            column.append(-1)
        done = len(rows) <= leaf_size or (leaves is not None and leaves <= 1)
        split = None if done else _best_split(counts[rows])
        if split is None:
            self.left[node] = len(self.members)
            self.members.append(rows)
            return node
        on_left = counts[rows, split[0]] <= split[1]
        self.letter[node], self.count[node] = split
        share = [None, None] if leaves is None else [leaves * on_left.mean(), leaves * (1 - on_left.mean())]
        self.left[node] = self._grow(counts, rows[on_left], share[0], leaf_size)
        self.right[node] = self._grow(counts, rows[~on_left], share[1], leaf_size)
        return node

    def visits(self, counts: np.ndarray, rise: bool, fall: bool) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``counts``) for every leaf that a row reaches if one letter may
        rise by one and another may fall by one; with neither, its home leaf."""
        spent = np.full(len(counts), -1 if rise else N_LETTERS)
        fallen = np.full(len(counts), -1 if fall else N_LETTERS)
        stack = [(0, np.arange(len(counts)), spent, fallen)]
        while stack:
            node, rows, up, down = stack.pop()
            letter, limit = self.letter[node], self.count[node]
            if letter < 0:
                yield self.left[node], rows
                continue
            have = counts[rows, letter] + (up == letter) - (down == letter)
            is_left = have <= limit
            may_rise = is_left & (have == limit) & (up == -1) & (down != letter)
            may_fall = ~is_left & (have == limit + 1) & (down == -1) & (up != letter)
            for child, stay, move, on_up in ((self.left[node], is_left, may_fall, False), (self.right[node], ~is_left, may_rise, True)):
                go = stay | move
                if go.any():
                    new_up = np.where(move, letter, up)[go] if on_up else up[go]
                    new_down = down[go] if on_up else np.where(move, letter, down)[go]
                    stack.append((child, rows[go], new_up, new_down))


def fit_trees(words: DataFrame) -> dict[int, Tree]:
    """The tree of every length that has one, fitted on a bounded sample."""
    sizes = (words.filter(F.length("word") <= TREE_LENGTH).groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n"))
             .filter(F.col("n") > LEAF).collect())  # TREE_LENGTH rows at most
    total = sum(r.n for r in sizes)
    if not total:
        return {}
    leaves = min(MAX_LEAVES, total / LEAF)
    share = min(1.0, leaves * PER_LEAF / total)
    sample = words.filter(F.length("word").isin([r.length for r in sizes])
                          & (F.xxhash64("word").bitwiseAND((1 << 40) - 1) < int(share * (1 << 40)))).select("word").toArrow()
    by_length: dict[int, list[str]] = {}
    for w in sorted(sample.column("word").to_pylist()):
        by_length.setdefault(len(w), []).append(w)
    return {r.length: Tree(letter_counts(letters(by_length[r.length], r.length)), leaves * r.n / total)
            for r in sizes if r.length in by_length}


def _deal(trees: dict[int, Tree]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Words (word, n) to (length, leaf, role, word, n): one row as member, one for each visit."""
    def reach(length: int, counts: np.ndarray, rise: bool, fall: bool) -> Iterator[tuple[int, np.ndarray]]:
        tree = trees.get(length)
        return iter([(0, np.arange(len(counts)))]) if tree is None else tree.visits(counts, rise, fall)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = b.column("word").to_pylist()
            sizes = np.fromiter(map(len, every), dtype=np.int64, count=len(every))
            for length in np.unique(sizes).tolist():
                here = np.flatnonzero(sizes == length)
                words = [every[i] for i in here]
                counts = (letter_counts(letters(words, length)) if length in trees or length + 1 in trees
                          else np.zeros((len(words), N_LETTERS), dtype=np.int64))
                home = np.zeros(len(words), dtype=np.int64)
                for leaf, rows in reach(length, counts, False, False):
                    home[rows] = leaf
                found = [(length, home, MEMBER, np.arange(len(words))), (length, home, OWN, np.arange(len(words)))]
                for leaf, rows in reach(length, counts, True, True):
                    rows = rows[home[rows] < leaf]
                    found.append((length, np.full(len(rows), leaf), SAME, rows))
                for leaf, rows in reach(length + 1, counts, True, False):
                    found.append((length + 1, np.full(len(rows), leaf), SHORTER, rows))
                rows = np.concatenate([f[3] for f in found])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([np.full(len(f[3]), f[0]) for f in found]), pa.int32()),
                    pa.array(np.concatenate([f[1] for f in found]), pa.int32()),
                    pa.array(np.concatenate([np.full(len(f[3]), f[2]) for f in found]), pa.int32()),
                    b.column("word").take(pa.array(here[rows])), b.column("n").take(pa.array(here[rows]))],
                    names=["length", "leaf", "role", "word", "n"])
    return deal


# ---- the search within a pair of blocks -------------------------------------------------
def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Does deleting one letter of each row of ``long`` give the row of ``short``?"""
    width = short.shape[1]
    head, tail = short == long[:, :-1], (short == long[:, 1:])[:, ::-1]
    same_head = np.where(head.all(axis=1), width, head.argmin(axis=1))
    same_tail = np.where(tail.all(axis=1), width, tail.argmin(axis=1))
    return same_head + same_tail >= width


def near_pairs(members: np.ndarray, visitors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(visitor, member) row numbers of the pairs one edit apart.

    ``visitors`` have the members' length (replaced letter; a word is no pair with itself) or
    one letter less (inserted letter).
    """
    same = visitors.shape[1] == members.shape[1]
    m_counts, v_counts = letter_counts(members), letter_counts(visitors)
    real = np.float32 if members.shape[1] < 2048 else np.float64  # squares summed stay exact
    m, v = m_counts.astype(real), v_counts.astype(real)
    m_norm, v_norm = (m * m).sum(axis=1), (v * v).sum(axis=1)
    # +1 and -1 in two letters, or +1 in one: the squared distance is 2 or 1
    distance, check = (2, one_replaced) if same else (1, one_inserted)
    tree = Tree(m_counts, leaf_size=LOCAL)
    for leaf, reached in tree.visits(v_counts, rise=True, fall=same):
        rows = tree.members[leaf]
        step = max(1, PAIRS // len(rows))
        for at in range(0, len(reached), step):
            part = reached[at:at + step]
            gap = v_norm[part][:, None] + m_norm[rows][None, :] - 2 * (v[part] @ m[rows].T)
            i, j = np.nonzero(gap == distance)
            some = max(1, BLOCK_CHARS // members.shape[1])
            for k in range(0, len(i), some):
                a, b = part[i[k:k + some]], rows[j[k:k + some]]
                ok = check(visitors[a], members[b])
                if ok.any():
                    yield a[ok], b[ok]


def _search(key: tuple, table: pa.Table) -> pa.Table:
    """Partial (word, n_near, form_n, form) of one pair of blocks."""
    length = key[0].as_py()
    words, role = table.column("word").to_pylist(), table.column("role").to_numpy()
    n = table.column("n").to_numpy()
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    near, best_n, best = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64), np.full(len(words), -1)

    def fold(one: np.ndarray, other: np.ndarray) -> None:
        np.add.at(near, one, 1)
        strong = n[other] >= RATIO * n[one]
        one, other = one[strong], other[strong]
        order = np.lexsort((rank[other], -n[other], one))
        one, other = one[order], other[order]
        first = np.ones(len(one), dtype=bool)
        first[1:] = one[1:] != one[:-1]
        one, other = one[first], other[first]
        better = (n[other] > best_n[one]) | ((n[other] == best_n[one]) & (rank[other] < rank[best[one]]))
        best_n[one[better]], best[one[better]] = n[other[better]], other[better]

    member = np.flatnonzero(role == MEMBER)
    codes = letters([words[i] for i in member], length)
    for roles, width in (((OWN,), length), ((SAME,), length), ((SHORTER,), length - 1)):
        visitor = np.flatnonzero(np.isin(role, roles))
        if not len(member) or not len(visitor):
            continue
        for a, b in near_pairs(codes, letters([words[i] for i in visitor], width)):
            a, b = visitor[a], member[b]
            if roles == (OWN,):
                once = rank[a] < rank[b]  # both words are members of this leaf
                # equal words have two rows, next to each other in rank, so no pair is near itself
                a, b = a[once], b[once]
            fold(a, b)
            fold(b, a)
    some = np.flatnonzero(near)
    return pa.table({"word": pa.array([words[i] for i in some], pa.string()), "n_near": pa.array(near[some]),
                     "form_n": pa.array(best_n[some], mask=best[some] < 0),
                     "form": pa.array([words[i] if i >= 0 else None for i in best[some]], pa.string())})


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n) of every row of ``words`` (word, n)."""
    dealt = C.materialize(words.mapInArrow(_deal(fit_trees(words)), "length int, leaf int, role int, word string, n long"), "spelling-visits")
    sizes = dealt.groupBy("length", "leaf").agg(F.count_if(F.col("role") == MEMBER).alias("m"), F.count_if(F.col("role") != MEMBER).alias("v"))

    def blocks(rows: str, most: int):
        fit = F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.lit(BLOCK_CHARS) / F.col("length"))))
        return F.greatest(F.lit(1), F.ceil(F.col(rows) / fit)).cast("int")

    sizes = sizes.filter("m > 0").select(F.col("length").alias("s_length"), F.col("leaf").alias("s_leaf"),
                                         blocks("m", MEMBERS).alias("m_blocks"), blocks("v", VISITORS).alias("v_blocks"))
    cells = dealt.join(sizes, (F.col("length") == F.col("s_length")) & (F.col("leaf") == F.col("s_leaf")))
    own = F.pmod(F.xxhash64("word"), F.when(F.col("role") == MEMBER, F.col("m_blocks")).otherwise(F.col("v_blocks"))).cast("int")
    facing = F.sequence(F.lit(0), F.when(F.col("role") == MEMBER, F.col("v_blocks")).otherwise(F.col("m_blocks")) - 1)
    cells = cells.select("length", "leaf", "role", "word", "n", own.alias("own"), F.explode(facing).alias("other"))
    is_member = F.col("role") == MEMBER
    cells = cells.select("length", "leaf", "role", "word", "n", F.when(is_member, F.col("own")).otherwise(F.col("other")).alias("m_block"),
                         F.when(is_member, F.col("other")).otherwise(F.col("own")).alias("v_block"))
    found = cells.groupBy("length", "leaf", "m_block", "v_block").applyInArrow(_search, "word string, n_near long, form_n long, form string")
    every = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"), F.lit(None).cast("string").alias("form"))
    every = every.unionByName(found.withColumn("n", F.lit(None).cast("long")))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("by"), F.col("form").alias("form"))))
    return (every.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n", "n_near", F.col("best.form").alias("form"), (-F.col("best.by")).alias("form_n")))


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the last of their chain of forms."""
    at = C.materialize(forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = at.select(F.col("word").alias("w"), F.col("root").alias("next"))
        step = at.join(ahead, F.col("root") == F.col("w"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = C.materialize(step, "spelling-roots")
        at = step.select("word", "root")
        if not step.filter("moved").limit(1).count():
            return at


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``."""
    words = C.materialize(count_words(docs, id_col, text_col), "spelling-words")
    forms = C.materialize(near_words(words), "spelling-forms")
    roots = follow(forms).select(F.col("word").alias("r_word"), "root")
    return forms.join(roots, F.col("word") == F.col("r_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(C.table(spark, sf_dir, "documents"))


ORACLE = f"""WITH RECURSIVE tab AS (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(0, 256)) AS i)),
runs AS (
  SELECT id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents)
  WHERE length(r) >= {MIN_LENGTH}),
counted AS (SELECT id, run, count(*) AS n FROM runs GROUP BY id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295,
      flatten(list_transform(string_split(id || ':' || run, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END))),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
  FROM counted, tab),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % {DELETE_ONE_IN} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
spots AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
holes AS (SELECT word, n, substr(word, 1, i - 1) || '?' || substr(word, i + 1) AS hole FROM spots),
cuts AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM spots),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b USING (hole) WHERE a.word <> b.word
  UNION ALL SELECT c.word, c.n, w.word, w.n FROM cuts c JOIN words w ON c.cut = w.word
  UNION ALL SELECT w.word, w.n, c.word, c.n FROM cuts c JOIN words w ON c.cut = w.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS top_n FROM near GROUP BY word),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= {RATIO} * words.n THEN top_n END AS form_n,
    CASE WHEN top_n >= {RATIO} * words.n THEN (SELECT min(other) FROM near WHERE near.word = words.word AND other_n = top_n) END AS form
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS top, 0 AS hop FROM forms
  UNION ALL SELECT chain.word, forms.form, hop + 1 FROM chain JOIN forms ON chain.top = forms.word WHERE forms.form IS NOT NULL),
roots AS (SELECT word, arg_max(top, hop) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""
