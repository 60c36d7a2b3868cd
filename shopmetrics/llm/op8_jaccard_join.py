"""N-gram Jaccard join by vertical partitioning (fragments, partial overlaps, sums).

Documents with 100 * |intersection| >= 80 * |union| of their five-word shingle sets link.

1. Sets.  Rows with the same set share a set id (a hash of the sorted shingles), so copies
   are never paired; everything below runs on set ids.
2. Global order.  Shingles are ordered rarest first: by the step of an approximate document
   frequency (a fixed table of ``FREQ_CELLS`` hashed counters over all documents) and then by
   hash.  The order needs only to be the same for all documents; a
   coarse count costs candidates, not results.
3. Candidates.  Two linked sets share one of their n - ceil(0.8 n) + 1 first shingles.
   Posting lists of those prefixes, split by the size classes of the two partners (a member
   enters those that its place in the order still allows), give the candidates.  A list is
   not paired within itself: each round compares its members with one pivot (the member
   with the most common shingles, such as the original of a family of near copies).  Members
   that the verified links have joined need no more comparing, and a former pivot leaves its
   lists.  After ``ROUNDS`` rounds, what is left compares only members of *different*
   components, and only where size and position still allow a link.
4. Verification.  The global order is cut into ``FRAGMENTS`` ranges of equal load, by the mass
   of the frequency table.  A set's shingles in one range are a fragment; fragments of a
   candidate pair meet by (set, fragment), count a partial overlap, and the parts are summed
   per pair.  Fragments are made by a pass over the texts for the sets in the pairs only, from
   one row of each set, and never kept for all.
5. Components of the verified links; every row gets the least doc_id of its component.
6. Links.  Every link lies within a component, so all pairs of sets in one whose sizes allow a
   link are verified: a component's sets are dealt into blocks of bounded size, blocks meet
   pairwise, and a task sums the partial overlaps of a pair of blocks over ranges of their
   shingles.  A row's ``n_links`` is the number of other rows linked with it, copies included.
   The work grows with the square of a component, as the links do; rows moved grow with its
   number of blocks.

Steps 3 and 5 skip pairs only when already connected, or when the bounds on size and position
rule a link out; step 6 then counts the skipped ones.  Hot lists, pivots and fragments are
joins whose other side has one row a key, which Spark splits.

Defined cases: null or empty text has no shingle, links with nothing and is its own
component; one to four words are one shingle; texts of any length are cut whole, in pieces at
blanks; ties and repeated rows fall together by set; a null id does not count for the least
id; an empty table gives no rows; other columns are ignored, whatever their names
(``keep_one`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C
from .op2_decontamination import SHINGLE_SQL

SHINGLE = 5
SPACES = frozenset(b" \t\n\x0b\x0c\r")
PIECE = 1 << 20
BATCH_ROWS = 256
PERCENT = 80
FREQ_CELLS = 1 << 22
FREQ_BLOCK = 1 << 16
STEPS_PER_OCTAVE = 4
STEP_AT = np.uint64(55)
FRAGMENTS = 4
ROUNDS = 2
CLASS_BASE = 1.1
BLOCK_SHINGLES = 1 << 18
BLOCK_SETS = 1 << 10
COLUMNS = 1 << 11


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and start of every word of UTF-8 text, A-Z lower-cased."""
    base = 0x9E3779B97F4A7C15
    hashes, starts, at = [], [], 0
    while at < len(raw):
        stop = min(at + PIECE, len(raw))
        while stop < len(raw) and raw[stop] not in SPACES:
            stop += 1
        data = np.frombuffer(raw, np.uint8, count=stop - at, offset=at)
        data = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
        first, last = edge[::2], edge[1::2]
        n = len(data)
        up = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))
        inverse = np.uint64(pow(base, -1, 1 << 64))
        down = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, inverse, np.uint64)]))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(data.astype(np.uint64) + np.uint64(base)) * up[:n], dtype=np.uint64)])
        hashes.append(_mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)))
        starts.append(first + at)
        at = stop
    return (np.concatenate(hashes), np.concatenate(starts)) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def shingle_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, shingle hash) of every shingle, in order, repeats included."""
    raws = [(t or "").encode() for t in texts]
    words, starts = word_hashes(b"\n".join(raws))
    bounds = np.cumsum([0] + [len(r) + 1 for r in raws])
    owner = np.searchsorted(bounds, starts, side="right") - 1
    count = np.bincount(owner, minlength=len(raws))
    weight = [np.uint64(w) for w in (0x8CB92BA72F3D8DD7, 0xAEF17502108EF2D9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
    total = np.zeros(len(words), np.uint64)
    for k in range(SHINGLE):
        same = owner[k:] == owner[:len(owner) - k] if k else np.ones(len(owner), bool)
        total[:len(words) - k][same] += (words[k:] * weight[k])[same]
    place = np.arange(len(words)) - (np.cumsum(count) - count)[owner]
    short = count[owner] < SHINGLE
    total[short] += count[owner][short].astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
    on = np.where(short, place == 0, place <= count[owner] - SHINGLE)
    return owner[on], _mix(total[on])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, BATCH_ROWS):
            yield b.slice(at, BATCH_ROWS)


def _frequency_steps(docs: DataFrame) -> np.ndarray:
    """Frequency step of each of the FREQ_CELLS hashed counters: a table of 4 MB at any size.

    A shingle that a given share of the documents holds stands out of its cell by the same
    factor at every size.  Tasks send counters as blocks in the least width that holds them;
    blocks are summed as they stream in, and one byte a counter reaches the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(FREQ_CELLS, np.uint32)
        for b in _slices(batches):
            _, h = shingle_hashes(b.column(0).to_pylist())
            np.add.at(seen, (h & np.uint64(FREQ_CELLS - 1)).astype(np.int64), np.uint32(1))
        for block, part in enumerate(seen.reshape(-1, FREQ_BLOCK)):
            if part.any():
                data = part.astype(np.min_scalar_type(part.max())).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([data], pa.binary())], names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for block, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw = data.as_buffer()
                part = np.frombuffer(raw, np.dtype(f"u{raw.size // FREQ_BLOCK}"))
                total[block] = total.get(block, 0) + part.astype(np.uint64)
        for block, n in total.items():
            steps = np.floor(STEPS_PER_OCTAVE * np.log2(n + 1.0)).astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([steps], pa.binary())], names=["block", "steps"])

    parts = docs.select("text").mapInArrow(count, "block int, counts binary")
    summed = parts.repartition("block").mapInArrow(add, "block int, steps binary").toArrow()
    table = np.zeros((FREQ_CELLS // FREQ_BLOCK, FREQ_BLOCK), np.uint8)
    for block, steps in zip(summed.column("block").to_pylist(), summed.column("steps").to_pylist(), strict=True):
        table[block] = np.frombuffer(steps, np.uint8)
    return table.ravel()


def _ordered(texts: list[str | None], steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, order key, hash) by owner and key, with set size and id by text."""
    owner, h = shingle_hashes(texts)
    key = (steps[(h & np.uint64(FREQ_CELLS - 1)).astype(np.int64)].astype(np.uint64) << STEP_AT) | (h & np.uint64((1 << 55) - 1))
    order = np.lexsort((key, owner))
    owner, key, h = owner[order], key[order], h[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
    owner, key, h = owner[new], key[new], h[new]
    size = np.bincount(owner, minlength=len(texts))
    sid = np.zeros(len(texts), np.uint64)
    if len(owner):
        begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        sid[owner[begin]] = _mix(np.add.reduceat(_mix(h + np.uint64(0x632BE59BD9B4E019)), begin) + size[owner[begin]].astype(np.uint64))
    return owner, key, h, size, sid


def _prefix_rows(steps: np.ndarray):
    """(doc_id, n, sid, common, keys, text_hash): keys are the prefix, once for a set in a task."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for b in _slices(batches):
            owner, key, _, size, sid = _ordered(b.column(1).to_pylist(), steps)
            begin = np.cumsum(size) - size
            weight = np.bincount(owner, weights=(key >> STEP_AT).astype(float), minlength=len(size))
            fresh = np.zeros(len(size), bool)
            for i, s in enumerate(sid.tolist()):
                if size[i] and s not in known:
                    known.add(s)
                    fresh[i] = True
            take = np.where(fresh, size - (PERCENT * size + 99) // 100 + 1, 0)
            on = (np.arange(len(owner)) - begin[owner]) < take[owner]
            keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(take)]).astype(np.int32)), pa.array(key[on].view(np.int64)))
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(size.astype(np.int32)), pa.array(sid.view(np.int64), mask=size == 0),
                pa.array((1000 * weight / np.maximum(size, 1)).astype(np.int64)), keys, b.column(2)],
                names=["doc_id", "n", "sid", "common", "keys", "text_hash"])

    return rows


def _cuts(steps: np.ndarray) -> np.ndarray:
    """Order keys that part the global order into ``FRAGMENTS`` ranges of equal load.

    A cell of step s counts about 2^(s / STEPS_PER_OCTAVE) shingles; within a step the order is
    by hash, so any share of a step is a range of hashes.
    """
    mass = np.bincount(steps, minlength=1) * (2.0 ** (np.arange(int(steps.max(initial=0)) + 1) / STEPS_PER_OCTAVE))
    upto = np.cumsum(mass)
    goal = upto[-1] * np.arange(1, FRAGMENTS) / FRAGMENTS
    step = np.minimum(np.searchsorted(upto, goal), len(mass) - 1)
    share = np.clip((goal - (upto - mass)[step]) / np.maximum(mass[step], 1e-300), 0, 1)
    return (step.astype(np.uint64) << STEP_AT) | np.minimum(share * 2.0**55, 2.0**55 - 8).astype(np.uint64)


def _home(sid: np.ndarray, doc_id: np.ndarray) -> np.ndarray:
    return _mix(sid ^ _mix(doc_id + np.uint64(0x9E3779B97F4A7C15)))


def _fragments(docs: DataFrame, steps: np.ndarray, pairs: DataFrame, central: DataFrame) -> DataFrame:
    """(sid, part, sh) of the sets in ``pairs``, one row each, from a pass over the texts.

    A set is read from the row of its least doc_id only.  A fixed-size bitmap of the wanted
    (set, doc_id) selects these rows; what it lets through besides is not joined with any pair.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct().join(central.select("sid", "home"), "sid")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sid, home = (b.column(i).fill_null(0).to_numpy().view(np.uint64) for i in range(2))
            yield pa.RecordBatch.from_arrays([pa.array(_home(sid, home).view(np.int64))], names=["k"])

    bits = np.array(C.bitmap(wanted.select("sid", "home").mapInArrow(keyed, "k long"), "k").first()["bits"], np.int64).view(np.uint64)
    last = np.uint64(C.BITMAP_BITS - 1)
    cuts = _cuts(steps)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for b in _slices(batches):
            owner, key, h, size, sid = _ordered(b.column(1).to_pylist(), steps)
            on = size > 0
            mark = _home(sid, b.column(0).fill_null(0).to_numpy().view(np.uint64))
            for spot in (mark & last, (mark >> np.uint64(40)) & last):
                on &= (bits[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
            begin = np.cumsum(size) - size
            out: list[tuple[int, int, np.ndarray]] = []
            for i in np.flatnonzero(on):
                s = int(sid[i].view(np.int64))
                if s not in known:
                    known.add(s)
                    mine = slice(begin[i], begin[i] + size[i])
                    cut = [0, *np.searchsorted(key[mine], cuts), size[i]]
                    out += [(s, f, h[mine][cut[f]:cut[f + 1]].view(np.int64)) for f in range(FRAGMENTS) if cut[f] < cut[f + 1]]
            if out:
                sids, parts, sh = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(parts, pa.int32()), pa.array(sh, pa.list_(pa.int64()))], names=["sid", "part", "sh"])

    found = C.materialize(docs.select("doc_id", "text").mapInArrow(rows, "sid long, part int, sh array<long>"), "fragments")
    # rows that share doc_id and text, or that the bitmap let through, can have given a set twice
    twice = C.materialize(found.groupBy(F.col("sid").alias("t_sid"), F.col("part").alias("t_part")).agg(F.count("*").alias("n")).filter("n > 1"), "read-twice")
    if not twice.limit(1).count():
        return found
    same = (F.col("sid") == F.col("t_sid")) & (F.col("part") == F.col("t_part"))
    return found.join(twice, same, "left_anti").unionByName(found.join(twice, same, "left_semi").dropDuplicates(["sid", "part"]))


def _only(rows: DataFrame, wanted: DataFrame, count: str) -> DataFrame:
    """``rows`` whose sid is among the ids ``wanted`` (one column), and some more, before an exchange."""
    bits = C.materialize(C.bitmap(wanted.toDF("s"), "s"), "wanted-bits")
    return C.with_bitmap(rows, bits, F.col(count)).filter(C.maybe_in(F.col("bits"), F.col("sid"))).drop("bits")


def _need(a: Column, b: Column) -> Column:
    """Least intersection of linked sets of sizes a and b."""
    return F.ceil(PERCENT * (a + b) / (100 + PERCENT))


def _room(n_a: str, at_a: str, n_b: str, at_b: str) -> Column:
    """May a pair link whose first common shingle has these places?

    Sizes must be near, and all the overlap lies at or after the places.  A pair is always
    met in the list of its first common shingle, so other lists may pass it by.
    """
    near = 100 * F.least(n_a, n_b) >= PERCENT * F.greatest(n_a, n_b)
    return near & (F.least(F.col(n_a) - F.col(at_a), F.col(n_b) - F.col(at_b)) >= _need(F.col(n_a), F.col(n_b)))


def _size_class(n: Column) -> Column:
    return F.floor(F.log(F.greatest(n, F.lit(1.0))) / F.log(F.lit(CLASS_BASE))).cast("int")


def _verify(docs: DataFrame, steps: np.ndarray, sets: DataFrame, central: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Linked (a, b) of candidate pairs (a, n_a, b, n_b), and the fragments of their sets.

    The prefixes are counted first.  Linked sets lack few of each other's shingles, so both
    prefixes hold at least the first need - ceil(0.8 max) + 1 common ones: a pair with fewer
    is done.
    """
    pairs = C.materialize(pairs, "candidates")
    keys = sets.filter(F.size("keys") > 0).select("sid", "n", "keys")
    # one row a set, so that copies read by many tasks meet no pair more than once; that of b is
    # written, since a pivot may have very many pairs, which Spark can then split
    keys_a = _only(keys, pairs.select("a"), "n").dropDuplicates(["sid"])
    keys_b = C.materialize(_only(keys, pairs.select("b"), "n").dropDuplicates(["sid"]), "pair-prefixes")
    both = (pairs.join(keys_a.select(F.col("sid").alias("a"), F.col("keys").alias("k_a")), "a")
            .join(keys_b.select(F.col("sid").alias("b"), F.col("keys").alias("k_b")), "b"))
    least = _need(F.col("n_a"), F.col("n_b")) - F.ceil(PERCENT * F.greatest("n_a", "n_b") / 100) + 1
    pairs = both.filter(F.size(F.array_intersect("k_a", "k_b")) >= least).select("a", "n_a", "b", "n_b")
    pairs = C.materialize(pairs, "near-pairs")
    fragments = _fragments(docs, steps, pairs, central)
    side_a = _only(fragments, pairs.select("a"), "part").select(F.col("sid").alias("a"), "part", F.col("sh").alias("sh_a"))
    side_b = _only(fragments, pairs.select("b"), "part").select(F.col("sid").alias("b"), "part", F.col("sh").alias("sh_b"))
    met = pairs.join(side_a, "a").join(side_b, ["b", "part"])
    partial = met.select("a", "b", "part", "n_a", "n_b", F.size(F.array_intersect("sh_a", "sh_b")).alias("k"))
    total = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("k").alias("k"))
    return total.filter(100 * F.col("k") >= PERCENT * (F.col("n_a") + F.col("n_b") - F.col("k"))).select("a", "b"), fragments


def _pack(table: pa.Table) -> pa.Table:
    """One row of a block: its sets' ids, sizes, copies and shingles, as bytes."""
    # a set that several rounds have read gives equal rows
    row = {k: i for i, k in enumerate(zip(table["sid"].to_pylist(), table["part"].to_pylist(), strict=True))}
    at: dict[int, list[int]] = {}
    for (sid, _), i in row.items():
        at.setdefault(sid, []).append(i)
    sids = sorted(at)
    first = [at[s][0] for s in sids]
    n = table["n"].to_numpy()[first].astype(np.int64)
    copies = table["copies"].to_numpy()[first].astype(np.int64)
    shingles = np.concatenate([table["sh"][i].values.to_numpy() for s in sids for i in at[s]])
    data = [np.array(sids, np.int64), n, copies, shingles]
    key = [table[k][:1].combine_chunks() for k in ("comp", "class", "block")]
    return pa.table([*key, pa.array([int(n.min())]), pa.array([int(n.max())]), *[pa.array([x.tobytes()], pa.binary()) for x in data]],
                    names=["comp", "class", "block", "low", "high", "sids", "sizes", "copies", "shingles"])


def block_overlap(n_a: np.ndarray, sh_a: np.ndarray, n_b: np.ndarray, sh_b: np.ndarray) -> np.ndarray:
    """Overlap of each set of block a with each of b: partial overlaps by range of shingles, summed."""
    common = np.intersect1d(sh_a, sh_b)
    total = np.zeros((len(n_a), len(n_b)), np.int64)

    def entries(n: np.ndarray, sh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spot = np.searchsorted(common, sh)
        on = common[np.minimum(spot, len(common) - 1)] == sh
        order = np.argsort(spot[on], kind="stable")
        return spot[on][order], np.repeat(np.arange(len(n)), n)[on][order]

    if len(common):
        sides = [entries(n_a, sh_a), entries(n_b, sh_b)]
        for start in range(0, len(common), COLUMNS):
            dense = []
            for (spot, owner), n in zip(sides, (n_a, n_b), strict=True):
                lo, hi = np.searchsorted(spot, [start, start + COLUMNS])
                x = np.zeros((len(n), COLUMNS), np.float32)
                x[owner[lo:hi], spot[lo:hi] - start] = 1
                dense.append(x)
            total += np.rint(dense[0] @ dense[1].T).astype(np.int64)
    return total


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sid, links) of the sets of each pair of blocks; links count the rows of the other set."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {k: v[i] for k, v in zip(batch.schema.names, batch.columns, strict=True)}
            (s_a, n_a, c_a, sh_a), (s_b, n_b, c_b, sh_b) = (
                [np.frombuffer(row[f"{k}_{x}"].as_buffer(), np.int64) for k in ("sids", "sizes", "copies", "shingles")] for x in "ab")
            k = block_overlap(n_a, sh_a, n_b, sh_b)
            linked = 100 * k >= PERCENT * (n_a[:, None] + n_b[None, :] - k)
            if row["same"].as_py():
                np.fill_diagonal(linked, False)
                sids, links = s_a, linked @ c_b
            else:
                sids, links = np.concatenate([s_a, s_b]), np.concatenate([linked @ c_b, c_a @ linked])
            yield pa.RecordBatch.from_arrays([pa.array(sids), pa.array(links)], names=["sid", "links"])


def _count_links(members: DataFrame, fragments: DataFrame) -> DataFrame:
    """(sid, links) of ``members`` (sid, comp, n, copies): all pairs of a component, by blocks.

    Blocks hold sets of one size class, unless the component fits one block.
    """
    whole = members.groupBy("comp").agg(F.sum("n").alias("t"), F.count("*").alias("m"))
    fits = (F.col("t") <= BLOCK_SHINGLES) & (F.col("m") <= BLOCK_SETS)
    whole = C.materialize(whole.select(F.col("comp").alias("w_comp"), fits.alias("fits")), "component-sizes")
    members = members.join(whole, F.col("comp") == F.col("w_comp")).select(
        "sid", "comp", "n", "copies", F.when(F.col("fits"), F.lit(-1)).otherwise(_size_class(F.col("n") + 1e-6)).alias("class"))
    cells = members.groupBy(F.col("comp").alias("l_comp"), F.col("class").alias("l_class")).agg(
        F.ceil(F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count("*") / BLOCK_SETS)).alias("blocks"))
    cells = C.materialize(cells, "cells")
    members = members.join(cells, (F.col("comp") == F.col("l_comp")) & (F.col("class") == F.col("l_class"))).select(
        F.col("sid").alias("m_sid"), "comp", "n", "copies", "class", F.pmod(F.xxhash64("sid"), F.col("blocks")).alias("block"))
    members = C.materialize(members, "members")
    linked = _only(fragments, members.select("m_sid"), "part")
    blocks = C.materialize(linked.join(members, F.col("sid") == F.col("m_sid")).drop("m_sid").groupBy("comp", "class", "block").applyInArrow(
        _pack, "comp long, class int, block long, low long, high long, sids binary, sizes binary, copies binary, shingles binary"), "blocks")
    place = F.struct("class", "block")
    a = blocks.select("comp", place.alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"))
    b = blocks.select("comp", place.alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    near = (100 * F.col("high_a") >= PERCENT * F.col("low_b")) & (100 * F.col("high_b") >= PERCENT * F.col("low_a"))
    met = C.materialize(a.join(b, "comp").filter((F.col("a") <= F.col("b")) & near).select("comp", "a", "b"), "block-pairs")
    for x in "ab":
        side = blocks.select("comp", place.alias(x), *[F.col(k).alias(f"{k}_{x}") for k in ("sids", "sizes", "copies", "shingles")])
        # a merge join deals the pairs by block; a broadcast would leave them in the few tasks that read them
        met = met.join(side.hint("merge"), ["comp", x])
    counted = met.withColumn("same", F.col("a") == F.col("b")).drop("comp", "a", "b").mapInArrow(_block_links, "sid long, links long")
    return counted.groupBy("sid").agg(F.sum("links").alias("links"))


def _star(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pivot of each list, and the pairs of its members with it."""
    pivot = (lists.groupBy("token", "class").agg(F.max(F.struct("common", "sid", "n", "at")).alias("p"), F.count("*").alias("size"))
             .filter("size > 1").select("token", "class", F.col("p.sid").alias("p_sid"), F.col("p.n").alias("p_n"), F.col("p.at").alias("p_at")))
    pivot = C.materialize(pivot, "pivots")
    pairs = (lists.join(pivot, ["token", "class"]).filter((F.col("sid") != F.col("p_sid")) & _room("n", "at", "p_n", "p_at"))
             .select(F.col("sid").alias("a"), F.col("n").alias("n_a"), F.col("p_sid").alias("b"), F.col("p_n").alias("n_b")).distinct())
    return pivot, pairs


def _labelled(docs: DataFrame, count_links: bool) -> DataFrame:
    """(doc_id, text_hash, sid, n_shingles, comp, n_links) of every row of ``docs`` (doc_id, text).

    ``comp`` is the least sid of the component; ``n_links`` is null unless counted.
    """
    steps = _frequency_steps(docs)
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    sets = C.materialize(hashed.mapInArrow(_prefix_rows(steps), "doc_id long, n int, sid long, common long, keys array<long>, text_hash long"), "sets")
    rows = sets.select("sid", "n", F.posexplode("keys").alias("at", "token"))
    # one exchange by token: the shared ones, then the lists of their members by size classes
    same = Window.partitionBy("token")
    shared = (rows.withColumn("low", F.min("sid").over(same)).withColumn("high", F.max("sid").over(same))
              .filter("low < high").select("token", "sid", "n", "at").distinct())
    # partners that the sizes and this member's place allow
    most = F.least(100 * F.col("n") / PERCENT, (100 + PERCENT) * (F.col("n") - F.col("at")) / PERCENT - F.col("n"))
    lo, hi = _size_class(PERCENT * F.col("n") / 100 - 1e-6), _size_class(most + 1e-6)
    mine = _size_class(F.col("n") + 1e-6)
    partner = F.when((most >= PERCENT * F.col("n") / 100 - 1e-6) & (hi >= lo), F.sequence(lo, hi))
    shared = shared.select("*", mine.alias("own"), F.explode(partner).alias("other"))
    shared = shared.withColumn("c1", F.least("own", "other")).withColumn("c2", F.greatest("own", "other"))
    group = Window.partitionBy("token", "c1", "c2")
    lists = (shared.withColumn("m", F.count("*").over(group)).withColumn("least", F.min("own").over(group)).withColumn("most", F.max("own").over(group))
             .filter("m > 1 AND least = c1 AND most = c2")
             .select("token", F.struct("c1", "c2").alias("class"), "sid", "n", "at"))
    lists = C.materialize(lists, "postings")
    central = C.materialize(sets.filter("sid IS NOT NULL").groupBy("sid").agg(
        F.max("common").alias("common"), F.max("n").alias("n"), F.count("*").alias("copies"), F.min("doc_id").alias("home")), "central")
    lists = C.materialize(lists.join(central.select("sid", "common"), "sid"), "postings")

    edges, fragments, rest = None, None, lists
    for _ in range(ROUNDS):
        pivot, pairs = _star(rest)
        new, parts = _verify(docs, steps, sets, central, pairs)
        new = C.materialize(new, "links")
        edges = new if edges is None else edges.union(new)
        fragments = parts if fragments is None else fragments.union(parts)
        comps = C.components(edges)
        # members that are in one component with their pivot need no more comparing with each other
        rest = (rest.drop("comp").join(comps.select(F.col("id").alias("sid"), "comp"), "sid", "left")
                .withColumn("comp", F.coalesce("comp", "sid")))
        rest = rest.join(pivot.select("token", "class", "p_sid"), ["token", "class"]).filter(F.col("sid") != F.col("p_sid")).drop("p_sid")
        mixed = (rest.groupBy("token", "class").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
                 .filter("low < high").select("token", "class"))
        rest = C.materialize(rest.join(C.materialize(mixed, "mixed"), ["token", "class"]), "unresolved")

    # of each list, the members outside its most common component meet all others
    counts = rest.groupBy("token", "class", "comp").agg(F.count("*").alias("m"))
    major = counts.groupBy("token", "class").agg(F.max(F.struct("m", "comp")).alias("x")).select("token", "class", F.col("x.comp").alias("major"))
    major = C.materialize(major, "majors")
    minor = rest.join(major, ["token", "class"]).filter(F.col("comp") != F.col("major"))
    minor = minor.select("token", "class", F.col("sid").alias("a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"), F.col("comp").alias("comp_a"))
    other = rest.select("token", "class", F.col("sid").alias("b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"), F.col("comp").alias("comp_b"))
    left = (minor.join(other, ["token", "class"]).filter((F.col("comp_a") != F.col("comp_b")) & _room("n_a", "at_a", "n_b", "at_b"))
            .select(F.least(F.struct("a", "n_a"), F.struct(F.col("b").alias("a"), F.col("n_b").alias("n_a"))).alias("x"),
                    F.greatest(F.struct("a", "n_a"), F.struct(F.col("b").alias("a"), F.col("n_b").alias("n_a"))).alias("y"))
            .select(F.col("x.a").alias("a"), F.col("x.n_a").alias("n_a"), F.col("y.a").alias("b"), F.col("y.n_a").alias("n_b")).distinct())
    new, parts = _verify(docs, steps, sets, central, left)
    edges = C.materialize(edges.union(new).distinct(), "links")
    comps = C.components(edges)
    # only linked sets have a row here; a copy group alone is its own component
    named = comps.select(F.col("id").alias("c_sid"), "comp")
    if count_links:
        members = C.materialize(central.join(named, F.col("sid") == F.col("c_sid")).select("sid", "comp", "n", "copies"), "linked-sets")
        counted = _count_links(members, fragments.union(parts)).withColumnRenamed("sid", "e_sid")
        named = central.join(named, F.col("sid") == F.col("c_sid"), "left").join(counted, F.col("sid") == F.col("e_sid"), "left").select(
            F.col("sid").alias("c_sid"), "comp", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
        links = F.coalesce("links", F.lit(0))
    else:
        links = F.lit(None)
    named = C.materialize(named, "named")
    labelled = sets.select("doc_id", "text_hash", "n", "sid").join(named, F.col("sid") == F.col("c_sid"), "left").select(
        "doc_id", "text_hash", F.col("n").cast("long").alias("n_shingles"), "sid", F.coalesce("comp", "sid").alias("comp"), links.cast("long").alias("n_links"))
    return C.materialize(labelled, "labelled")


def linked_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sid, n_shingles, component_id, n_links) of every row.

    ``n_links`` counts the other rows whose shingle set links with the row's, copies included.
    """
    labelled = _labelled(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), count_links=True)
    least = labelled.filter(F.col("comp").isNotNull()).groupBy(F.col("comp").alias("c")).agg(F.min("doc_id").alias("least"))
    least = C.materialize(least, "least")
    return labelled.join(least, F.col("comp") == F.col("c"), "left").select(
        "doc_id", "sid", "n_shingles", F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"), "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of the least doc_id, a null one last.

    Rows are told apart by doc_id and a hash of the text, so a doc_id that two texts share
    removes neither for the other's copies.  Of several rows with the chosen doc_id and text the
    least one in JSON stays.  Documents without a shingle all stay.
    """
    found = _labelled(docs.select("doc_id", "text"), count_links=False).filter(F.col("sid").isNotNull())
    rank = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "text_hash")
    best = C.materialize(found.groupBy(F.col("comp").alias("c")).agg(F.min(rank).alias("best")), "best")
    keys = (found.join(best, F.col("comp") == F.col("c")).withColumn("chosen", rank == F.col("best"))
            .groupBy("doc_id", "text_hash").agg(F.bool_or("chosen").alias("chosen"), F.count("*").alias("rows"))
            .filter("NOT chosen OR rows > 1").select(F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash"), "chosen"))
    keys = C.materialize(keys, "near-copies")
    rows = docs.select(F.struct("*").alias("_d")).withColumn("_h", F.xxhash64("_d.text"))
    same = F.col("_d.doc_id").eqNullSafe(F.col("k_id")) & (F.col("_h") == F.col("k_hash"))
    alone = rows.join(keys, same, "left_anti").select("_d")
    repeated = rows.join(keys.filter("chosen"), same, "left_semi")
    one = repeated.groupBy(F.col("_d.doc_id").alias("k_id"), "_h").agg(F.min_by("_d", F.to_json("_d")).alias("_d")).select("_d")
    return alone.union(one).select("_d.*")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_components(C.table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


ORACLE = f"""WITH RECURSIVE s AS ({SHINGLE_SQL.format(id='doc_id', table='documents')}),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
pairs AS (SELECT a.id AS a, b.id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.short = b.short AND a.id <> b.id GROUP BY a.id, b.id),
links AS (SELECT a, b FROM pairs JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach(id, other) AS (SELECT DISTINCT a, b FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(r.other), d.doc_id)) AS component_id,
  (SELECT count(*) FROM links WHERE links.a = d.doc_id) AS n_links
FROM documents d LEFT JOIN n ON n.id = d.doc_id LEFT JOIN reach r ON r.id = d.doc_id GROUP BY d.doc_id"""
