"""Removal of repeated 400-byte strings by a distributed merge sort of sparse suffixes.

Texts are UTF-8 bytes.  A window is a 400-byte string of one text; every byte of a window
that also starts elsewhere is removed.

*Sparse suffixes.*  The anchor of a window is the position of the least 16-byte hash among
its first ``SPAN`` positions (the first of ties).  It depends on the window's bytes alone,
so equal windows have their anchors at the same offset.  Neighbouring windows mostly share
an anchor: sorting one suffix per anchor, about one in ``SPAN`` / 2 bytes, covers all
windows.

*Distinguishing prefixes.*  Each anchor has ``CORE`` = 400 - SPAN + 1 bytes to its right that
belong to every window it serves.  Anchors whose core is unique in the corpus cannot serve
a repeated window; a count of 64-bit core fingerprints drops them before any string moves.
Copies of a text are counted once: all their windows repeat, and one stands for them.

*Merge sort.*  What remains is sorted by map tasks into runs: an entry is the suffix from
the anchor, followed by the reversed bytes before it.  Runs are exchanged front-coded (the
length of the prefix shared with the entry before, and the rest) by core, and each reduce
task combines its runs with a loser tree that compares from the known common prefix on and
never looks at it again.  The merge hands on each entry with the prefix it shares with its
predecessor, which splits the order into classes of one core and shows equal entries.

*Windows.*  Entries equal in whole are repeated in all their windows.  Where a class has
different entries (the ends of passages, edits of near copies), its windows are compared by
64-bit fingerprints of their 400 bytes, within the class.  A core with more than ``HOT``
entries is split among several reduce tasks; what its parts leave open is compared across
parts by fingerprint counts, which aggregate before the exchange.

Repeated windows go back to their texts as runs of positions, and bytes are removed there.
Nothing is held for the corpus in one place.  Memory of a task is bounded by its piece of a
text (``PIECE``) and its share of the runs.

Defined cases: a null text is empty, and texts under 400 bytes are untouched; a text that
occurs twice is wholly removed if it has 400 bytes; repeated rows (same id and text) are
copies as well; null ids are fine, rows are told apart by a hash of id and text.
Fingerprints are 64 bits: a chance of about n^2 / 2^65 in n compared windows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

WINDOW = 400
SPAN = 256
GRAM = 16
CORE = WINDOW - SPAN + 1
PIECE = 1 << 17
BATCH_ROWS = 256
HOT = 4096
ENTRY_BYTES = 700
TASK_BYTES = 24 << 20
RUN_ENTRIES = 16384

_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_M = np.uint64(0xBF58476D1CE4E5B9)
_N = np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M
    x = (x ^ (x >> np.uint64(27))) * _N
    return x ^ (x >> np.uint64(31))


def _eights(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit word of the eight bytes from each position on."""
    n = len(data) - 7
    out = np.empty(max(n, 0), np.uint64)
    raw = data.tobytes()
    for s in range(min(8, max(n, 0))):
        k = (n - s + 7) // 8
        out[s::8] = np.frombuffer(raw, "<u8", count=k, offset=s)
    return _mix(out)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        inverse = np.uint64(pow(int(_B), -1, 1 << 64))
        _POWERS[size] = tuple(np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in (_B, inverse))
    return _POWERS[size]


class Prints:
    """Fingerprints of substrings of a byte array, by prefix sums of mixed words."""

    def __init__(self, data: np.ndarray) -> None:
        self.words = _eights(data)
        up, self.down = _powers(len(self.words) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.words * up[:len(self.words)], dtype=np.uint64)])

    def of(self, start: np.ndarray, length: int) -> np.ndarray:
        return _mix((self.sums[start + length - 7] - self.sums[start]) * self.down[start])


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of w values."""
    n = len(x)
    pad = (-n) % w
    full = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Prints]:
    """(anchor, first window, last window) of the windows of ``data``, and its prints."""
    prints = Prints(data)
    m = len(data) - WINDOW + 1
    grams = prints.words[:-8] * _M ^ prints.words[8:]
    place = np.arange(len(grams), dtype=np.uint64)
    key = (_mix(grams) & ~np.uint64((1 << 24) - 1)) | place
    at = (_sliding_min(key[:m + SPAN - 1], SPAN) & np.uint64((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:] - 1, [m - 1]])
    return at[first], first, last, prints


def pieces(raw: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Overlapping pieces that hold every window of a text once: (offset, bytes)."""
    for start in range(0, max(len(raw) - WINDOW + 1, 0), PIECE):
        yield start, np.frombuffer(raw, np.uint8, count=min(PIECE + WINDOW - 1, len(raw) - start), offset=start)


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices: texts and results of a whole Arrow batch are large in Python."""
    for b in batches:
        for at in range(0, b.num_rows, BATCH_ROWS):
            yield b.slice(at, BATCH_ROWS)


def core_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, at, core) of every anchor."""
    def packed(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=["rid", "at", "core"])

    for b in batches:
        found, held = [], 0
        for rid, text in zip(b.column(0).to_numpy(), b.column(1), strict=True):
            for offset, data in pieces(text.as_py().encode()):
                at, _, _, prints = anchors(data)
                found.append((np.full(len(at), rid, np.int64), at + offset, prints.of(at, CORE).view(np.int64)))
                held += len(at)
                if held > 100_000:
                    yield packed(found)
                    found, held = [], 0
        if found:
            yield packed(found)


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    step = 64
    while known < n:
        if a[known:known + step] == b[known:known + step]:
            known += step
        elif step == 1:
            return known
        else:
            step = max(1, step // 4)
    return n


def merge_runs(runs: list[Iterator[tuple[bytes, int, tuple]]]) -> Iterator[tuple[bytes, int, tuple]]:
    """Merge sorted runs of (key, prefix shared with the entry before, payload).

    Loser tree: every stored loser knows the prefix it shares with the entry that beat it
    on the way, which is the last one handed out; of two entries, the one that shares more
    with that is the lesser, and only equal prefixes are compared further.
    """
    k = 1
    while k < max(len(runs), 1):
        k *= 2
    heads: list = [next(r, None) for r in runs] + [None] * (k - len(runs))
    keys = [h[0] if h else None for h in heads]
    known = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        if keys[a] is None:
            return b, a
        if keys[b] is None or known[a] > known[b]:
            return a, b
        if known[a] < known[b]:
            return b, a
        p = shared_prefix(keys[a], keys[b], known[a])
        if keys[a][p:p + 1] <= keys[b][p:p + 1]:
            known[b] = p
            return a, b
        known[a] = p
        return b, a

    losers = [0] * k
    winners = list(range(k))
    base = k
    while len(winners) > 1:
        base //= 2
        level = []
        for i in range(0, len(winners), 2):
            w, loser = play(winners[i], winners[i + 1])
            losers[base + i // 2] = loser
            level.append(w)
        winners = level
    top = winners[0]
    while keys[top] is not None:
        yield keys[top], known[top], heads[top][2]
        heads[top] = next(runs[top], None)
        if heads[top] is None:
            keys[top] = None
        else:
            keys[top], known[top] = heads[top][0], heads[top][1]
        node = (top + k) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2


# an entry: key bytes, reach (bytes of the key right of the anchor), row, first window, last window, hot
_META = "<HHHqqqB"
_META_SIZE = struct.calcsize(_META)


def encode_run(entries: list[tuple[bytes, tuple]]) -> bytes:
    """A sorted run, front-coded."""
    out, before = [], b""
    for key, meta in entries:
        p = shared_prefix(before, key)
        out.append(struct.pack(_META, p, len(key) - p, *meta))
        out.append(key[p:])
        before = key
    return zlib.compress(b"".join(out), 1)


def decode_run(blob: bytes) -> Iterator[tuple[bytes, int, tuple]]:
    raw, at, before = zlib.decompress(blob), 0, b""
    while at < len(raw):
        p, rest, *meta = struct.unpack_from(_META, raw, at)
        at += _META_SIZE
        before = before[:p] + raw[at:at + rest]
        at += rest
        yield before, p, tuple(meta)


def run_maker(parts: int, hot: int):
    """Map side: texts with their surviving anchors to front-coded runs by reduce task."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            tasks = sorted(held)
            blobs = [encode_run(sorted(held[t])) for t in tasks]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(tasks, pa.int32()), pa.array(blobs, pa.binary())], names=["task", "run"])

        for b in small(batches):
            for rid, text, spots, counts in zip(*(b.column(i) for i in range(4)), strict=True):
                raw, rid = text.as_py().encode(), rid.as_py()
                want = dict(zip(spots.as_py(), counts.as_py(), strict=True))
                chosen = np.array(sorted(want), np.int64)
                for offset, data in pieces(raw):
                    at, first, last, prints = anchors(data)
                    on = np.isin(at + offset, chosen)
                    at, first, last = at[on], first[on], last[on]
                    core = prints.of(at, CORE).tolist()
                    piece = data.tobytes()
                    for x, lo, hi, c in zip(at.tolist(), first.tolist(), last.tolist(), core, strict=True):
                        split = -(-want[x + offset] // hot)
                        task = (c + (hash((rid, x)) % split if split > 1 else 0) * 0x9E3779B1) % parts
                        right = piece[x:hi + WINDOW]
                        held.setdefault(task, []).append((right + piece[lo:x][::-1], (len(right), rid, lo + offset, hi + offset, split > 1)))
                        size += 1
                    if size >= RUN_ENTRIES:
                        yield flush()
                        size = 0
        if held:
            yield flush()

    return make


def _runs_of(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True)


def repeated_windows(runs: list[bytes]) -> Iterator[tuple[int | None, int | None, int | None, int | None]]:
    """(row, first, last, None) of repeated windows; (row, at, at, print) of open hot ones.

    A hot print that is known to repeat, or whose owner is settled, comes without row.
    """
    classes: list[list[tuple[bytes, int, list]]] = []  # distinct entries with their owners
    for key, p, (reach, rid, lo, hi, hot) in merge_runs([decode_run(r) for r in runs]):
        if not classes or p < CORE:
            classes.append([])
        mine = classes[-1]
        if mine and mine[-1][0] == key and mine[-1][1] == reach:
            mine[-1][2].append((rid, lo, hi, hot))
        else:
            mine.append((key, reach, [(rid, lo, hi, hot)]))
        if p < CORE and len(classes) > 128:
            yield from _settle(classes[:-1])
            classes = classes[-1:]
    yield from _settle(classes)


def _settle(classes: list[list[tuple[bytes, int, list]]]) -> Iterator[tuple]:
    open_entries: list[tuple[int, bytes, list]] = []  # class, window bytes, owners
    for c, entries in enumerate(classes):
        hot = any(o[3] for _, _, owners in entries for o in owners)
        for key, reach, owners in entries:
            if len(owners) > 1:
                for rid, lo, hi, _ in owners:
                    yield rid, lo, hi, None
            if len(entries) > 1 or hot:
                open_entries.append((c, key[reach:][::-1] + key[:reach], owners))
    if not open_entries:
        return
    sizes = np.array([len(t) for _, t, _ in open_entries])
    prints = Prints(np.frombuffer(b"".join(t for _, t, _ in open_entries), np.uint8))
    start = np.cumsum(sizes) - sizes
    counts = sizes - WINDOW + 1
    owner = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    found = prints.of(start[owner] + nth, WINDOW)
    weight = np.array([min(2, len(o)) for _, _, o in open_entries])
    _, back = np.unique(found, return_inverse=True)
    again = np.bincount(back, weights=weight[owner])[back] > 1
    seen: set[int] = set()
    ends = np.cumsum(counts).tolist()
    for a, z, (_, _, owners) in zip([0, *ends], ends, open_entries, strict=False):
        rid, lo, _, _ = owners[0]
        if len(owners) == 1:
            for s, e in _runs_of(again[a:z]):
                yield rid, lo + s, lo + e, None
        if any(o[3] for o in owners):
            for j in range(a, z):
                value = int(found[j].view(np.int64))
                if again[j]:
                    if value not in seen:
                        seen.add(value)
                        yield None, None, None, value
                else:
                    yield rid, lo + j - a, lo + j - a, value


def merge_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    by_task: dict[int, list[bytes]] = {}
    for b in batches:
        for task, run in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            by_task.setdefault(task, []).append(run)
    schema = pa.schema([("rid", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("print", pa.int64())])
    rows: list[tuple] = []

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], schema=schema)

    for runs in by_task.values():
        for row in repeated_windows(runs):
            rows.append(row)
            if len(rows) >= 50_000:
                yield packed()
                rows = []
    if rows:
        yield packed()


def remove(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """(kept bytes, bytes removed, maximal removed runs) for repeated windows ``spans``."""
    kept, at, removed, runs, end = [], 0, 0, 0, -1
    for lo, hi in sorted(spans):
        stop = hi + WINDOW
        if lo > end:
            kept.append(raw[at:lo])
            runs += 1
            removed += stop - lo
        elif stop > end:
            removed += stop - end
        end = max(end, stop)
        at = end
    kept.append(raw[at:])
    return b"".join(kept), removed, runs


def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    for b in small(batches):
        out: list[list] = [[] for _ in names]
        for doc, text, lo, hi in zip(*(b.column(i) for i in range(4)), strict=True):
            raw = text.as_py().encode()
            kept, removed, runs = remove(raw, list(zip(lo.as_py() or [], hi.as_py() or [], strict=True)))
            for column, value in zip(out, (doc.as_py(), len(raw), removed, runs, kept), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=names)


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; ``kept`` is binary."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", C.whole_text("text").alias("text"))
    rows = rows.withColumn("rid", F.xxhash64("doc_id", "text"))
    size = F.octet_length("text")
    sized = C.materialize(rows.select("rid", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"),
                                      size.cast("long").alias("size")).filter(F.col("size") >= WINDOW), "text-keys")
    copies = (sized.groupBy("t1", "t2", "size").agg(F.count("*").alias("n"), F.min("rid").alias("one")).filter("n > 1"))
    copied = C.materialize(sized.join(copies, ["t1", "t2", "size"]).select("rid", "one", "size").distinct(), "copies")

    long_rows = rows.filter(size >= WINDOW)
    found = C.materialize(long_rows.select("rid", "text").mapInArrow(core_rows, "rid long, at long, core long"), "anchors")
    found = found.join(copied.filter("rid <> one").select("rid"), "rid", "left_anti").dropDuplicates(["rid", "at"])
    found = C.materialize(found, "anchors")
    # written, as Spark splits a hot key only between plain exchanges
    counted = C.materialize(found.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1"), "repeated-cores")
    alive = found.join(counted, "core").groupBy("rid").agg(F.collect_list(F.struct("at", "n")).alias("x"))
    alive = C.materialize(alive.select(F.col("rid").alias("a_rid"), F.col("x.at").alias("spots"), F.col("x.n").alias("counts")), "survivors")
    total = alive.agg(F.sum(F.size("spots"))).first()[0] or 0
    parts = max(8, -(-int(total) * ENTRY_BYTES // TASK_BYTES))

    def only(keys: DataFrame, key: str) -> DataFrame:
        """Texts that may have a key, before the exact join."""
        bits = C.materialize(C.bitmap(keys, key), "row-bits")
        return C.with_bitmap(long_rows, bits, size)

    with_spots = (only(alive, "a_rid").filter(C.maybe_in(F.col("bits"), F.col("rid"))).drop("bits").dropDuplicates(["rid"])
                  .join(alive.hint("shuffle_hash"), F.col("rid") == F.col("a_rid")))
    runs = with_spots.select("rid", "text", "spots", "counts").mapInArrow(run_maker(parts, hot), "task int, run binary")
    windows = C.materialize(runs.repartition(parts, "task").mapInArrow(merge_task, "rid long, lo long, hi long, print long"), "windows")
    prints = windows.filter(F.col("print").isNotNull())
    again = prints.groupBy("print").agg(F.count("*").alias("n")).filter("n > 1").select("print")
    crossed = prints.filter(F.col("rid").isNotNull()).join(again, "print").select("rid", "lo", "hi")
    whole = copied.select("rid", F.lit(0).cast("long").alias("lo"), (F.col("size") - WINDOW).alias("hi"))
    every = windows.filter(F.col("print").isNull()).select("rid", "lo", "hi").union(crossed).union(whole)
    spans = C.materialize(every.groupBy(F.col("rid").alias("s_rid")).agg(F.collect_list(F.struct("lo", "hi")).alias("x"))
                          .select("s_rid", F.col("x.lo").alias("lo"), F.col("x.hi").alias("hi")), "spans")

    bits = C.materialize(C.bitmap(spans, "s_rid"), "row-bits")
    marked = C.with_bitmap(rows, bits, size).withColumn("maybe", (size >= WINDOW) & C.maybe_in(F.col("bits"), F.col("rid"))).drop("bits")
    none = F.array().cast("array<bigint>")
    untouched = marked.filter(~F.col("maybe")).select(
        "doc_id", size.cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.col("text").cast("binary").alias("kept"))
    cut = (marked.filter("maybe").join(spans.hint("shuffle_hash"), F.col("rid") == F.col("s_rid"), "left")
           .select("doc_id", "text", F.coalesce("lo", none).alias("lo"), F.coalesce("hi", none).alias("hi"))
           .mapInArrow(cut_rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))
    return untouched.union(cut)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(C.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
