"""Exact order statistics without a sort.

NTILE boundaries, rank-qcut boundaries and quantiles all ask for a few rows of a total order: the
ones at given ranks.  ``rows_at`` finds them for several orders at once:

1. one aggregation counts each order's rows and nulls;
2. a round narrows the part of the order that can hold each wanted rank (its *scope*): a mergeable
   sketch (``percentile_approx``) proposes pivots just around the rank, then exact counts below and
   at every pivot tell the cell between two pivots, or the pivot itself, that holds it;
3. where the scope is one value, the search goes on among its rows by the id, three characters a time;
4. a scope of at most ``FETCH`` rows is read and sorted.

The sketch only guides: the counts are exact, so a bad pivot costs a round and never a wrong row.
Each scope shrinks to some 1/2500 of itself a round, and one pivot a round is a row picked by hash,
so that a round always gets closer.  No row is shuffled or sorted; the driver holds the pivots and
at most ``FETCH`` rows a scope.  The rounds read the key columns from a cache, released at the end;
callers pass a checkpointed frame, so that a lost executor costs only a read.
"""

from __future__ import annotations

import functools
import math
import operator
import os
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A scope of so many rows is read instead of searched further.
FETCH = 2048
#: ``percentile_approx``: ranks are off by at most rows / ACCURACY.
ACCURACY = 10_000
#: Characters of a string id compared at a time: three code points of 21 bits fit a long.
ID_CHARACTERS, CHARACTER_BITS = 3, 21


@dataclass(frozen=True)
class Order:
    """A total order: a value column, then an ascending unique id (a null string id counts as the empty one; ids hold no NUL).
    Without an id only the value at a rank is asked for.  Nulls of the value come first or last."""

    value: str
    ascending: bool = True
    nulls_first: bool = False
    id: str | None = None

    def keys(self) -> list[tuple[str, bool, bool]]:
        """The form that :func:`bucketing.precedes` takes."""
        return [(self.value, self.ascending, self.nulls_first), (self.id, True, True)]


@dataclass
class _Search:
    """One wanted rank: its order, its scope as conditions, its place in the scope."""

    order: Order
    rank: int
    rows: int
    where: list[Column] = field(default_factory=list)
    level: int = 0                # 0: the value; from 1 on: characters of the id
    found: tuple | None = None
    prefix: str = ""              # what all ids in the scope start with, once that is known
    path: tuple = ()              # the cells taken; searches of one order and path share a scope

    def scope(self) -> Column:
        return functools.reduce(operator.and_, self.where, F.lit(True))


class _Key:
    """What one level of a search compares: the value, a number id, or the next characters of a
    string id.  Sketches need a number (``code``); conditions compare the strings themselves."""

    def __init__(self, search: _Search, id_types: dict, shared: dict):
        order = search.order
        self.text = search.level > 0 and isinstance(id_types[order.id], T.StringType)
        if not self.text:
            self.code = F.col(order.id if search.level else order.value)
            return
        self.id, self.prefix = _text(order.id), search.prefix or shared[order.id]
        self.code = F.lit(0).cast("bigint")
        for at in range(len(self.prefix) + 1, len(self.prefix) + 1 + ID_CHARACTERS):     # 0 beyond the end
            self.code = self.code * F.lit(1 << CHARACTER_BITS) + F.ascii(F.substring(self.id, at, 1))

    def start(self, pivot: int) -> str:
        """The start of the ids with this code: the whole id if it ends within these characters."""
        points = [(pivot >> CHARACTER_BITS * i) % (1 << CHARACTER_BITS) for i in reversed(range(ID_CHARACTERS))]
        return self.prefix + "".join(chr(point) for point in points if point)

    def ends(self, pivot: int) -> bool:
        return pivot % (1 << CHARACTER_BITS) == 0

    def below(self, pivot) -> Column:
        return self.id < F.lit(self.start(pivot)) if self.text else self.code < F.lit(pivot)

    def at(self, pivot) -> Column:
        if not self.text:
            return self.code == F.lit(pivot)
        return self.id == F.lit(self.start(pivot)) if self.ends(pivot) else self.id.startswith(F.lit(self.start(pivot)))

    def above(self, pivot) -> Column:
        if not self.text:
            return self.code > F.lit(pivot)
        return (self.id > F.lit(self.start(pivot))) & ~self.at(pivot)


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _shared_start(low: str | None, high: str | None) -> str:
    """What every id starts with, as the least and the greatest do."""
    return os.path.commonprefix([low or "", high or ""])


def _start(df: DataFrame, wanted: dict[str, tuple[Order, object]]) -> tuple[dict, dict, int]:
    """The searches of every order, what all ids of a column start with, the row count."""
    ids = {o.id for o, _ in wanted.values() if o.id and isinstance(df.schema[o.id].dataType, T.StringType)}
    aggregates = [F.count(F.lit(1)).alias("n")]
    aggregates += [F.count(F.col(o.value)).alias(f"v{i}") for i, (o, _) in enumerate(wanted.values())]
    for i, name in enumerate(sorted(ids)):
        aggregates += [F.min(_text(name)).alias(f"a{i}"), F.max(_text(name)).alias(f"b{i}")]
    row = df.agg(*aggregates).first()
    shared = {name: _shared_start(row[f"a{i}"], row[f"b{i}"]) for i, name in enumerate(sorted(ids))}
    searches = {}
    for i, (name, (order, ranks)) in enumerate(wanted.items()):
        there, nulls = row[f"v{i}"], row["n"] - row[f"v{i}"]
        rows = row["n"] if order.id else there
        searches[name] = []
        for rank in ranks(rows):
            before = nulls if order.nulls_first and order.id else 0
            if order.id and (rank <= nulls if order.nulls_first else rank > there):
                search = _Search(order, rank if order.nulls_first else rank - there, nulls, [F.col(order.value).isNull()], 1)
            else:
                search = _Search(order, rank - before, there, [F.col(order.value).isNotNull()])
            searches[name].append(search)
    return searches, shared, row["n"]


def _pivots(df: DataFrame, groups: list[list[_Search]], keys: list[_Key], turn: int) -> list[list]:
    """Values in each scope around its wanted ranks, by a sketch, and one more by hash."""
    aggregates = []
    for i, (group, key) in enumerate(zip(groups, keys)):
        order, scope, shares = group[0].order, group[0].scope(), []
        for search in group:
            at = (search.rank - 0.5) / search.rows
            if search.level == 0 and not order.ascending:
                at = 1 - at
            shares += [min(1.0, max(0.0, at + step * 2 / ACCURACY)) for step in (-1, 0, 1)]
        salt = F.xxhash64(F.col(order.id or order.value), F.lit(turn))
        aggregates += [F.percentile_approx(F.when(scope, key.code), shares, ACCURACY).alias(f"q{i}"),
                       F.min_by(key.code, F.when(scope, salt)).alias(f"h{i}")]
    row = df.agg(*aggregates).first()
    return [sorted(set(row[f"q{i}"]) | {row[f"h{i}"]}, key=_sort_key) for i in range(len(groups))]


def _narrow(df: DataFrame, groups: list[list[_Search]], keys: list[_Key], pivots: list[list]) -> None:
    """Count exactly the rows between and at the pivots; keep the cell that holds each rank.
    Cell 2j lies below pivot j (and above the one before it), cell 2j + 1 at it."""
    cells = []
    for i, (group, key) in enumerate(zip(groups, keys)):
        cell = F.when(key.below(pivots[i][0]), 0)
        for j, pivot in enumerate(pivots[i]):
            cell = (cell.when(key.below(pivot), 2 * j) if j else cell).when(key.at(pivot), 2 * j + 1)
        cells.append(F.when(group[0].scope(), F.struct(F.lit(i).alias("i"), cell.otherwise(2 * len(pivots[i])).alias("cell"))))
    counted = (df.select(F.explode(F.array(*cells)).alias("at")).where("at is not null")
               .groupBy("at.i", "at.cell").count().collect())     # at most one row a cell
    counts = {(row["i"], row["cell"]): row["count"] for row in counted}
    for i, (group, key) in enumerate(zip(groups, keys)):
        order, level = group[0].order, group[0].level
        number = 2 * len(pivots[i]) + 1
        walk = range(number) if order.ascending or level else range(number - 1, -1, -1)
        for search in group:
            for cell in walk:
                search.rows = counts.get((i, cell), 0)
                if search.rank <= search.rows:
                    break
                search.rank -= search.rows
            search.path += (cell,)
            if cell % 2 == 0:
                search.where = [*search.where, *([key.above(pivots[i][cell // 2 - 1])] if cell else []),
                                *([key.below(pivots[i][cell // 2])] if cell + 1 < number else [])]
                continue
            pivot = pivots[i][cell // 2]     # one value: done, or on among its rows by the id
            search.where = [*search.where, key.at(pivot)]
            if order.id is None:
                search.found = (pivot, None)
            elif search.rows > FETCH and level and (not key.text or key.ends(pivot)):
                raise ValueError(f"{order.id} repeats: it cannot break ties")
            elif key.text:
                search.prefix = key.start(pivot)
            search.level += 1


def _fetch(df: DataFrame, groups: list[list[_Search]]) -> None:
    """Read the scopes of few rows (at most ``FETCH`` a scope); each is sorted here."""
    columns = sorted({c for group in groups for c in (group[0].order.value, group[0].order.id) if c})
    flags = [F.coalesce(group[0].scope(), F.lit(False)).alias(f"in {i}") for i, group in enumerate(groups)]
    rows = df.select(*columns, *flags).collect()
    for i, group in enumerate(groups):
        order = group[0].order
        keys = [(row[order.value], row[order.id] if order.id else None) for row in rows if row[f"in {i}"]]
        if order.id:
            keys.sort(key=lambda key: (key[1] is not None, key[1]))
        if group[0].level == 0:
            keys.sort(key=lambda key: _sort_key(key[0]), reverse=not order.ascending)
        for search in group:
            search.found = keys[search.rank - 1]


def _sort_key(value):
    return (1, 0) if isinstance(value, float) and math.isnan(value) else (0, value)


def _search(df: DataFrame, wanted: dict[str, tuple[Order, object]]) -> tuple[dict[str, list[_Search]], int]:
    """Rounds until every rank is found."""
    searches, shared, n = _start(df, wanted)
    every = [s for group in searches.values() for s in group]
    id_types = {s.order.id: df.schema[s.order.id].dataType for s in every if s.order.id}
    turn = 0
    while open_ := [s for s in every if s.found is None]:
        scopes: dict[tuple, list[_Search]] = {}
        for search in open_:
            scopes.setdefault((search.order, search.level, search.path), []).append(search)
        groups = list(scopes.values())
        left = df.where(functools.reduce(operator.or_, [g[0].scope() for g in groups]))
        if wide := [g for g in groups if g[0].rows > FETCH]:
            keys = [_Key(g[0], id_types, shared) for g in wide]
            _narrow(left, wide, keys, _pivots(left, wide, keys, turn))
        else:
            _fetch(left, groups)
        turn += 1
    return searches, n


def rows_at(df: DataFrame, wanted: dict[str, tuple[Order, object]]) -> tuple[dict[str, list[tuple]], int]:
    """The (value, id) at some ranks of several orders, and the row count.

    ``wanted`` maps a name to an order and a function from its row count to the 1-based ranks asked
    for, each at most that count.  With an id, null values are rows of the order; without one they
    are left out, and the count passed is that of the other rows."""
    columns = sorted({c for order, _ in wanted.values() for c in (order.value, order.id) if c})
    keys = df.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        searches, n = _search(keys, wanted)
    finally:
        keys.unpersist()
    return {name: [s.found for s in group] for name, group in searches.items()}, n


def ntile_starts(k: int):
    """First rank of tiles 2 to k (SQL NTILE: the first ``n mod k`` tiles hold one row more)."""
    def starts(n: int) -> list[int]:
        base, more = divmod(n, k)
        return [1 + tile * base + min(tile, more) for tile in range(1, min(k, n))]
    return starts


def qcut_starts(k: int):
    """First rank of buckets 2 to k of pandas ``qcut(rank(method="first"), k)``: a rank is in bucket
    b or above where ``k * (rank - 1) > (b - 1) * (n - 1)``."""
    def starts(n: int) -> list[int]:
        return [(bucket - 1) * (n - 1) // k + 2 for bucket in range(2, k + 1)] if n > 1 else []
    return starts


def linear_quantiles(df: DataFrame, columns: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles of several columns (numpy default, ``quantile_cont``)."""
    rows = {}

    def ranks(column, probs):
        def of(n: int) -> list[int]:
            rows[column] = n
            places = [p * (n - 1) for p in probs] if n else []
            return [r for at in places for r in (int(at) + 1, min(int(at) + 1, n - 1) + 1)]
        return of
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    found, _ = rows_at(doubles, {c: (Order(c), ranks(c, probs)) for c, probs in columns.items()})
    out = {}
    for c, probs in columns.items():
        values = [value for value, _ in found[c]]
        out[c] = [None] * len(probs) if not values else [
            low + (high - low) * (p * (rows[c] - 1) - int(p * (rows[c] - 1)))
            for p, low, high in zip(probs, values[::2], values[1::2])]
    return out
