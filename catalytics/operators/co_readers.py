"""Recommendations over co-readers, by blocks of users.

A path (u, T, co, t) leads from a user over a table T that somebody else reads
as well to a table t of that co-reader. There are far more paths than edges or
results, so no path row is ever shuffled: the asking users are dealt into
blocks, and the task of a block joins and sums.

Up to ``HELD_EDGES`` edges in all, the edges are written once, packed by reader
and by table (``packed``), and the task of each block reads that table and sums
one user after the other (``_Held``). Nothing is sent to blocks, so what is
written follows the edges, whatever the number of blocks.

With more edges each co-reader's edges are sent only to the blocks that hold
somebody to pair with. A block's rows arrive sorted: first the edges of its own
users, then the edges of one co-reader after the other. Only one reader is held
at a time; what stays is the block's own edges and its sums, 12 bytes for each
of its users and each table that can be recommended (``_Block``). The block
size follows from that bound."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalytics.plans import spread, written

#: Sums (users x tables) that one block holds, and the most users in a block.
BLOCK_SUMS, BLOCK_USERS = 8_000_000, 512
#: Edges that a task may hold (about 15 bytes each, as much again while it reads
#: them), users of a block that holds them, the blocks that are made for parallel
#: work if users are few, and the most blocks, each of which is a scan in the plan.
HELD_EDGES, HELD_USERS, HELD_BLOCKS, MOST_BLOCKS = 40_000_000, 16_384, 24, 128
#: About the most edges in a packed row.
LIST_EDGES = 1024


def dense_ids(rows: DataFrame, key: str, out: str) -> DataFrame:
    """``rows`` with the number ``out`` = 0, 1, 2, ... in the order of ``key``.
    Range partitions are numbered by themselves and then by their counts (one
    row a partition), so no task sees all rows."""
    place = F.monotonically_increasing_id()
    ordered = written(rows.repartitionByRange(key).sortWithinPartitions(key).withColumn("__m", place), "dense-ids")
    ordered = ordered.withColumn("__p", F.shiftright("__m", 33))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    base = ordered.groupBy("__p").agg(F.count(F.lit(1)).alias("__n")).select(
        "__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.join(base, "__p").withColumn(out, F.col("__base") + inside).drop("__m", "__p", "__base")


class _Block:
    """Sums of one block of users: ``readers`` and ``total`` by (user, table)."""

    def __init__(self, users: int, tables: int):
        self.readers, self.total = np.zeros((users, tables), np.int32), np.zeros((users, tables), np.int64)
        self.own: list[tuple] = []
        self.by_table: np.ndarray | None = None

    def add_own(self, user: int, slot: int, t: np.ndarray, k: np.ndarray) -> None:
        self.own.append((user, slot, t, k))

    def _index(self) -> None:
        t = np.concatenate([x[2] for x in self.own])
        order = np.argsort(t, kind="stable")
        self.by_table = t[order]
        self.k = np.concatenate([x[3] for x in self.own])[order]
        self.slot = np.repeat([x[1] for x in self.own], [len(x[2]) for x in self.own])[order]
        self.slot_of = {x[0]: x[1] for x in self.own}

    def add_co_reader(self, co: int, t: np.ndarray, e: np.ndarray, k: np.ndarray, rc: np.ndarray) -> None:
        if self.by_table is None:
            self._index()
        lo = np.searchsorted(self.by_table, t, "left")
        n = np.searchsorted(self.by_table, t, "right") - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())  # own edges on tables that co reads
        slot, via = self.slot[at], np.repeat(np.arange(len(t)), n)
        if (me := self.slot_of.get(co)) is not None:
            slot, via, at = (x[slot != me] for x in (slot, via, at))
        size = len(self.readers)
        shared = np.bincount(slot, minlength=size)
        users = np.flatnonzero(shared)
        can = np.flatnonzero(e >= 0)
        if not len(users) or not len(can):
            return
        both = self.k[at] * k[via]
        weight = np.zeros(size, np.int64)
        np.add.at(weight, slot, both)
        step = max(1, BLOCK_SUMS // len(users))
        for part in (can[i:i + step] for i in range(0, len(can), step)):
            cells = np.ix_(users, e[part])
            self.readers[cells] += 1
            self.total[cells] += weight[users][:, None] * rc[part]
        # no path leads over t to t itself
        back = e[via] >= 0
        slot, via, both = slot[back], via[back], both[back]
        self.total[slot, e[via]] -= both * rc[via]
        self.readers[slot, e[via]] -= shared[slot] == 1

    def best(self, n: int, least: int) -> Iterator[tuple]:
        """(user, table, readers, total, rank): the first ``n`` of each user by
        readers * ln(total), ties by table number."""
        for user, slot, *_ in self.own:
            can, readers, total = _first(n, least, np.arange(self.readers.shape[1]), self.readers[slot], self.total[slot])
            yield from zip([user] * len(can), can, readers, total, range(1, len(can) + 1))


def _places(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo[0], lo[0] + 1, ..., n[0] of them, then n[1] from lo[1], and so on."""
    n = n.astype(np.int64)
    return np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


def _lists(pieces: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(first place, number, columns) by key, of pieces (keys, sizes, columns)
    in which key ``keys[i]`` has the next ``sizes[i]`` values."""
    columns = [[*c] for c in zip(*pieces)]
    pieces.clear()
    for i, c in enumerate(columns):  # one after the other, so that one column is held twice
        columns[i] = np.concatenate(c)
        c.clear()
    keys, sizes, *values = columns
    start = np.cumsum(sizes, dtype=np.int64) - sizes
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.diff(keys[order], prepend=-1))
    if len(first) < len(keys):  # a long list came in several pieces
        at = _places(start[order], sizes[order])
        values = [c[at] for c in values]
        keys, sizes = keys[order][first], np.add.reduceat(sizes[order], first)
        start = np.cumsum(sizes, dtype=np.int64) - sizes
    lo, n = np.zeros(keys.max() + 1, np.int64), np.zeros(keys.max() + 1, np.int32)
    lo[keys], n[keys] = start, sizes
    return lo, n, values


class _Held:
    """All edges, by reader and by table; tables below ``n_tables`` can be
    recommended."""

    def __init__(self, by_reader: list[list[np.ndarray]], by_table: list[list[np.ndarray]], n_tables: int):
        self.lo, self.n, (self.t, self.k, self.rc) = _lists(by_reader)
        self.t_lo, self.t_n, (self.t_u, self.t_k) = _lists(by_table)
        self.n_tables = n_tables
        # what a co-reader recommends: its edges with tables that can be
        can = self.t < n_tables
        before = np.zeros(len(can) + 1, np.int32)
        np.cumsum(can, out=before[1:])
        self.can_lo = before[self.lo].astype(np.int64)
        self.can_n = before[self.lo + self.n] - before[self.lo]
        self.can_t, self.can_rc = self.t[can], self.rc[can]
        # sum of reads of the paths from a table to itself, per edge of the user
        self.back = np.zeros(len(self.t_lo), np.int64)
        for i in range(0, len(self.t), 1 << 20):
            part = slice(i, i + (1 << 20))
            np.add.at(self.back, self.t[part].astype(np.int64), self.k[part].astype(np.int64) * self.rc[part])
        self.count, self.slot = np.zeros(n_tables, np.int64), np.zeros(n_tables, np.int64)

    def sums(self, user: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tables, readers, totals) of one user: the tables with ``least``
        readers or more."""
        own = slice(self.lo[user], self.lo[user] + self.n[user])
        t, k = self.t[own], self.k[own].astype(np.int64)
        n = self.t_n[t]
        via = _places(self.t_lo[t], n)  # co-readers' edges on the user's tables
        mine, co = np.repeat(np.arange(len(t)), n), self.t_u[via]
        other = co != user
        via, mine, co = via[other], mine[other], co[other]
        rows, at, shared = np.unique(co, return_inverse=True, return_counts=True)
        weight = np.zeros(len(rows), np.int64)
        np.add.at(weight, at, k[mine] * self.t_k[via])
        edges = _places(self.can_lo[rows], self.can_n[rows])
        cells = self.can_t[edges].astype(np.int64)
        np.add.at(self.count, cells, 1)
        # no path leads over t to t itself: a table on which the user met the co-reader
        back = np.flatnonzero(t < self.n_tables)
        self.count[t[back]] -= np.bincount(mine[shared[at] == 1], minlength=len(t))[back]
        found = np.flatnonzero(self.count[cells] >= max(1, least))
        places = cells[found]
        self.slot[places] = np.arange(len(places))
        tables = places[self.slot[places] == np.arange(len(places))]
        self.slot[tables] = np.arange(len(tables))
        readers = self.count[tables]
        total = np.zeros(len(tables), np.int64)
        via_co = np.repeat(np.arange(len(rows)), self.can_n[rows])[found]
        np.add.at(total, self.slot[places], weight[via_co] * self.can_rc[edges[found]])
        back = back[self.count[t[back]] >= max(1, least)]
        mine_rc = self.rc[own][back].astype(np.int64)
        total[self.slot[t[back]]] -= k[back] * (self.back[t[back]] - k[back] * mine_rc)
        self.count[cells] = 0
        return tables, readers, total


def _first(n: int, least: int, tables: np.ndarray, readers: np.ndarray, total: np.ndarray) -> tuple[list, list, list]:
    """The first ``n`` by readers * ln(total), ties by table number."""
    keep = readers >= max(1, least)
    tables, readers, total = tables[keep], readers[keep], total[keep]
    with np.errstate(divide="ignore"):
        score = readers * np.log(total)
    if len(tables) > n:
        keep = score >= np.partition(score, -n)[-n]
        tables, readers, total, score = tables[keep], readers[keep], total[keep], score[keep]
    order = np.lexsort((tables, -score))[:n]
    return tables[order].tolist(), readers[order].tolist(), total[order].tolist()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[np.ndarray]]]:
    """((block, kind, user), columns) of each run of equal keys."""
    key, held = None, []
    for b in batches:
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)]
        if not len(cols[0]):
            continue
        change = np.flatnonzero(np.any([np.diff(c) != 0 for c in cols[:3]], axis=0)) + 1
        for lo, hi in zip([0, *change.tolist()], [*change.tolist(), len(cols[0])]):
            now = tuple(int(c[lo]) for c in cols[:3])
            if now != key and held:
                yield key, [np.concatenate(x) for x in zip(*held)]
                held = []
            key = now
            held.append([c[lo:hi] for c in cols[3:]])
    if held:
        yield key, [np.concatenate(x) for x in zip(*held)]


def co_reader_tops(reads: DataFrame, n: int, min_readers: int, users: DataFrame | None = None,
                   block_sums: int = BLOCK_SUMS, block_users: int = BLOCK_USERS,
                   held_edges: int = HELD_EDGES) -> DataFrame:
    """(user_key, table_key, co_readers, total_co_reads, rank): for each user
    (of ``users``, if given) the ``n`` best tables of its co-readers. Several
    READ edges of one user and table are as many paths but one reader."""
    edges = written(reads.groupBy("user_key", "table_key").agg(
        F.count(F.lit(1)).alias("k"), F.coalesce(F.sum("read_count"), F.lit(0)).cast("long").alias("rc")), "co-edges")
    readers = edges.groupBy("table_key").agg(F.count(F.lit(1)).alias("__readers"))
    tables = written(readers, "co-tables")
    # exact prune: a table has no more co-readers than readers; the others, which
    # are only met on, are numbered -1, -2, ...
    enough = F.col("__readers") >= min_readers
    can = written(dense_ids(tables.where(enough).select("table_key"), "table_key", "e"), "co-candidates")
    rest = dense_ids(tables.where(~enough).select("table_key"), "table_key", "e").withColumn("e", -1 - F.col("e"))
    people = written(dense_ids(edges.select("user_key").distinct(), "user_key", "u"), "co-users")
    asking = people if users is None else people.join(users.select("user_key").distinct(), "user_key", "left_semi")
    asking = written(dense_ids(asking, "user_key", "a"), "co-asking")
    e = written(edges.join(spread(people), "user_key").join(spread(can.unionByName(rest)), "table_key")
                .select("u", F.col("e").cast("long").alias("e"), "k", "rc"), "co-reads")
    n_tables, n_asking, n_edges = can.count(), asking.count(), e.count()
    if n_edges <= held_edges:
        top = _held_tops(e, asking, n_tables, n_asking, n, min_readers)
    else:
        top = _streamed_tops(e, asking, n_tables, n_asking, n, min_readers, block_sums, block_users)
    return top.join(people, "u").join(can.select("e", "table_key"), "e") \
        .select("user_key", "table_key", "co_readers", "total_co_reads", "rank")


TOPS = "u long, e long, co_readers long, total_co_reads long, rank long"


def _batch(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                      ["u", "e", "co_readers", "total_co_reads", "rank"])


def packed(rows: DataFrame, kind: int, key: str, kinds: dict[str, np.dtype], list_edges: int) -> DataFrame:
    """``rows`` in rows of about ``list_edges``: bytes of the keys, of the number
    of rows of each and of the columns named by ``kinds``. The rows of a key
    follow each other; only a key with more of them is in several rows."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def row(key: np.ndarray, *columns: np.ndarray) -> list:
            first = np.flatnonzero(np.diff(key, prepend=-1))
            sizes = np.diff(first, append=len(key)).astype(np.int32)
            return [kind, key[first].astype(np.int32).tobytes(), sizes.tobytes(),
                    *[c.astype(t).tobytes() for c, t in zip(columns, kinds.values())], *[None] * (3 - len(kinds))]

        def batch(found: list[list]) -> pa.RecordBatch:
            types = [pa.int32(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], ["kind", "keys", "sizes", "a", "b", "c"])

        for b in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            held = [np.concatenate(c) for c in zip(held, columns)] if held else columns
            found = []
            starts = np.flatnonzero(np.diff(held[0], prepend=-1))
            at = 0
            while len(held[0]) - at >= list_edges:
                # up to the last key that begins within reach, or a piece of a longer list
                i = np.searchsorted(starts, at + list_edges, "right") - 1
                end = starts[i] if starts[i] > at else at + list_edges
                found.append(row(*[c[at:end] for c in held]))
                at = end
            held = [c[at:] for c in held]
            if found:
                yield batch(found)
        if held and len(held[0]):
            yield batch([row(*held)])

    return rows.select(key, *kinds).repartition(key).sortWithinPartitions(key).mapInArrow(
        pack, "kind int, keys binary, sizes binary, a binary, b binary, c binary")


def _unpacked(column: pa.Array, kind: np.dtype) -> np.ndarray:
    """The values of all rows of a column of ``packed``, one after the other."""
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].copy().view(kind)


def _held_tops(e: DataFrame, asking: DataFrame, n_tables: int, n_asking: int, n: int, min_readers: int,
               list_edges: int = LIST_EDGES) -> DataFrame:
    """Blocks that hold all edges. Packed rows of kind 0 are the edges by
    reader, of kind 1 by table, of kind 2 the users by block."""
    size = max(1, min(HELD_USERS, -(-n_asking // HELD_BLOCKS)), -(-n_asking // MOST_BLOCKS))
    blocks = max(1, -(-n_asking // size))
    most = e.agg(F.max("k"), F.min("rc"), F.max("rc")).first()
    number = np.dtype(np.int32)
    k_kind = np.min_scalar_type(most[0] or 0)
    rc_kind = np.result_type(np.min_scalar_type(most[1] or 0), np.min_scalar_type(most[2] or 0))
    if rc_kind.kind == "f":  # of values below 0 and beyond the signed numbers
        rc_kind = np.dtype(np.int64)
    kinds = [[number, k_kind, rc_kind], [number, k_kind], [number]]
    # one number a table: candidates first, the others behind them
    x = e.withColumn("x", F.when(F.col("e") >= 0, F.col("e")).otherwise(n_tables - 1 - F.col("e")))
    block = F.floor(F.col("a") / size).alias("block")
    parts = [packed(x, 0, "u", dict(zip(["x", "k", "rc"], kinds[0])), list_edges),
             packed(x, 1, "x", dict(zip(["u", "k"], kinds[1])), list_edges),
             packed(asking.select(block, "u"), 2, "block", {"u": number}, list_edges)]
    lists = written(reduce(DataFrame.unionByName, parts), "co-lists")

    def read(i: int) -> DataFrame:
        return lists.coalesce(1).select(F.lit(i).alias("block"), "*")

    # each block's task reads all lists. A union of single partitions only would
    # be merged to one partition, so there is one more part, without rows
    none = lists.where(F.col("kind") < 0).select(F.lit(-1).alias("block"), "*")
    rows = reduce(DataFrame.unionByName, [none, *map(read, range(blocks))])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[list[list[np.ndarray]]] = [[], [], []]
        at = None
        for b in batches:
            kind = b.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(kind)) + 1).tolist(), len(kind)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                part, now = b.slice(lo, hi - lo), int(kind[lo])
                at = part.column(0)[0].as_py()
                pieces[now].append([_unpacked(part.column(i + 2), t) for i, t in enumerate([number, number, *kinds[now]])])
        if not all(pieces):
            return
        users = np.concatenate([u[np.repeat(keys, sizes) == at] for keys, sizes, u in pieces[2]])
        edges = _Held(*pieces[:2], n_tables)
        found: list[tuple] = []
        for user in users[users < len(edges.lo)].tolist():
            best = _first(n, min_readers, *edges.sums(user, min_readers))
            found += zip([user] * len(best[0]), *best, range(1, len(best[0]) + 1))
            if len(found) > 10_000:
                yield _batch(found)
                found = []
        yield _batch(found)

    return rows.mapInArrow(total, TOPS)


def _streamed_tops(e: DataFrame, asking: DataFrame, n_tables: int, n_asking: int, n: int, min_readers: int,
                   block_sums: int, block_users: int) -> DataFrame:
    """Blocks that hold their sums and one co-reader at a time."""
    size = max(1, min(block_users, block_sums // max(1, n_tables)))
    blocks = max(1, -(-n_asking // size))

    e = e.withColumn("t", F.col("e"))
    block = F.floor(F.col("a") / size).cast("int").alias("block")
    own = e.join(asking.select("u", block, (F.col("a") % size).alias("slot")), "u")
    pairs = own.select("block", "t").distinct().join(e.select("t", "u"), "t").select("block", "u").distinct()
    sent = pairs.join(e, "u").select("block", F.lit(1).alias("kind"), "u", F.lit(0).cast("long").alias("slot"), "t", "e", "k", "rc")
    rows = own.select("block", F.lit(0).alias("kind"), "u", "slot", "t", "e", "k", "rc").unionByName(sent)
    rows = rows.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "kind", "u")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tops(sums: _Block) -> pa.RecordBatch:
            return _batch(list(sums.best(n, min_readers)))

        at, sums = None, None
        for (block, kind, user), (slot, t, e, k, rc) in _runs(batches):
            if block != at:
                if sums is not None:
                    yield tops(sums)
                at, sums = block, _Block(size, n_tables)
            if kind == 0:
                sums.add_own(user, int(slot[0]), t, k)
            else:
                sums.add_co_reader(user, t, e, k, rc)
        if sums is not None:
            yield tops(sums)

    return rows.mapInArrow(total, TOPS)
