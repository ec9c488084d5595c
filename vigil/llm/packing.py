"""Best-fit packing by swap-based local search.

Pieces are dealt at random to shards of bounded size; each shard places its
pieces best-fit, then improves: it takes the emptiest underfull bins and
moves a document, exchanges one for one or two for one with fuller bins, each
time increasing the sum of squared fills, until bins empty. Full bins are
done; the pieces of all others are pooled, dealt anew to fewer shards and
packed again, until one shard holds the pool or a round gains nothing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .shared import checkpoint

#: pieces per shard: bounds the memory and time of a task
SHARD = 8192


# ------------------------------------------------------------- local search

class Bins:
    """Bins of one shard: items are numbers, sizes are given."""

    def __init__(self, sizes: list[int], capacity: int):
        self.size, self.cap = sizes, capacity
        self.items: list[set[int]] = []
        self.fill: list[int] = []
        self.where = [-1] * len(sizes)
        self.free: list[set[int]] = [set() for _ in range(capacity + 1)]  # bins by free space
        # underfull bins' items by (free space + own size): what fits in their place
        self.reach: list[set[int]] = [set() for _ in range(capacity + 1)]

    def _unlist(self, b: int) -> None:
        room = self.cap - self.fill[b]
        self.free[room].discard(b)
        for i in self.items[b]:
            self.reach[room + self.size[i]].discard(i)

    def _list(self, b: int) -> None:
        room = self.cap - self.fill[b]
        if room and self.items[b]:
            self.free[room].add(b)
            for i in self.items[b]:
                self.reach[room + self.size[i]].add(i)

    def shift(self, out: list[int], a: int, back: list[int], b: int) -> None:
        """Items ``out`` go from bin a to bin b, ``back`` from b to a."""
        for x in (a, b):
            if x >= 0:
                self._unlist(x)
        for moved, src, dst in ((out, a, b), (back, b, a)):
            for i in moved:
                if src >= 0:
                    self.items[src].discard(i)
                    self.fill[src] -= self.size[i]
                if dst >= 0:
                    self.items[dst].add(i)
                    self.fill[dst] += self.size[i]
                self.where[i] = dst
        for x in (a, b):
            if x >= 0:
                self._list(x)

    def best_fit(self) -> None:
        """Largest first, each to the fullest bin with room."""
        room_of = np.zeros(self.cap + 1, np.int64)  # bins by free space, to search quickly
        for i in sorted(range(len(self.size)), key=lambda i: (-self.size[i], i)):
            s = self.size[i]
            fits = np.flatnonzero(room_of[s:])
            if len(fits):
                room = s + int(fits[0])
                b = min(self.free[room])
                room_of[room] -= 1
            else:
                b = len(self.items)
                self.items.append(set())
                self.fill.append(0)
            self.shift([i], -1, [], b)
            if self.cap - self.fill[b]:
                room_of[self.cap - self.fill[b]] += 1

    def _target(self, x: int, a: int, least: int) -> tuple[list[int], int] | None:
        """Where size x of bin a can go, or be exchanged for a smaller item:
        (items that come back, bin). The tightest place is taken, within a
        bin at least as full as a, and the exchange must leave a emptier by
        ``least``."""
        for room in range(x, self.cap + 1):
            for b in self.free[room]:
                if b != a and self.fill[b] >= self.fill[a]:
                    return [], b
            for i in self.reach[room]:
                b = self.where[i]
                if b != a and self.size[i] <= x - least and self.fill[b] >= self.fill[a]:
                    return [i], b
            if room - x > self.cap >> 3:
                return None
        return None

    def improve(self, rounds: int = 4) -> None:
        """Each step raises the sum of squared fills (a fuller bin gains what
        an emptier one loses), so the search ends; ``rounds`` bounds it."""
        for _ in range(rounds):
            steps = 0
            for a in sorted((b for b in range(len(self.items)) if 0 < self.fill[b] < self.cap),
                            key=lambda b: (self.fill[b], b)):
                steps += self._empty(a)
            if not steps:
                break

    def _empty(self, a: int) -> int:
        steps = 0
        while self.items[a] and self.fill[a] < self.cap and steps < 64:
            mine = sorted(self.items[a], key=lambda i: (-self.size[i], i))
            options = [[i] for i in mine] + [[i, j] for n, i in enumerate(mine[:8]) for j in mine[n + 1:8]]
            for out in options:
                x = sum(self.size[i] for i in out)
                found = self._target(x, a, 1) if x <= self.cap else None
                if found:
                    self.shift(out, a, *found)
                    steps += 1
                    break
            else:
                break
        return steps


def pack_sizes(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each size; bins are numbered from 0 without gaps."""
    bins = Bins(sizes, capacity)
    bins.best_fit()
    bins.improve()
    number: dict[int, int] = {}
    at: dict[int, int] = {}
    out, offsets = [], []
    for i, s in enumerate(sizes):
        b = number.setdefault(bins.where[i], len(number))
        out.append(b)
        offsets.append(at.get(b, 0))
        at[b] = offsets[-1] + s
    return out, offsets


# -------------------------------------------------------------------- Spark

def pieces(df: DataFrame, path: str, capacity: int, end_id: int, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """Token pieces of every text: ``key``, ``piece``, ``start``, ``length``,
    ``ids_crc32``. A document is its ids and ``end_id``; only longer ones are
    cut, the first piece takes the remainder. Null text: empty (one piece of
    one token)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe.load(path)
        raw = lambda ids: np.array(ids, "<u4").tobytes()
        memo = bpe.Memo(lambda w: raw(b.word(" " + w)))
        end = raw([end_id])
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            keep = []
            for n, t in enumerate(batch.column(1).to_pylist()):
                words = b.words(t) if t else None
                if words is None:
                    ids = raw(b.ids(t or "")) + end
                else:
                    ids = b"".join([raw(b.word(words[0])) if words[0] else b"",
                                    *map(memo.__getitem__, words[1:]), end])
                total = len(ids) // 4
                first = total if total <= capacity else total % capacity or capacity
                ends = [first, *range(first + capacity, total + 1, capacity)]
                view = memoryview(ids)
                for p, e in enumerate(ends):
                    s = ends[p - 1] if p else 0
                    keep.append(n)
                    for column, value in zip(rows, (p, s, e - s, zlib.crc32(view[4 * s:4 * e])), strict=False):
                        column.append(value)
            memo.trim()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(rows[0], pa.int32()),
                 *(pa.array(r, pa.int64()) for r in rows[1:4])], [key, "piece", "start", "length", "ids_crc32"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(items: DataFrame, capacity: int, length: str = "length", shard: int = SHARD) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: every row in one
    sequence of at most ``capacity``, gapless from 0.

    Lengths must lie in 1..capacity. All columns pass through (earlier
    columns named ``sequence_id``, ``offset`` are replaced); equal rows are
    packed each for itself; an empty table gives an empty one. Sequence
    numbers are unique, not dense. Full rows take no part in the search."""
    items = items.drop("sequence_id", "offset", "_bin", "_shard")
    names = items.columns
    items = checkpoint(items.withColumn("_bin", F.monotonically_increasing_id()))
    done = [items.where(F.col(length) >= capacity).select(
        *names, (F.col("_bin") * 2 + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))]
    pool = items.where(F.col(length) < capacity)
    count = pool.count()
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pool.schema.fields)
    schema += ", _shard bigint, offset bigint, _open boolean"

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = pack_sizes(frame[length].tolist(), capacity)
        frame = frame.copy()
        fills = np.bincount(bins, frame[length].to_numpy())
        frame["_bin"] = np.array(bins, np.int64)
        frame["offset"] = offsets
        frame["_open"] = fills[bins] < capacity
        return frame

    turn = 0
    while count:
        turn += 1
        shards = -(-count // shard)
        dealt = pool.withColumn("_shard", F.pmod(F.xxhash64("_bin", F.lit(turn)), F.lit(shards)))
        # a name for each row that the next turn can deal by
        placed = checkpoint(dealt.groupBy("_shard").applyInPandas(place, schema))
        number = (F.col("_shard") * (2 * shard) + F.col("_bin")) * 128 + F.lit(2 * turn)
        cols = [*names, number.alias("sequence_id"), "offset"]
        left = placed.where("_open").count()
        if shards == 1 or left > 0.9 * count or turn == 63:
            done.append(placed.select(*cols))
            break
        done.append(placed.where("not _open").select(*cols))
        pool = placed.where("_open").drop("_shard", "offset", "_open").withColumn(
            "_bin", F.monotonically_increasing_id())
        count = left
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
