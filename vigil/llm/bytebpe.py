"""Byte-level BPE over ``.tiktoken`` rank files by padded numpy matrices.

A text is cut by the split pattern. A pre-token that is itself in the file
has that id (the rule of such files); the others become rows of byte ids,
padded to the width of their length bucket. Each round every row merges its
leftmost pair of least rank: an argmin along the rows finds it, the row loses
one cell, so the whole matrix is one column narrower; only the two pairs
beside the merge are looked up again, in an open-addressing hash table of all
pairs that the file can merge. Rows without a pair left are taken out
(compaction) and the rest goes on.

Pre-tokens of more than ``LONG`` bytes, whose rounds would cost the square of
their length, are merged with a heap; the result is the same.

Ids of a pre-token are kept in a bounded memo of the worker. The file is read
where it lies, the path is a parameter."""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed value: the usual split pattern, for texts of ASCII characters alone.
ASCII_PATTERN = re.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+""", re.ASCII)
UNICODE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: longest pre-token in bytes that goes through the matrices
LONG = 2048
#: upper widths of the length buckets
WIDTHS = (2, 3, 4, 5, 6, 8, 10, 12, 16, 24, 32, 64, 128, 256, 512, 1024, LONG)
#: cells of one matrix
CELLS = 1 << 20
#: characters that are cut at a time, pre-tokens of one text at a time
BLOCK_CHARS, BLOCK_PIECES = 2_000_000, 200_000
#: longest pre-token that is kept, and entries kept by a worker
MEMO_CHARS, MEMO_ENTRIES = 48, 400_000

NONE = np.int32(2**31 - 1)


class PairTable:
    """(left id, right id) -> rank, by open addressing with linear steps."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        ranks = np.fromiter(pairs.values(), np.int32, len(pairs))
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys, self.ranks = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int32)
        at, rest = self._slot(keys), np.arange(len(keys))
        while len(rest):
            slots, first = np.unique(at[rest], return_index=True)
            free = self.keys[slots] == -1
            placed = rest[first[free]]
            self.keys[slots[free]], self.ranks[slots[free]] = keys[placed], ranks[placed]
            rest = np.setdiff1d(rest, placed, assume_unique=True)
            at[rest] = (at[rest] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, ``NONE`` where they do not merge; ids below 0 are
        padding."""
        out = np.full(left.shape, NONE, np.int32)
        real = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left.reshape(-1)[real].astype(np.int64) << 32 | right.reshape(-1)[real].astype(np.int64)
        flat, at = out.reshape(-1), self._slot(keys)
        while len(real):
            found = self.keys[at]
            hit = found == keys
            flat[real[hit]] = self.ranks[at[hit]]
            on = ~hit & (found != -1)
            real, keys, at = real[on], keys[on], (at[on] + 1) & (len(self.keys) - 1)
        return out


def merge_rows(ids: np.ndarray, table: PairTable) -> list[np.ndarray]:
    """Merged ids of every row of ``ids`` (int32, padded with -1 on the
    right)."""
    out: list[np.ndarray] = [ids[:0]] * len(ids)
    ids, who = ids.copy(), np.arange(len(ids))
    ranks = table.look_up(ids[:, :-1], ids[:, 1:])
    while True:
        n, width = ids.shape
        best = ranks.argmin(1) if width > 1 else np.zeros(n, np.int64)
        least = ranks[np.arange(n), best] if width > 1 else np.full(n, NONE)
        done = least == NONE
        if done.any():
            sizes = (ids[done] >= 0).sum(1)
            for w, row, size in zip(who[done], ids[done], sizes, strict=True):
                out[w] = row[:size].copy()
            on = ~done
            ids, who, ranks, best, least = ids[on], who[on], ranks[on], best[on], least[on]
            n = len(ids)
        if not n:
            return out
        row, cols = np.arange(n), np.arange(width)
        ids[row, best] = least
        ids = ids[cols[None, :] != (best + 1)[:, None]].reshape(n, width - 1)
        ranks = ranks[cols[None, :-1] != best[:, None]].reshape(n, width - 2)
        for side in (best - 1, best):  # the pairs that the merge has changed
            at = np.flatnonzero((side >= 0) & (side < width - 2))
            if len(at):
                ranks[at, side[at]] = table.look_up(ids[at, side[at]], ids[at, side[at] + 1])


def merge_long(ids: list[int], pairs: dict[tuple[int, int], int]) -> list[int]:
    """The same merges for one long row: a heap of (rank, place) over a
    linked list."""
    ids, n = list(ids), len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, a, b) for i, (a, b) in enumerate(itertools.pairwise(ids)) if (r := pairs.get((a, b))) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue  # one of the two has merged since
        ids[i], ids[j], after[i] = rank, -1, after[j]
        if after[i] < n:
            before[after[i]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right < n and (r := pairs.get((ids[left], ids[right]))) is not None:
                heapq.heappush(heap, (r, left, ids[left], ids[right]))
    return [x for x in ids if x >= 0]


class Ranks:
    """One rank file, ready to encode and decode."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.table = {r: t for t, r in self.ranks.items()}
        self.letters = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        get = self.ranks.get
        self.pairs = {(a, b): r for t, r in self.ranks.items() for i in range(1, len(t))
                      if (a := get(t[:i])) is not None and (b := get(t[i:])) is not None}
        self.hashed = PairTable(self.pairs)
        self.usual = pattern == UNICODE_PATTERN
        self.pattern = regex.compile(pattern)
        self.strange = _strange(pattern)
        self.far = re.compile(f"[{re.escape(min(self.strange, default=chr(sys.maxunicode)))}-{chr(sys.maxunicode)}]")
        self.memo: dict[str, tuple[int, str, bytes]] = {"": (0, "", b"")}

    def cut(self, text: str) -> Iterator[str]:
        """Pre-tokens of ``text``."""
        if self.usual and text.isascii():
            return (m[0] for m in ASCII_PATTERN.finditer(text))
        if self.odd(text):
            plain = text.translate(dict.fromkeys(map(ord, self.strange), "\uffff"))  # same places, the other class
            return (text[m.start():m.end()] for m in self.pattern.finditer(plain))
        return (m[0] for m in self.pattern.finditer(text))

    def cut_all(self, text: str) -> list[str]:
        if self.usual and text.isascii():
            return ASCII_PATTERN.findall(text)
        return list(self.cut(text)) if self.odd(text) else self.pattern.findall(text)

    def odd(self, text: str) -> bool:
        """Whether it holds characters that the two Unicode tables class apart."""
        return not self.strange.isdisjoint(self.far.findall(text))

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of pre-tokens."""
        out: list[list[int]] = [[]] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if (r := self.ranks.get(p)) is not None:
                out[i] = [r]
            elif len(p) > LONG:
                out[i] = merge_long(self.letters[np.frombuffer(p, np.uint8)].tolist(), self.pairs)
            elif p:
                buckets.setdefault(next(w for w in WIDTHS if w >= len(p)), []).append(i)
        for width, who in buckets.items():
            step = max(1, CELLS // width)
            for lo in range(0, len(who), step):
                some = who[lo:lo + step]
                size = np.array([len(pieces[i]) for i in some])
                filled = np.arange(width)[None, :] < size[:, None]
                ids = np.full(filled.shape, -1, np.int32)
                ids[filled] = self.letters[np.frombuffer(b"".join(pieces[i] for i in some), np.uint8)]
                for i, row in zip(some, merge_rows(ids, self.hashed), strict=True):
                    out[i] = row.tolist()
        return out

    def learn(self, pieces: Iterable[str]) -> dict[str, tuple[int, str, bytes]]:
        """(count, ids as text, decoded bytes) of pre-tokens that the memo
        lacks; all but long ones enter it."""
        fresh = list(pieces)
        got, more = self.encode_pieces([p.encode() for p in fresh]), {}
        for p, ids in zip(fresh, got, strict=True):
            value = (len(ids), ",".join(map(str, ids)), b"".join(map(self.table.__getitem__, ids)))
            (self.memo if len(p) <= MEMO_CHARS else more)[p] = value
        return more

    def _values(self, pieces: list[str], more: dict) -> list[tuple[int, str, bytes]]:
        memo = self.memo
        try:
            return [memo[p] for p in pieces]
        except KeyError:
            return [memo[p] if p in memo else more[p] for p in pieces]

    def results(self, texts: list[str]) -> Iterator[Result]:
        """One result per text, in order; a block of texts is cut, its new
        pre-tokens merged together; a text beyond the block goes on its own,
        in stretches."""
        block, chars = [], 0
        for text in [*texts, None]:
            if text is None or chars + len(text) > BLOCK_CHARS:
                cut = [self.cut_all(t) for t in block]
                more = self.learn(set().union(*cut) - self.memo.keys())
                for pieces in cut:
                    one = Result()
                    one.add(self._values(pieces, more))
                    yield one
                block, chars = [], 0
                if len(self.memo) > MEMO_ENTRIES:
                    self.memo = {"": self.memo[""]}
            if text is not None and len(text) > BLOCK_CHARS:
                one, pieces = Result(), self.cut(text)
                while some := list(itertools.islice(pieces, BLOCK_PIECES)):
                    more = self.learn(set(some) - self.memo.keys())
                    one.add(self._values(some, more))
                    if len(self.memo) > MEMO_ENTRIES:
                        self.memo = {"": self.memo[""]}
                yield one
            elif text is not None:
                block.append(text)
                chars += len(text)


class Result:
    """Count, ids and decoded bytes of one text, as digests or in full."""

    def __init__(self):
        self.n, self.ids, self.raw = 0, [], []

    def add(self, values: list[tuple[int, str, bytes]]) -> None:
        if values:
            n, ids, raw = zip(*values, strict=True)
            self.n += sum(n)
            self.ids.append(",".join(ids))
            self.raw.append(b"".join(raw))

    def digests(self) -> tuple[str, str]:
        ids, raw = hashlib.sha256(), hashlib.sha256()
        for k, (a, b) in enumerate(zip(self.ids, self.raw, strict=True)):
            ids.update(("," * (k > 0) + a).encode())
            raw.update(b)
        return ids.hexdigest(), raw.hexdigest()

    def numbers(self) -> list[int]:
        return [int(x) for part in self.ids for x in part.split(",")]


@functools.lru_cache(maxsize=2)
def _strange(pattern: str) -> frozenset[str]:
    """Characters that are letters or numbers in the ``regex`` module's
    Unicode tables but not yet in those of ``tiktoken``. Candidates are those
    that Python's tables do not know; each is asked for with a vocabulary in
    which a letter (number) and a following ``a`` (``1``) need one id less."""
    import regex
    import tiktoken

    every = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, sys.maxunicode + 1))))
    doubt = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {bytes([b, ord(x)]): 256 + 64 * n + b - 128 for n, x in enumerate("a1") for b in range(128, 192)}
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    alone = lambda c, x: len(probe.encode_ordinary(c + x)) > len(c.encode())
    return frozenset(c for c in doubt if alone(c, "a") and alone(c, "1"))


@functools.lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Ranks:
    return Ranks(path, pattern)


def encode_decode(df: DataFrame, path: str, pattern: str = UNICODE_PATTERN, key: str = "doc_id", text: str = "text",
                  digests: bool = True) -> DataFrame:
    """Encode every text with the ranks at ``path``, each match of
    ``pattern`` separately and without special tokens, and decode the ids.
    ``digests``: ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas),
    ``decoded_sha256`` (of the bytes); else ``n_tokens``, ``ids`` array<int>,
    ``decoded`` binary.

    A null text counts as empty (0 tokens, digests of nothing); null and
    repeated keys, and repeated rows, give one result a row; an empty table an
    empty one; other columns are ignored, whatever their names. Long texts are
    cut and hashed in stretches."""
    kind = df.schema[key].dataType.simpleString()
    names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
    kinds = [pa.string(), pa.string()] if digests else [pa.list_(pa.int32()), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path, pattern)
        for batch in batches:
            counts, cols = [], ([], [])
            for r in coder.results([t or "" for t in batch.column(1).to_pylist()]):
                counts.append(r.n)
                for col, x in zip(cols, r.digests() if digests else (r.numbers(), b"".join(r.raw)), strict=True):
                    col.append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), *map(pa.array, cols, kinds)], [key, "n_tokens", *names])

    tail = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded binary"
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens bigint, {tail}")
