"""BPE encoding and decoding through a minimal acyclic transducer.

1. Frequent words (space-delimited, counted over all documents by lossy
   counting: a block reports words of at least half the wanted share, the
   reports are summed, so every word of the wanted share is found and at most
   2 / share words remain - a proven bound).
2. The driver compiles them with their ids into a minimal acyclic automaton:
   equal suffixes share states, arcs carry additive outputs that sum to the
   number of the word, and that number points to its ids.
3. The automaton is sent with ``addFile``; every worker maps it into memory
   and looks up the distinct words of a batch together. Words not in it are
   merged exactly, so the result never depends on the lexicon."""

from __future__ import annotations

import atexit
import hashlib
import os
import shutil
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe

#: text characters whose words are looked up together
BLOCK_CHARS = 4_000_000


# ---------------------------------------------------------------- automaton

def compile_lexicon(words: dict[bytes, list[int]]) -> dict[str, np.ndarray]:
    """Minimal acyclic transducer of ``words``, as arrays: ``keys`` sorted
    (state << 8 | byte), ``to``, ``out`` per arc, ``final`` per state, ``at``
    and ``ids`` (ids of word number k: ids[at[k]:at[k+1]]). State 0 starts."""
    register: dict[tuple, int] = {}
    arcs_of: list[tuple] = []
    final_of: list[bool] = []

    def settle(node: list) -> int:
        """State of a finished node; an equal one is reused."""
        shape = (node[1], tuple(node[0]))
        if shape not in register:
            register[shape] = len(arcs_of)
            arcs_of.append(shape[1])
            final_of.append(node[1])
        return register[shape]

    order = sorted(words)
    path: list[list] = [[[], False]]  # [arcs (byte, state), final] on the last word's path
    last = b""
    for word in [*order, None]:
        keep = 0 if word is None else len(os.path.commonprefix([last, word]))
        while len(path) - 1 > keep:
            node = path.pop()
            path[-1][0].append((last[len(path) - 1], settle(node)))
        if word is None:
            break
        path += [[[], False] for _ in word[keep:]]
        path[-1][1] = True
        last = word
    root = settle(path[0])

    below = [0] * len(arcs_of)  # words from a state; targets are settled first
    for s, arcs in enumerate(arcs_of):
        below[s] = final_of[s] + sum(below[t] for _, t in arcs)
    name = {s: (0 if s == root else s + 1) for s in range(len(arcs_of))}
    rows = []
    for s, arcs in enumerate(arcs_of):
        before = int(final_of[s])
        for byte, t in arcs:
            rows.append((name[s] << 8 | byte, name[t], before))
            before += below[t]
    rows.sort()
    final = np.zeros(len(arcs_of) + 1, bool)
    for s, f in enumerate(final_of):
        final[name[s]] = f
    keys, to, out = (np.array([r[i] for r in rows], np.int64) for i in range(3))
    lengths = [len(words[w]) for w in order]
    return {"keys": keys, "to": to, "out": out, "final": final,
            "at": np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
            "ids": np.array([i for w in order for i in words[w]], np.int32)}


def save(lexicon: dict[str, np.ndarray], path: str) -> None:
    """One file: names, types and lengths in a text line, then the arrays."""
    with open(path, "wb") as f:
        head = ";".join(f"{k},{v.dtype.str},{len(v)}" for k, v in lexicon.items())
        f.write(head.encode().ljust(512))
        for v in lexicon.values():
            f.write(v.tobytes().ljust(-(-v.nbytes // 8) * 8, b"\0"))


def load(path: str) -> dict[str, np.ndarray]:
    """The arrays of a saved automaton, mapped, not read."""
    raw = np.memmap(path, np.uint8, "r")
    out, at = {}, 512
    for part in raw[:512].tobytes().decode().strip().split(";"):
        name, kind, n = part.split(",")
        size = np.dtype(kind).itemsize * int(n)
        out[name] = raw[at:at + size].view(kind)
        at += -(-size // 8) * 8
    return out


def look_up(lexicon: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """Numbers of ``words`` in the lexicon, -1 where not in it; all words
    walk the automaton together, one byte a step."""
    number = np.full(len(words), -1, np.int64)
    keys, to, out, final = (lexicon[k] for k in ("keys", "to", "out", "final"))
    if not len(keys) or not words:
        return number
    lengths = np.array([len(w) for w in words])
    order = np.argsort(-lengths, kind="stable")
    flat = np.frombuffer(b"".join(words), np.uint8)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])[order]
    left = lengths[order]
    state, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    alive = np.flatnonzero(left > 0)
    for step in range(int(left.max())):
        alive = alive[left[alive] > step]
        want = state[alive] << 8 | flat[starts[alive] + step]
        at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        hit = keys[at] == want
        state[alive[~hit]] = -1
        alive, at = alive[hit], at[hit]
        state[alive] = to[at]
        total[alive] += out[at]
        if not len(alive):
            break
    good = (state > 0) & (left > 0)
    good[good] = final[state[good]]
    number[order[good]] = total[good]
    return number


# -------------------------------------------------------------------- Spark

def frequent_words(df: DataFrame, text: str, path: str, share: float) -> list[str]:
    """Every space-delimited word that makes up at least ``share`` of all
    words, and at most 2 / ``share`` words in all. Counts cover all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe.load(path)
        seen: Counter = Counter()
        chars = 0

        def report():
            total = sum(seen.values())
            some = [(w, n) for w, n in seen.items() if n >= share / 2 * total and len(w) <= bpe.MEMO_CHARS]
            some.append((None, total))
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())],
                ["word", "n"])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                words = b.words(t) if t else None
                if words:
                    seen.update(words[1:])
                    chars += len(t)
                if chars > 8 * BLOCK_CHARS:  # a block ends: its memory is bounded
                    yield report()
                    seen, chars = Counter(), 0
        if seen:
            yield report()

    counts = df.select(text).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = counts.persist()
    try:
        total = counts.where("word is null").agg(F.sum("n")).first()[0] or 0
        rows = counts.where(F.col("word").isNotNull() & (F.col("n") >= share / 2 * total)).collect()
    finally:
        counts.unpersist()
    return sorted(r.word for r in rows)


class Coder:
    """Encodes texts in a worker: (count, ids joined by commas, bytes)."""

    def __init__(self, path: str, lexicon: dict[str, np.ndarray]):
        self.bpe, self.lexicon = bpe.load(path), lexicon
        self.memo: dict[str, tuple[int, str, bytes]] = {}

    def _value(self, ids: list[int]) -> tuple[int, str, bytes]:
        return len(ids), ",".join(map(str, ids)), b"".join(map(self.bpe.table.__getitem__, ids))

    def _learn(self, words: list[str]) -> None:
        """Values of words that stand after a space."""
        number = look_up(self.lexicon, [w.encode() for w in words]).tolist()
        at, ids = self.lexicon["at"], self.lexicon["ids"]
        for w, k in zip(words, number, strict=True):
            self.memo[w] = self._value(ids[at[k]:at[k + 1]].tolist() if k >= 0 else self.bpe.word(" " + w))

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Per text: token count, ids as text, decoded text."""
        out, parts, chars = [], [], 0
        for t in [*texts, None]:
            if t is not None:
                parts.append((t, self.bpe.words(t)))
                chars += len(t)
            if parts and (t is None or chars > BLOCK_CHARS):
                fresh = set().union(*(w[1:] for _, w in parts if w)) - self.memo.keys()
                self._learn(list(fresh))
                out += [self._one(*p) for p in parts]
                parts, chars = [], 0
                if len(self.memo) > bpe.MEMO_ENTRIES:
                    self.memo.clear()
        return out

    def _one(self, text: str, words: list[str] | None) -> tuple[int, str, str]:
        if words is None:
            n, ids, raw = self._value(self.bpe.ids(text))
        else:
            got = [self._value(self.bpe.word(words[0]))] if words[0] else []
            got += map(self.memo.__getitem__, words[1:])
            counts, ids, raw = zip(*got, strict=True) if got else ((), (), ())
            n, ids, raw = sum(counts), ",".join(ids), b"".join(raw)
        return n, ids, raw.decode("utf-8", "replace")


def encode_decode(df: DataFrame, path: str, share: float = 5e-5, key: str = "doc_id", text: str = "text",
                  digests: bool = True) -> DataFrame:
    """Encode every text with the byte-level BPE file at ``path`` and decode
    the ids again. ``digests``: ``n_tokens``, ``ids_sha256`` (decimal ids
    joined by commas), ``decoded_sha256``; else ``n_tokens``, ``ids``
    array<int>, ``decoded``.

    A null text counts as empty (0 tokens, digests of the empty string);
    repeated rows give repeated results; an empty table an empty one; other
    columns are ignored. ``share``: words of at least this share of all words
    enter the lexicon, at most 2 / ``share`` words."""
    spark = df.sparkSession
    b = bpe.load(path)
    words = frequent_words(df, text, path, share)
    lexicon = compile_lexicon({w.encode(): b.word(" " + w) for w in words if w})
    name = f"lexicon-{hashlib.sha256(repr((path, words)).encode()).hexdigest()[:24]}.bin"
    if name not in (os.path.basename(f) for f in spark.sparkContext.listFiles):
        folder = tempfile.mkdtemp()  # the driver's own: it serves the file to executors, new ones too
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        save(lexicon, os.path.join(folder, name))
        spark.sparkContext.addFile(os.path.join(folder, name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(path, load(SparkFiles.get(name)))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            got = coder.encode([t or "" for t in batch.column(1).to_pylist()])
            if digests:
                cols = [pa.array([sha(g[1]) for g in got]), pa.array([sha(g[2]) for g in got])]
                names = ["ids_sha256", "decoded_sha256"]
            else:
                cols = [pa.array([[int(i) for i in g[1].split(",")] if g[1] else [] for g in got], pa.list_(pa.int32())),
                        pa.array([g[2] for g in got], pa.string())]
                names = ["ids", "decoded"]
            cols = [c.cast(pa.string()) if digests else c for c in cols]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.int64()), *cols], [key, "n_tokens", *names])

    kind = df.schema[key].dataType.simpleString()
    tail = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens bigint, {tail}")
