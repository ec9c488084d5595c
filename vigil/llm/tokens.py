"""Token counts by whole-token shortcut.

Offline, every vocabulary string is encoded alone by its merges; those that
come back as one token (and are one pre-token of the split pattern) are
proven. Counting then takes a proven pre-token as 1 and merges only the
rest. The proven set is bounded by the vocabulary and is broadcast."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from . import bpe


def proven(path: str) -> tuple[frozenset[str], dict[str, int]]:
    """(strings that are one token alone, token counts of the vocabulary's
    single pre-tokens that are not)."""
    import regex

    b = bpe.load(path)
    one = regex.compile(bpe.PATTERN)
    good, bad = set(), {}
    for raw in b.ranks:
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            continue
        if one.fullmatch(text) and one.match(text).end() == len(text):
            n = len(b.merge(raw))
            if n == 1:
                good.add(text)
            else:
                bad[text] = n
    return frozenset(good), bad


class Counter:
    def __init__(self, path: str, good, bad):
        import regex

        self.bpe, self.good, self.bad = bpe.load(path), good, bad
        self.find = regex.compile(bpe.PATTERN).findall
        self.rest = bpe.Memo(self._rest)
        self.memo = bpe.Memo(lambda w: self._word(" " + w))

    def _rest(self, piece: str) -> int:
        return self.bad.get(piece) or len(self.bpe.word(piece))

    def _word(self, text: str) -> int:
        return sum(1 if p in self.good else self.rest[p] for p in self.find(text))

    def count(self, text: str) -> int:
        words = self.bpe.words(text)
        if words is None:
            return self._word(text) if self.bpe.plain(text) else len(self.bpe.ids(text))
        return (self._word(words[0]) if words[0] else 0) + sum(map(self.memo.__getitem__, words[1:]))


def count_tokens(df: DataFrame, path: str, limit: int = 512, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``
    (more than ``limit`` tokens).

    A null text counts as empty (0 bytes, 0 tokens); null keys and repeated
    rows are kept as they are; an empty table gives an empty result; other
    columns are ignored. One narrow scan, no shuffle; a worker keeps a
    bounded memo of words."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(proven(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, *shared.value)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for t in batch.column(1).to_pylist():
                t = t or ""
                n_bytes.append(len(t.encode()))
                n_tokens.append(counter.count(t))
            counter.memo.trim()
            counter.rest.trim()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_())],
                [key, "n_bytes", "n_tokens", "over_limit"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
