"""Language identification: script ranges narrow the candidates, then Viterbi
over per-word scores with a switching penalty labels the spans of a text.

Learning counts hashed letter trigrams (with word edges) and scripts by
language over all training rows, in Spark; the driver gets the summed counts
(languages x buckets). Prediction scores words by trigram log likelihoods,
rules out languages that are not written in the word's script, and lets the
Viterbi path choose; all arrays run over a block of texts."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: code points that are scored together
BLOCK = 1_000_000
BUCKETS = 1 << 15
#: texts whose Viterbi paths are walked together
SLICE = 2000
#: nats that a change of language costs
SWITCH = 12.0
#: a language is a candidate for a script that holds this share of its letters
SCRIPT_SHARE = 0.01

# First and last code points of scripts (letters outside count as "other").
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x06FF), ("arabic", 0x0750, 0x077F), ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF), ("tamil", 0x0B80, 0x0BFF), ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
)
SCRIPT_NAMES = ("none", "other", *dict.fromkeys(s for s, _, _ in SCRIPTS))


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: script of a letter (0: no letter), lower-case letter."""
    script = np.zeros(0x110000, np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            script[i] = 1
            low = c.lower()
            if len(low) == 1:
                lower[i] = ord(low)
    for name, a, b in SCRIPTS:
        part = script[a:b + 1]
        part[part > 0] = SCRIPT_NAMES.index(name)
    return script, lower


class Words:
    """The words of a block of texts: runs of letters of one script."""

    def __init__(self, texts: list[str]):
        script_of, lower = tables()
        sizes = np.array([len(t) for t in texts], np.int64)
        cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        scripts = script_of[np.minimum(cp, 0x10FFFF)]
        at = np.flatnonzero(scripts)
        doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)[at]
        begin = np.ones(len(at), bool)
        if len(at):
            begin[1:] = (np.diff(at) > 1) | (doc[1:] != doc[:-1]) | (scripts[at[1:]] != scripts[at[:-1]])
        cur = lower[cp[at]].astype(np.uint64)
        end = np.append(begin[1:], True)[:len(at)]
        prev, nxt = np.zeros_like(cur), np.zeros_like(cur)
        prev[1:], nxt[:-1] = cur[:-1], cur[1:]
        prev[begin], nxt[end] = 0, 0
        mixed = (prev * np.uint64(0x9E3779B97F4A7C15) + cur * np.uint64(0xC2B2AE3D27D4EB4F)
                 + nxt * np.uint64(0x165667B19E3779F9))
        self.gram = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                     >> np.uint64(64 - 15)).astype(np.int32)
        self.starts = np.flatnonzero(begin)
        self.doc = doc[self.starts]
        self.letter_doc = doc
        self.script = scripts[at[self.starts]] if len(at) else np.zeros(0, np.uint8)
        self.letter_script = scripts[at]
        self.length = np.diff(np.append(self.starts, len(at)))
        origin = (np.cumsum(sizes) - sizes)[self.doc]
        self.first = at[self.starts] - origin  # code point offsets in the text
        self.last = self.first + self.length


def blocks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    start, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t)
        if chars >= BLOCK or i == len(texts) - 1:
            yield start, texts[start:i + 1]
            start, chars = i + 1, 0


# -------------------------------------------------------------------- model

class Model:
    """Languages, trigram log likelihoods (bucket, language) and whether a
    language is a candidate for a script."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.langs = sorted(counts)
        grams = np.array([counts[x][:BUCKETS] for x in self.langs], np.float64).reshape(len(self.langs), BUCKETS)
        smooth = 0.1
        self.logp = np.log((grams + smooth) / (grams.sum(1, keepdims=True) + smooth * BUCKETS)).T.astype(np.float32)
        scripts = np.array([counts[x][BUCKETS:] for x in self.langs], np.float64)
        self.allowed = (scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)).T.copy() \
            if self.langs else np.zeros((len(SCRIPT_NAMES), 0), bool)
        self.allowed[~self.allowed.any(1)] = True  # a script never seen rules nothing out

    def scores(self, w: Words) -> np.ndarray:
        """Log likelihood per word and language; ruled-out ones far below."""
        if not len(w.starts):
            return np.zeros((0, len(self.langs)), np.float32)
        s = np.add.reduceat(self.logp[w.gram], w.starts, axis=0)
        return np.where(self.allowed[w.script], s, s - np.float32(1e4))


def viterbi(scores: np.ndarray, doc: np.ndarray, n_docs: int, switch: float) -> np.ndarray:
    """Best language of every word; the texts walk together, the longest
    first, so a step costs what is still open. Ties stay with the current
    language, then the first."""
    words = np.bincount(doc, minlength=n_docs)
    order = np.argsort(-words, kind="stable")
    counts, begin = words[order], (np.cumsum(words) - words)[order]
    longest = int(counts[0]) if n_docs else 0
    if not longest:
        return np.zeros(0, np.int64)
    open_at = np.searchsorted(-counts, -np.arange(1, longest + 1), "right")  # texts with more than t words
    stay = np.zeros(scores.shape, bool)
    came = np.zeros(len(scores), np.int16)
    value = np.zeros((n_docs, scores.shape[1]), np.float64)
    for t, n in enumerate(open_at.tolist()):
        at = begin[:n] + t
        if t:
            v = value[:n]
            top = v.argmax(1)
            change = v[np.arange(n), top][:, None] - switch
            stay[at] = v >= change
            came[at] = top
            value[:n] = np.maximum(v, change)
        value[:n] += scores[at]
    out = np.zeros(len(scores), np.int64)
    state = value.argmax(1)
    for t in range(longest - 1, -1, -1):
        n = int(open_at[t])
        at = begin[:n] + t
        out[at] = state[:n]
        if t:
            state[:n] = np.where(stay[at, state[:n]], state[:n], came[at])
    return out


# -------------------------------------------------------------------- Spark

def learn(df: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts over all rows of ``df`` with a text and a language. The driver
    gets languages x (2 ** 15 + scripts) sums."""
    size = BUCKETS + len(SCRIPT_NAMES)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}

        def rows():
            for name, c in held.items():
                at = np.flatnonzero(c)
                yield pd.DataFrame({"lang": name, "bucket": at.astype(np.int32), "n": c[at]})
            held.clear()

        for batch in batches:
            for name, texts in batch.groupby("_lang")["_text"]:
                for _, some in blocks(texts.tolist()):
                    w = Words(some)
                    c = held.setdefault(name, np.zeros(size, np.int64))
                    c[:BUCKETS] += np.bincount(w.gram, minlength=BUCKETS)
                    c[BUCKETS:] += np.bincount(w.letter_script, minlength=len(SCRIPT_NAMES))
            if len(held) > 64:
                yield from rows()
        yield from rows()

    source = df.select(F.col(text).alias("_text"), F.col(lang).cast("string").alias("_lang")).dropna()
    sums = source.mapInPandas(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n"))
    counts: dict[str, np.ndarray] = {}
    for name, part in sums.toPandas().groupby("lang"):
        counts[name] = np.zeros(size, np.int64)
        counts[name][part["bucket"]] = part["n"]
    return Model(counts)


def identify(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", switch: float = SWITCH,
             carry: tuple[Column, ...] = (), keep_text: str | None = None) -> DataFrame:
    """Per row: ``key``, ``lang_pred`` (the language with most letters on the
    Viterbi path; ``und`` for a null text, one without letters, or a model
    without languages), ``score`` (its share of the letters, 0 to 1) and
    ``spans``: array of struct (start, stop, lang), code points, from the
    first to the last word of every stretch of one language.

    Ties go to the first language by name. Rows are independent: repeated
    rows and null keys stay; an empty table gives an empty one. ``carry``:
    columns to pass along, by their aliases; ``keep_text``: name under which
    the text passes along."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)
    source = df.select(F.col(key).alias("_key"), *carry, F.col(text).alias(keep_text or "_text"))
    kept = [f for f in source.schema.fields if f.name != "_text"]
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())]))

    def label(m: Model, texts: list[str]) -> tuple[list, list, list]:
        """(languages, scores, spans) of some texts."""
        n_langs = len(m.langs)
        parts = []
        for start, some in blocks(texts):
            w = Words(some)
            parts.append((m.scores(w), w.doc + start, w.length, w.first, w.last))
        scores, doc, length, first, last = (np.concatenate([p[i] for p in parts]) for i in range(5))
        path = viterbi(scores, doc, len(texts), switch)
        letters = np.bincount(doc * n_langs + path, length, len(texts) * n_langs).reshape(-1, n_langs)
        best, total = letters.argmax(1), letters.sum(1)
        spans: list[list] = [[] for _ in texts]
        if len(doc):
            new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (path[1:] != path[:-1])]))
            end = np.append(new[1:], len(doc)) - 1
            for d, a, b, k in zip(doc[new].tolist(), first[new].tolist(), last[end].tolist(), path[new].tolist(),
                                  strict=True):
                spans[d].append({"start": a, "stop": b, "lang": m.langs[k]})
        share = letters[np.arange(len(texts)), best] / np.maximum(total, 1)
        return np.where(total > 0, np.array(m.langs, object)[best], "und").tolist(), share.tolist(), spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            out: tuple[list, ...] = ([], [], [])
            for lo in range(0, batch.num_rows, SLICE):
                some = [t or "" for t in texts.slice(lo, SLICE).to_pylist()]
                got = label(m, some) if m.langs else (["und"] * len(some), [0.0] * len(some), [[] for _ in some])
                for column, values in zip(out, got, strict=True):
                    column += values
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), pa.array(out[0], pa.string()),
                 pa.array(out[1], pa.float64()), pa.array(out[2], span_type)],
                [*(f.name for f in kept), "lang_pred", "score", "spans"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    out = source.mapInArrow(run, f"{fields}, lang_pred string, score double, "
                                 "spans array<struct<start:bigint,stop:bigint,lang:string>>")
    return out.withColumnRenamed("_key", key)


def held_out(key: str = "doc_id") -> Column:
    """crc32 of the key as text leaves no remainder by 5; a null key is
    neither held out nor learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def learn_from(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """The model of the rows that are not held out."""
    return learn(docs.where(F.col(key).isNotNull() & ~held_out(key)), text, lang)
