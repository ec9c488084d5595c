"""Document fingerprints by locally consistent parsing.

A text's code points are cut into phrases by deterministic coin tossing: each
symbol is relabelled by the lowest bit in which it differs from its left
neighbour, twice more on the labels, and phrases begin at local maxima of the
last labels. A phrase's name is a hash of its symbols, the names are the next
level's symbols. Where a phrase begins depends on a few neighbours only, so
equal substrings get equal phrase names in their interior at any offset, in
any text, without a shared dictionary. Runs of one symbol are named first.

The fingerprint keeps, for each of ``BINS`` bins, 16 bits of the smallest
name among the phrases of levels 2 and up that fall in the bin: its likeness
to another estimates the share of common phrases. All arrays run over a block
of documents; a document's result depends on its own text only."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 64
#: code points that are parsed together
BLOCK = 1_000_000
#: levels whose phrases enter the fingerprint (a phrase spans about 3 ** level code points)
LEVELS = (2, 3, 4)
EMPTY = "-" * (4 * BINS)

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (in place where possible)."""
    x = x ^ (x >> _U(32))
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


def _toss_table(labels: int) -> np.ndarray:
    """New label by (left << 8 | own): twice the lowest differing bit, plus
    the own bit there."""
    left, own = np.meshgrid(np.arange(labels), np.arange(labels), indexing="ij")
    diff = left ^ own
    low = np.zeros_like(diff)
    for bit in reversed(range(8)):
        low[(diff >> bit & 1) == 1] = bit
    table = np.zeros((labels, 256), np.uint8)
    table[:, :labels] = 2 * low + (own >> low & 1)
    return table.ravel()


_TABLE = _toss_table(256)
_WEIGHTS = _mix(np.arange(1, 4097, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)


def _low_bit(x: np.ndarray) -> np.ndarray:
    """Index of the lowest set bit of nonzero numbers."""
    return (np.frexp((x & (~x + _U(1))).astype(np.float64))[1] - 1).astype(np.uint8)


def _labels(sym: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels of symbols whose neighbours differ; ``first``: where documents
    begin (their first symbol is tossed against its complement)."""
    left = np.empty_like(sym)
    left[1:] = sym[:-1]
    left[first] = ~sym[first]
    bit = _low_bit(left ^ sym)
    lab = (bit << 1) | ((sym >> bit.astype(np.uint64)).astype(np.uint8) & np.uint8(1))
    for _ in range(2):
        pair = np.empty(len(lab), np.uint16)
        pair[1:] = lab[:-1].astype(np.uint16) << 8
        pair[first] = (lab[first] ^ np.uint8(1)).astype(np.uint16) << 8
        lab = _TABLE[pair | lab]
    return lab


def _level(sym: np.ndarray, doc: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One level of the hierarchy: names and documents of its phrases, and
    phrases per document (documents without symbols stay without)."""
    new_doc = np.empty(len(sym), bool)
    new_doc[0] = True
    new_doc[1:] = doc[1:] != doc[:-1]
    # runs of one symbol become one symbol
    keep = new_doc.copy()
    keep[1:] |= sym[1:] != sym[:-1]
    if not keep.all():
        at = np.flatnonzero(keep)
        run = np.diff(np.append(at, len(sym))).astype(np.uint64)
        sym, doc, new_doc = sym[at], doc[at], new_doc[at]
        long = run > 1
        sym[long] = _mix(sym[long] * _U(3) + run[long] * _U(0xA0761D6478BD642F))
        # a renamed run equals a neighbour with a chance of 2 ** -64; nudge it apart
        same = np.flatnonzero((sym[1:] == sym[:-1]) & ~new_doc[1:]) + 1
        sym[same] += _U(1)
    first = np.flatnonzero(new_doc)
    lab = _labels(sym, first)
    begin = np.zeros(len(sym), bool)
    if len(sym) > 2:
        begin[1:-1] = (lab[1:-1] > lab[:-2]) & (lab[1:-1] >= lab[2:])
        begin[first[1:] - 1] = False  # a last symbol has no right neighbour to beat
    begin |= new_doc
    starts = np.flatnonzero(begin)
    length = np.diff(np.append(starts, len(sym)))
    inside = np.arange(len(sym)) - np.repeat(starts, length)
    names = _mix(np.add.reduceat(_mix(sym) * _WEIGHTS[np.minimum(inside, len(_WEIGHTS) - 1)], starts))
    docs = doc[starts]
    return names, docs, np.bincount(docs, minlength=len(sizes))


def phrases(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(level, document number, phrase name) arrays, level 1 and up, in text
    order. A document that is one phrase at a level stays one above it."""
    sizes = np.array([len(t) for t in texts], np.int64)
    sym = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    for level in range(1, max(LEVELS) + 1):
        if not len(sym):
            return
        sym, doc, sizes = _level(sym, doc, sizes)
        yield level, doc, sym


def sketches(texts: list[str]) -> np.ndarray:
    """One row of ``BINS`` numbers per text: 16 bits and one, 0 for an empty
    bin."""
    best = np.full(len(texts) * BINS, np.iinfo(np.uint64).max, np.uint64)
    for level, doc, name in phrases(texts):
        if level in LEVELS:
            at = doc * BINS + (name >> _U(58)).astype(np.int64)
            np.minimum.at(best, at, name & _U((1 << 58) - 1))
    empty = best == np.iinfo(np.uint64).max
    out = (_mix(best) >> _U(48)).astype(np.int32) + 1
    out[empty] = 0
    return out.reshape(len(texts), BINS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bins among those filled in either row; 1 for two empty
    fingerprints."""
    either = ((a > 0) | (b > 0)).sum(1)
    same = ((a == b) & (a > 0)).sum(1)
    return np.where(either == 0, 1.0, same / np.maximum(either, 1))


def render(rows: np.ndarray) -> list[str]:
    """Fingerprints as text: four hex digits a bin, dashes where empty."""
    if not len(rows):
        return []
    flat = (np.maximum(rows, 1) - 1).astype(">u2").tobytes().hex()
    out = [flat[i:i + 4 * BINS] for i in range(0, len(flat), 4 * BINS)]
    for n, k in zip(*np.nonzero(rows == 0), strict=True):
        out[n] = f"{out[n][:4 * k]}----{out[n][4 * k + 4:]}"
    return out


def blocks(texts: list[str]) -> Iterator[slice]:
    """Consecutive slices of about ``BLOCK`` code points."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t)
        if chars >= BLOCK:
            yield slice(start, i + 1)
            start, chars = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def sketch_all(texts: list[str]) -> np.ndarray:
    parts = [sketches(texts[s]) for s in blocks(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, BINS), np.int32)


# -------------------------------------------------------------------- Spark

def fingerprint(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_chars``, ``fingerprint`` of every row. Null text: empty
    (all dashes); equal texts have equal fingerprints; repeated rows and null
    keys stay; other columns are ignored."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["_text"].fillna("").tolist()
            yield pd.DataFrame({"_key": batch["_key"], "n_chars": [len(t) for t in texts],
                                "fingerprint": render(sketch_all(texts))})

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInPandas(
        run, f"_key {kind}, n_chars bigint, fingerprint string")
    return out.withColumnRenamed("_key", key)


def _bounds(df: DataFrame, key: str, rows: int) -> tuple[list, bool]:
    """(existing keys at which ranges of about ``rows`` rows begin, whether
    null keys exist). A sample of keys by hash, eight a range; at most 2 ** 16
    ranges, so the driver gets a bounded number of keys."""
    total, least, nulls = df.agg(F.count("*"), F.min(key), F.count_if(F.col(key).isNull())).first()
    if least is None:
        return [], nulls > 0
    ranges = min(max(1, total // rows), 1 << 16)
    step = max(1, total // (8 * ranges))
    some = df.select(key).where((F.pmod(F.xxhash64(key), F.lit(step)) == 0) & F.col(key).isNotNull()).distinct()
    some = sorted(r[0] for r in some.collect())[8::8]
    return sorted({least, *some}), nulls > 0


def compare_next(df: DataFrame, key: str = "doc_id", text: str = "text", rows: int = 512) -> DataFrame:
    """Per row, in ascending ``key`` order: ``n_chars``, the sha-256 of the
    edited text (last quarter replaced by the first code points of the next
    row's text; after the last row comes the first), both fingerprints, the
    likeness to the edited text (``near_edited``) and to the next row
    (``near_next``).

    Null text: empty. Equal keys are ordered by text; null keys come first.
    One row is its own next; an empty table gives an empty result; other
    columns are ignored.

    Rows are dealt by key ranges that begin at existing keys; each text is
    shuffled once, and only a range's first key goes to the range before it
    as well (``_guest``). A task streams its sorted ranges, so its memory
    does not depend on their size."""
    bounds, nulls = _bounds(df, key, rows)
    n_ranges = max(1, len(bounds))
    kind = df.schema[key].dataType

    @F.pandas_udf("array<int>")
    def places(keys: pd.Series) -> pd.Series:
        """The range of a key; for a range's first key, the range before too."""
        null = keys.isna().to_numpy()
        out = []
        at = np.zeros(len(keys), np.int64)
        if bounds:
            known = keys[~null].to_numpy()
            at[~null] = np.maximum(np.searchsorted(np.array(bounds, known.dtype), known, "right") - 1, 0)
        for k, p, is_null in zip(keys, at.tolist(), null.tolist(), strict=True):
            begins = is_null or (bool(bounds) and k == bounds[p] and not (p == 0 and nulls))
            out.append([p, (p - 1) % n_ranges] if begins else [p])
        return pd.Series(out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left: pd.DataFrame | None = None  # the last row, whose next is to come
        for batch in batches:
            if left is not None:
                batch = pd.concat([left, batch], ignore_index=True)
            left = batch.iloc[-1:]
            texts = batch["_text"].tolist()
            part, guest = batch["_part"].to_numpy(), batch["_guest"].to_numpy()
            mine = np.flatnonzero((part[1:] == part[:-1]) & ~guest[:-1])
            yield from compare(batch["_key"], texts, mine)

    def compare(keys: pd.Series, texts: list[str], mine: np.ndarray) -> Iterator[pd.DataFrame]:
        for s in blocks([texts[i] for i in mine]):
            at = mine[s]
            lo, hi = int(at[0]), int(at[-1]) + 2
            own = sketch_all(texts[lo:hi])
            edited = []
            for i in at.tolist():
                cut = len(texts[i]) // 4
                edited.append(texts[i][:len(texts[i]) - cut] + texts[i + 1][:cut])
            other = sketch_all(edited)
            a, b = own[at - lo], own[at - lo + 1]
            yield pd.DataFrame({
                "_key": keys.iloc[at], "n_chars": [len(texts[i]) for i in at.tolist()],
                "edited_sha256": [hashlib.sha256(e.encode()).hexdigest() for e in edited],
                "fingerprint": render(a), "edited_fingerprint": render(other),
                "near_edited": likeness(a, other), "near_next": likeness(a, b)})

    dealt = df.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text")).withColumn(
        "_places", places("_key")).select("_key", "_text", F.posexplode("_places").alias("_nth", "_part")).withColumn(
        "_guest", F.col("_nth") > 0).drop("_nth")
    dealt = dealt.repartition("_part").sortWithinPartitions("_part", "_guest", "_key", "_text")
    out = dealt.mapInPandas(run, f"_key {kind.simpleString()}, n_chars bigint, edited_sha256 string, fingerprint string,"
                                 " edited_fingerprint string, near_edited double, near_next double")
    return out.withColumnRenamed("_key", key)
