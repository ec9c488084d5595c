"""N-gram Jaccard join by a token-group matrix.

1. Every text becomes its set of hashed word shingles; equal sets are one
   (``sid``, a digest of the set).
2. In any order of tokens, a linked set shares one of its first
   n - ceil(t n) + 1 with its partner. So a set with as many tokens that no
   other set holds has no links and leaves; that is nearly all of a corpus.
   The first look counts only the lowest 40 % of the hash values (class A),
   in one exchange of packed arrays; the second, among the sets left, counts
   all tokens, and orders prefixes by rarity.
3. The others are partitioned into groups: sets with one min-hash meet, and
   those that verifiably link with the first one are tied to it. A group is
   what such ties connect.
4. Groups that share prefix tokens form clusters (connected components, in
   Spark); nothing links across clusters, and one that holds a single group
   is done. The others' sets are dealt to chunks of bounded size; every two
   chunks of a cluster meet in a task. There the matrix holds the token union
   of each group; a set opens a group of the other chunk only if the union
   holds enough of its tokens, and only members of opened groups are
   compared. A task returns a forest over groups, never pairs.

No step caps a list: a pair is left out only if a bound excludes it, or if
both sides are known to be connected already."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import checkpoint

#: UTF-8 bytes that are shingled together
BLOCK = 2_000_000
#: share of the hash values that make class A
SHARE_A = 0.4
#: min-hashes that form groups
HASHES = 3
#: sets under one min-hash that one task streams, and rows that ask for one
#: key in a shuffle; more are salted, or their keys (HOT_KEYS at most) broadcast
HOT, HOT_KEYS = 1000, 4096
#: edges that one task contracts
BLOCK_EDGES = 1_000_000
#: sets, and tokens, of a chunk: two chunks are compared in one task
BLOCK_SETS, BLOCK_TOKENS = 512, 400_000

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Byte values (upper case as lower), separators, and an odd base."""
    value = _mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
    value[65:91] = value[97:123]
    gap = np.zeros(256, bool)
    gap[[0x20, *range(0x09, 0x0E)]] = True
    return value, gap, _mix(np.arange(101, 117, dtype=np.uint64)) | _U(1), 0x5851F42D4C957F2D


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = _tables()[3]
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def shingles(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, document numbers) of the distinct word k-shingles of UTF-8
    texts, by document, then hash. A text of fewer words has one: all of it."""
    value, gap, mult, _ = _tables()
    flat = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    gaps = gap[flat]
    edge = np.flatnonzero(gaps[1:] != gaps[:-1]) + 1
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = _powers(max(len(flat), 1 << 21))
    total = np.cumsum(value[flat] * up[:len(flat)])
    word = (total[ends - 1] - total[starts - 1]) * down[starts]
    word = _mix(word + (ends - starts).astype(np.uint64) * _U(0xA0761D6478BD642F))
    offsets = np.cumsum([1] + [len(t) + 1 for t in texts])
    doc = np.searchsorted(offsets, starts, "right") - 1
    n = np.bincount(doc, minlength=len(texts))
    if len(word) >= k:
        h = np.zeros(len(word) - k + 1, np.uint64)
        for j in range(k):
            h += word[j:len(word) - k + 1 + j] * mult[j]
        good = doc[:len(h)] == doc[k - 1:]
        h, d = _mix(h[good]), doc[:len(h)][good]
    else:
        h, d = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        begin = np.cumsum(n) - n
        extra = np.array([n[s] for s in short], np.uint64) * _U(0x9FB21C651E98DF25)
        for j in range(k - 1):
            has = n[short] > j
            extra[has] += word[begin[short[has]] + j] * mult[j]
        h, d = np.concatenate([h, _mix(extra)]), np.concatenate([d, short])
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[keep], d[keep]


def blocks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= BLOCK or i == len(texts) - 1:
            yield start, texts[start:i + 1]
            start, size = i + 1, 0


def sets_of(texts: list[bytes], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By block: first document, hashes, document numbers in the block, set
    sizes and set digests (int64; 0 for an empty set)."""
    for start, some in blocks(texts):
        h, d = shingles(some, k)
        n = np.bincount(d, minlength=len(some))
        digest = np.zeros(len(some), np.uint64)
        np.add.at(digest, d, _mix(h ^ _U(0x2545F4914F6CDD1D)))
        digest = _mix(digest + n.astype(np.uint64) * _U(0xD1342543DE82EF95)) | _U(1)
        yield start, h, d, n, np.where(n > 0, digest, _U(0)).view(np.int64)


_LIMIT_A = _U(int(SHARE_A * 2 ** 64))


def _code(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, 32 more bits) of class A tokens: what frequencies go by."""
    m = _mix(h ^ _U(0x632BE59BD9B4E019))
    return (m >> _U(32)) % _U(buckets), (m & _U(0xFFFFFFFF)).astype(np.uint32)


def links(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted token arrays have Jaccard >= num / den."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if len(small) * den < len(large) * num:
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int((large[at] == small).sum())
    return common * den >= num * (len(a) + len(b) - common)


# -------------------------------------------------------------------- Spark

def _deal(sid: np.ndarray, who: np.ndarray, h: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Tokens ``h`` of sets ``sid[who]``, packed in one row a bucket."""
    bucket, low = _code(h, buckets)
    order = np.lexsort((who, bucket))
    bucket, low, who = bucket[order].astype(np.int64), low[order], who[order]
    cut = np.flatnonzero(np.diff(bucket)) + 1
    rows: tuple[list, ...] = ([], [], [], [])
    for lo, hi in zip(np.append(0, cut), np.append(cut, len(bucket)), strict=True):
        if lo == hi:
            continue
        first = np.flatnonzero(np.append(True, np.diff(who[lo:hi]) != 0))
        rows[0].append(int(bucket[lo]))
        rows[1].append(sid[who[lo:hi][first]].tobytes())
        rows[2].append(np.diff(np.append(first, hi - lo)).astype(np.uint32).tobytes())
        rows[3].append(low[lo:hi].tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[0], pa.int64()), *(pa.array(r, pa.binary()) for r in rows[1:])],
        ["bucket", "sids", "sizes", "tokens"])


_DEALT = "bucket bigint, sids binary, sizes binary, tokens binary"


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin and end."""
    first = np.flatnonzero(np.append(True, x[1:] != x[:-1])[:len(x)])
    return first, np.append(first[1:], len(x))[:len(first)]


def _shared(dealt: DataFrame, buckets: int, detail: bool) -> DataFrame:
    """(sid, held, codes, counts) from dealt tokens: how many tokens of a set
    other sets hold too and, with ``detail``, these tokens and how many sets
    hold each. Both exchanges move packed arrays: tokens to buckets, what is
    found there to ranges of sets."""

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        read = lambda c, t: np.frombuffer(b"".join(frame[c]), t)
        sid = np.repeat(read("sids", np.int64), read("sizes", np.uint32))
        low = read("tokens", np.uint32)
        order = np.lexsort((sid, low))
        sid, low = sid[order], low[order]
        keep = np.ones(len(low), bool)
        keep[1:] = (low[1:] != low[:-1]) | (sid[1:] != sid[:-1])  # copies of a set count once
        sid, low = sid[keep], low[keep]
        first, last = _runs(low)
        each = np.repeat(last - first, last - first)
        many = each > 1
        sid, low, each = sid[many], low[many], each[many].astype(np.uint32)
        span = (sid.view(np.uint64) % _U(buckets)).astype(np.int64)
        order = np.lexsort((sid, span))
        sid, low, each, span = sid[order], low[order], each[order], span[order]
        code = np.int64(frame["bucket"].iloc[0]) << 32 | low.astype(np.int64)
        rows = []
        for lo, hi in zip(*_runs(span), strict=True):
            a, z = _runs(sid[lo:hi])
            rows.append((int(span[lo]), sid[lo:hi][a].tobytes(), (z - a).astype(np.uint32).tobytes(),
                         code[lo:hi].tobytes() if detail else b"", each[lo:hi].tobytes() if detail else b""))
        return pd.DataFrame(rows, columns=["span", "sids", "sizes", "codes", "counts"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        read = lambda c, t: np.frombuffer(b"".join(frame[c]), t)
        sid, size = read("sids", np.int64), read("sizes", np.uint32).astype(np.int64)
        order = np.argsort(sid, kind="stable")
        names, start = np.unique(sid[order], return_index=True)
        out = pd.DataFrame({"sid": names, "held": np.add.reduceat(size[order], start)})
        if not detail:
            return out.assign(codes=b"", counts=b"")
        by = np.argsort(np.repeat(sid, size), kind="stable")
        ends = np.cumsum(out["held"].to_numpy())
        for c, t in (("codes", np.int64), ("counts", np.uint32)):
            x = read(c, t)[by]
            out[c] = [x[e - n:e].tobytes() for e, n in zip(ends, out["held"], strict=True)]
        return out

    found = dealt.groupBy("bucket").applyInPandas(
        count, "span bigint, sids binary, sizes binary, codes binary, counts binary")
    return found.groupBy("span").applyInPandas(merge, "sid bigint, held bigint, codes binary, counts binary")


def _deal_texts(texts: DataFrame, k: int, buckets: int) -> DataFrame:
    """The class A tokens of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, h, d, _, sid in sets_of([t or b"" for t in batch.column(0).to_pylist()], k):
                a = np.flatnonzero(h < _LIMIT_A)
                yield _deal(sid, d[a], h[a], buckets)

    return texts.select(F.col("_text").cast("binary")).mapInArrow(run, _DEALT)


def _deal_sets(sets: DataFrame, buckets: int) -> DataFrame:
    """All tokens of sets (sid, tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [np.frombuffer(t, np.uint64) for t in batch.column(1).to_pylist()]
            if tokens:
                who = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
                yield _deal(batch.column(0).to_numpy(), who, np.concatenate(tokens), buckets)

    return sets.select("sid", "tokens").mapInArrow(run, _DEALT)


def _prefix_size(num: int, den: int) -> Column:
    """n - ceil(n num / den) + 1."""
    return F.expr(f"n - (n * {num} + {den - 1}) div {den} + 1")


def _read_sets(texts: DataFrame, chosen: DataFrame, k: int) -> DataFrame:
    """(sid, tokens) of the ``chosen`` sets (sid, doc), read again from their
    texts. A text is found by its key and its hash, so that a repeated key
    brings no other texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            want = batch["sid"].to_numpy()
            for start, h, _, n, sid in sets_of([bytes(t) if t is not None else b"" for t in batch["_text"]], k):
                ends = np.cumsum(n)
                good = np.flatnonzero(sid == want[start:start + len(n)])
                yield pd.DataFrame({"sid": sid[good], "tokens": [h[ends[i] - n[i]:ends[i]].tobytes() for i in good]})

    joined = texts.join(chosen, texts["_key"].eqNullSafe(chosen["doc._key"]) & (texts["_h"] == chosen["doc._h"])).select(
        F.col("_text").cast("binary").alias("_text"), "sid")
    return joined.mapInPandas(run, "sid bigint, tokens binary").dropDuplicates(["sid"])


def _prefixes(sets: DataFrame, num: int, den: int, buckets: int) -> DataFrame:
    """(sid, u, tokens, prefix, least) of the ``sets`` that may have links
    among each other: ``u`` tokens are in no other set, ``prefix`` holds the
    shared ones among the rarest n - ceil(t n) + 1, ``least`` min-hashes."""
    shared = _shared(_deal_sets(sets, buckets), buckets, detail=True)
    seeds = _mix(np.arange(7001, 7001 + HASHES, dtype=np.uint64))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for sid, tokens, codes, counts in zip(batch["sid"], batch["tokens"], batch["codes"], batch["counts"],
                                                  strict=True):
                mine = np.frombuffer(tokens, np.uint64)
                n = len(mine)
                known = np.frombuffer(codes, np.int64)
                by = np.argsort(known)
                bucket, low = _code(mine, buckets)
                code = bucket.astype(np.int64) << 32 | low.astype(np.int64)
                at = np.minimum(np.searchsorted(known[by], code), len(known) - 1)
                freq = np.where(known[by][at] == code, np.frombuffer(counts, np.uint32)[by][at], 1)
                size, u = n - -(-n * num // den) + 1, int((freq == 1).sum())
                if u < size:
                    rows.append((sid, u, tokens, mine[np.lexsort((mine, freq))[u:size]].view(np.int64).tolist(),
                                 [int(_mix(mine ^ s).min().view(np.int64)) for s in seeds]))
            yield pd.DataFrame(rows, columns=["sid", "u", "tokens", "prefix", "least"])

    return sets.join(shared, "sid").mapInPandas(  # a set that shares nothing has no links
        run, "sid bigint, u int, tokens binary, prefix array<bigint>, least array<bigint>")


def _look_up(rows: DataFrame, key: str, table: DataFrame, total: int) -> DataFrame:
    """``rows`` with the columns that ``table`` (``key``, n: how many rows
    ask for it, ...; keys unique) has under ``key``, null where it has none.
    What many rows ask for is broadcast, at most ``HOT_KEYS`` keys as each
    has its share of ``total`` rows; the others meet by a shuffle, to which
    rows that are served already are spread."""
    limit = max(HOT, total // HOT_KEYS)
    names = [c for c in table.columns if c not in (key, "n")]
    hot = F.broadcast(table.where(F.col("n") > limit).select(F.col(key).alias("_hot"), F.struct(*names).alias("_a")))
    cold = table.where(F.col("n") <= limit).select(F.col(key).alias("_cold"), F.struct(*names).alias("_b"))
    out = rows.join(hot, F.col(key) == F.col("_hot"), "left").withColumn(
        "_at", F.when(F.col("_hot").isNull(), F.col(key)).otherwise(F.xxhash64(F.monotonically_increasing_id())))
    out = out.join(cold, F.col("_at") == F.col("_cold"), "left")
    return out.select(*rows.columns, *(F.when(F.col("_hot").isNotNull(), F.col(f"_a.{c}")).otherwise(
        F.col(f"_b.{c}")).alias(c) for c in names))


def _gather(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(member, head) links: sets that share a min-hash are streamed in order
    of (u, sid), the first is the head: it has the fewest tokens of its own,
    so it lies nearest to the others. A min-hash of more than ``HOT`` sets is
    salted anew for each of the hashes, so salted parts overlap."""
    keys = sets.select("sid", F.posexplode("least").alias("turn", "key"))
    counts = checkpoint(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    asked = _look_up(keys, "key", counts.withColumn("many", F.col("n")), HASHES * sets.count()).where("many > 1")
    asked = asked.groupBy("sid").agg(F.collect_list(F.struct("turn", "key", "many")).alias("keys"))
    dealt = sets.select("sid", "u", "tokens").join(asked, "sid").select("sid", "u", "tokens", F.explode("keys").alias("k"))
    dealt = dealt.select("sid", "u", "tokens", "k.key", F.pmod(
        F.xxhash64("sid", "k.turn"), F.ceil(F.col("k.many") / HOT)).alias("salt"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, head, held = None, 0, None
        for batch in batches:
            out = []
            for sid, tokens, k, s in zip(batch["sid"], batch["tokens"], batch["key"], batch["salt"], strict=True):
                mine = np.frombuffer(tokens, np.uint64)
                if (k, s) != now:
                    now, head, held = (k, s), sid, mine
                elif links(mine, held, num, den):
                    out.append((sid, head))
            yield pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return dealt.repartition("key", "salt").sortWithinPartitions("key", "salt", "u", "sid").select(
        "sid", "tokens", "key", "salt").mapInPandas(run, "a bigint, b bigint")


def _overlap(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of token arrays ``a`` with ``b``."""
    flat = lambda x: (np.repeat(np.arange(len(x)), [len(t) for t in x]), np.concatenate(x))
    (ra, ta), (rb, tb) = flat(a), flat(b)
    both = np.intersect1d(ta, tb)
    out = np.zeros((len(a), len(b)), np.float32)
    ca, cb = np.searchsorted(both, ta), np.searchsorted(both, tb)
    for c, t in ((ca, ta), (cb, tb)):
        if len(both):
            c[c == len(both)] = 0
            c[both[c] != t] = -1
        else:
            c[:] = -1
    width = 4096
    by_a, by_b = np.argsort(ca, kind="stable"), np.argsort(cb, kind="stable")
    for lo in range(0, len(both), width):
        dense = []
        for c, r, by, n in ((ca, ra, by_a, len(a)), (cb, rb, by_b, len(b))):
            at = by[np.searchsorted(c[by], lo):np.searchsorted(c[by], lo + width)]
            m = np.zeros((n, width), np.float32)
            m[r[at], c[at] - lo] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out


def _open_groups(a: pd.DataFrame, b: pd.DataFrame, num: int, den: int) -> list[tuple[int, int]]:
    """Links between different groups of two chunks of sets (a chunk may be
    given twice), as a forest over groups: query sets against group unions
    first, then against the members of the groups that a bound leaves open."""
    ta, tb = ([np.frombuffer(t, np.uint64) for t in x["tokens"]] for x in (a, b))
    na, nb = (np.array([len(t) for t in x]) for x in (ta, tb))
    ga, gb = a["grp"].to_numpy(), b["grp"].to_numpy()
    names, inside = np.unique(gb, return_inverse=True)
    members = [np.flatnonzero(inside == g) for g in range(len(names))]
    unions = [tb[m[0]] if len(m) == 1 else np.unique(np.concatenate([tb[i] for i in m])) for m in members]
    bound = _overlap(ta, unions) * den >= na[:, None] * num  # the union of two sets is at least either
    bound &= ga[:, None] != names[None, :]
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    edges = []
    open_groups = np.flatnonzero(bound.any(0))
    if not len(open_groups):
        return edges
    queries = np.flatnonzero(bound.any(1))
    cols = np.concatenate([members[g] for g in open_groups])
    common = _overlap([ta[i] for i in queries], [tb[j] for j in cols])
    linked = common * den >= num * (na[queries][:, None] + nb[cols][None, :] - common)
    linked &= bound[queries][:, inside[cols]]
    for i, j in zip(*np.nonzero(linked), strict=True):
        x, y = int(ga[queries[i]]), int(gb[cols[j]])
        if find(x) != find(y):
            root[find(x)] = find(y)
            edges.append((x, y))
    return edges


def _compare(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): linked groups, from ``sets`` (sid, grp, tokens, cluster,
    chunks). A cluster's sets are dealt to chunks of bounded size, and every
    two chunks meet in a task of their own, which returns a forest."""
    dealt = sets.withColumn("chunk", F.pmod(F.xxhash64("sid"), F.col("chunks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
    dealt = dealt.select("cluster", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"),
                         "chunk", "grp", "tokens")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = (frame[frame["chunk"] == frame[c].iloc[0]] for c in ("lo", "hi"))
        edges = _open_groups(a, b, num, den) if len(a) and len(b) else []
        return pd.DataFrame(edges, columns=["a", "b"], dtype=np.int64)

    return dealt.groupBy("cluster", "lo", "hi").applyInPandas(run, "a bigint, b bigint")


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root): every node that is not its component's smallest."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(names))
    while True:
        least = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], least)
        np.minimum.at(new, root[y], least)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(root))
    return names[moved], names[root[moved]]


def _contract(edges: DataFrame, tasks: int) -> DataFrame:
    """Edges (a, b) as stars of the components that a task sees: at most
    ``BLOCK_EDGES`` edges in each of ``tasks``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if got:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in _forest(*(np.concatenate(c) for c in zip(*got, strict=True)))], ["a", "b"])

    return edges.select("a", "b").coalesce(tasks).mapInArrow(run, "a bigint, b bigint")


def _star(edges: DataFrame, total: int, large: bool) -> DataFrame:
    """One turn of star building: per node, its larger (its smaller)
    neighbours are tied to its smallest neighbour."""
    out = edges.union(edges.select("b", "a")) if large else edges
    least = checkpoint(out.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select(
        "a", F.least("a", "m").alias("m"), "n"))
    met = _look_up(out, "a", least, 2 * total)
    if large:
        return met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    return met.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m")).distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) for ``nodes`` (node): the smallest node reachable over
    ``edges`` (a, b). Tasks contract the edges that they hold to stars; at
    most ``BLOCK_EDGES`` edges are one task, which is then done. More are
    tied to smaller neighbours in turns (large star, small star), each cut
    through the checkpoint folder, until nothing changes or one task holds
    what is left."""
    edges = checkpoint(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        total, mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        tasks = -(-total // BLOCK_EDGES)
        if tasks <= 1 or (total, mark) == seen:
            stars = _contract(edges, 1) if tasks == 1 else edges
            break
        seen = total, mark
        edges = checkpoint(_star(_contract(edges, tasks), total, large=True))
        edges = checkpoint(_star(edges, total, large=False))
    return nodes.join(stars.withColumnRenamed("b", "_root"), F.col("node") == F.col("a"), "left").select(
        "node", F.coalesce("_root", "node").alias("root"))


def linked(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 4, num: int = 85,
           den: int = 100) -> DataFrame:
    """Per row of ``df``: ``_key``, ``_h`` (hash of its text), ``n`` (size of
    its set) and ``first`` (struct _void, _key, _h: the smallest row reachable
    by links, null keys last; null for rows without a set)."""
    texts = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(text).alias("_h"))
    kind = df.schema[key].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, n_a, ids = [], [], []
            for _, h, d, size, sid in sets_of([t or b"" for t in batch.column(2).to_pylist()], k):
                n.append(size)
                n_a.append(np.bincount(d[h < _LIMIT_A], minlength=len(size)))
                ids.append(sid)
            cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(cat(x), pa.int64()) for x in (n, n_a, ids))],
                ["_key", "_h", "n", "n_a", "sid"])

    rows = checkpoint(texts.select("_key", "_h", F.col("_text").cast("binary").alias("_text")).mapInArrow(
        describe, f"_key {kind}, _h bigint, n bigint, n_a bigint, sid bigint"))
    total = rows.count()
    buckets = max(8, total // 4096)
    sets = checkpoint(rows.where("n > 0").groupBy("sid").agg(
        F.min(F.struct(F.col("_key").isNull().alias("_void"), "_key", "_h")).alias("doc"), F.first("n").alias("n"),
        F.first("n_a").alias("n_a"), F.count("*").alias("copies")))
    shared = _shared(_deal_texts(texts, k, buckets), buckets, detail=False).select("sid", "held")
    chosen = sets.join(shared, "sid", "left").where(
        F.col("n_a") - F.coalesce("held", F.lit(0)) < _prefix_size(num, den)).select("sid", "doc")
    read = checkpoint(_read_sets(texts, chosen, k))
    opened = checkpoint(_prefixes(read, num, den, max(8, min(buckets, read.count() // 512))))
    some = opened.count()

    group = components(opened.select(F.col("sid").alias("node")), _gather(opened, num, den))
    group = checkpoint(group.select(F.col("node").alias("sid"), F.col("root").alias("grp")))

    # groups reach each other over shared prefix tokens only: a cluster of one group is done
    prefix = checkpoint(opened.select("sid", "prefix").join(group, "sid").select(
        "grp", F.explode("prefix").alias("token")).distinct())
    holder = prefix.groupBy("token").agg(F.min("grp").alias("b"), F.max("grp").alias("z"), F.count("*").alias("n")).where(
        "b <> z")
    near = _look_up(prefix, "token", holder, prefix.count()).where("grp <> b").select(F.col("grp").alias("a"), "b")
    sizes = group.groupBy(F.col("grp").alias("node")).agg(F.count("*").alias("n"))
    cluster = components(sizes.select("node"), near).join(sizes, "node").select(
        F.col("node").alias("grp"), F.col("root").alias("cluster"), "n")
    placed = checkpoint(_look_up(group, "grp", cluster, some))
    amount = opened.select("sid", (F.length("tokens") / 8).alias("size")).join(placed, "sid").groupBy("cluster").agg(
        F.max("grp").alias("g1"), F.min("grp").alias("g2"), F.count("*").alias("n"), F.sum("size").alias("size"))
    several = amount.where("g1 <> g2").select("cluster", "n", F.ceil(
        F.greatest(F.col("n") / BLOCK_SETS, F.col("size") / BLOCK_TOKENS)).alias("chunks"))
    asked = _look_up(placed, "cluster", several, some).where("chunks is not null")
    edges = _compare(opened.select("sid", "tokens").join(asked, "sid"), num, den)
    root = components(sizes.select("node"), edges).join(sizes, "node").select(
        F.col("node").alias("grp"), F.col("root").alias("comp"), "n")
    comp = _look_up(group, "grp", root, some).select("sid", "comp")

    # back to the rows: set -> component -> smallest row
    named = checkpoint(sets.select("sid", "doc").join(comp, "sid"))
    least = named.groupBy("comp").agg(F.min("doc").alias("first"), F.count("*").alias("n"))
    named = _look_up(named.select("sid", "comp"), "comp", least, some).select("sid", "first")
    final = checkpoint(sets.join(named, "sid", "left").select(
        "sid", F.coalesce("first", "doc").alias("first"), F.col("copies").alias("n")))
    out = _look_up(rows.select("_key", "_h", "sid", F.col("n").alias("size")), "sid", final, total)
    return out.select("_key", "_h", F.col("size").alias("n"), "first")


def join_components(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 4, num: int = 85,
                    den: int = 100) -> DataFrame:
    """Per row: ``key``, ``n_shingles`` (size of its set) and
    ``component_id`` (smallest key reachable by links, its own included).

    Rows link when den x intersection >= num x union of their sets of word
    ``k``-shingles. Null and empty texts, and texts without words, have empty
    sets and link with nothing; equal rows link with each other; null keys
    are never the smallest; an empty table gives an empty one; other columns
    are ignored."""
    return linked(df, key, text, k, num, den).select(
        F.col("_key").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("first._key")).otherwise(F.col("_key")).alias("component_id"))


def drop_copies(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, num: int = 80,
                den: int = 100) -> DataFrame:
    """One row of each component of ``linked`` rows: that with the smallest
    key (null keys last, ties by a hash of the text); of equal rows one. Rows
    are told apart by key and text, so a repeated key keeps what has no copy,
    and a row without a key goes if it has one. Rows with nothing to compare
    all stay, but equal ones once."""
    found = checkpoint(linked(df, key, text, k, num, den))
    mine = F.struct(F.col("_key").isNull().alias("_void"), "_key", "_h")
    kept = found.where((F.col("n") == 0) | F.col("first").eqNullSafe(mine)).groupBy(
        F.col("_key").alias("_kept"), F.col("_h").alias("_kept_h")).agg(F.count("*").alias("_n"))
    kept = checkpoint(kept)
    out = df.join(kept.drop("_n"), F.col(key).eqNullSafe(F.col("_kept")) & (F.xxhash64(text) == F.col("_kept_h")), "left_semi")
    return out if kept.where("_n > 1").isEmpty() else out.dropDuplicates([key, text])
