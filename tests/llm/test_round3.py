"""Merkle manifest, spelling variants and byte-level BPE against brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from vigil.llm import bytebpe, merkle, spelling

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# -------------------------------------------------------------------- manifest

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows, fanout):
    """rows: (doc_id, source, lang, n_chars, text)."""
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, plus=0: sha(*map(part, (*r[:3], r[3] if r[3] is None else r[3] + plus, r[4])))

    def tree(nodes):
        """The top, and per node its siblings as (left, right) by level."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, a in enumerate(at):
                first = a - a % fanout
                paths[i].append((nodes[first:a], nodes[a + 1:first + fanout]))
                at[i] = a // fanout
            nodes = [sha(*nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
        return nodes[0], paths

    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    subs = {g: tree([leaf(r) for r in groups[g]]) for g in names}
    root, over = tree([subs[g][0] for g in names])
    out = []
    for g, above in zip(names, over, strict=True):
        for r, path in zip(groups[g], subs[g][1], strict=True):
            path, bad = path + above, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            now = leaf(r, int(bad))
            for left, right in path:
                now = sha(*left, now, *right)
            out.append((r[0], leaf(r), subs[g][0], root, sha(*(x for p in path for side in p for x in side)), now,
                        now == root))
    return collections.Counter(out)


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_merkle_manifest(spark, docs, fanout):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    odd = [(n, None, f"l{n % 3}" if n % 3 else None, n, "é" * n) for n in range(70)] + [
        (500, "s", "only", None, None), (None, "s", "two", 1, ""), (None, None, None, None, None), (7, "s", "two", 3, "a"),
        (7, "s", "two", 3, "a"), (7, "s", "two", 4, "b")]
    odd = spark.createDataFrame(odd, docs.select(*columns).schema).withColumn("hash", F.lit(1)).withColumn("grp", F.lit(2))
    for df in (odd, odd.where("doc_id = 500"), docs) if fanout == 2 else (odd,):
        got = merkle.manifest(df, fanout=fanout).collect()
        assert collections.Counter(map(tuple, got)) == brute_manifest([tuple(r) for r in df.select(*columns).collect()], fanout)
        assert {r.verified for r in got if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 7} <= {True}
    assert merkle.manifest(odd.limit(0)).count() == 0


def test_numbering_of_ties(spark, monkeypatch):
    monkeypatch.setattr(merkle, "OFFSETS", 0)
    df = spark.createDataFrame([(g, 5) for g in "aab" * 40], "grp string, k int")
    got = sorted((r.grp, r.idx, r.m) for r in merkle.number(df, "grp", ["k"]).collect())
    assert got == [("a", i, 80) for i in range(80)] + [("b", i, 40) for i in range(40)]


# ------------------------------------------------------------ spelling variants

def brute_words(rows, times):
    counts = collections.Counter()
    for k, t in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in r)
            h = zlib.crc32(f"{'null' if k is None else k}:{r}".encode())
            counts[r if h % 199 else r[:h % len(r)] + r[h % len(r) + 1:]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= times}


def brute_variants(v):
    near, letters = collections.defaultdict(set), sorted({x for w in v for x in w})
    for w in v:
        for i in range(len(w) + 1):
            for z in [w[:i] + w[i + 1:], *(w[:i] + a + w[i + 1:] for a in letters), *(w[:i] + a + w[i:] for a in letters)]:
                if z != w and z in v:
                    near[w].add(z)
    best = {w: min(near[w], key=lambda x: (-v[x], x), default=None) for w in v}
    form = {w: b if b is not None and v[b] >= 5 * v[w] else None for w, b in best.items()}
    out = {}
    for w, n in v.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), v[form[w]] if form[w] else None)
    return out


def as_dict(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def made_words():
    rng = random.Random(5)
    counts = {"a" * n: n for n in range(6, 15)}
    for base, n in (("meadow", 900), ("harbour", 700), ("straßeñ", 400), ("antidisestablishmentarianism" * 3, 90), ("b" * 61, 8)):
        counts[base] = n
        for _ in range(60):
            w = base
            for _ in range(rng.choice([1, 1, 2])):
                i, kind = rng.randrange(len(w) + 1), rng.randrange(3)
                w = w[:i] + rng.choice("aeàÿz" if kind else "e") * (kind > 0) + w[i + (kind < 2):]
            if len(w) >= 6:
                counts.setdefault(w, rng.choice([5, 6, 30, 180]))
    counts |= {"b" * 60: 50, "b" * 62: 300, "c" * 60: 5, "c" * 59 + "d": 30}
    return counts


def test_spelling_of_made_words(spark, monkeypatch):
    counts = made_words()
    text = " ".join(w for w, n in counts.items() for _ in range(n))
    df = spark.createDataFrame([(None, text)], "doc_id string, text string")
    want = brute_variants(counts)
    monkeypatch.setattr(spelling, "TRIE_CHARS", 14)
    assert as_dict(spelling.variants(df, every=0)) == want
    monkeypatch.setattr(spelling, "BROADCAST_EDGES", 0)
    monkeypatch.setattr(spelling, "HOT", 40)
    monkeypatch.setattr(spelling, "TRIE_CHARS", 9)
    monkeypatch.setattr(spelling, "TASK_WORDS", 100)
    assert as_dict(spelling.variants(df, every=0)) == want


def test_spelling_of_documents(spark, docs):
    odd = spark.createDataFrame([(None, None), (None, "Meadow MEADOW meadow×÷"), (1, ""), (1, "x"), (1, "x" * 3000)],
                                "doc_id bigint, text string")
    df = docs.select("doc_id", "text").unionAll(odd).unionAll(odd).withColumn("word", F.lit("w")).withColumn("n", F.lit(1))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    words = brute_words(rows, 2)
    assert {r.word: r.n for r in spelling.words(df, times=2).collect()} == words
    v = brute_words(rows, 5)
    assert as_dict(spelling.variants(df)) == brute_variants(v)
    assert spelling.variants(df.limit(0)).count() == 0


# ------------------------------------------------------------------ byte-level BPE

@pytest.fixture(scope="module")
def library():
    ranks = bytebpe.load(RANKS, public_tokenizers.PATTERN).ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = [None, "", " ", "a", "  two  spaces \n \n x ", "tab\tnew\r\nline", "naïve café – “quotes” €5", "日本語 テキスト 한국어",
       "😀 emoji  z​w ́", "<|endoftext|> in", "don't we'll I'M 123abc 1 2  3", "x" * 3000, "ab" * 2500, "word " * 2000,
       "é" * 1500, " \xa0nbsp", "\x1c\x85 odd \x1f", "՘a⃁ 㐀", "ſtrange ʼn Ǆ", "\x00"]


def test_byte_bpe(spark, docs, library, monkeypatch):
    odd = spark.createDataFrame([(n, t, "x", -1) for n, t in enumerate(ODD)] + [(3, "a", "", 0), (None, "key", None, None)],
                                "doc_id bigint, text string, ids string, n_tokens int")
    hexed = lambda b: hashlib.sha256(b).hexdigest()
    for df in (odd, docs):
        want = collections.Counter()
        for r in df.collect():
            ids = library.encode_ordinary(r.text or "")
            want[r.doc_id, len(ids), hexed(",".join(map(str, ids)).encode()), hexed(library.decode_bytes(ids))] += 1
        assert collections.Counter(map(tuple, bytebpe.encode_decode(df, RANKS).collect())) == want
    full = {r.doc_id: r for r in bytebpe.encode_decode(odd, RANKS, digests=False).collect()}
    assert full[6].ids == library.encode_ordinary(ODD[6]) and full[6].decoded == ODD[6].encode()
    assert bytebpe.encode_decode(odd.limit(0), RANKS).count() == 0
    coder = bytebpe.load(RANKS, public_tokenizers.PATTERN)
    monkeypatch.setattr(bytebpe, "BLOCK_CHARS", 50)
    monkeypatch.setattr(bytebpe, "BLOCK_PIECES", 7)
    monkeypatch.setattr(bytebpe, "MEMO_ENTRIES", 20)
    texts = [t or "" for t in ODD]
    assert [r.numbers() for r in coder.results(texts)] == [library.encode_ordinary(t) for t in texts]


def test_byte_bpe_of_random_characters(library):
    coder, rng = bytebpe.load(RANKS, public_tokenizers.PATTERN), random.Random(1)
    ranges = [(32, 127), (32, 33), (9, 14), (0xA0, 0x3000), (0x3000, 0xD800), (0xE000, 0x32000)]
    texts = ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(60)) for _ in range(2000)]
    texts += ["".join(chr(c) for c in range(lo, lo + 256) if not 0xD800 <= c < 0xE000) for lo in range(0, 0x32000, 256)]
    for text, r in zip(texts, coder.results(texts), strict=True):
        assert r.numbers() == library.encode_ordinary(text) and b"".join(r.raw) == text.encode()


def test_matrix_and_heap_merge_alike():
    coder, rng = bytebpe.load(RANKS, public_tokenizers.PATTERN), random.Random(2)
    rows = [bytes(rng.choice(b"aest nrio\xc3\xa9") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    width = max(map(len, rows))
    ids = np.full((len(rows), width), -1, np.int32)
    for row, p in zip(ids, rows, strict=True):
        row[:len(p)] = coder.letters[list(p)]
    for p, got in zip(rows, bytebpe.merge_rows(ids, coder.hashed), strict=True):
        parts = [p[i:i + 1] for i in range(len(p))]
        while True:
            best = min(((coder.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(itertools.pairwise(parts))),
                       default=(1 << 60, 0))
            if best[0] == 1 << 60:
                break
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        want = [coder.ranks[x] for x in parts]
        assert got.tolist() == want == bytebpe.merge_long(coder.letters[list(p)].tolist(), coder.pairs)


# -------------------------------------------------------------------- oracles

@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_spelling_variants", "secret_links_planted"])
def test_query_equals_its_sql(spark, name):
    import duckdb

    from vigil.llm import queries

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    plain = lambda rows: collections.Counter(tuple(None if v != v else v for v in r) for r in rows)
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLE[name])
    order = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(order)
    assert plain(tuple(r) for r in got.select(*order).collect()) == plain(want.fetchall())
