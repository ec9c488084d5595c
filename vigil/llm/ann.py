"""Approximate nearest neighbours over balanced posting lists.

Centroids are fitted on a bounded sample by balanced clustering (a list that
grows beyond its share is split, hierarchically). Every distinct vector goes
to the list of its nearest centroid, boundary vectors also to the lists of
others almost as near. A query walks an in-memory graph over the centroids
and visits the lists whose centroids are within a distance ratio of the
nearest. How many lists and which ratio follow the index: both are calibrated
on sampled vectors, half of them held back from the fit, whose exact
neighbours one scan finds. Lists are stored by groups of neighbouring lists, in
blocks of bounded size, so a long list is many rows; a query goes once to every
block of a group of which it visits a list, with a number and the lists, and
only its number and its best rows come back. No task holds more at a time than
a block of vectors, one of queries and a table of ``CELLS``.

Copies of a vector are one entry that keeps the smallest ids (one more than
asked for, in case the query is among them), which loses no answer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpoint, sample_by_hash

#: vectors in a stored block, queries in a block, at most; fewer where they are long
BLOCK, QUERY_BLOCK = 16_384, 16_384
#: entries of a table that a task makes at a time, values in a block of vectors
CELLS = 1 << 20


# ---------------------------------------------------------------- centroids

def balanced_centroids(x: np.ndarray, size: int, seed: int = 7) -> np.ndarray:
    """Unit centroids of clusters of at most about ``size`` rows of ``x``:
    k-means splits a cluster in up to eight until it is small enough."""
    rng = np.random.default_rng(seed)
    done, todo = [], [x]
    while todo:
        part = todo.pop()
        k = min(8, -(-len(part) // size))
        if k <= 1:
            if len(part):
                done.append(part.mean(0))
            continue
        c = part[rng.choice(len(part), k, replace=False)]
        for _ in range(8):
            near = (part @ c.T).argmax(1)
            for j in range(k):
                if (near == j).any():
                    c[j] = part[near == j].mean(0)
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-30)
        near = (part @ c.T).argmax(1)
        pieces = [part[near == j] for j in range(k)]
        if max(map(len, pieces)) == len(part):  # one point many times: no split helps
            done.append(part.mean(0))
        else:
            todo += pieces
    c = np.array(done).reshape(len(done), x.shape[1])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-30)


class Graph:
    """Nearest-neighbour graph over centroids, walked by many queries at once."""

    def __init__(self, c: np.ndarray, degree: int = 16):
        self.c = c
        near = []
        for lo in range(0, len(c), step := in_turns(len(c))):
            sims = c[lo:lo + step] @ c.T
            sims[np.arange(len(sims)), np.arange(lo, lo + len(sims))] = -2
            if len(c) > 1:
                near.append(np.argpartition(-sims, min(degree, len(c) - 1), axis=1)[:, :degree])
        to = np.concatenate(near) if near else np.zeros((0, 0), np.int64)
        at = np.repeat(np.arange(len(to)), to.shape[1])
        both = np.unique(np.concatenate([np.stack([at, to.ravel()], 1), np.stack([to.ravel(), at], 1)]), axis=0)
        both = both[both[:, 0] != both[:, 1]]
        #: the nodes linked to node i are links[first[i]:first[i + 1]]
        self.links, self.first = both[:, 1], np.searchsorted(both[:, 0], np.arange(len(c) + 1))
        self.entries = np.unique(np.linspace(0, len(c) - 1, min(len(c), 32)).astype(np.int64))

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, similarities) of about the ``width`` nearest to every
        row of ``q``, nearest first; similarity -inf: fewer were met. A turn
        expands, for all rows, what is among the nearest so far and has not
        been expanded; the walk ends where nothing is left to expand."""
        n, width = len(self.c), min(width, len(self.c))
        sims, done = np.full((len(q), n), -np.inf), np.zeros((len(q), n), bool)
        sims[:, self.entries] = q @ self.c[self.entries].T
        while True:
            bar = np.partition(sims, n - width, axis=1)[:, n - width]
            row, node = np.nonzero((sims >= bar[:, None]) & (sims > -np.inf) & ~done)
            if not len(row):
                break
            done[row, node] = True
            met = np.zeros(sims.shape, bool)
            for lo in range(0, len(row), 4096):
                r, e = row[lo:lo + 4096], node[lo:lo + 4096]
                degree = self.first[e + 1] - self.first[e]
                at = np.arange(degree.sum()) - np.repeat(np.cumsum(degree) - degree - self.first[e], degree)
                met[np.repeat(r, degree), self.links[at]] = True
            row, node = np.nonzero(met & (sims == -np.inf))
            for lo in range(0, len(row), step := in_turns(q.shape[1])):
                r, e = row[lo:lo + step], node[lo:lo + step]
                sims[r, e] = np.einsum("ij,ij->i", q[r], self.c[e])
        top = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        top.sort(1)
        found = np.take_along_axis(sims, top, 1)
        order = np.argsort(-found, axis=1, kind="stable")
        return np.take_along_axis(top, order, 1), np.take_along_axis(found, order, 1)


def in_turns(entries: int) -> int:
    """Rows of so many entries that a task takes at a time."""
    return max(1, CELLS // max(entries, 1))


def distance(sims: np.ndarray) -> np.ndarray:
    """Euclidean distance of unit vectors by their cosine."""
    return np.sqrt(np.maximum(2 - 2 * sims, 0))


# -------------------------------------------------------------------- Spark

def _valid(vector: str):
    """Vectors that take part: not null, not empty, all finite, not zero."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(
        v, lambda x: x != 0)


def distinct_vectors(df: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(v array<double>, ids) of the distinct valid vectors with their
    ``k`` + 1 smallest distinct ids; a partial limit runs before the shuffle,
    so a vector that a third of the rows share costs k + 1 rows a task."""
    rows = df.where(_valid(vector) & F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("id"), F.transform(vector, lambda x: x.cast("double") + 0.0).alias("v"))
    order = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    first = rows.distinct().withColumn("nth", order).where(F.col("nth") <= k + 1)
    return first.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def block_rows(dim: int) -> int:
    """Vectors in a block."""
    return max(1, min(BLOCK, CELLS // dim))


def unit(column: pd.Series) -> np.ndarray:
    x = np.stack(column.to_numpy()).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(vectors: DataFrame, sample: int, list_size: int, probes: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Centroids from at most ``sample`` distinct vectors of the most common
    length (chosen by a hash), for lists of ``list_size`` of ``vectors``, and
    up to ``probes`` unit vectors (an eighth of the sample at most): the first
    half of them is in the fit, so nearer to its centroid, the other held back."""
    total = vectors.count()
    by_size: dict[int, list] = {}
    for v in sample_by_hash(vectors, "v", sample):
        by_size.setdefault(len(v), []).append(v)
    if not by_size:
        return np.zeros((0, 0)), np.zeros((0, 0))
    x = np.array(max(by_size.values(), key=len))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    held = min(probes // 2, len(x) // 16)
    x, tried = x[:len(x) - held], x[len(x) - 2 * held:]
    return balanced_centroids(x, max(8, round(list_size * len(x) / max(total, 1)))), tried


def lists_of(u: np.ndarray, c: np.ndarray, replicas: int, closure: float) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``u``, list) of every list that a vector lies in."""
    rows, lists = [], []
    for lo in range(0, len(u), step := in_turns(len(c))):
        near = distance(u[lo:lo + step] @ c.T)
        top = np.argpartition(near, min(replicas, len(c)) - 1, axis=1)[:, :replicas]
        top.sort(1)
        d = np.take_along_axis(near, top, 1)
        order = np.argsort(d, axis=1, kind="stable")
        top, d = np.take_along_axis(top, order, 1), np.take_along_axis(d, order, 1)
        row, col = np.nonzero(d <= closure * d[:, :1] + 1e-12)
        rows.append(row + lo)
        lists.append(top[row, col])
    return np.concatenate(rows), np.concatenate(lists)


def by_group(row: np.ndarray, lists: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, list]:
    """(row, group, lists) for the pairs (row, list): a group is ``span``
    lists that follow one another."""
    order = np.lexsort((lists, row))
    row, lists = row[order], lists[order]
    group = lists // span
    new = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(group, prepend=-1) != 0))
    return row[new], group[new], np.split(lists, new[1:]) if len(new) else []


def best_in_block(a: np.ndarray, a_lists: list, b: np.ndarray, b_lists: list, least: np.ndarray, most: int
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``a``, row of ``b``, cosine): the ``most`` nearest rows of ``b``
    to every row of ``a`` among those that share a list with it, nearest first,
    ties to the smaller ``least``."""
    norm_a, norm_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)

    def sides(lists: list) -> dict[int, np.ndarray]:
        flat = np.concatenate([np.asarray(x, np.int64) for x in lists])
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        order = np.argsort(flat, kind="stable")
        names, first = np.unique(flat[order], return_index=True)
        return dict(zip(names.tolist(), np.split(row[order], first[1:]), strict=True))

    bar = np.full(len(a), -np.inf)  # no row of b under it is among the nearest
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    kept, held = [none], 0

    def prune() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, x, s = map(np.concatenate, zip(*kept, strict=True))
        order = np.lexsort((-s, x, q))
        q, x, s = q[order], x[order], s[order]
        once = (np.diff(q, prepend=-1) != 0) | (np.diff(x, prepend=-1) != 0)  # a pair may share several lists
        q, x, s = q[once], x[once], s[once]
        order = np.lexsort((x, least[x], -s, q))
        q, x, s = q[order], x[order], s[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        last = place == most - 1
        bar[q[last]] = np.maximum(bar[q[last]], s[last])
        return q[place < most], x[place < most], s[place < most]

    others = sides(b_lists)
    for name, asked in sides(a_lists).items():
        x = others.get(name)
        if x is None:
            continue
        for lo in range(0, len(asked), step := in_turns(max(len(x), a.shape[1]))):
            q = asked[lo:lo + step]
            sims = (a[q] @ b[x].T) / norm_a[q][:, None] / norm_b[x][None, :]
            if len(x) >= most and (bar[q] == -np.inf).any():
                bar[q] = np.maximum(bar[q], np.partition(sims, len(x) - most, axis=1)[:, len(x) - most])
            row, col = np.nonzero(sims >= bar[q][:, None])
            kept.append((q[row], x[col], sims[row, col]))
            held += len(row)
            if held > max(CELLS, 2 * most * len(a)):
                kept = [prune()]
                held = len(kept[0][0])
    return prune()


def exact(vectors: DataFrame, probes: np.ndarray, k: int) -> list:
    """Rows (probe, v) of the ``k`` nearest of ``vectors`` to every probe but
    the nearest, which is the probe itself; a task sends k + 1 a probe."""
    n, dim = probes.shape

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score, best = np.full((n, k + 1), -np.inf), np.zeros((n, k + 1, dim))
        for b in batches:
            for lo in range(0, len(b), 4096):
                raw = np.stack(b["v"].iloc[lo:lo + 4096].to_numpy())
                sims = np.concatenate([score, probes @ unit(b["v"].iloc[lo:lo + 4096]).T], 1)
                at = np.argpartition(-sims, k, axis=1)[:, :k + 1]
                old = np.take_along_axis(best, np.minimum(at, k)[:, :, None], 1)
                best = np.where((at <= k)[:, :, None], old, raw[np.maximum(at - k - 1, 0)])
                score = np.take_along_axis(sims, at, 1)
        row, col = np.nonzero(score > -np.inf)
        yield pd.DataFrame({"probe": row, "score": score[row, col], "v": list(best[row, col])})

    found = vectors.select("v").mapInPandas(nearest, "probe int, score double, v array<double>")
    order = F.row_number().over(Window.partitionBy("probe").orderBy(F.col("score").desc(), "v"))
    return found.withColumn("nth", order).where(F.col("nth").between(2, k + 1)).select("probe", "v").collect()


def calibrate(vectors: DataFrame, c: np.ndarray, probes: np.ndarray, k: int, recall: float, replicas: int,
              closure: float) -> tuple[int, float]:
    """The fewest lists and the smallest distance ratio at which both halves
    of ``probes`` meet at least ``recall`` of their exact neighbours (each
    rule may lose half of the rest)."""
    pairs = exact(vectors, probes, k) if len(probes) else []
    if not pairs:
        return 0, 0.0
    probe = np.array([p.probe for p in pairs])
    row, at = lists_of(unit(pd.Series([p.v for p in pairs])), c, replicas, closure)
    d = distance(probes @ c.T)
    needs = np.full(len(pairs), np.inf)  # distance of the nearest list that holds the neighbour
    np.minimum.at(needs, row, d[probe[row], at])
    lists = (d[probe] <= needs[:, None]).sum(1)
    ratios = needs / np.maximum(d.min(1)[probe], 1e-9)
    share = 1 - (1 - recall) / 2
    halves = [h for h in (probe < len(probes) // 2, probe >= len(probes) // 2) if h.any()]
    width, ratio = (max(np.quantile(need[h], share, method="higher") for h in halves) for need in (lists, ratios))
    return int(width), float(ratio)


def search(df: DataFrame, queries, key: str = "vec_id", vector: str = "embedding", k: int = 5,
           sample: int = 20_000, list_size: int = 256, width: int = 48, ratio: float = 1.35,
           replicas: int = 4, closure: float = 1.10, recall: float = 0.95, probes: int = 256) -> DataFrame:
    """The ``k`` nearest rows by cosine of each query row: ``query_id``,
    ``rank`` (from 1), ``vec_id``, ``score`` (double precision, on the
    original vectors), nearest first, ties to the smaller id.

    ``queries``: condition on ``key`` that makes a row a query; candidates
    are all rows but those with the query's own id. Null, zero or non-finite
    vectors and null ids take no part; vectors are compared with those of
    their own length: the sample's most common one is indexed, every other is
    one list that is searched whole; equal rows count once; an empty table gives an empty result;
    other columns are ignored.

    The index is fitted on at most ``sample`` distinct vectors and holds
    every one. At least ``width`` lists are looked at, those farther than
    ``ratio`` times the nearest are skipped; both grow until up to ``probes``
    sampled vectors meet ``recall`` of their exact neighbours. On vectors
    without structure that is a fixed share of the lists, whatever their
    number. A vector lies in up to ``replicas`` lists within ``closure``
    times its nearest centroid's distance."""
    spark = df.sparkSession
    vectors = checkpoint(distinct_vectors(df, key, vector, k))
    centroids, tried = fit(vectors, sample, list_size, probes)
    dim = centroids.shape[1] if len(centroids) else 0
    if not dim:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    shared = spark.sparkContext.broadcast((centroids, Graph(centroids)))
    same = vectors.where(F.size("v") == dim)
    least = calibrate(same, centroids, tried, k, recall, replicas, closure)
    width, ratio = max(width, least[0]), max(ratio, least[1])
    # groups of about a block of vectors, and enough of them for small tables to be more than one task
    groups = max(-(-same.count() // block_rows(dim)), int(spark.conf.get("spark.sql.shuffle.partitions")))
    span = -(-len(centroids) // min(groups, len(centroids)))
    groups = -(-len(centroids) // span)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c, _ = shared.value
        for b in batches:
            for lo in range(0, len(b), step := in_turns(max(len(c), replicas * dim))):
                part = b.iloc[lo:lo + step]
                row, group, lists = by_group(*lists_of(unit(part["v"]), c, replicas, closure), span)
                yield pd.DataFrame({"group": group, "lists": lists, "v": part["v"].to_numpy()[row],
                                    "ids": part["ids"].to_numpy()[row]})

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, graph = shared.value
        for b in batches:
            for lo in range(0, len(b), step := in_turns(max(len(graph.c), groups * dim))):
                part = b.iloc[lo:lo + step]
                at, sims = graph.search(unit(part["v"]), width)
                d = distance(sims)
                row, col = np.nonzero((d <= ratio * d[:, :1] + 1e-9) & (sims > -np.inf))
                row, group, lists = by_group(row, at[row, col], span)
                yield pd.DataFrame({"group": group, "lists": lists, "qid": part["qid"].to_numpy()[row],
                                    "v": part["v"].to_numpy()[row]})

    # vectors of another length are one list of that length, which its queries visit
    by_length = lambda rows, *keep: rows.where(F.size("v") != dim).select(
        (-F.size("v")).cast("bigint").alias("group"), F.array((-F.size("v")).cast("bigint")).alias("lists"), *keep)
    stored = same.select("v", "ids").mapInPandas(
        assign, "group bigint, lists array<bigint>, v array<double>, ids array<bigint>")
    stored = checkpoint(stored.unionByName(by_length(vectors, "v", "ids")))
    asked = df.where(queries & _valid(vector) & F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("id"), F.transform(vector, lambda x: x.cast("double") + 0.0).alias("v"))
    # queries with one vector ask once; their number does not matter to the search
    asked = asked.distinct()
    once = checkpoint(asked.select("v").distinct().withColumn("qid", F.monotonically_increasing_id()))
    visits = once.where(F.size("v") == dim).mapInPandas(
        route, "group bigint, lists array<bigint>, qid bigint, v array<double>")
    visits = checkpoint(visits.unionByName(by_length(once, "qid", "v")))

    # groups and the queries that visit them, in blocks of bounded size
    def blocks(rows: DataFrame, most: int) -> DataFrame:
        """(group, parts): the number of blocks of a group."""
        size = F.when(F.col("group") < 0, -F.col("group")).otherwise(dim)
        fit_in = F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.lit(CELLS) / size)))
        return rows.groupBy("group").count().select("group", F.ceil(F.col("count") / fit_in).alias("parts"))

    parts, qparts = blocks(stored, BLOCK), blocks(visits, QUERY_BLOCK)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    both = F.broadcast(checkpoint(parts.join(qparts.withColumnRenamed("parts", "qparts"), "group")))  # a row a group
    # a vector goes to every block of queries of its group, a query to every block of vectors
    work = stored.join(both, "group").select(
        "group", F.pmod(F.xxhash64("v"), F.col("parts")).alias("part"), every("qparts").alias("qpart"), "lists", "v", "ids",
        F.lit(-1).cast("bigint").alias("qid"))
    work = work.unionByName(visits.join(both, "group").select(
        "group", every("parts").alias("part"), F.pmod("qid", F.col("qparts")).alias("qpart"),
        "lists", "v", F.array().cast("array<bigint>").alias("ids"), "qid"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        ask = frame["qid"].to_numpy() >= 0
        q, x = frame[ask], frame[~ask]
        if not len(q) or not len(x):
            return pd.DataFrame({"qid": [], "vec_id": [], "score": []})
        ids = x["ids"].tolist()
        row, at, score = best_in_block(np.stack(q["v"].to_numpy()), q["lists"].tolist(), np.stack(x["v"].to_numpy()),
                                       x["lists"].tolist(), np.array([i[0] for i in ids]), k + 1)
        many = np.array([len(i) for i in ids])[at]
        vec_id = np.concatenate([ids[j] for j in at.tolist()]) if len(at) else np.zeros(0, np.int64)
        return pd.DataFrame({"qid": np.repeat(q["qid"].to_numpy()[row], many), "vec_id": vec_id,
                             "score": np.repeat(score, many)})

    found = work.groupBy("group", "part", "qpart").applyInPandas(compare, "qid bigint, vec_id bigint, score double")
    best = found.groupBy("qid", "vec_id").agg(F.max("score").alias("score"))  # a vector may be met in several groups
    order = F.row_number().over(Window.partitionBy("qid").orderBy(F.col("score").desc(), "vec_id"))
    best = best.withColumn("nth", order).where(F.col("nth") <= k + 1).drop("nth")
    hits = asked.join(once, "v").select("id", "qid").join(best, "qid").where("id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.col("score").desc(), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("id").alias("query_id"), "rank", "vec_id", "score")
