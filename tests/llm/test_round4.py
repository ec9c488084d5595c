"""What tasks and the driver hold at a time, and joins of blocks against brute force."""

import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from vigil.llm import ann, spelling


def units(rng, n, dim):
    x = rng.standard_normal((n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


# ------------------------------------------------------------ nearest neighbours

def test_lists_and_walk_in_bounded_tables():
    rng = np.random.default_rng(3)
    c, u = units(rng, 3000, 16), units(rng, 4096, 16)
    tracemalloc.start()
    row, lists = ann.lists_of(u, c, 4, 1.1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * 8 * ann.CELLS  # one table of 4096 x 3000 has 98 MB, and several were held
    d = ann.distance(u[:200] @ c.T)
    for i in range(200):
        top = np.argsort(d[i], kind="stable")[:4]
        assert lists[row == i].tolist() == top[d[i, top] <= 1.1 * d[i, top[0]] + 1e-12].tolist()
    at, sims = ann.Graph(c).search(u[:300], 400)
    want = -np.sort(-(u[:300] @ c.T), axis=1)[:, :400]
    assert (sims >= want - 1e-12).mean() > 0.99 and (np.diff(sims, axis=1) <= 0).all()
    assert np.allclose(sims, np.einsum("ij,ikj->ik", u[:300], c[at]))
    assert ann.Graph(c[:1]).search(u[:2], 48)[0].tolist() == [[0], [0]]


def test_blocks_against_all_pairs(monkeypatch):
    monkeypatch.setattr(ann, "CELLS", 500)  # many turns
    rng = np.random.default_rng(4)
    a, b = rng.integers(-2, 3, (40, 3)) + 0.5, rng.integers(-2, 3, (300, 3)) + 0.5  # many ties
    lists = lambda n: [np.unique(rng.integers(0, 9, rng.integers(1, 5))) for _ in range(n)]
    a_lists, b_lists, least = lists(40), lists(300), rng.permutation(300)
    row, at, score = ann.best_in_block(a, a_lists, b, b_lists, least, 6)
    for i in range(40):
        near = [j for j in range(300) if set(a_lists[i]) & set(b_lists[j])]
        cosine = {j: a[i] @ b[j] / np.linalg.norm(a[i]) / np.linalg.norm(b[j]) for j in near}
        best = sorted(near, key=lambda j: -cosine[j])[:6]
        assert np.allclose(score[row == i], [cosine[j] for j in best])
        assert len(set(at[row == i].tolist())) == len(best) and all(np.isclose(cosine[j], s) for j, s in zip(
            at[row == i].tolist(), score[row == i].tolist(), strict=True))


def test_queries_go_out_in_bounded_frames(spark, monkeypatch):
    """What a task hands out at a time does not grow with the lists that its
    queries visit, and a query goes once to a group of lists."""
    monkeypatch.setattr(ann, "CELLS", 1 << 15)
    rng = np.random.default_rng(6)
    x = units(rng, 3000, 64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    frames = []

    def spy(self, f, schema, *args, original=type(df).mapInPandas):
        if "v array" in schema and "probe" not in schema:
            frames.append([sum(map(len, out["v"])) for out in f(iter([self.toPandas()]))])
        return original(self, f, schema, *args)

    monkeypatch.setattr(type(df), "mapInPandas", spy)
    found = ann.search(df, F.col("vec_id") % 4 == 0, list_size=16).collect()
    assert len(frames) == 2 and max(map(max, frames)) <= ann.CELLS
    sims = x[::4] @ x.T
    sims[np.arange(750), np.arange(0, 3000, 4)] = -2
    best = np.argsort(-sims, axis=1)[:, :5]
    assert len(found) == 750 * 5
    assert sum(r.vec_id in best[r.query_id // 4] for r in found) > 0.93 * len(found)


# ------------------------------------------------------------ spelling variants

def test_size_estimates_of_levels_stay_small(spark, monkeypatch):
    """The planner's estimate of a level is a product of those of its inputs;
    where the states enter it three times its digits grow threefold a level."""
    rng = np.random.default_rng(8)
    words = sorted({"".join(rng.choice(list("abc"), n)) for n in rng.integers(6, 12, 150)})
    df = spark.createDataFrame([(i, " ".join(words)) for i in range(5)], "doc_id bigint, text string")
    want = {tuple(r) for r in spelling.variants(df, every=0).collect()}
    bits = []

    def spy(frame, original=spelling.checkpoint):
        bits.append(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length())
        return original(frame)

    monkeypatch.setattr(spelling, "checkpoint", spy)
    monkeypatch.setattr(spelling, "BROADCAST_EDGES", 0)
    for hot in (20_000, 20):  # no node of many states, and some
        monkeypatch.setattr(spelling, "HOT", hot)
        bits.clear()
        assert {tuple(r) for r in spelling.variants(df, every=0).collect()} == want
        assert max(bits) < 20_000
