"""Isolation forest (A1-A5) as Spark jobs (Liu, Ting and Zhou, 2008).

* A1 features: fixed list of numeric columns, missing column or null -> 0.0.
* A2 scaler: mean and population sigma per feature from one aggregate
  (sigma 0 -> 1); the fitted numbers are the model, like any fitted scaler.
* A3 fit: every tree gets its own uniform random subset of ``psi`` rows
  (without replacement). A row's draw for tree ``t`` is a hash of
  (row id, t, seed), so sampling is deterministic and independent of
  partitioning. One pass keeps only rows whose draw is below an
  oversampled threshold (about 2 * psi per tree), then ``row_number`` per
  tree keeps the ``psi`` smallest draws. Trees are built in parallel, one
  ``applyInPandas`` group per tree (at most psi rows each).
* A5 score: the node table (at most trees * (2 * psi - 1) rows, a proven
  bound) is shipped to the tasks and each Arrow batch is walked through all
  trees with NumPy; ``raw_score = -2 ** (-E[h] / c(psi))``. The anomaly
  threshold is the ``contamination`` quantile of the training scores.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FEATURE_COLUMNS
from .quantiles import select_quantiles

# ship this module's task-side code by value, so executors need no install
try:
    import sys as _sys

    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: the package must be installed
    pass

EULER = 0.5772156649015329
NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.IntegerType()),
])


def avg_path_length(n):
    """c(n): average path length of an unsuccessful BST search."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    return out


# ------------------------------------------------------------------ A1 / A2
def prepare_features(df: DataFrame, features=FEATURE_COLUMNS, keep=()) -> DataFrame:
    """A1: the feature columns as doubles; absent column or null -> 0.0."""
    cols = [F.col(k) for k in keep]
    for c in features:
        x = F.col(f"`{c}`").cast("double") if c in df.columns else F.lit(None).cast("double")
        cols.append(F.coalesce(x, F.lit(0.0)).alias(c))
    return df.select(*cols)


def fit_scaler(feats: DataFrame, features) -> tuple:
    """A2: (means, sigmas) from one aggregate; sigma 0 -> 1."""
    return _count_and_scaler(feats, features)[1:]


def _count_and_scaler(feats: DataFrame, features) -> tuple:
    aggs = [F.count(F.lit(1))]
    for c in features:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    r = feats.agg(*aggs).first()
    means = [float(r[f"m_{c}"] or 0.0) for c in features]
    sig = [float(r[f"s_{c}"] or 0.0) for c in features]
    return r[0], means, [s if s > 0 else 1.0 for s in sig]


def standardize(feats: DataFrame, features, means, sigmas, keep=()) -> DataFrame:
    return feats.select(*[F.col(k) for k in keep],
                        *[((F.col(c) - F.lit(m)) / F.lit(s)).alias(c)
                          for c, m, s in zip(features, means, sigmas)])


# ------------------------------------------------------------------ model
@dataclass
class ForestModel:
    features: tuple
    means: list
    sigmas: list
    nodes: DataFrame          # NODE_SCHEMA rows
    psi: int
    threshold: float          # raw scores below it are anomalies
    n_trees: int

    # -------------------------------------------------------------- A4
    def save(self, spark: SparkSession, path: str) -> None:
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        meta = [(c, float(m), float(s)) for c, m, s in zip(self.features, self.means, self.sigmas)]
        (spark.createDataFrame(meta, "feature string, mean double, sigma double")
         .withColumn("ord", F.monotonically_increasing_id())
         .withColumn("psi", F.lit(self.psi)).withColumn("threshold", F.lit(self.threshold))
         .withColumn("n_trees", F.lit(self.n_trees))
         .coalesce(1).write.mode("overwrite").parquet(f"{path}/params"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> "ForestModel":
        try:
            p = spark.read.parquet(f"{path}/params").orderBy("ord").collect()
            nodes = spark.read.parquet(f"{path}/nodes")
        except Exception as e:  # noqa: BLE001
            raise FileNotFoundError(f"{path} holds no saved forest") from e
        return ForestModel(tuple(r.feature for r in p), [r.mean for r in p], [r.sigma for r in p],
                           nodes, int(p[0].psi), float(p[0].threshold), int(p[0].n_trees))

    # -------------------------------------------------------------- A5
    def score(self, df: DataFrame, keep=()) -> DataFrame:
        """Per row: raw_score, anomaly_score, anomaly_flag, prediction_label."""
        from ..session import deal

        feats = standardize(deal(prepare_features(df, self.features, keep)), self.features,
                            self.means, self.sigmas, keep)
        raw = _score_raw(feats, self.nodes, self.features, self.psi, self.n_trees, keep)
        return raw.select(*[F.col(k) for k in keep], "raw_score",
                          F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), -F.col("raw_score"))), 4)
                          .alias("anomaly_score"),
                          (F.col("raw_score") < F.lit(self.threshold)).cast("int").alias("anomaly_flag"),
                          F.when(F.col("raw_score") < F.lit(self.threshold), "ANOMALY").otherwise("NORMAL")
                          .alias("prediction_label"))


# ------------------------------------------------------------------ A3
def _uniform(row_id: F.Column, tree: F.Column, seed: int) -> F.Column:
    h = F.xxhash64(row_id, tree, F.lit(seed))
    return h.bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / float(1 << 53)


def _build_tree_fn(features, psi: int, seed: int):
    k = len(features)
    max_depth = int(math.ceil(math.log2(max(psi, 2))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        x = pdf[list(features)].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, t])
        rows = []

        def grow(idx, depth):
            node = len(rows)
            rows.append([t, node, -1, 0.0, -1, -1, len(idx)])
            if depth >= max_depth or len(idx) <= 1:
                return node
            sub = x[idx]
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            cand = np.flatnonzero(hi > lo)
            if cand.size == 0:
                return node
            f = int(rng.choice(cand))
            thr = float(rng.uniform(lo[f], hi[f]))
            go_left = sub[:, f] < thr
            left = grow(idx[go_left], depth + 1)
            right = grow(idx[~go_left], depth + 1)
            rows[node][2:6] = [f, thr, left, right]
            return node

        grow(np.arange(len(x)), 0)
        return pd.DataFrame(rows, columns=[f.name for f in NODE_SCHEMA.fields]).astype(
            {"tree": "int32", "node": "int32", "feature": "int32", "left": "int32", "right": "int32",
             "size": "int32"})

    assert k > 0
    return build


def fit(df: DataFrame, row_id: str, features=FEATURE_COLUMNS, n_trees: int = 100,
        contamination: float = 0.1, seed: int = 42, max_samples: int = 256,
        min_rows: int = 5) -> ForestModel | None:
    """A3: fit on ``df`` (any size). Returns None below ``min_rows`` rows."""
    from ..session import spread

    features = tuple(features)
    held: list = []
    feats = spread(prepare_features(df, features, keep=(row_id,)), held)
    n, means, sigmas = _count_and_scaler(feats, features)
    if n < min_rows:
        return None
    z = standardize(feats, features, means, sigmas, keep=(row_id,))
    psi = min(max_samples, n)
    q = min(1.0, 2.0 * psi / n + 64.0 / n)  # oversampled keep rate per tree
    rid = F.col(row_id).cast("string")
    # Each row joins each tree's candidate pool independently with
    # probability q. The first tree a row joins is geometric(q), drawn from
    # one hash, so the (rare) rows that join any tree are found in one cheap
    # pass; only they draw the per-tree coins for the later trees.
    if q >= 1.0:
        first = F.lit(0)
    else:
        u = _uniform(rid, F.lit(-1), seed)
        first = F.floor(F.log(F.greatest(u, F.lit(1e-300))) / F.lit(math.log1p(-q))).cast("int")
    keep = z.withColumn("_t1", first).filter(F.col("_t1") < n_trees)
    later = F.filter(F.sequence(F.col("_t1") + 1, F.greatest(F.col("_t1") + 1, F.lit(n_trees - 1))),
                     lambda t: (t < n_trees) & (_uniform(rid, t, seed) < F.lit(q)))
    cand = (keep.select("*", F.explode(F.concat(F.array(F.col("_t1")), later)).alias("tree"))
            .withColumn("_u", _uniform(rid, F.col("tree"), seed + 1)))
    w = Window.partitionBy("tree").orderBy("_u", row_id)
    sample = cand.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= psi)
    nodes = (sample.select("tree", *features).groupBy("tree")
             .applyInPandas(_build_tree_fn(features, psi, seed), NODE_SCHEMA))
    from ..session import cut_lineage

    nodes = cut_lineage(nodes)
    # offset: contamination quantile of the training scores
    train = cut_lineage(_score_raw(z, nodes, features, psi, n_trees, keep=(row_id,)).selectExpr("0 AS k", "raw_score"))
    thr = select_quantiles(train, "k", ["raw_score"], probs=(contamination,)).first()["q_0"][0]
    for d in held:
        d.unpersist()
    return ForestModel(features, means, sigmas, nodes, psi, float(thr), n_trees)


def _flat_trees(arr: np.ndarray) -> tuple:
    """Rows of ``NODE_SCHEMA`` -> (roots, levels, feature, threshold, child,
    path). Node numbers run over all trees, ``child[2 i]`` and ``child[2 i + 1]``
    are the right and left child of node ``i``; a leaf is its own child, so a
    walk takes the same number of steps in every tree. ``path`` is the path
    length of a leaf: its depth and what its size adds."""
    arr = arr[np.lexsort((arr[:, 1], arr[:, 0]))]
    _, roots, nodes = np.unique(arr[:, 0], return_index=True, return_counts=True)
    start = np.repeat(roots, nodes)
    inner = arr[:, 2] >= 0
    here = np.arange(len(arr))
    left, right = (np.where(inner, arr[:, c].astype(np.int64) + start, here) for c in (4, 5))
    depth, level, levels = np.zeros(len(arr)), roots, 0
    while inner[level].any():
        levels += 1
        level = level[inner[level]]
        level = np.concatenate([left[level], right[level]])
        depth[level] = levels
    feature = np.where(inner, arr[:, 2], 0).astype(np.int64)
    child = np.column_stack([right, left]).ravel()
    return roots, levels, feature, arr[:, 3], child, depth + avg_path_length(arr[:, 6])


def _mean_path(x: np.ndarray, trees: tuple, rows: int = 512) -> np.ndarray:
    """Mean path length over all trees; ``rows`` at a time, so that the nodes
    at hand (rows x trees) stay in the processor's cache."""
    roots, levels, feature, threshold, child, path = trees
    out = np.empty(len(x))
    for at in range(0, len(x), rows):
        part = np.ascontiguousarray(x[at:at + rows])
        first = (np.arange(len(part)) * x.shape[1])[:, None]
        flat = part.ravel()
        node = np.broadcast_to(roots, (len(part), len(roots)))
        for _ in range(levels):
            goes_left = flat.take(feature.take(node) + first) < threshold.take(node)
            node = child.take(2 * node + goes_left)
        out[at:at + rows] = path.take(node).mean(axis=1)
    return out


def _score_raw(z: DataFrame, nodes: DataFrame, features, psi: int, n_trees: int, keep) -> DataFrame:
    """Mean path length over all trees -> raw score, per Arrow batch."""
    rows = nodes.orderBy("tree", "node").collect()  # <= n_trees * (2 * psi - 1) rows
    bound = n_trees * (2 * psi - 1)
    if len(rows) > bound:
        raise ValueError(f"node table larger than its bound {bound}")
    nd = np.array([[r.tree, r.node, r.feature, r.threshold, r.left, r.right, r.size] for r in rows], dtype=float)
    bc = z.sparkSession.sparkContext.broadcast(nd)
    cpsi = float(avg_path_length([psi])[0])
    feats, keep = list(features), list(keep)

    def walk(it):
        trees = _flat_trees(bc.value)
        for pdf in it:
            eh = _mean_path(pdf[feats].to_numpy(dtype=float), trees)
            yield pdf[keep].assign(raw_score=-np.power(2.0, -eh / cpsi))

    schema = T.StructType([z.schema[k] for k in keep] + [T.StructField("raw_score", T.DoubleType())])
    return z.mapInPandas(walk, schema)
