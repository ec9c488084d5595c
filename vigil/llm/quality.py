"""Quality classifier by hierarchical empirical Bayes.

A logistic regression on text statistics gives each document a probability;
grouped aggregation turns them into host and path posteriors: a host's mean
is shrunk toward the global mean, a path's toward its host's, by as much as
the spread between groups says (method of moments). A document's log odds and
its path's posterior are then combined. Sparse sites fall back to the level
above; only sums leave the documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import checkpoint

FEATURES = ("bias", "upper", "digit", "symbol", "bars", "newline", "repeat", "distinct", "mean_word", "log_words",
            "top_word", "letters")
#: groups that are joined by broadcast; more go through a salted join
BROADCAST_GROUPS = 20_000
SALT = 32


def features(texts: list[str]) -> np.ndarray:
    """One row of statistics per text; zeros for an empty one."""
    kind = np.zeros(256, np.uint8)  # of bytes: other, upper, digit, symbol, bar, newline, white space, letter
    for b in range(128):
        c = chr(b)
        kind[b] = (1 if c.isupper() else 2 if c.isdigit() else 4 if c == "|" else 5 if c == "\n" else
                   6 if c.isspace() else 7 if c.islower() else 3 if c not in ".,;:'\"()-" else 0)
    kind[128:] = 7
    out = np.zeros((len(texts), len(FEATURES)))
    for i, t in enumerate(texts):
        words = t.split()
        if not words:
            continue
        raw = np.frombuffer(t.encode("utf-8", "replace"), np.uint8)
        share = np.bincount(kind[raw], minlength=8) / len(raw)
        n = len(words)
        seen: dict[str, int] = {}
        for w in words:
            seen[w] = seen.get(w, 0) + 1
        same = sum(map(str.__eq__, words, words[1:]))
        out[i] = (1.0, share[1], share[2], share[3], share[4], share[5], same / n, len(seen) / n,
                  min(len(t) / n, 30) / 10, np.log1p(n) / 5, max(seen.values()) / n, share[7])
    return out


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> dict[str, np.ndarray]:
    """Ridge logistic regression by Newton steps, on scaled statistics."""
    mean, spread = x.mean(0), x.std(0)
    mean[0], spread[0] = 0, 1
    spread[spread == 0] = 1
    z = (x - mean) / spread
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return {"mean": mean, "spread": spread, "w": w}


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          sample: int = 20_000) -> dict[str, np.ndarray] | None:
    """Fit on at most ``sample`` labelled rows, chosen by a hash of the key
    (a bound on what the driver and the broadcast hold). None when no label
    meets a document: the classifier is then silent."""
    some = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).alias("_key"), F.col(label).cast("double").alias("_y"))
    some = some.groupBy("_key").agg(F.avg("_y").alias("_y")).orderBy(F.xxhash64("_key"), "_key").limit(sample)
    pairs = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(some), "_key")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"_key": b["_key"].astype(str), "y": b["_y"],
                                "x": list(features(b["_text"].fillna("").tolist()))})

    got = pairs.mapInPandas(run, "_key string, y double, x array<double>")
    # a key may stand on many rows: one row a key, so the sample's bound holds
    got = got.groupBy("_key").agg(F.first("y").alias("y"), F.first("x").alias("x")).toPandas().sort_values("_key")
    return fit(np.array(got["x"].tolist()), got["y"].to_numpy()) if len(got) else None


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def evidence(docs: DataFrame, model: dict[str, np.ndarray] | None, columns: list[Column], text: str = "text",
             keep_text: str | None = None) -> DataFrame:
    """``columns`` (aliased), the text under ``keep_text`` if named, and
    ``evidence``: the document's own probability; 0 for texts without words,
    0.5 from a silent classifier. Columns pass as Arrow arrays; only a slice
    of the texts becomes Python strings at a time."""
    source = docs.select(*columns, F.col(text).alias(keep_text or "_text"))
    kept = [f for f in source.schema.fields if f.name != "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, out = batch.column(batch.num_columns - 1), []
            for lo in range(0, batch.num_rows, 500):
                x = features([t or "" for t in texts.slice(lo, 500).to_pylist()])
                p = np.full(len(x), 0.5) if model is None else 1 / (1 + np.exp(-np.clip(
                    (x - model["mean"]) / model["spread"] @ model["w"], -30, 30)))
                out.append(np.where(x[:, 0] > 0, p, 0.0))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), pa.array(np.concatenate([np.zeros(0), *out]))],
                [*(f.name for f in kept), "evidence"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return source.mapInArrow(run, f"{fields}, evidence double")


def strength(groups: DataFrame, p: str, n: str) -> float:
    """Pseudo-count of a prior for group means ``p`` of ``n`` documents:
    mean x (1 - mean) over the variance between groups, less one."""
    r = groups.agg(F.sum(n).alias("n"), F.sum(F.col(p) * F.col(n)).alias("s"),
                   F.sum(F.col(p) * F.col(p) * F.col(n)).alias("q"), F.count("*").alias("k")).first()
    if not r.n or r.k < 2:
        return 100.0
    mean = r.s / r.n
    between = max(r.q / r.n - mean * mean - mean * (1 - mean) * r.k / r.n, 1e-6)
    return float(min(max(mean * (1 - mean) / between - 1, 1.0), 1e4))


def posteriors(scored: DataFrame) -> DataFrame:
    """(_host, _path) with host and path posteriors and the global mean, from
    rows (_host, _path, evidence). Partial sums leave the documents; a hot
    host costs one row a task."""
    paths = checkpoint(scored.groupBy("_host", "_path").agg(F.count("*").alias("n"), F.sum("evidence").alias("s")))
    hosts = paths.groupBy(F.col("_host").alias("h_host")).agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s")).first()
    mean = total.s / total.n if total.n else 0.5
    a = strength(hosts.withColumn("p", F.col("hs") / F.col("hn")), "p", "hn")
    hosts = hosts.withColumn("host_posterior", (F.col("hs") + a * mean) / (F.col("hn") + a))
    b = strength(paths.withColumn("p", F.col("s") / F.col("n")), "p", "n")
    return paths.join(hosts, F.col("_host").eqNullSafe(F.col("h_host"))).select(
        "_host", "_path", "host_posterior",
        ((F.col("s") + b * F.col("host_posterior")) / (F.col("n") + b)).alias("path_posterior"),
        F.lit(float(mean)).alias("prior"))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
             path: str = "lang", threshold: float = 0.5, weight: float = 0.5, sample: int = 20_000,
             carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: ``key``, ``evidence``, ``host_posterior``,
    ``path_posterior``, ``quality`` (probability after the site's word) and
    ``keep`` (``quality`` >= ``threshold``).

    ``host`` and ``path`` name the site columns (a path lies within its
    host; null is a site of its own). log odds of ``quality`` = log odds of
    the evidence + ``weight`` x (those of the path posterior - those of the
    global mean). Texts without words, null ones too, get 0 and go. Repeated
    rows and null keys stay; an empty table gives an empty one; without
    labels the sites alone speak. ``carry``: columns to pass along."""
    model = train(docs, labels, key, text, sample=sample)
    columns = [F.col(key).alias("_key"), F.col(host).cast("string").alias("_host"),
               F.col(path).cast("string").alias("_path")]
    if carry:  # whole documents: scored twice rather than written once more
        sites = posteriors(evidence(docs, model, columns[1:], text))
        passed = [F.col(c).alias(f"_c{i}") for i, c in enumerate(carry) if c != text]
        scored = evidence(docs, model, columns + passed, text,
                          f"_c{carry.index(text)}" if text in carry else None)
    else:
        scored = checkpoint(evidence(docs, model, columns, text))
        sites = posteriors(scored)
    return combine(scored, sites, key, threshold, weight, carry)


def combine(scored: DataFrame, sites: DataFrame, key: str, threshold: float, weight: float,
            carry: tuple[str, ...]) -> DataFrame:
    sites = checkpoint(sites.withColumnsRenamed({"_host": "s_host", "_path": "s_path"}))
    on = lambda d, s: d["_host"].eqNullSafe(s["s_host"]) & d["_path"].eqNullSafe(s["s_path"])
    if sites.count() <= BROADCAST_GROUPS:
        right = F.broadcast(sites)
        joined = scored.join(right, on(scored, right), "left")
    else:  # a hot site is dealt over SALT copies of its row
        d = scored.withColumn("_salt", F.pmod(F.xxhash64("_key", "evidence"), F.lit(SALT)))
        s = sites.withColumn("s_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))).withColumn(
            "s_salt", F.col("s_salt").cast("bigint"))
        joined = d.join(s, on(d, s) & (d["_salt"] == s["s_salt"]), "left")
    odds = _logit(F.col("evidence")) + weight * (_logit(F.col("path_posterior")) - _logit(F.col("prior")))
    quality = F.when(F.col("evidence") > 0, 1 / (1 + F.exp(-odds))).otherwise(0.0)
    return joined.select(
        F.col("_key").alias(key), *(F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)), "evidence",
        "host_posterior", "path_posterior", quality.alias("quality"), (quality >= threshold).alias("keep"))
