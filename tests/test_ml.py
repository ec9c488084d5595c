"""Isolation forest (no SQL oracle): planted outliers rank first, a fixed
seed reproduces the model, the flag share follows the contamination, and a
saved model scores like the in-memory one. Forecast on a known series."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigil.operators import forecast as fc
from vigil.operators import iforest


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(0)
    n = 2000
    x = rng.normal(0, 1, (n, 3))
    x[:10] = rng.normal(8, 0.5, (10, 3))  # planted outliers: ids 0..9
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(rid=np.arange(n))
    return spark.createDataFrame(pdf)


def test_planted_outliers_rank_first(spark, planted):
    m = iforest.fit(planted, "rid", ("a", "b", "c"), n_trees=50, seed=7)
    s = m.score(planted, keep=("rid",)).orderBy("raw_score").limit(10).collect()
    assert {r["rid"] for r in s} == set(range(10))


def test_seed_reproducible_and_contamination(spark, planted):
    m1 = iforest.fit(planted, "rid", ("a", "b", "c"), n_trees=30, seed=11, contamination=0.05)
    m2 = iforest.fit(planted, "rid", ("a", "b", "c"), n_trees=30, seed=11, contamination=0.05)
    a = m1.score(planted, keep=("rid",)).select("rid", F.col("raw_score").alias("a"))
    b = m2.score(planted, keep=("rid",)).select("rid", F.col("raw_score").alias("b"))
    assert a.join(b, "rid").filter("abs(a - b) > 1e-12").count() == 0
    share = m1.score(planted, keep=("rid",)).agg(F.avg("anomaly_flag")).first()[0]
    assert 0.03 <= share <= 0.07
    nodes = m1.nodes.groupBy("tree").agg(F.sum(F.when(F.col("feature") < 0, F.col("size"))).alias("n"))
    assert {r["n"] for r in nodes.collect()} == {256}  # psi rows per tree, no replacement


def test_scores_equal_a_plain_walk(spark, planted):
    """Scores, threshold and flags of every row against one walk per row and
    tree over the stored nodes, null features and values beyond the sample included."""
    feats = ("a", "b", "c")
    m = iforest.fit(planted, "rid", feats, n_trees=20, seed=5)
    nodes = {(r.tree, r.node): r for r in m.nodes.collect()}

    def path(row, tree):
        r, depth = nodes[tree, 0], 0
        while r.feature >= 0:
            r, depth = nodes[tree, r.left if row[r.feature] < r.threshold else r.right], depth + 1
        n = r.size
        more = 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n
        return depth + more

    def plain(values):
        z = [((v if v is not None else 0.0) - mu) / sd for v, mu, sd in zip(values, m.means, m.sigmas)]
        return -2 ** (-np.mean([path(z, t) for t in range(20)]) / float(iforest.avg_path_length([m.psi])[0]))

    want = {r.rid: plain(r[:3]) for r in planted.select("a", "b", "c", "rid").collect()}
    assert m.threshold == pytest.approx(np.quantile(list(want.values()), 0.1), abs=1e-12)
    odd = spark.createDataFrame([(None, 1e300, -1e300, 5000), (None, None, None, 5001)], planted.schema)
    want |= {r.rid: plain(r[:3]) for r in odd.select("a", "b", "c", "rid").collect()}
    got = m.score(planted.unionByName(odd), keep=("rid",)).collect()
    assert len(got) == 2002
    for r in got:
        assert r.raw_score == pytest.approx(want[r.rid], abs=1e-12)
        assert r.anomaly_flag == int(r.raw_score < m.threshold) == int(r.prediction_label == "ANOMALY")


def test_model_roundtrip(spark, planted, tmpdir_path):
    m = iforest.fit(planted, "rid", ("a", "b", "c"), n_trees=20, seed=3)
    m.save(spark, tmpdir_path + "/m")
    m2 = iforest.ForestModel.load(spark, tmpdir_path + "/m")
    assert m2.threshold == pytest.approx(m.threshold) and m2.psi == m.psi
    a = m.score(planted, keep=("rid",)).select("rid", F.col("raw_score").alias("a"))
    b = m2.score(planted, keep=("rid",)).select("rid", F.col("raw_score").alias("b"))
    assert a.join(b, "rid").filter("abs(a - b) > 1e-12").count() == 0
    with pytest.raises(FileNotFoundError):
        iforest.ForestModel.load(spark, tmpdir_path + "/missing")


def test_too_little_history_gives_no_model(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(4)], "rid long, row_count double")
    assert iforest.fit(df, "rid", ("row_count",)) is None


def test_forecast_linear_weekly(spark):
    days = pd.date_range("2024-01-01", periods=28, freq="D")
    y = 100 + 2 * np.arange(28) + np.where(days.dayofweek == 5, 30, 0)
    y[20] += 200  # spike
    pdf = pd.DataFrame({"dataset_name": "d", "timestamp": days + pd.Timedelta(hours=8), "row_count": y})
    f = fc.forecast_row_count(spark.createDataFrame(pdf), horizon=7)
    rows = {r["ds"]: r for r in f.collect()}
    assert len(rows) == 35
    assert rows[dt.date(2024, 1, 21)]["anomaly"] == 1
    assert sum(r["anomaly"] for r in rows.values()) == 1
    future = [r for d, r in rows.items() if d > dt.date(2024, 1, 28)]
    assert all(r["actual"] is None and r["anomaly"] == 0 for r in future)
