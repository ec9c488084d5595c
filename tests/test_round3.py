"""Stored profiles, neighbours by ranges, history and folders, quartiles, correlations of many columns."""

import dataclasses
import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF0001
from vigil.catalog_io import EVENTS_CSV_SCHEMA
from vigil.catalog_monitor import AS_OF_EVENTS, EVENTS_CFG
from vigil.config import blank_config
from vigil.operators import ordering
from vigil.plans.run import run_series
from vigil.sources import history as hist
from vigil.sources import snapshots as snap
from vigil.streaming import state
from vigil.streaming.monitor import process_days, stream_monitor


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_neighbours_by_ranges(spark):
    rows = [(None, 7), *((i * 3, i) for i in range(200))]
    df = spark.createDataFrame(rows, "k int, x int").repartition(5)
    whole = ordering.with_neighbours(df, "k", 201, {"a": "x"}, {"z": "x"})
    parts = ordering.with_neighbours(df, "k", 201, {"a": "x"}, {"z": "x"}, most=10)
    assert "SinglePartition" in plan(whole) and "SinglePartition" not in plan(parts)
    key = lambda r: (r.k is not None, r.k or 0)
    assert sorted(parts.collect(), key=key) == sorted(whole.collect(), key=key)
    one = ordering.with_neighbours(df.where("k = 3"), "k", 201, {"a": "x"}, {"z": "x"}, most=10).first()
    assert (one.a, one.z) == (None, None)
    assert ordering.with_neighbours(df.limit(0), "k", 201, {"a": "x"}, most=10).count() == 0


def test_many_snapshots_without_one_task(spark):
    ev = spark.read.parquet(f"{SF0001}/events.parquet").withColumn("snapshot", F.col("user_id"))

    def metrics(config):
        run = run_series(ev, config, key="snapshot", as_of=AS_OF_EVENTS, dataset_name="users")
        return {r.snapshot: r for r in run.metrics(dt.datetime(2024, 1, 1)).collect()}

    want = metrics(EVENTS_CFG)
    got = metrics(dataclasses.replace(EVENTS_CFG, window_rows=5))
    assert len(want) > 10 and got.keys() == want.keys()
    for k, r in got.items():
        for c, v in r.asDict().items():
            assert v == pytest.approx(want[k][c], nan_ok=True) if isinstance(v, float) else v == want[k][c], (k, c)


def move(spark, source, target):
    fs, root = snap._fs_path(spark, source)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(target))
    for f in fs.listStatus(root):
        fs.rename(f.getPath(), path(os.path.join(target, f.getPath().getName())))


def test_monitor_without_old_files(spark, tmpdir_path):
    """Days arrive one batch at a time, the files of checked days go: the
    history is that of the whole series."""
    ev = spark.read.parquet(f"{SF0001}/events.parquet").withColumn("snapshot_date", F.to_date("ts"))
    days = [dt.date(2024, 1, d) for d in range(1, 9)]
    ev = ev.where(F.col("snapshot_date").isin(days))
    # the third day ranges wider than the second: kept values are counted over bins they never had
    ev = ev.withColumn("value", F.when(F.col("snapshot_date") == days[2], F.col("value") * 3 - 20).otherwise(F.col("value")))
    path, ck, old = (os.path.join(tmpdir_path, x) for x in ("h", "ck", "old"))
    schema = T._parse_datatype_string(EVENTS_CSV_SCHEMA)
    src = os.path.join(tmpdir_path, "src")
    for some in (days[:2], days[2:3], days[3:7], days[7:]):
        new = os.path.join(tmpdir_path, f"new{some[0].day}")
        snap.write_snapshot_files(ev.where(F.col("snapshot_date").isin(some)), new, "snapshot_date")
        if os.path.isdir(src):
            move(spark, src, old)
        move(spark, new, src)
        stream_monitor(spark, src, schema, path, ck, EVENTS_CFG, "events", as_of=AS_OF_EVENTS)
    got = hist.fetch_all_metrics(spark, path, "events").drop("id", "created_at")
    batch = hist.history_rows(run_series(ev, EVENTS_CFG, key="snapshot_date", as_of=AS_OF_EVENTS, dataset_name="events")
                              .metrics()).drop("id", "created_at")
    assert got.count() == 8
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    # a configuration that needs what was not kept cannot go on without the files
    other = dataclasses.replace(EVENTS_CFG, psi_column="user_id")
    with pytest.raises(FileNotFoundError, match="2024-01-07"):
        process_days(spark, [days[7]], src, schema, path, other, "events", as_of=AS_OF_EVENTS)
    with pytest.raises(FileNotFoundError):
        process_days(spark, [days[3]], src, schema, path, EVENTS_CFG, "events", as_of=AS_OF_EVENTS)
    assert state.load(spark, os.path.join(tmpdir_path, "none"), "events", days, None) == ([], None)


def test_two_writers_and_compaction(spark, tmpdir_path):
    from concurrent.futures import ThreadPoolExecutor

    ev = spark.read.parquet(f"{SF0001}/events.parquet").withColumn("snapshot", F.to_date("ts"))
    m = run_series(ev, EVENTS_CFG, key="snapshot", as_of=AS_OF_EVENTS, dataset_name="events").metrics()
    rows = spark.createDataFrame(m.collect(), m.schema)
    path = os.path.join(tmpdir_path, "h")
    parts = [rows.where(F.dayofmonth("timestamp") % 4 == i) for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda p: hist.replace_metrics(spark, path, p), parts))
    assert hist.fetch_all_metrics(spark, path, "events").count() == 30
    changed = parts[1].withColumn("row_count", F.lit(-1).cast("long"))
    hist.replace_metrics(spark, path, changed)
    hist.append_metrics(spark, path, parts[2])  # a second row beside the first
    read = lambda: sorted(map(tuple, hist.fetch_all_metrics(spark, path).drop("created_at").collect()))
    before = read()
    assert len(before) == 30 + parts[2].count() and sum(r[3] == -1 for r in before) == parts[1].count()
    assert hist.compact_metrics(spark, path) >= 6 and read() == before
    stored = spark.read.parquet(path)
    assert stored.count() == len(before) and not any("_staging" in f for f in os.listdir(path))
    # copies that a crashed compaction leaves read as one
    hist._add_files(spark, path, stored.select(*hist.STORED_SCHEMA.fieldNames()))
    assert read() == before


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_partition_folders(spark, tmpdir_path, fmt):
    ev = spark.read.parquet(f"{SF0001}/events.parquet").withColumn("snapshot_date", F.to_date("ts"))
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    ev = ev.where(F.col("snapshot_date").isin(days))
    src = os.path.join(tmpdir_path, "src")
    snap.write_snapshots(ev.repartition(2), src, fmt=fmt)
    assert list(snap.snapshot_files(spark, src)) == days
    data = snap.scan_snapshot_series(spark, src)
    assert data.count() == ev.count() and data.columns == [*ev.columns]
    kinds = {r.snapshot_date: r.dtypes for r in snap.snapshot_schemas(spark, src).collect()}
    assert list(sorted(kinds)) == days and kinds[days[0]]["value"] == "float64"
    path = os.path.join(tmpdir_path, "h")
    stream_monitor(spark, src, T._parse_datatype_string(EVENTS_CSV_SCHEMA), path, os.path.join(tmpdir_path, "ck"),
                   EVENTS_CFG, "events", as_of=AS_OF_EVENTS)
    got = hist.fetch_all_metrics(spark, path, "events").drop("id", "created_at")
    batch = hist.history_rows(run_series(ev.withColumn("user_id", F.col("user_id").cast("long")), EVENTS_CFG,
                                         key="snapshot_date", as_of=AS_OF_EVENTS, dataset_name="events").metrics())
    pick = ["timestamp", "row_count", "drift_score", "entropy_delta", "outlier_count"]
    assert sorted(got.select(*pick).collect()) == sorted(batch.select(*pick).collect()) and got.count() == 3


def test_header_with_a_line_break(spark, tmpdir_path):
    os.makedirs(tmpdir_path, exist_ok=True)
    with open(os.path.join(tmpdir_path, "snapshot_2024-01-01.csv"), "w", newline="") as f:
        f.write('a,"b\nc",d\n1,2,3\n')
    path = os.path.join(tmpdir_path, "snapshot_2024-01-01.csv")
    assert snap._header(spark, path) == ("a", "b\nc", "d")


def test_parquet_table(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    spark.createDataFrame([(1, float("nan")), (2, 2.0)], "a int, b double").write.parquet(path)
    assert [r.b for r in snap.load_table(spark, path).orderBy("a").collect()] == [None, 2.0]
    assert snap.load_table(spark, path, T._parse_datatype_string("a string")).schema["a"].dataType == T.StringType()


def test_run_from_the_command_line(spark, tmpdir_path, capsys):
    import json

    from vigil.__main__ import main

    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    for day, n in ((1, 30), (2, 40)):
        with open(os.path.join(src, f"snapshot_2024-01-0{day}.csv"), "w") as f:
            f.write("Order ID,Sales,Empty\n" + "".join(f"{i},{i % 7}.5,\n" for i in range(n)))
    assert snap.load_csv(spark, os.path.join(src, "snapshot_2024-01-01.csv")).schema["Empty"].dataType == T.DoubleType()
    path = os.path.join(tmpdir_path, "h")
    assert main([src, path, "--as-of", "2024-01-02", "--dataset", "shop"]) == 0
    record = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    metrics, ml = json.loads(record["metrics"]), json.loads(record["ml_result"])
    assert metrics["row_count"] == 40 and metrics["dataset_name"] == "shop"
    assert ml["prediction_label"] == "insufficient_data" and ml["combined_flag"] == record["combined_flag"]
    assert hist.fetch_all_metrics(spark, path, "shop").count() == 1
    assert main([os.path.join(tmpdir_path, "none"), path]) == 1


@pytest.mark.parametrize("way", ["whole", "sketch", "miss"])
def test_quartiles_by_bracket(spark, monkeypatch, way):
    """Exact in two scans; brackets that hold too much leave the rest to refinement."""
    import numpy as np

    from vigil.operators import quantiles

    rng = np.random.default_rng(3)
    inf = float("inf")
    columns = {"a": rng.normal(size=4000), "b": rng.integers(0, 3, 4000).astype(float), "c": 10.0 ** rng.uniform(*((-6, 6) if way == "miss" else (-300, 300)), 4000),
               "d": np.where(rng.random(4000) < 0.3, inf, np.where(rng.random(4000) < 0.5, -inf, rng.normal(size=4000)))}
    rows = [(int(i % 3), *(float(x[i]) for x in columns.values())) for i in range(4000)] + [(9, 1.0, 2.0, 3.0, 4.0), (8, *[None] * 4)]
    df = spark.createDataFrame(rows, "k int, a double, b double, c double, d double").repartition(5)
    if way == "miss":
        monkeypatch.setattr(quantiles, "BRACKET_MAX", 0)
    if way == "sketch":
        monkeypatch.setattr(quantiles, "ACCURACY", 100)
    got = {r.k: r for r in quantiles.select_quantiles(df, "k", list(columns), collect_max=200).collect()}
    exact = {r.k: r for r in df.groupBy("k").agg(*[F.percentile(c, F.array(F.lit(0.25), F.lit(0.75))).alias(f"q_{i}")
                                                  for i, c in enumerate(columns)]).collect()}
    for k in (0, 1, 2, 9):
        for i in range(4):
            assert got[k][f"q_{i}"] == pytest.approx(exact[k][f"q_{i}"], rel=1e-12, nan_ok=True), (k, i)


@pytest.mark.parametrize("cells", [16_000_000, 1])
def test_correlations_of_many_columns(spark, monkeypatch, cells):
    """Matrix products against the expressions per pair: nulls, NaN, infinity, constants, far-off values, a null
    key, a snapshot without values; sums handed out at once or batch by batch."""
    from vigil.operators import gram

    monkeypatch.setattr(gram, "CELLS", cells)
    rng = np.random.default_rng(3)
    k, rows = 14, []
    for i in range(900):
        x = list(rng.normal(0, 1, k))
        x[1] = x[0] * 2 + rng.normal() * (1 + i // 300)
        x[2] = 0.1
        x[3] = None if i % 3 else x[3]
        x[4] = 1e9 + x[4]
        x[5] = float("nan") if i == 701 else x[5]
        x[6] = float("inf") if i == 10 else x[6]
        x[7] = 0.7 if x[3] is not None else 0.1 * (i % 7)  # constant where the fourth is present
        x = [v if v is None else float(v) for v in x]
        rows.append([i // 300 or None, *(x if i < 600 or i % 2 else [None] * k)])
    names = [f"c{i}" for i in range(k)]
    df = spark.createDataFrame(rows, ", ".join(["day int", *(f"{n} double" for n in names)])).repartition(5)
    runs = [run_series(df, blank_config(corr_columns=tuple(names), row_duplicates=False, gram_columns=g), key="day")
            for g in (20, 3)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    narrow = {r.day: [r[f"corr_{p}"] for p in range(len(pairs))] for r in runs[0].checks.p.facts_with(()).collect()}
    wide = {r.day: r.corr for r in runs[1].checks.p.facts_with(("gram",)).collect()}
    assert set(narrow) == set(wide) == {None, 1, 2}
    for day in wide:
        for pair, a, b in zip(pairs, narrow[day], wide[day], strict=True):
            if pair == (3, 7):
                continue  # constant on the rows that both have, which the expressions do not see
            np.testing.assert_allclose(b, a, atol=1e-6, err_msg=f"{day} {pair}")
        assert wide[day][pairs.index((3, 7))] == 0
    clean = df.drop("c5", "c6")
    names = names[:5] + names[8:]
    got = [run_series(clean, blank_config(corr_columns=tuple(names), row_duplicates=False, gram_columns=g), key="day")
           .checks.correlation().orderBy("day").collect() for g in (20, 3)]
    for a, b in zip(*got, strict=True):
        assert (a.worst_pair, a.passed) == (b.worst_pair, b.passed)
        assert (a.max_correlation_drift is None) == (b.max_correlation_drift is None)
        if a.max_correlation_drift is not None:
            assert a.max_correlation_drift == pytest.approx(b.max_correlation_drift, abs=1e-6)


def test_two_hundred_columns(spark):
    """20 100 pairs without an expression each."""
    names = [f"c{i}" for i in range(200)]
    df = spark.range(3000).selectExpr("CAST(id % 2 AS INT) AS day", *[
        f"CASE WHEN id % {7 + i % 5} <> 0 THEN sin(id * {i + 1}) + CAST(id % {3 + i % 11} AS DOUBLE) END AS c{i}" for i in range(200)])
    run = run_series(df, blank_config(corr_columns=tuple(names), row_duplicates=False), key="day")
    first, second = run.checks.correlation().orderBy("day").collect()
    assert first.max_correlation_drift is None and first.worst_pair is None and first.passed
    pdf = df.toPandas()
    step = (pdf[pdf.day == 1][names].corr(min_periods=1) - pdf[pdf.day == 0][names].corr(min_periods=1)).abs().to_numpy()
    i, j = np.unravel_index(np.nanargmax(step), step.shape)
    assert second.max_correlation_drift == pytest.approx(np.nanmax(step), abs=1e-9)
    assert second.worst_pair == f"('c{min(i, j)}', 'c{max(i, j)}')"


def test_monitor_keeps_many_correlations(spark, tmpdir_path):
    """Stored correlations of a gone day serve the next one, under the same columns only."""
    from vigil.operators.checks import Checks
    from vigil.operators.profile import Profile

    ev = spark.read.parquet(f"{SF0001}/events.parquet").withColumn("day", F.to_date("ts"))
    ev = ev.selectExpr("day", *[f"value * {i + 1} + (event_id % {i + 2}) * user_id AS c{i}" for i in range(5)])
    cfg = blank_config(corr_columns=tuple(f"c{i}" for i in range(5)), row_duplicates=False, gram_columns=2)
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    two = ev.where(F.col("day").isin(d1, d2))
    both = Profile(two, cfg, key="day")
    state.save(both, tmpdir_path, "events", [d1])
    have, stored = state.load(spark, tmpdir_path, "events", [d1], both)
    assert have == [d1]
    want = [r for r in Checks(both).correlation().collect() if r.day == d2]
    got = Checks(Profile(two.where(F.col("day") == d2), cfg, key="day", stored=stored)).correlation().collect()
    assert got == want and got[0].worst_pair
    fewer = dataclasses.replace(cfg, corr_columns=cfg.corr_columns[:4])
    assert state.load(spark, tmpdir_path, "events", [d1], Profile(two, fewer, key="day")) == ([], None)
