"""Sources, history table, reports, streaming and property tests."""

import datetime as dt
import os

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF0001
from vigil.catalog_monitor import AS_OF_EVENTS, EVENTS_CFG
from vigil.config import blank_config
from vigil.plans import reports
from vigil.plans.run import current_only, run_all_checks, run_series
from vigil.sources import history as hist
from vigil.sources import snapshots as snap


def test_csv_tokens_and_types(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "s.csv")
    with open(p, "w") as f:
        f.write("id,name,amount,when\n1,NA,1.5,2024-01-01\n2,None,,2024-01-02\n3,x,NaN,null\n4,null,2,N/A\n")
    df = snap.load_csv(spark, p)
    types = dict(df.dtypes)
    assert types["id"] == "bigint" and types["amount"] == "double" and types["when"] == "string"
    rows = {r["id"]: r for r in df.collect()}
    assert rows[1]["name"] is None and rows[2]["name"] is None and rows[4]["name"] is None
    assert rows[2]["amount"] is None and rows[3]["amount"] is None and rows[4]["when"] is None


def test_csv_missing_and_empty(spark, tmpdir_path):
    with pytest.raises(FileNotFoundError):
        snap.load_csv(spark, os.path.join(tmpdir_path, "nope.csv"))
    e = os.path.join(tmpdir_path, "empty.csv")
    open(e, "w").close()
    with pytest.raises(ValueError):
        snap.load_csv(spark, e)


def test_snapshot_files_roundtrip(spark, tmpdir_path):
    ev = spark.read.parquet(f"{SF0001}/events.parquet").withColumn("snapshot_date", F.to_date("ts"))
    names = snap.write_snapshot_files(ev, tmpdir_path, "snapshot_date")
    assert names and all(n.startswith("snapshot_") and n.endswith(".csv") for n in names)
    s = snap.scan_snapshot_series(spark, tmpdir_path)
    assert s.count() == ev.count()
    latest = snap.load_latest_snapshot(s)
    want = ev.agg(F.max("snapshot_date")).first()[0]
    assert latest.select("snapshot_date").distinct().collect()[0][0] == want
    assert snap.load_previous_snapshot(s, steps_back=10_000) is None


def test_history_append_is_idempotent(spark, tmpdir_path):
    run = run_series(snap.series_from_table(spark.read.parquet(f"{SF0001}/events.parquet"), F.to_date("ts"),
                                            "snapshot"), EVENTS_CFG, key="snapshot", as_of=AS_OF_EVENTS,
                     dataset_name="events")
    m = run.metrics()
    path = os.path.join(tmpdir_path, "h")
    hist.append_metrics(spark, path, m)
    hist.append_metrics(spark, path, m, skip_existing=True)  # the guard is opt-in
    h = hist.fetch_all_metrics(spark, path, "events")
    n = m.count()
    assert h.count() == n
    assert hist.fetch_recent_metrics(h, 3).count() == 3
    assert hist.metrics_exist_on(h, "events", dt.date(2024, 1, 5)).first()["exists"]
    assert not hist.metrics_exist_on(h, "events", dt.date(2023, 1, 5)).first()["exists"]
    r7 = reports.report(h, "r07_project_summary", "events").first()
    assert r7["total_runs"] == n
    feeds = reports.dashboard_feeds(h, "events")
    assert feeds.count() == 6 * n


def test_stream_equals_batch(spark, tmpdir_path):
    from pyspark.sql import types as T

    from vigil.catalog_io import EVENTS_CSV_SCHEMA
    from vigil.streaming.monitor import stream_monitor

    ev = spark.read.parquet(f"{SF0001}/events.parquet").withColumn("snapshot_date", F.to_date("ts"))
    src = os.path.join(tmpdir_path, "src")
    first = ev.filter(F.col("snapshot_date") <= F.lit(dt.date(2024, 1, 10)))
    rest = ev.filter(F.col("snapshot_date") > F.lit(dt.date(2024, 1, 10)))
    snap.write_snapshot_files(first, src, "snapshot_date")
    path, ck = os.path.join(tmpdir_path, "h"), os.path.join(tmpdir_path, "ck")
    schema = T._parse_datatype_string(EVENTS_CSV_SCHEMA)
    stream_monitor(spark, src, schema, path, ck, EVENTS_CFG, "events", as_of=AS_OF_EVENTS)
    snap.write_snapshot_files(rest, os.path.join(tmpdir_path, "src2"), "snapshot_date")
    # new files arrive: move them into the watched folder, second run picks them up
    jvm = spark.sparkContext._jvm
    fs, root = snap._fs_path(spark, os.path.join(tmpdir_path, "src2"))
    for f in fs.listStatus(root):
        fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(os.path.join(src, f.getPath().getName())))
    stream_monitor(spark, src, schema, path, ck, EVENTS_CFG, "events", as_of=AS_OF_EVENTS)
    got = hist.fetch_all_metrics(spark, path, "events").drop("id", "created_at")
    batch = hist.history_rows(run_series(snap.series_from_table(spark.read.parquet(f"{SF0001}/events.parquet"),
                                                                F.to_date("ts"), "snapshot"), EVENTS_CFG,
                                         key="snapshot", as_of=AS_OF_EVENTS, dataset_name="events")
                              .metrics()).drop("id", "created_at")
    assert got.count() == batch.count() == 30
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_series_equals_pair_for_every_date(spark):
    ev = spark.read.parquet(f"{SF0001}/events.parquet").withColumn("d", F.to_date("ts"))
    cfg = EVENTS_CFG
    series = run_series(ev.withColumnRenamed("d", "snapshot"), cfg, key="snapshot", as_of=AS_OF_EVENTS)
    sm = {r["snapshot"]: r for r in series.metrics().collect()}
    for day in (dt.date(2024, 1, 2), dt.date(2024, 1, 17)):
        cur = ev.filter(F.col("d") == F.lit(day)).drop("d")
        prev = ev.filter(F.col("d") == F.lit(day - dt.timedelta(days=1))).drop("d")
        pm = current_only(run_all_checks(cur, prev, cfg, as_of=AS_OF_EVENTS).metrics()).first()
        for f in ("row_count", "quality_score", "drift_score", "correlation_drift", "entropy_delta",
                  "volume_change_pct", "outlier_count", "checks_passed"):
            assert pm[f] == pytest.approx(sm[day][f]), f


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40),
       st.lists(st.sampled_from(["a", "b", "c", "d", "e"]), min_size=1, max_size=40))
def test_psi_and_entropy_properties(spark, xs, cats):
    rows = [(k, x, cats[i % len(cats)]) for k in (1, 2) for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "snapshot int, x double, c string")
    cfg = blank_config(psi_column="x", entropy_column="c", row_duplicates=False)
    run = run_series(df, cfg, key="snapshot")
    psi = {r["snapshot"]: r["psi_score"] for r in run.checks.psi().collect()}
    assert psi[2] == pytest.approx(0.0, abs=1e-12)  # identical snapshots
    ent = {r["snapshot"]: r for r in run.checks.entropy().collect()}
    k = len(set(cats[i % len(cats)] for i in range(len(xs))))
    assert -1e-9 <= ent[1]["current_entropy"] <= np.log2(k) + 1e-9
    m = {r["snapshot"]: r["quality_score"] for r in run.metrics().collect()}
    assert all(0 <= v <= 100 for v in m.values())
