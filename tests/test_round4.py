"""Passes of the monitor over text files, formats tried for dates in text,
and stages of many column expressions."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF0001
from vigil import session
from vigil.catalog_io import EVENTS_CSV_SCHEMA
from vigil.catalog_monitor import AS_OF_EVENTS, EVENTS_CFG
from vigil.config import blank_config
from vigil.operators import profile
from vigil.plans.run import run_series
from vigil.sources import history as hist
from vigil.sources import snapshots as snap
from vigil.streaming import monitor


def test_monitor_parses_its_files_once(spark, tmpdir_path, monkeypatch):
    ev = spark.read.parquet(f"{SF0001}/events.parquet").withColumn("snapshot_date", F.to_date("ts"))
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    src = os.path.join(tmpdir_path, "src")
    snap.write_snapshot_files(ev.where(F.col("snapshot_date").isin(days)), src, "snapshot_date")
    seen = {}

    def save(prof, *a, f=monitor.state.save):
        seen["level"], seen["series"] = prof.series.storageLevel, prof.series
        return f(prof, *a)

    monkeypatch.setattr(monitor.state, "save", save)
    kept = spark.sparkContext._jsc.getPersistentRDDs().size
    before = kept()
    n = monitor.process_days(spark, days, src, T._parse_datatype_string(EVENTS_CSV_SCHEMA), os.path.join(tmpdir_path, "h"),
                             EVENTS_CFG, "events", as_of=AS_OF_EVENTS)
    assert n == 2
    assert seen["level"].useDisk and not seen["level"].useMemory
    # let go at the end
    assert not seen["series"].storageLevel.useDisk and kept() <= before


def test_stream_keeps_rows_and_tries_one_format(spark, tmpdir_path, monkeypatch):
    ev = spark.read.parquet(f"{SF0001}/events.parquet").withColumn("snapshot_date", F.to_date("ts"))
    src, path = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "h")
    snap.write_snapshot_files(ev.where(F.col("snapshot_date") <= dt.date(2024, 1, 2)), src, "snapshot_date")
    levels, formats = [], set()

    def save(prof, *a, f=monitor.state.save):
        levels.append(prof.series.storageLevel.useDisk)
        return f(prof, *a)

    def ts_sql(kind, name, fmt=None, f=profile.ts_sql):
        formats.add(fmt)
        return f(kind, name, fmt)

    monkeypatch.setattr(monitor.state, "save", save)
    monkeypatch.setattr(profile, "ts_sql", ts_sql)
    monitor.stream_monitor(spark, src, T._parse_datatype_string(EVENTS_CSV_SCHEMA), path, os.path.join(tmpdir_path, "ck"),
                           EVENTS_CFG, "events", as_of=AS_OF_EVENTS)
    assert levels == [True] and formats == {None}
    assert hist.fetch_all_metrics(spark, path, "events").count() == 2


@pytest.mark.parametrize("days, chosen, tried", [
    (["2024-01-02", "2024-01-03 04:05:06", None], None, 1),   # ISO reads all: no other format is tried
    ([None, None], None, 1),
    (["2024-01-02", "02/01/2024", "13/01/2024"], "dd/MM/yyyy", 3),
    (["2024-01-02", "2024-01-03", "02/01/2024"], None, 3),
    (["2024-01-02", "13/01/2024", "x"], None, 3),             # a tie: ISO
])
def test_formats_are_tried_where_iso_fails(spark, monkeypatch, days, chosen, tried):
    formats = []

    def ts_sql(kind, name, fmt=None, f=profile.ts_sql):
        formats.append(fmt)
        return f(kind, name, fmt)

    df = spark.createDataFrame([(1, d) for d in days], "k int, day string")
    cfg = blank_config(date_column="day", date_formats=("dd/MM/yyyy", "MM/dd/yyyy"), row_duplicates=False)
    p = profile.Profile(df, cfg, key="k")
    monkeypatch.setattr(profile, "ts_sql", ts_sql)
    assert p.date_format == chosen
    assert len(formats) == tried


def test_stages_stay_below_what_the_jvm_compiles(spark):
    name, df = session.METHOD_LIMIT, spark.createDataFrame([(1, 2.0)], "k int, x double")
    old = spark.conf.get(name, "65535")
    try:
        spark.conf.unset(name)
        run_series(df, blank_config(row_duplicates=False), key="k").close()
        assert spark.conf.get(name) == "8000"
        spark.conf.set(name, "30000")  # the user's own
        run_series(df, blank_config(row_duplicates=False), key="k").close()
        assert spark.conf.get(name) == "30000"
    finally:
        spark.conf.set(name, old)


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("names, by_pattern", [
    (["snapshot_2024-01-01-part-0.csv", "snapshot_2024-01-02.csv"], False),
    (["day=2024-01-01/part-0.csv", "day=2024-01-02/a=b.csv"], False),
    (["a day=2024-01-01/part 0.csv", "snapshot_2024-01-02 b%20.csv"], False),       # names that a URI encodes
    (["day=2024-01-01/snapshot_2024-01-01.csv", "d=2024-01-02.csv"], False),
    (["day=2024-01-01/snapshot_2025-05-05.csv", "snapshot_2024-01-02.csv"], True),  # the folder's date counts
])
def test_day_of_a_row_without_a_search_in_its_path(spark, tmpdir_path, names, by_pattern):
    for i, name in enumerate(names):
        path = os.path.join(tmpdir_path, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(f"x\n{i + 1}\n")
    s = snap.scan_snapshot_series(spark, tmpdir_path)
    assert {(r.snapshot_date, r.x) for r in s.collect()} == {(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)}
    assert ("regexp_extract(" in _plan(s)) == by_pattern
    s.withColumn("y", F.col("x") * 2).write.partitionBy("snapshot_date").parquet(os.path.join(tmpdir_path, "p"))
    p = snap.scan_snapshot_series(spark, os.path.join(tmpdir_path, "p"))
    assert {(r.snapshot_date, r.y) for r in p.collect()} == {(dt.date(2024, 1, 1), 2), (dt.date(2024, 1, 2), 4)}
    assert "regexp_extract(" not in _plan(p)
