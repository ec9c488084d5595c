"""Quartiles without a round limit, CSV dialect, codes, reruns."""

import datetime as dt
import os

import numpy as np
from pyspark.sql import functions as F

from vigil.config import blank_config
from vigil.operators.quantiles import select_quantiles
from vigil.plans.run import run_series
from vigil.sources import history as hist
from vigil.sources import snapshots as snap


def test_quantiles_over_any_range(spark):
    rng = np.random.default_rng(0)
    cases = {
        0: [float(x) for x in 10.0 ** rng.uniform(-2, 2, 300)],
        1: [float(x) for x in rng.normal(size=399)] + [float("inf")],
        2: [float("-inf")] * 150 + [1.0, 2.0] + [float("inf")] * 150,
        3: [-1.7e308, 1.7e308, 0.0, 3.0, 1.0] * 2,
        4: [7.0] * 200,
    }
    df = spark.createDataFrame([(k, x) for k, xs in cases.items() for x in xs], "k int, x double")
    want = {r.k: r.q for r in df.groupBy("k").agg(F.expr("percentile(x, array(0.25, 0.75))").alias("q")).collect()}
    for bins, most in ((64, 10), (16384, 100_000)):
        got = {r.k: r.q_0 for r in select_quantiles(df, "k", ["x"], bins=bins, collect_max=most).collect()}
        for k in cases:
            assert np.allclose(got[k], want[k], rtol=1e-12), (k, got[k], want[k])


def test_csv_dialect_and_codes(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "snapshot_2024-01-01.csv")
    with open(path, "w") as f:
        f.write('id,code,props,price\n1,12D,"{""k"": 1, ""b"": 2}",1.5\n2,7F,"two\nlines",2e3\n')
    rows = snap.load_csv(spark, path, multi_line=True).orderBy("id").collect()
    assert [r.code for r in rows] == ["12D", "7F"] and [r.price for r in rows] == [1.5, 2000.0]
    assert rows[0].props == '{"k": 1, "b": 2}' and rows[1].props == "two\nlines" and rows[0].id == 1


def test_rerun_replaces_a_day_and_odd_names_are_left_out(spark, tmpdir_path):
    day = spark.range(100).selectExpr("id", "DATE'2024-01-01' AS snapshot_date")
    for n in (100, 40):
        snap.write_snapshot_files(day.limit(n), tmpdir_path)
    with open(os.path.join(tmpdir_path, "snapshot_latest.csv"), "w") as f:
        f.write("id\n5\n")
    series = snap.scan_snapshot_series(spark, tmpdir_path)
    assert series.count() == 40 and series.select("snapshot_date").distinct().count() == 1
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    snap.write_snapshots(day, os.path.join(tmpdir_path, "p"))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def _csv(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_each_file_keeps_its_own_columns_and_types(spark, tmpdir_path):
    _csv(tmpdir_path, "snapshot_2024-01-01.csv", "id,price,qty\n1,2.5,7\n")
    _csv(tmpdir_path, "snapshot_2024-01-02.csv", "id,qty,price\n2,8,3.5\n")
    _csv(tmpdir_path, "snapshot_2024-01-03.csv", "id,price,note\n3,abc,x\n")
    rows = {r.id: r for r in snap.scan_snapshot_series(spark, tmpdir_path).collect()}
    assert (rows[1].price, rows[1].qty, rows[2].price, rows[2].qty) == ("2.5", 7, "3.5", 8)
    assert rows[3].qty is None and rows[1].note is None
    run = run_series(snap.scan_snapshot_series(spark, tmpdir_path),
                     blank_config(expected_columns=("id", "qty"), expected_dtypes={"price": ("float64",)}),
                     key="snapshot_date", schemas=snap.snapshot_schemas(spark, tmpdir_path))
    c9 = {r.snapshot_date.day: r for r in run.checks.schema_changes().collect()}
    assert c9[1].passed and c9[2].passed and not c9[3].passed
    assert (c9[3].columns_added, c9[3].columns_removed) == (["note"], ["qty"])
    assert c9[3].type_changes == ["price:float64->object"]
    assert [r.snapshot_date.day for r in run.checks.data_types().collect()] == [3]
    assert {r.snapshot_date.day: r.missing_columns for r in run.checks.column_existence().collect()} == {
        1: [], 2: [], 3: ["qty"]}
    flags = {(r.snapshot_date.day, r.check): r.passed for r in run.results().collect()}
    assert not flags[3, "schema_change_detection"] and flags[2, "schema_change_detection"]
    newest = snap.load_snapshot(spark, tmpdir_path, 1)
    assert dict(newest.dtypes)["price"] == "double" and newest.count() == 1
    # only the files of the day are read
    assert len(newest.inputFiles()) == 1 and snap.load_snapshot(spark, tmpdir_path, 3) is None


def test_a_null_snapshot_is_checked_like_any_other(spark):
    rows = [(i % 20, float(i % 20)) for i in range(37)] + [(99, 1e6)]
    df = spark.createDataFrame([(None, *r) for r in rows], "k int, id int, x double")
    df = df.unionByName(spark.createDataFrame([(1, i, float(i)) for i in range(30)], df.schema))
    run = run_series(df, blank_config(id_column="id", iqr_columns=("x",), zscore_columns=("x",), entropy_column="id",
                                      psi_column="x"), key="k")
    m = {r.check: r.passed for r in run.results().filter("k IS NULL").collect()}
    assert len(m) == 21 and None not in m.values()
    assert not m["outlier_detection_iqr"] and not m["duplicate_detection"] and not m["uniqueness_constraints"]
    assert run.checks.duplicates().filter("k IS NULL").first().duplicate_rows == 17


def test_single_checks_scan_only_what_they_need(spark):
    df = spark.range(50).selectExpr("id", "CAST(id AS DOUBLE) AS x", "id % 2 AS k")
    cfg = blank_config(id_column="id", iqr_columns=("x",), entropy_column="x")
    run = run_series(df, cfg, key="k")
    run.checks.null_values().collect()
    assert list(run.profile._views) == [frozenset()]
    run.checks.uniqueness().collect()
    assert set(run.profile._views) == {frozenset(), frozenset({"ids"})}
    # key and id are all that the id exchange carries
    assert run.profile.series.selectExpr("k", "id AS g").distinct().columns == ["k", "g"]


def test_stream_checks_whole_days_whatever_the_batches(spark, tmpdir_path):
    from pyspark.sql import types as T

    from vigil.streaming.monitor import stream_monitor

    src, path, ckpt = (os.path.join(tmpdir_path, x) for x in ("src", "hist", "ckpt"))
    os.makedirs(src)
    for day, n in ((1, 50), (2, 100)):
        for part in range(2):
            _csv(src, f"snapshot_2024-01-0{day}-{part}.csv", "id\n" + "".join(f"{part * n + i}\n" for i in range(n)))
    schema = T._parse_datatype_string("id BIGINT")
    go = lambda: stream_monitor(spark, src, schema, path, ckpt, blank_config(id_column="id"), "d",
                                as_of=dt.date(2024, 1, 5), max_files_per_trigger=1)
    go()
    rows = lambda: {r.timestamp.day: r for r in hist.fetch_all_metrics(spark, path, "d").collect()}
    assert {d: r.row_count for d, r in rows().items()} == {1: 100, 2: 200} and rows()[2].volume_change_pct == 100
    _csv(src, "snapshot_2024-01-01-late.csv", "id\n" + "".join(f"{1000 + i}\n" for i in range(100)))
    go()
    got = rows()
    assert {d: r.row_count for d, r in got.items()} == {1: 200, 2: 200} and got[2].volume_change_pct == 0
    assert hist.fetch_all_metrics(spark, path, "d").count() == 2
