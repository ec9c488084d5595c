"""Registered queries for sources and sinks (S1-S11). Inputs are files that
Spark writes from the driver tables into fresh folders under the shared
checkpoint folder, then reads back through the operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from .catalog import KEY, register, table, tidy
from .catalog_ml import scratch
from .config import NULL_TOKENS, blank_config
from .plans.run import run_series
from .catalog_monitor import DATASET, HISTORY_DBL_SQL, dec_to_double, events_metrics
from .sources import history as hist
from .sources import snapshots as snap


def _events_snapshot_dir(spark, sf) -> str:
    """events written as one ``snapshot_YYYY-MM-DD.csv`` file per day."""
    d = scratch(spark, "snapshots")
    e = table(spark, sf, "events").withColumn("snapshot_date", F.to_date("ts"))
    snap.write_snapshot_files(e, d, "snapshot_date")
    return d


ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
EVENT_SQL = "SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props FROM events"


def _events_text(df):
    return tidy(df.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "user_id",
                          "event_type", "value", "props"))


@register("s1_load_csv", f"SELECT {ORDER_COLS.replace('o_orderdate', 'CAST(o_orderdate AS DATE) AS o_orderdate')} FROM orders")
def s1(spark, sf):
    d = scratch(spark, "csv")
    table(spark, sf, "orders").selectExpr(*ORDER_COLS.split(", ")).write.options(**snap.CSV_WRITE).csv(d)
    return tidy(snap.load_csv(spark, d).withColumn("o_orderdate", F.to_date(F.col("o_orderdate").cast("timestamp_ntz"))))


@register("s1_quoted_text", """
SELECT doc_id, md5(text) AS text_md5, CAST(length(text) AS BIGINT) AS n
FROM (SELECT doc_id, CASE WHEN text NOT IN (""" + ", ".join(f"'{x}'" for x in NULL_TOKENS) + """) THEN text END AS text
      FROM documents)""")
def s1_text(spark, sf):
    """Whole texts (quotes, commas and line breaks in quoted cells) through the loader."""
    d = scratch(spark, "csv-text")
    table(spark, sf, "documents").select("doc_id", "text").write.options(**snap.CSV_WRITE).csv(d)
    return tidy(snap.load_csv(spark, d, multi_line=True)
                .select("doc_id", F.md5("text").alias("text_md5"), F.char_length("text").cast("long").alias("n")))


@register("s2_load_latest_snapshot", EVENT_SQL + """
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def s2(spark, sf):
    return _events_text(snap.load_snapshot(spark, _events_snapshot_dir(spark, sf)))


@register("s3_load_previous_snapshot", "WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events ORDER BY d DESC "
          "LIMIT 2) " + EVENT_SQL + " WHERE CAST(ts AS DATE) = (SELECT min(d) FROM d)")
def s3(spark, sf):
    return _events_text(snap.load_snapshot(spark, _events_snapshot_dir(spark, sf), steps_back=1))


@register("s4_add_ingestion_timestamp", """
SELECT *, '2024-01-01 08:00:00' AS ingestion_timestamp FROM customer""")
def s4(spark, sf):
    return tidy(snap.add_ingestion_timestamp(table(spark, sf, "customer"), _dt.datetime(2024, 1, 1, 8, 0, 0)))


@register("s5_write_snapshots", """
SELECT CAST(ts AS DATE) AS snapshot_date, count(*) AS n, round(sum(value), 6) AS total_value
FROM events GROUP BY 1""")
def s5(spark, sf):
    d = scratch(spark, "parts")
    e = table(spark, sf, "events").withColumn("snapshot_date", F.to_date("ts"))
    snap.write_snapshots(e, d, "snapshot_date")
    back = spark.read.parquet(d)
    return tidy(back.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total_value")))


@register("s6_scan_snapshot_series", """
WITH k AS (SELECT CAST(ts AS DATE) AS snapshot_date, count(*) AS n FROM events GROUP BY 1)
SELECT snapshot_date, CAST(n AS BIGINT) AS n, CAST(lag(snapshot_date) OVER (ORDER BY snapshot_date) AS VARCHAR)
       AS previous_date FROM k""")
def s6(spark, sf):
    s = snap.scan_snapshot_series(spark, _events_snapshot_dir(spark, sf))
    keys = snap.snapshot_keys(s)
    counts = s.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))
    return keys.join(counts, "snapshot_date").select("snapshot_date", "n",
                                                     F.col("prev_key").cast("string").alias("previous_date"))


# orders by year, as files that differ: 1994 reordered, 1995 without the priority, 1996 with one more column,
# 1997 with customer keys that are text; other years as they are
DRIFT_COLS = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
DRIFT = {1994: ("o_totalprice", "o_orderpriority", "o_custkey", "o_orderkey"),
         1995: ("o_orderkey", "o_custkey", "o_totalprice"),
         1996: (*DRIFT_COLS, "o_orderstatus"),
         1997: ("o_orderkey", "concat('C', o_custkey) AS o_custkey", "o_totalprice", "o_orderpriority")}


def _drift_dir(spark, sf) -> str:
    d = scratch(spark, "drift")
    o = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    first = F.make_date("y", F.lit(1), F.lit(1)).alias("snapshot_date")
    for year, cols in [(None, DRIFT_COLS), *DRIFT.items()]:
        part = o.filter(~F.col("y").isin(list(DRIFT)) if year is None else F.col("y") == year)
        snap.write_snapshot_files(part.select(*[F.expr(c) for c in cols], first), d)
    return d


@register("s6_schema_drift", """
SELECT make_date(y, 1, 1) AS snapshot_date, o_orderkey, CASE WHEN y = 1997 THEN 'C' ELSE '' END || o_custkey AS o_custkey,
       round(o_totalprice, 6) AS o_totalprice, CASE WHEN y <> 1995 THEN o_orderpriority END AS o_orderpriority,
       CASE WHEN y = 1996 THEN o_orderstatus END AS o_orderstatus
FROM (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)""")
def s6_drift(spark, sf):
    """Columns are bound by each file's own header, missing ones are null."""
    s = snap.scan_snapshot_series(spark, _drift_dir(spark, sf))
    return tidy(s.select("snapshot_date", *DRIFT_COLS, "o_orderstatus"))


@register("c09_schema_change_series", """
WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
c(col, dt) AS (VALUES ('o_orderkey', 'int64'), ('o_custkey', 'int64'), ('o_totalprice', 'float64'),
               ('o_orderpriority', 'object'), ('o_orderstatus', 'object')),
d AS (SELECT y, col, CASE WHEN y = 1997 AND col = 'o_custkey' THEN 'object' ELSE dt END AS dt FROM y, c
      WHERE NOT (y = 1995 AND col = 'o_orderpriority') AND (y = 1996 OR col <> 'o_orderstatus')),
p AS (SELECT y, lag(y) OVER (ORDER BY y) AS py FROM y),
x AS (SELECT p.y, k.col, a.dt AS cur, b.dt AS prev FROM p JOIN c k ON p.py IS NOT NULL
      LEFT JOIN d a ON a.y = p.y AND a.col = k.col LEFT JOIN d b ON b.y = p.py AND b.col = k.col),
g AS (SELECT y, coalesce(string_agg(col, ',' ORDER BY col) FILTER (WHERE cur IS NOT NULL AND prev IS NULL), '') AS ca,
             coalesce(string_agg(col, ',' ORDER BY col) FILTER (WHERE cur IS NULL AND prev IS NOT NULL), '') AS cr,
             coalesce(string_agg(col || ':' || prev || '->' || cur, ',' ORDER BY col) FILTER (WHERE cur <> prev), '') AS ct
      FROM x GROUP BY y)
SELECT make_date(p.y, 1, 1) AS snapshot_date, ca AS columns_added, cr AS columns_removed, ct AS type_changes,
       CAST(coalesce(ca || cr || ct = '', true) AS INTEGER) AS passed
FROM p LEFT JOIN g USING (y)""")
def c09_series(spark, sf):
    """Every yearly file against the one before it, by its own columns and types."""
    d = _drift_dir(spark, sf)
    with_schema = snap.snapshot_schemas(spark, d)
    run = run_series(snap.scan_snapshot_series(spark, d), blank_config(row_duplicates=False), key="snapshot_date",
                     schemas=with_schema)
    return tidy(run.checks.schema_changes().select(
        "snapshot_date", *[F.array_join(c, ",").alias(c) for c in ("columns_added", "columns_removed", "type_changes")],
        "passed"))


_HIST_OUT = ("dataset_name, timestamp, row_count, null_percentage, duplicate_count, quality_score, anomaly_flag, "
             "drift_score, outlier_count, volume_change_pct, max_skewness, entropy_delta, correlation_drift, "
             "checks_passed, checks_failed, total_checks")


def _stored_history(spark, sf, twice=False):
    path = scratch(spark, "history")
    hist.create_metrics_history(spark, path)
    m = events_metrics(spark, sf)
    hist.append_metrics(spark, path, m)
    if twice:  # a retried append with the guard on must not duplicate rows
        hist.append_metrics(spark, path, m, skip_existing=True)
    return hist.fetch_all_metrics(spark, path, DATASET)


@register("s7_create_metrics_history", f"SELECT {_HIST_OUT} FROM ({HISTORY_DBL_SQL})")
def s7(spark, sf):
    """Creating the table again leaves the rows it holds."""
    path = scratch(spark, "history")
    hist.create_metrics_history(spark, path)
    hist.append_metrics(spark, path, events_metrics(spark, sf))
    return tidy(dec_to_double(hist.create_metrics_history(spark, path).drop("id", "created_at")))


@register("s8_append_metrics", f"SELECT {_HIST_OUT} FROM ({HISTORY_DBL_SQL})")
def s8(spark, sf):
    return tidy(dec_to_double(_stored_history(spark, sf, twice=True).drop("id", "created_at")))


@register("s9_fetch_all_metrics", f"SELECT {_HIST_OUT} FROM ({HISTORY_DBL_SQL})")
def s9(spark, sf):
    return tidy(dec_to_double(_stored_history(spark, sf).drop("id", "created_at")))


@register("s10_fetch_recent_metrics", f"""
SELECT timestamp, row_count, quality_score FROM ({HISTORY_DBL_SQL}) ORDER BY timestamp DESC LIMIT 5""")
def s10(spark, sf):
    h = _stored_history(spark, sf)
    return tidy(dec_to_double(hist.fetch_recent_metrics(h, 5).select("timestamp", "row_count", "quality_score")))


@register("s11_metrics_exist_today", f"""
SELECT '{DATASET}' AS dataset_name, DATE '2024-01-30' AS day,
       CAST(count(*) > 0 AS INTEGER) AS exists FROM ({HISTORY_DBL_SQL}) WHERE CAST(timestamp AS DATE) = DATE '2024-01-30'""")
def s11(spark, sf):
    h = _stored_history(spark, sf)
    return tidy(hist.metrics_exist_on(h, DATASET, _dt.date(2024, 1, 30)))


EVENTS_CSV_SCHEMA = ("event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING, value DOUBLE, "
                     "props STRING")


@register("p3_stream_monitor", f"SELECT {_HIST_OUT} FROM ({HISTORY_DBL_SQL})")
def p3(spark, sf):
    """events written as daily snapshot files, consumed by the streaming
    monitor (all pending files in one available-now run): the history it
    writes equals the batch backfill's."""
    from pyspark.sql import types as T

    from .catalog_monitor import AS_OF_EVENTS, EVENTS_CFG
    from .streaming.monitor import stream_monitor

    src = _events_snapshot_dir(spark, sf)
    path = scratch(spark, "history")
    stream_monitor(spark, src, T._parse_datatype_string(EVENTS_CSV_SCHEMA), path, scratch(spark, "stream-ckpt"),
                   EVENTS_CFG, DATASET, key="snapshot_date", as_of=AS_OF_EVENTS)
    return tidy(dec_to_double(hist.fetch_all_metrics(spark, path, DATASET).drop("id", "created_at")))
