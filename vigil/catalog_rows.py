"""Registered queries for row-level and key-level variants of the checks
(quarantine, types of values, dates in text, several keys), predecessors of
many snapshots, and monitoring after old files have gone."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .catalog import EVENTS_SQL, KEY, LINEITEM_SQL, events_series, lineitem_series, register, table, tidy
from .catalog_io import _HIST_OUT, EVENTS_CSV_SCHEMA
from .catalog_ml import scratch
from .catalog_monitor import AS_OF_EVENTS, DATASET, EVENT_TYPES, EVENTS_CFG, HISTORY_DBL_SQL, dec_to_double
from .config import blank_config
from .operators.quarantine import BROKEN, quarantine
from .plans.run import run_series
from .sources import history as hist
from .sources import snapshots as snap

_TYPES = ", ".join(f"'{t}'" for t in EVENT_TYPES)


@register("c05_quarantine_rows", f"""
SELECT snapshot, event_id, concat_ws(',',
  CASE WHEN value < 0.0 OR value > 100.0 THEN 'range: value' END,
  CASE WHEN NOT regexp_matches(props, '^\\{{"k": \\d+\\}}$') THEN 'pattern: props' END,
  CASE WHEN value <= 0 THEN 'value_positive' END,
  CASE WHEN value < 0 OR value > 100 THEN 'value_range' END,
  CASE WHEN event_type IS NULL OR event_type NOT IN ({_TYPES}) THEN 'valid_event_type' END,
  CASE WHEN event_type IS NOT NULL AND props IS NOT NULL AND trim(props) = '' THEN 'empty: props' END,
  CASE WHEN event_type IS NOT NULL AND props IS NULL THEN 'missing: props' END) AS broken_rules
FROM {EVENTS_SQL}""")
def quarantine_rows(spark, sf):
    """Every event through the two sinks; some values and types are made bad by
    the table itself only where it is so."""
    good, bad = quarantine(events_series(spark, sf), EVENTS_CFG, scratch(spark, "quarantine"), KEY)
    out = good.select(KEY, "event_id", F.lit("").alias(BROKEN)).unionByName(
        bad.select(KEY, "event_id", F.array_join(BROKEN, ",").alias(BROKEN)))
    return out


@register("c05_quarantine_counts", f"""
WITH e AS {EVENTS_SQL},
r AS (SELECT snapshot, 'value_range' AS rule, count(*) FILTER (WHERE value < 0 OR value > 40) AS c FROM e GROUP BY snapshot
      UNION ALL SELECT snapshot, 'valid_event_type', count(*) FILTER (WHERE event_type IS NULL OR event_type <> 'view')
      FROM e GROUP BY snapshot)
SELECT snapshot, rule, CAST(c AS BIGINT) AS quarantined, CAST(c AS BIGINT) AS counted FROM r WHERE c > 0""")
def quarantine_counts(spark, sf):
    """Narrow rules that many events break: rows in the sink per rule beside
    the counts of the check."""
    from .config import SetRule

    cfg = blank_config(bounded_column=("value", 0, 40), rule_names=("p", "l", "value_range"),
                       set_rules=(SetRule("valid_event_type", "event_type", ("view",)),), row_duplicates=False)
    _, bad = quarantine(events_series(spark, sf), cfg, scratch(spark, "quarantine"), KEY)
    found = bad.select(KEY, F.explode(BROKEN).alias("rule")).groupBy(KEY, "rule").agg(F.count("*").alias("quarantined"))
    run = run_series(events_series(spark, sf), cfg, key=KEY)
    counted = run.checks.business_rules().withColumnRenamed("violation_count", "counted")
    return found.join(counted, [KEY, "rule"], "left")


@register("c03_value_types", """
WITH o AS (SELECT *, CAST(year(o_orderdate) AS BIGINT) AS snapshot FROM orders)
SELECT snapshot, 'code' AS column_name, t AS data_type, CAST(count(*) AS BIGINT) AS value_count,
       CAST(count(*) FILTER (WHERE o_orderkey % 7 = 0 OR (t = 'int64' AND o_orderkey % 5 = 0)) AS BIGINT) AS failing
FROM o, (VALUES ('int64'), ('float64')) x(t) WHERE o_orderkey % 3 <> 0 GROUP BY snapshot, t""")
def value_types(spark, sf):
    """Order keys as text, some with a letter, some with a fraction, some null."""
    o = table(spark, sf, "orders").select(F.year("o_orderdate").cast("long").alias(KEY), F.expr(
        "CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN concat('x', o_orderkey) "
        "WHEN o_orderkey % 5 = 0 THEN concat(o_orderkey, '.5') ELSE concat(' ', o_orderkey, ' ') END").alias("code"))
    run = run_series(o, blank_config(value_types={"code": ("int64", "float64")}, row_duplicates=False), key=KEY)
    return run.checks.value_types()


@register("c10_text_dates", """
WITH o AS (SELECT *, CAST(year(o_orderdate) AS BIGINT) AS snapshot, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT snapshot, 'dd/MM/yyyy' AS date_format, CAST(count(*) AS BIGINT) AS value_count,
       CAST(count(*) FILTER (WHERE o_orderkey % 13 = 0) AS BIGINT) AS unparsed,
       max(d) FILTER (WHERE o_orderkey % 13 <> 0) AS latest_date,
       CAST(DATE '1999-01-01' - max(d) FILTER (WHERE o_orderkey % 13 <> 0) AS BIGINT) AS age_days
FROM o GROUP BY snapshot""")
def text_dates(spark, sf):
    """Order dates as day/month/year text, every thirteenth unreadable."""
    o = table(spark, sf, "orders").select(F.year("o_orderdate").cast("long").alias(KEY), F.expr(
        "CASE WHEN o_orderkey % 13 = 0 THEN 'unknown' ELSE date_format(o_orderdate, 'dd/MM/yyyy') END").alias("day"))
    run = run_series(o, blank_config(date_column="day", row_duplicates=False), key=KEY, as_of=_dt.date(1999, 1, 1))
    return run.checks.date_parsing().drop("column_name").join(
        run.checks.freshness().select(KEY, "latest_date", "age_days"), KEY)


@register("c19_composite_keys", f"""
WITH l AS {LINEITEM_SQL}
SELECT snapshot, 'l_orderkey, l_linenumber' AS columns, CAST(count(*) AS BIGINT) AS total_rows,
       CAST(count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS unique_values,
       CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS duplicates,
       CAST(count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS INTEGER) AS passed
FROM l WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY snapshot
UNION ALL
SELECT snapshot, 'l_partkey, l_suppkey', CAST(count(*) AS BIGINT), CAST(count(DISTINCT (l_partkey, l_suppkey)) AS BIGINT),
       CAST(count(*) - count(DISTINCT (l_partkey, l_suppkey)) AS BIGINT),
       CAST(count(*) = count(DISTINCT (l_partkey, l_suppkey)) AS INTEGER)
FROM l WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL GROUP BY snapshot
UNION ALL
SELECT snapshot, 'l_orderkey', CAST(count(*) AS BIGINT), CAST(count(DISTINCT l_orderkey) AS BIGINT),
       CAST(count(*) - count(DISTINCT l_orderkey) AS BIGINT), CAST(count(*) = count(DISTINCT l_orderkey) AS INTEGER)
FROM l WHERE l_orderkey IS NOT NULL GROUP BY snapshot""")
def composite_keys(spark, sf):
    cfg = blank_config(unique_keys=(("l_orderkey", "l_linenumber"), ("l_partkey", "l_suppkey"), ("l_orderkey",)),
                       row_duplicates=False)
    return tidy(run_series(lineitem_series(spark, sf), cfg, key=KEY).checks.unique_keys())


@register("p2_many_keys", """
WITH u AS (SELECT user_id AS snapshot, count(*) AS n FROM events GROUP BY user_id),
p AS (SELECT *, lag(n) OVER (ORDER BY snapshot NULLS FIRST) AS p FROM u)
SELECT snapshot, CAST(p AS BIGINT) AS previous_rows, CAST(n AS BIGINT) AS current_rows,
       round(abs(n - p) / CAST(greatest(p, 1) AS DOUBLE) * 100, 6) AS change_pct,
       CAST(p IS NULL OR abs(n - p) / CAST(greatest(p, 1) AS DOUBLE) * 100 <= 10.0 AS INTEGER) AS passed
FROM p""")
def many_keys(spark, sf):
    """A snapshot for every user; predecessors are found range by range, as for
    millions of snapshots, whatever the size."""
    ev = table(spark, sf, "events").withColumn(KEY, F.col("user_id"))
    cfg = blank_config(volume_threshold_pct=10.0, row_duplicates=False, window_rows=0)
    return tidy(run_series(ev, cfg, key=KEY).checks.volume())


@register("p3_previous_gone", f"SELECT {_HIST_OUT} FROM ({HISTORY_DBL_SQL})")
def previous_gone(spark, sf):
    """Daily files of events arrive in two halves; before the second is
    checked, the files of the first have gone. The history is that of the
    whole series."""
    from .streaming.monitor import stream_monitor

    ev = table(spark, sf, "events").withColumn("snapshot_date", F.to_date("ts"))
    src, ck, path = scratch(spark, "snapshots"), scratch(spark, "stream-ckpt"), scratch(spark, "history")
    half = F.col("snapshot_date") <= F.lit(_dt.date(2024, 1, 15))
    schema = T._parse_datatype_string(EVENTS_CSV_SCHEMA)
    jvm = spark.sparkContext._jvm
    for part in (half, ~half):
        fs, root = snap._fs_path(spark, src)
        if fs.exists(root):
            fs.rename(root, jvm.org.apache.hadoop.fs.Path(scratch(spark, "archive")))
        snap.write_snapshot_files(ev.where(part), src, "snapshot_date")
        stream_monitor(spark, src, schema, path, ck, EVENTS_CFG, DATASET, as_of=AS_OF_EVENTS)
    return tidy(dec_to_double(hist.fetch_all_metrics(spark, path, DATASET).drop("id", "created_at")))


@register("s6_partitioned_layout", """
SELECT CAST(ts AS DATE) AS snapshot_date, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT event_id) AS BIGINT) AS ids,
       round(sum(value), 6) AS total, CAST(sum(length(props)) AS BIGINT) AS chars FROM events GROUP BY 1""")
def partitioned_layout(spark, sf):
    """What S5 writes into partition folders (odd days CSV, even days Parquet)
    read back as one series."""
    ev = table(spark, sf, "events").withColumn("snapshot_date", F.to_date("ts"))
    path = scratch(spark, "partitioned")
    odd = F.dayofmonth("snapshot_date") % 2 == 1
    snap.write_snapshots(ev.where(odd), path, fmt="csv")
    snap.write_snapshots(ev.where(~odd), path, fmt="parquet")
    data = snap.scan_snapshot_series(spark, path)
    return tidy(data.groupBy("snapshot_date").agg(
        F.count("*").alias("n"), F.countDistinct("event_id").alias("ids"), F.sum("value").alias("total"),
        F.sum(F.length("props")).alias("chars")))


@register("s8_row_versions", f"SELECT {_HIST_OUT} FROM ({HISTORY_DBL_SQL})")
def row_versions(spark, sf):
    """History rows written twice, the first time wrong: the later versions
    count, before and after compaction."""
    from .catalog_monitor import events_metrics

    path, m = scratch(spark, "history"), events_metrics(spark, sf)
    hist.replace_metrics(spark, path, m.withColumn("row_count", F.lit(0).cast("long")))
    hist.replace_metrics(spark, path, m)
    hist.compact_metrics(spark, path)
    return tidy(dec_to_double(hist.fetch_all_metrics(spark, path, DATASET).drop("id", "created_at")))
