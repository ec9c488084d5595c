"""Registered queries over the driver tables, each with an equivalent DuckDB
SQL oracle. Every query reads whole tables (or data Spark derives from
them); snapshots are cut from the tables by a key expression (ship year,
order year, event day, language, ...), so a query exercises the series
engine on many snapshots at once.

Output conventions shared with the oracle: the snapshot key is called
``snapshot``; counts are BIGINT; flags are INTEGER 0/1; doubles are rounded
to 6 places on both sides.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .config import SetRule, blank_config
from .plans.run import current_only, run_all_checks, run_series
from .sources.snapshots import series_from_table

KEY = "snapshot"
QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tidy(df: DataFrame) -> DataFrame:
    """Round doubles to 6 places and turn booleans into 0/1 integers."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, 6)
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        out.append(c.alias(f.name))
    return df.select(*out)


# ----------------------------------------------------------------- series
def orders_series(spark, sf, nullify=True):
    o = table(spark, sf, "orders")
    if nullify:
        o = o.withColumn("o_orderpriority", F.expr("nullif(o_orderpriority, '4-NOT SPECIFIED')"))
    return series_from_table(o, F.year("o_orderdate").cast("long"), KEY)


def lineitem_series(spark, sf):
    return series_from_table(table(spark, sf, "lineitem"), F.year("l_shipdate").cast("long"), KEY)


def events_series(spark, sf):
    return series_from_table(table(spark, sf, "events"), F.to_date("ts"), KEY)


ORDERS_SQL = ("(SELECT * REPLACE (nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority), "
              "CAST(year(o_orderdate) AS BIGINT) AS snapshot FROM orders)")
LINEITEM_SQL = "(SELECT *, CAST(year(l_shipdate) AS BIGINT) AS snapshot FROM lineitem)"
EVENTS_SQL = "(SELECT *, CAST(ts AS DATE) AS snapshot FROM events)"

ORDERS_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


# ================================================================= C1
def _c01_sql():
    parts = [f"SELECT snapshot, '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
             f"round(CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100, 6) AS null_pct "
             f"FROM {ORDERS_SQL} GROUP BY snapshot" for c in ORDERS_COLS]
    return "\nUNION ALL\n".join(parts)


@register("c01_null_value_detection", _c01_sql())
def c01(spark, sf):
    run = run_series(orders_series(spark, sf), blank_config(row_duplicates=False), key=KEY)
    return tidy(run.checks.null_values_by_column())


@register("c01_null_summary", f"""
SELECT snapshot, CAST({' + '.join(f'(count(*) - count({c}))' for c in ORDERS_COLS)} AS BIGINT) AS total_nulls,
       round(({' + '.join(f'CAST(count(*) - count({c}) AS DOUBLE) / count(*)' for c in ORDERS_COLS)}) / {len(ORDERS_COLS)} * 100, 6)
         AS overall_null_pct,
       CAST(({' + '.join(f'(count(*) - count({c}))' for c in ORDERS_COLS)}) = 0 AS INTEGER) AS passed
FROM {ORDERS_SQL} GROUP BY snapshot""")
def c01_summary(spark, sf):
    run = run_series(orders_series(spark, sf), blank_config(row_duplicates=False), key=KEY)
    return tidy(run.checks.null_values())


# ================================================================= C2
@register("c02_duplicate_detection", f"""
WITH l AS {LINEITEM_SQL},
d AS (SELECT snapshot, count(*) AS d FROM (SELECT DISTINCT * FROM l) GROUP BY snapshot),
a AS (SELECT snapshot, count(*) AS n, count(DISTINCT l_orderkey) AS did,
             max(CASE WHEN l_orderkey IS NULL THEN 1 ELSE 0 END) AS hn FROM l GROUP BY snapshot)
SELECT a.snapshot, CAST(a.n - d.d AS BIGINT) AS duplicate_rows, CAST(a.n - a.did - a.hn AS BIGINT) AS duplicate_ids,
       CAST(a.n - d.d = 0 AND a.n - a.did - a.hn = 0 AS INTEGER) AS passed
FROM a JOIN d USING (snapshot)""")
def c02(spark, sf):
    run = run_series(lineitem_series(spark, sf), blank_config(id_column="l_orderkey"), key=KEY)
    return tidy(run.checks.duplicates())


@register("c02_duplicate_documents", """
WITH t AS (SELECT text, source, n_chars, lang AS snapshot FROM documents),
d AS (SELECT snapshot, count(*) AS d FROM (SELECT DISTINCT * FROM t) GROUP BY snapshot),
a AS (SELECT snapshot, count(*) AS n, count(DISTINCT n_chars) AS did,
             max(CASE WHEN n_chars IS NULL THEN 1 ELSE 0 END) AS hn FROM t GROUP BY snapshot)
SELECT a.snapshot, CAST(a.n - d.d AS BIGINT) AS duplicate_rows, CAST(a.n - a.did - a.hn AS BIGINT) AS duplicate_ids,
       CAST(a.n - d.d = 0 AND a.n - a.did - a.hn = 0 AS INTEGER) AS passed
FROM a JOIN d USING (snapshot)""")
def c02_docs(spark, sf):
    d = table(spark, sf, "documents").select("text", "source", "n_chars", F.col("lang").alias(KEY))
    run = run_series(d, blank_config(id_column="n_chars"), key=KEY)
    return tidy(run.checks.duplicates())


# ================================================================= C3 / C4
_DT_SQL = ("CASE data_type WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN 'int32' WHEN 'SMALLINT' THEN 'int16' "
           "WHEN 'TINYINT' THEN 'int8' WHEN 'DOUBLE' THEN 'float64' WHEN 'FLOAT' THEN 'float32' "
           "WHEN 'BOOLEAN' THEN 'bool' WHEN 'TIMESTAMP' THEN 'datetime64[ns]' ELSE 'object' END")
ORDERS_DTYPES = {"o_orderkey": ("int32",), "o_custkey": ("int64", "int32"),
                 "o_totalprice": ("float64",), "o_orderdate": ("object",)}
ORDERS_EXPECTED = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_clerk")


@register("c03_data_type_validation", f"""
WITH t AS (SELECT column_name, {_DT_SQL} AS actual FROM information_schema.columns WHERE table_name = 'orders'),
e(column_name, expected) AS (VALUES {', '.join(f"('{c}', '{'|'.join(v)}')" for c, v in ORDERS_DTYPES.items())}),
k AS (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS snapshot FROM orders)
SELECT k.snapshot, e.column_name, e.expected, t.actual
FROM k, e JOIN t USING (column_name) WHERE NOT list_contains(string_split(e.expected, '|'), t.actual)""")
def c03(spark, sf):
    run = run_series(orders_series(spark, sf, False),
                     blank_config(expected_dtypes=ORDERS_DTYPES, row_duplicates=False), key=KEY)
    df = run.checks.data_types()
    return tidy(df.withColumn("expected", F.array_join("expected", "|")))


@register("c04_column_existence", f"""
WITH t AS (SELECT column_name, ordinal_position FROM information_schema.columns WHERE table_name = 'orders'),
e(column_name, pos) AS (VALUES {', '.join(f"('{c}', {i})" for i, c in enumerate(ORDERS_EXPECTED))}),
m AS (SELECT coalesce(string_agg(column_name, ',' ORDER BY pos), '') AS missing_columns
      FROM e WHERE column_name NOT IN (SELECT column_name FROM t)),
x AS (SELECT coalesce(string_agg(column_name, ',' ORDER BY ordinal_position), '') AS extra_columns
      FROM t WHERE column_name NOT IN (SELECT column_name FROM e) AND column_name <> 'ingestion_timestamp'),
k AS (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS snapshot FROM orders)
SELECT k.snapshot, m.missing_columns, x.extra_columns, CAST(m.missing_columns = '' AS INTEGER) AS passed
FROM k, m, x""")
def c04(spark, sf):
    run = run_series(orders_series(spark, sf, False),
                     blank_config(expected_columns=ORDERS_EXPECTED, row_duplicates=False), key=KEY)
    df = run.checks.column_existence()
    return tidy(df.withColumn("missing_columns", F.array_join("missing_columns", ","))
                .withColumn("extra_columns", F.array_join("extra_columns", ",")))


# ================================================================= C5
LINEITEM_RANGES = {"l_quantity": (1, 45), "l_discount": (0, 0.08),
                   "l_tax": (0, 0.06), "l_extendedprice": (1000, 100000)}


@register("c05_range_validation", "\nUNION ALL\n".join(
    f"SELECT snapshot, '{c}' AS column_name, CAST({lo} AS DOUBLE) AS range_lo, CAST({hi} AS DOUBLE) AS range_hi, "
    f"CAST(count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS BIGINT) AS violation_count, "
    f"round(CAST(min({c}) AS DOUBLE), 6) AS min_found, round(CAST(max({c}) AS DOUBLE), 6) AS max_found "
    f"FROM {LINEITEM_SQL} GROUP BY snapshot" for c, (lo, hi) in LINEITEM_RANGES.items()))
def c05(spark, sf):
    run = run_series(lineitem_series(spark, sf),
                     blank_config(numeric_ranges=LINEITEM_RANGES, row_duplicates=False), key=KEY)
    return tidy(run.checks.range_violations())


# ================================================================= C6
CUSTOMER_PATTERNS = {"c_name": r"^[A-Za-z]+ [A-Za-z]+$", "c_mktsegment": r"^[A-Z]+$"}


@register("c06_regex_pattern_validation", "\nUNION ALL\n".join(
    f"SELECT c_nationkey AS snapshot, '{c}' AS column_name, '{p}' AS pattern, "
    f"CAST(count(*) FILTER (WHERE {c} IS NOT NULL AND NOT regexp_matches(CAST({c} AS VARCHAR), '{p}')) AS BIGINT)"
    f" AS invalid_count FROM customer GROUP BY c_nationkey" for c, p in CUSTOMER_PATTERNS.items()))
def c06(spark, sf):
    c = table(spark, sf, "customer").withColumnRenamed("c_nationkey", KEY)
    run = run_series(c, blank_config(patterns=CUSTOMER_PATTERNS, row_duplicates=False), key=KEY)
    return tidy(run.checks.pattern_violations())


# ================================================================= C7 / C8 / C15 (events.value per day)
@register("c07_outlier_detection_iqr", f"""
WITH e AS {EVENTS_SQL},
q AS (SELECT snapshot, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, count(value) AS nn
      FROM e GROUP BY snapshot),
b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT b.snapshot, 'value' AS column_name, round(q1, 6) AS q1, round(q3, 6) AS q3,
       round(lo, 6) AS lower_bound, round(hi, 6) AS upper_bound,
       CAST(count(*) FILTER (WHERE e.value < lo OR e.value > hi) AS BIGINT) AS outlier_count,
       round(CAST(count(*) FILTER (WHERE e.value < lo OR e.value > hi) AS DOUBLE) / any_value(nn) * 100, 6) AS outlier_pct
FROM b JOIN e USING (snapshot) GROUP BY b.snapshot, q1, q3, lo, hi""")
def c07(spark, sf):
    run = run_series(events_series(spark, sf), blank_config(iqr_columns=("value",), row_duplicates=False), key=KEY)
    return tidy(run.checks.iqr_outliers())


@register("c08_outlier_detection_zscore", f"""
WITH e AS {EVENTS_SQL},
m AS (SELECT snapshot, avg(value) AS mu, stddev_pop(value) AS sd, min(value) AS mn, max(value) AS mx
      FROM e GROUP BY snapshot)
SELECT m.snapshot, 'value' AS column_name,
       CAST(count(*) FILTER (WHERE abs((e.value - mu) / sd) > 3.0) AS BIGINT) AS outlier_count,
       round(greatest(any_value(mx) - mu, mu - any_value(mn)) / sd, 6) AS max_zscore
FROM m JOIN e USING (snapshot) GROUP BY m.snapshot, mu, sd""")
def c08(spark, sf):
    run = run_series(events_series(spark, sf), blank_config(zscore_columns=("value",), row_duplicates=False), key=KEY)
    return tidy(run.checks.zscore_outliers())


@register("c15_data_skew_detection", f"""
SELECT snapshot, 'value' AS column_name, round(skewness(value), 6) AS skewness,
       CAST(abs(skewness(value)) > 2.0 AS INTEGER) AS highly_skewed
FROM {EVENTS_SQL} GROUP BY snapshot
UNION ALL
SELECT snapshot, 'value_sq' AS column_name, round(skewness(value * value), 6) AS skewness,
       CAST(abs(skewness(value * value)) > 2.0 AS INTEGER) AS highly_skewed
FROM {EVENTS_SQL} GROUP BY snapshot""")
def c15(spark, sf):
    s = events_series(spark, sf).withColumn("value_sq", F.col("value") * F.col("value"))
    run = run_series(s, blank_config(skew_columns=("value", "value_sq"), row_duplicates=False), key=KEY)
    return tidy(run.checks.skew())


@register("c15_skew_orders", f"""
SELECT snapshot, 'o_totalprice' AS column_name, round(skewness(o_totalprice), 6) AS skewness,
       CAST(abs(skewness(o_totalprice)) > 2.0 AS INTEGER) AS highly_skewed
FROM {ORDERS_SQL} GROUP BY snapshot""")
def c15_orders(spark, sf):
    run = run_series(orders_series(spark, sf), blank_config(skew_columns=("o_totalprice",), row_duplicates=False),
                     key=KEY)
    return tidy(run.checks.skew())


# ================================================================= C9 (pair)
_C9_CUR = ("SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_totalprice, o_orderdate, "
           "o_orderstatus, CAST(year(o_orderdate) AS BIGINT) AS o_year FROM orders")


@register("c09_schema_change_detection", f"""
WITH c AS (SELECT column_name, {_DT_SQL.replace('data_type', 'column_type')} AS t FROM (DESCRIBE {_C9_CUR})),
p AS (SELECT column_name, {_DT_SQL.replace('data_type', 'column_type')} AS t FROM (DESCRIBE SELECT * FROM orders)),
a AS (SELECT coalesce(string_agg(column_name, ',' ORDER BY column_name), '') AS columns_added
      FROM c WHERE column_name NOT IN (SELECT column_name FROM p)),
r AS (SELECT coalesce(string_agg(column_name, ',' ORDER BY column_name), '') AS columns_removed
      FROM p WHERE column_name NOT IN (SELECT column_name FROM c)),
x AS (SELECT coalesce(string_agg(c.column_name || ':' || p.t || '->' || c.t, ',' ORDER BY c.column_name), '')
        AS type_changes FROM c JOIN p USING (column_name) WHERE c.t <> p.t)
SELECT columns_added, columns_removed, type_changes,
       CAST(columns_added = '' AND columns_removed = '' AND type_changes = '' AS INTEGER) AS passed
FROM a, r, x""")
def c09(spark, sf):
    prev = table(spark, sf, "orders")
    cur = prev.select("o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), "o_totalprice",
                      "o_orderdate", "o_orderstatus", F.year("o_orderdate").cast("long").alias("o_year"))
    run = run_all_checks(cur, prev, blank_config(row_duplicates=False))
    df = current_only(run.checks.schema_changes())
    return tidy(df.select(*[F.array_join(c, ",").alias(c) for c in ("columns_added", "columns_removed",
                                                                    "type_changes")], "passed"))


# ================================================================= C10
AS_OF_ORDERS = _dt.date(2001, 8, 15)


@register("c10_data_freshness", """
SELECT o_orderpriority AS snapshot, CAST(max(o_orderdate) AS DATE) AS latest_date,
       CAST(floor(date_diff('microsecond', max(o_orderdate), TIMESTAMP '2001-08-15 00:00:00') / 86400000000)
            AS BIGINT) AS age_days,
       CAST(floor(date_diff('microsecond', max(o_orderdate), TIMESTAMP '2001-08-15 00:00:00') / 86400000000)
            <= 30 AS INTEGER) AS passed
FROM orders GROUP BY o_orderpriority""")
def c10(spark, sf):
    o = table(spark, sf, "orders").withColumn(KEY, F.col("o_orderpriority"))
    run = run_series(o, blank_config(date_column="o_orderdate", row_duplicates=False), key=KEY, as_of=AS_OF_ORDERS)
    return tidy(run.checks.freshness())


@register("c10_freshness_events", """
SELECT event_type AS snapshot, CAST(max(ts) AS DATE) AS latest_date,
       CAST(floor(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-20 00:00:00') / 86400000000) AS BIGINT)
         AS age_days,
       CAST(floor(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-20 00:00:00') / 86400000000) <= 20
            AS INTEGER) AS passed
FROM events GROUP BY event_type""")
def c10_events(spark, sf):
    e = table(spark, sf, "events").withColumn(KEY, F.col("event_type"))
    run = run_series(e, blank_config(date_column="ts", freshness_max_days=20, row_duplicates=False),
                     key=KEY, as_of=_dt.date(2024, 2, 20))
    return tidy(run.checks.freshness())


# ================================================================= C11
@register("c11_volume_anomaly", f"""
WITH c AS (SELECT snapshot, count(*) AS n FROM {ORDERS_SQL} GROUP BY snapshot),
l AS (SELECT snapshot, n, lag(n) OVER (ORDER BY snapshot) AS pn FROM c)
SELECT snapshot, CAST(pn AS DOUBLE) AS previous_rows, CAST(n AS BIGINT) AS current_rows,
       round(abs(n - pn) / CAST(greatest(pn, 1) AS DOUBLE) * 100, 6) AS change_pct,
       CAST(pn IS NULL OR abs(n - pn) / CAST(greatest(pn, 1) AS DOUBLE) * 100 <= 30.0 AS INTEGER) AS passed
FROM l""")
def c11(spark, sf):
    run = run_series(orders_series(spark, sf), blank_config(row_duplicates=False), key=KEY)
    return tidy(run.checks.volume().withColumn("previous_rows", F.col("previous_rows").cast("double")))


# ================================================================= C12
@register("c12_missing_value_percentage", "\nUNION ALL\n".join(
    f"SELECT snapshot, '{c}' AS column_name, "
    f"round(CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100, 6) AS missing_pct, "
    f"CAST(round(CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100, 2) > 5.0 AS INTEGER) AS exceeds_threshold "
    f"FROM {ORDERS_SQL} GROUP BY snapshot" for c in ORDERS_COLS))
def c12(spark, sf):
    run = run_series(orders_series(spark, sf), blank_config(row_duplicates=False), key=KEY)
    return tidy(run.checks.missing_pct())


# ================================================================= C13
def psi_sql(src: str, col: str, bins: int = 10) -> str:
    """PSI of each snapshot against its predecessor, in DuckDB SQL."""
    def binexpr(v):
        return "1 + " + " + ".join(f"CAST({v} >= CAST({i} AS DOUBLE) * st + lo AS INTEGER)" for i in range(1, bins))
    return f"""
WITH s AS (SELECT snapshot, CAST({col} AS DOUBLE) AS v FROM {src}),
k AS (SELECT snapshot, min(v) AS mn, max(v) AS mx FROM s GROUP BY snapshot),
pr AS (SELECT snapshot, lag(snapshot) OVER (ORDER BY snapshot) AS ps FROM k),
b AS (SELECT pr.snapshot, pr.ps, least(a.mn, p.mn) AS lo, (greatest(a.mx, p.mx) - least(a.mn, p.mn)) / {bins} AS st
      FROM pr JOIN k a ON a.snapshot = pr.snapshot JOIN k p ON p.snapshot = pr.ps),
cur AS (SELECT b.snapshot, {binexpr('s.v')} AS bin FROM b JOIN s ON s.snapshot = b.snapshot WHERE s.v IS NOT NULL),
prv AS (SELECT b.snapshot, {binexpr('s.v')} AS bin FROM b JOIN s ON s.snapshot = b.ps WHERE s.v IS NOT NULL),
grid AS (SELECT b.snapshot, r.bin FROM b, (SELECT range AS bin FROM range(1, {bins + 1})) r),
cc AS (SELECT snapshot, bin, count(*) AS c FROM cur GROUP BY ALL),
pc AS (SELECT snapshot, bin, count(*) AS c FROM prv GROUP BY ALL),
j AS (SELECT g.snapshot, g.bin, coalesce(cc.c, 0) AS c, coalesce(pc.c, 0) AS p FROM grid g
      LEFT JOIN cc USING (snapshot, bin) LEFT JOIN pc USING (snapshot, bin)),
t AS (SELECT *, sum(c) OVER (PARTITION BY snapshot) AS ct, sum(p) OVER (PARTITION BY snapshot) AS pt FROM j),
sh AS (SELECT snapshot, CASE WHEN c / (ct + 1e-9) = 0 THEN 0.0001 ELSE c / (ct + 1e-9) END AS cs,
              CASE WHEN p / (pt + 1e-9) = 0 THEN 0.0001 ELSE p / (pt + 1e-9) END AS ps FROM t),
psi AS (SELECT snapshot, sum((cs - ps) * ln(cs / ps)) AS psi FROM sh GROUP BY snapshot)
SELECT k.snapshot, round(psi.psi, 6) AS psi_score,
       CASE WHEN psi.psi IS NULL THEN NULL WHEN round(psi.psi, 4) < 0.1 THEN 'none'
            WHEN round(psi.psi, 4) < 0.2 THEN 'slight' ELSE 'significant' END AS drift_level,
       CAST(psi.psi IS NULL OR round(psi.psi, 4) < 0.2 AS INTEGER) AS passed
FROM k LEFT JOIN psi USING (snapshot)"""


@register("c13_psi_distribution_drift", psi_sql(LINEITEM_SQL, "l_extendedprice"))
def c13(spark, sf):
    run = run_series(lineitem_series(spark, sf), blank_config(psi_column="l_extendedprice", row_duplicates=False),
                     key=KEY)
    return tidy(run.checks.psi())


@register("c13_psi_events", psi_sql(EVENTS_SQL, "value"))
def c13_events(spark, sf):
    run = run_series(events_series(spark, sf), blank_config(psi_column="value", row_duplicates=False), key=KEY)
    return tidy(run.checks.psi())


# ================================================================= C14
LINE_CORR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def corr_sql(src: str, cols, thr: float = 0.2) -> str:
    k = len(cols)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sel = []
    for p, (i, j) in enumerate(pairs):
        x, y = cols[i], cols[j]
        sx = f"stddev_pop(CASE WHEN {y} IS NOT NULL THEN {x} END)"
        sy = f"stddev_pop(CASE WHEN {x} IS NOT NULL THEN {y} END)"
        sel.append(f"CASE WHEN coalesce({sx} * {sy}, 0) = 0 THEN 0.0 ELSE covar_pop({x}, {y}) / ({sx} * {sy}) END"
                   f" AS c{p}")
    full = []
    for i in range(k):
        for j in range(k):
            p = pairs.index((min(i, j), max(i, j)))
            full.append(f"SELECT snapshot, {i * k + j} AS idx, '(''{cols[i]}'', ''{cols[j]}'')' AS pair, "
                        f"abs(c{p} - coalesce(pc{p}, 0.0)) AS d FROM j")
    return f"""
WITH m AS (SELECT snapshot, {', '.join(sel)} FROM {src} GROUP BY snapshot),
j AS (SELECT m.*, {', '.join(f'lag(c{p}) OVER (ORDER BY snapshot) AS pc{p}' for p in range(len(pairs)))},
             lag(snapshot) OVER (ORDER BY snapshot) AS prev FROM m),
d AS ({' UNION ALL '.join(full)}),
mx AS (SELECT snapshot, max(d) AS md FROM d GROUP BY snapshot),
w AS (SELECT d.snapshot, arg_min(pair, idx) AS worst FROM d JOIN mx USING (snapshot) WHERE d.d = mx.md GROUP BY d.snapshot)
SELECT j.snapshot, CASE WHEN j.prev IS NULL THEN NULL ELSE round(mx.md, 6) END AS max_correlation_drift,
       CASE WHEN j.prev IS NULL THEN NULL ELSE w.worst END AS worst_pair,
       CAST(j.prev IS NULL OR mx.md <= {thr} AS INTEGER) AS passed
FROM j JOIN mx USING (snapshot) JOIN w USING (snapshot)"""


@register("c14_correlation_drift", corr_sql(LINEITEM_SQL, LINE_CORR))
def c14(spark, sf):
    run = run_series(lineitem_series(spark, sf), blank_config(corr_columns=LINE_CORR, row_duplicates=False), key=KEY)
    return tidy(run.checks.correlation())


@register("c14_correlation_events", corr_sql(EVENTS_SQL, ("value", "user_id", "event_id")))
def c14_events(spark, sf):
    run = run_series(events_series(spark, sf), blank_config(corr_columns=("value", "user_id", "event_id"),
                                                            row_duplicates=False), key=KEY)
    return tidy(run.checks.correlation())


WIDE_BASE = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey")
#: 24 columns, each null in the orders that its number divides
WIDE = {f"w{i}": f"CASE WHEN l_orderkey % {i + 2} <> 0 THEN CAST({WIDE_BASE[i % 6]} AS DOUBLE) * "
                 f"{1 + i % 4} + (l_partkey % {i + 3}) * (l_linenumber % {1 + i % 5}) END" for i in range(24)}


@register("c14_many_columns", corr_sql(
    f"(SELECT snapshot, {', '.join(f'{x} AS {c}' for c, x in WIDE.items())} FROM {LINEITEM_SQL})", tuple(WIDE)))
def c14_wide(spark, sf):
    """Pairwise complete correlations of 24 columns by matrix products."""
    wide = lineitem_series(spark, sf).selectExpr(KEY, *[f"{x} AS {c}" for c, x in WIDE.items()])
    run = run_series(wide, blank_config(corr_columns=tuple(WIDE), row_duplicates=False), key=KEY)
    return tidy(run.checks.correlation())


# ================================================================= C16
@register("c16_entropy_change", f"""
WITH h AS (SELECT snapshot, entropy(event_type) AS h FROM {EVENTS_SQL} GROUP BY snapshot),
l AS (SELECT snapshot, h, lag(h) OVER (ORDER BY snapshot) AS ph FROM h)
SELECT snapshot, round(ph, 6) AS previous_entropy, round(h, 6) AS current_entropy,
       round(abs(h - ph), 6) AS entropy_delta, CAST(ph IS NULL OR abs(h - ph) < 0.5 AS INTEGER) AS passed
FROM l""")
def c16(spark, sf):
    run = run_series(events_series(spark, sf), blank_config(entropy_column="event_type", row_duplicates=False),
                     key=KEY)
    return tidy(run.checks.entropy())


@register("c16_entropy_orders", f"""
WITH h AS (SELECT snapshot, entropy(o_orderpriority) AS h FROM {ORDERS_SQL} GROUP BY snapshot),
l AS (SELECT snapshot, h, lag(h) OVER (ORDER BY snapshot) AS ph FROM h)
SELECT snapshot, round(ph, 6) AS previous_entropy, round(h, 6) AS current_entropy,
       round(abs(h - ph), 6) AS entropy_delta, CAST(ph IS NULL OR abs(h - ph) < 0.5 AS INTEGER) AS passed
FROM l""")
def c16_orders(spark, sf):
    run = run_series(orders_series(spark, sf), blank_config(entropy_column="o_orderpriority", row_duplicates=False),
                     key=KEY)
    return tidy(run.checks.entropy())


# ================================================================= C17
def gaps_sql(src: str, key: str, ts: str, thr: int) -> str:
    return f"""
WITH t AS (SELECT {key} AS snapshot, CAST({ts} AS TIMESTAMP) AS ts FROM {src}),
g AS (SELECT snapshot, ts, floor(date_diff('microsecond', lag(ts) OVER (PARTITION BY snapshot ORDER BY ts), ts)
                                   / 86400000000) AS gap FROM t WHERE ts IS NOT NULL),
k AS (SELECT DISTINCT snapshot FROM t),
a AS (SELECT snapshot, count(*) AS n, max(gap) AS mg, count(*) FILTER (WHERE gap > {thr}) AS lg FROM g GROUP BY snapshot)
SELECT k.snapshot, CAST(CASE WHEN coalesce(a.n, 0) >= 2 THEN greatest(coalesce(a.mg, 0), 0) ELSE 0 END AS BIGINT)
         AS max_gap_days_found,
       CAST(coalesce(a.lg, 0) AS BIGINT) AS large_gap_count, CAST(coalesce(a.lg, 0) = 0 AS INTEGER) AS passed
FROM k LEFT JOIN a USING (snapshot)"""


@register("c17_time_gap_detection", gaps_sql("events", "user_id", "ts", 2))
def c17(spark, sf):
    e = table(spark, sf, "events").withColumn(KEY, F.col("user_id"))
    run = run_series(e, blank_config(date_column="ts", max_gap_days=2, row_duplicates=False), key=KEY)
    return tidy(run.checks.time_gaps())


@register("c17_time_gaps_orders", gaps_sql("orders", "o_orderpriority", "o_orderdate", 1))
def c17_orders(spark, sf):
    o = table(spark, sf, "orders").withColumn(KEY, F.col("o_orderpriority"))
    run = run_series(o, blank_config(date_column="o_orderdate", max_gap_days=1, row_duplicates=False), key=KEY)
    return tidy(run.checks.time_gaps())


# ================================================================= C18
LINE_RULES = dict(positive_column="l_extendedprice", le_pair=("l_discount", "l_tax"),
                  bounded_column=("l_discount", 0, 0.08),
                  rule_names=("price_positive", "discount_le_tax", "discount_range"),
                  set_rules=(SetRule("valid_returnflag", "l_returnflag", ("A", "R")),
                             SetRule("valid_linestatus", "l_linestatus", ("O", "F"))))


@register("c18_business_rule_validation", f"""
WITH l AS (SELECT * REPLACE (nullif(l_linestatus, 'O') AS l_linestatus) FROM {LINEITEM_SQL})
SELECT snapshot, 'price_positive' AS rule, CAST(count(*) FILTER (WHERE l_extendedprice <= 0) AS BIGINT) AS violation_count FROM l GROUP BY snapshot
UNION ALL SELECT snapshot, 'discount_le_tax', CAST(count(*) FILTER (WHERE l_discount > l_tax) AS BIGINT) FROM l GROUP BY snapshot
UNION ALL SELECT snapshot, 'discount_range', CAST(count(*) FILTER (WHERE l_discount < 0 OR l_discount > 0.08) AS BIGINT) FROM l GROUP BY snapshot
UNION ALL SELECT snapshot, 'valid_returnflag', CAST(count(*) FILTER (WHERE coalesce(l_returnflag NOT IN ('A', 'R'), true)) AS BIGINT) FROM l GROUP BY snapshot
UNION ALL SELECT snapshot, 'valid_linestatus', CAST(count(*) FILTER (WHERE coalesce(l_linestatus NOT IN ('O', 'F'), true)) AS BIGINT) FROM l GROUP BY snapshot""")
def c18(spark, sf):
    s = lineitem_series(spark, sf).withColumn("l_linestatus", F.expr("nullif(l_linestatus, 'O')"))
    run = run_series(s, blank_config(row_duplicates=False, **LINE_RULES), key=KEY)
    return tidy(run.checks.business_rules())


@register("c18_invalid_values", f"""
SELECT DISTINCT snapshot, 'valid_returnflag' AS rule, CAST(l_returnflag AS VARCHAR) AS value FROM {LINEITEM_SQL}
WHERE coalesce(l_returnflag NOT IN ('A', 'R'), true)
UNION ALL
SELECT DISTINCT snapshot, 'valid_linestatus' AS rule, CAST(l_linestatus AS VARCHAR) AS value FROM {LINEITEM_SQL}
WHERE coalesce(l_linestatus NOT IN ('O', 'F'), true)""")
def c18_values(spark, sf):
    run = run_series(lineitem_series(spark, sf), blank_config(row_duplicates=False, **LINE_RULES), key=KEY)
    return tidy(run.checks.invalid_values())


# ================================================================= C19
@register("c19_uniqueness_constraints", f"""
SELECT snapshot, CAST(count(*) AS BIGINT) AS total_rows, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS unique_values,
       CAST(count(*) - count(DISTINCT l_orderkey) AS BIGINT) AS duplicates,
       CAST(count(*) - count(DISTINCT l_orderkey) = 0 AS INTEGER) AS passed
FROM {LINEITEM_SQL} GROUP BY snapshot""")
def c19(spark, sf):
    run = run_series(lineitem_series(spark, sf), blank_config(id_column="l_orderkey", row_duplicates=False), key=KEY)
    return tidy(run.checks.uniqueness())


@register("c19_uniqueness_orders", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS snapshot, CAST(count(*) AS BIGINT) AS total_rows,
       CAST(count(DISTINCT o_orderkey) AS BIGINT) AS unique_values,
       CAST(count(*) - count(DISTINCT o_orderkey) AS BIGINT) AS duplicates,
       CAST(count(*) - count(DISTINCT o_orderkey) = 0 AS INTEGER) AS passed
FROM orders GROUP BY 1""")
def c19_orders(spark, sf):
    run = run_series(orders_series(spark, sf, False), blank_config(id_column="o_orderkey", row_duplicates=False),
                     key=KEY)
    return tidy(run.checks.uniqueness())


# ================================================================= C20
@register("c20_referential_consistency", f"""
SELECT snapshot,
       CAST(count(*) FILTER (WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL
                             AND regexp_matches(o_orderpriority, '^\\s*$')) AS BIGINT) AS empty_child,
       CAST(count(*) FILTER (WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NULL) AS BIGINT)
         AS parent_without_child,
       CAST(count(*) FILTER (WHERE o_orderstatus IS NOT NULL AND (o_orderpriority IS NULL
                             OR regexp_matches(o_orderpriority, '^\\s*$'))) = 0 AS INTEGER) AS passed
FROM {ORDERS_SQL} GROUP BY snapshot""")
def c20(spark, sf):
    run = run_series(orders_series(spark, sf), blank_config(parent_column="o_orderstatus",
                                                            child_column="o_orderpriority", row_duplicates=False),
                     key=KEY)
    return tidy(run.checks.referential())


@register("c20_orphan_rows", """
SELECT CAST((SELECT count(*) FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id))
            AS BIGINT) AS children_without_parent,
       CAST((SELECT count(*) FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id))
            AS BIGINT) AS parents_without_child""")
def c20_orphans(spark, sf):
    from .operators.relations import orphan_counts
    return orphan_counts(table(spark, sf, "labels"), table(spark, sf, "documents"), "doc_id")


# ================================================================= C21
@register("c21_sales_calculation_check", f"""
WITH j AS (SELECT CAST(year(l.l_shipdate) AS BIGINT) AS snapshot, l.l_extendedprice AS s, l.l_quantity AS q,
                  p.p_retailprice AS pr, l.l_discount * 100 AS d
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
e AS (SELECT snapshot, CASE WHEN s IS NOT NULL AND q IS NOT NULL AND pr IS NOT NULL AND d IS NOT NULL THEN
        abs(s - q * pr * (1 - d / 100)) / (q * pr * (1 - d / 100) + 1e-9) * 100 END AS pct FROM j)
SELECT snapshot, CAST(count(*) FILTER (WHERE pct > 1.0) AS BIGINT) AS rows_with_bad_calculation,
       round(max(pct), 6) AS max_diff_pct, CAST(count(*) FILTER (WHERE pct > 1.0) = 0 AS INTEGER) AS passed
FROM e GROUP BY snapshot""")
def c21(spark, sf):
    from .operators.relations import lookup_join
    li = table(spark, sf, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice", "l_quantity",
                                             (F.col("l_discount") * 100).alias("l_discount_pct"))
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    j = lookup_join(li, part, "l_partkey")
    s = series_from_table(j.drop("l_partkey"), F.year("l_shipdate").cast("long"), KEY)
    cfg = blank_config(amount_column="l_extendedprice", quantity_column="l_quantity", price_column="p_retailprice",
                       discount_column="l_discount_pct", row_duplicates=False)
    return tidy(run_series(s, cfg, key=KEY).checks.amount_calc())

