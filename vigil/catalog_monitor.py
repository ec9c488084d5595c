"""Registered queries for the monitoring layer: the fused runner (M0-M4),
the series backfill (P2), the report queries over the history it yields
(R1-R11) and the history table operations (S7-S11). The flagship series is
``events`` cut into one snapshot per day.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from .catalog import EVENTS_SQL, KEY, events_series, register, tidy
from .config import CHECK_WEIGHTS, CRITICAL_CHECKS, SetRule, blank_config
from .operators.score import grade, quality_score_of
from .plans import reports
from .plans.run import run_series
from .sources.history import history_rows

DATASET = "events"
AS_OF_EVENTS = _dt.date(2024, 2, 15)
EVENT_COLS = ("event_id", "ts", "user_id", "event_type", "value", "props")
EVENT_TYPES = ("view", "click", "signup", "purchase", "error")
EVENTS_CFG = blank_config(
    expected_columns=EVENT_COLS + ("session_id",),
    expected_dtypes={"event_id": ("int64",), "user_id": ("int32",), "value": ("float64",)},
    numeric_ranges={"value": (0.0, 100.0)},
    patterns={"props": r'^\{"k": \d+\}$'},
    id_column="event_id", iqr_columns=("value",), zscore_columns=("value",), skew_columns=("value",),
    date_column="ts", freshness_max_days=30, max_gap_days=0,
    volume_threshold_pct=10.0, psi_column="value", corr_columns=("value", "user_id"),
    entropy_column="event_type", positive_column="value", bounded_column=("value", 0, 100),
    rule_names=("value_positive", "le_pair", "value_range"),
    set_rules=(SetRule("valid_event_type", "event_type", EVENT_TYPES),),
    parent_column="event_type", child_column="props")


def events_run(spark, sf):
    return run_series(events_series(spark, sf), EVENTS_CFG, key=KEY, as_of=AS_OF_EVENTS,
                      dataset_name=DATASET)


def events_metrics(spark, sf):
    return events_run(spark, sf).metrics()


# ----------------------------------------------------------------- oracle
def _dtype(col="data_type"):
    return (f"CASE {col} WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN 'int32' WHEN 'DOUBLE' THEN 'float64' "
            f"WHEN 'FLOAT' THEN 'float32' WHEN 'BOOLEAN' THEN 'bool' WHEN 'TIMESTAMP' THEN 'datetime64[ns]' "
            f"ELSE 'object' END")


def _metrics_sql() -> str:
    """The metrics row of every events day, written directly in SQL."""
    from .catalog import corr_sql, gaps_sql, psi_sql

    nulls = " + ".join(f"(count(*) - count({c}))" for c in EVENT_COLS)
    ratio = " + ".join(f"CAST(count(*) - count({c}) AS DOUBLE) / count(*)" for c in EVENT_COLS)
    miss = " + ".join(f"CAST(round_even(CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100, 2) > 5.0 AS INT)"
                      for c in EVENT_COLS)
    types = ", ".join(f"'{t}'" for t in EVENT_TYPES)
    dts = ", ".join(f"('{c}', '{'|'.join(v)}')" for c, v in EVENTS_CFG.expected_dtypes.items())
    exp = ", ".join(f"('{c}')" for c in EVENTS_CFG.expected_columns)
    w = CHECK_WEIGHTS
    total = sum(w.values())
    return f"""
WITH e AS {EVENTS_SQL},
st AS (SELECT column_name, {_dtype()} AS actual FROM information_schema.columns WHERE table_name = 'events'),
dt_ok AS (SELECT count(*) = 0 AS ok FROM (VALUES {dts}) x(c, exp) JOIN st ON st.column_name = x.c
          WHERE NOT list_contains(string_split(x.exp, '|'), st.actual)),
col_ok AS (SELECT count(*) = 0 AS ok FROM (VALUES {exp}) x(c) WHERE c NOT IN (SELECT column_name FROM st)),
base AS (
  SELECT snapshot, count(*) AS n, {nulls} AS total_nulls, ({ratio}) / {len(EVENT_COLS)} * 100 AS null_pct,
         {miss} AS miss_flags,
         count(DISTINCT event_id) AS did, max(CASE WHEN event_id IS NULL THEN 1 ELSE 0 END) AS hn,
         count(*) FILTER (WHERE value < 0.0 OR value > 100.0) AS rv,
         count(*) FILTER (WHERE props IS NOT NULL AND NOT regexp_matches(props, '^\\{{"k": \\d+\\}}$')) AS pb,
         avg(value) AS mu, stddev_pop(value) AS sd,
         quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3,
         CASE WHEN count(value) < 3 THEN NULL ELSE coalesce(skewness(value), 0.0) END AS sk,
         max(ts) AS fmax, entropy(event_type) AS h,
         count(*) FILTER (WHERE value <= 0) AS br_pos, count(*) FILTER (WHERE value < 0 OR value > 100) AS br_bnd,
         count(*) FILTER (WHERE coalesce(event_type NOT IN ({types}), true)) AS br_set,
         count(*) FILTER (WHERE event_type IS NOT NULL AND props IS NOT NULL AND regexp_matches(props, '^\\s*$'))
           AS rf_blank,
         count(*) FILTER (WHERE event_type IS NOT NULL AND props IS NULL) AS rf_missing
  FROM e GROUP BY snapshot),
dups AS (SELECT snapshot, count(*) AS d FROM (SELECT DISTINCT * FROM e) GROUP BY snapshot),
outl AS (SELECT b.snapshot,
                count(*) FILTER (WHERE e.value < b.q1 - 1.5 * (b.q3 - b.q1) OR e.value > b.q3 + 1.5 * (b.q3 - b.q1))
                  AS iqo,
                count(*) FILTER (WHERE abs((e.value - b.mu) / b.sd) > 3.0) AS zo
         FROM base b JOIN e USING (snapshot) GROUP BY b.snapshot),
gp AS ({gaps_sql('e', 'snapshot', 'ts', 0)}),
psi AS ({psi_sql(EVENTS_SQL, 'value')}),
cor AS ({corr_sql(EVENTS_SQL, ('value', 'user_id'))}),
psi_raw AS (SELECT snapshot, psi_score FROM psi),
j AS (SELECT b.*, d.d, o.iqo, o.zo, gp.large_gap_count AS lg, psi.psi_score AS psi, cor.max_correlation_drift AS cmax,
             lag(b.n) OVER (ORDER BY b.snapshot) AS pn, lag(b.h) OVER (ORDER BY b.snapshot) AS ph,
             lag(b.snapshot) OVER (ORDER BY b.snapshot) AS prev,
             CAST(floor(date_diff('microsecond', b.fmax, TIMESTAMP '{AS_OF_EVENTS} 00:00:00') / 86400000000) AS BIGINT)
               AS age
      FROM base b JOIN dups d USING (snapshot) JOIN outl o USING (snapshot) JOIN gp USING (snapshot)
      JOIN psi USING (snapshot) JOIN cor USING (snapshot)),
f AS (SELECT j.*,
        CAST(total_nulls = 0 AS INT) AS p1,
        CAST(n - d = 0 AND n - did - hn = 0 AS INT) AS p2,
        CAST((SELECT ok FROM dt_ok) AS INT) AS p3,
        CAST((SELECT ok FROM col_ok) AS INT) AS p4,
        CAST(rv = 0 AS INT) AS p5, CAST(pb = 0 AS INT) AS p6, CAST(iqo = 0 AS INT) AS p7, CAST(zo = 0 AS INT) AS p8,
        1 AS p9, CAST(coalesce(age <= 30, false) AS INT) AS p10,
        CAST(prev IS NULL OR abs(n - pn) / CAST(greatest(pn, 1) AS DOUBLE) * 100 <= 10.0 AS INT) AS p11,
        CAST(miss_flags = 0 AS INT) AS p12,
        CAST(psi IS NULL OR round_even(psi, 4) < 0.2 AS INT) AS p13,
        CAST(cmax IS NULL OR cmax <= 0.2 AS INT) AS p14,
        CAST(NOT coalesce(abs(sk) > 2.0, false) AS INT) AS p15,
        CAST(prev IS NULL OR abs(h - ph) < 0.5 AS INT) AS p16,
        CAST(lg = 0 AS INT) AS p17,
        CAST(br_pos = 0 AND br_bnd = 0 AND br_set = 0 AS INT) AS p18,
        CAST(n - did = 0 AS INT) AS p19,
        CAST(rf_blank = 0 AND rf_missing = 0 AS INT) AS p20,
        1 AS p21
      FROM j)
SELECT snapshot, '{DATASET}' AS dataset_name, CAST(snapshot AS TIMESTAMP) + INTERVAL 8 HOUR AS timestamp,
       CAST(n AS BIGINT) AS row_count, round(round_even(null_pct, 2), 6) AS null_percentage,
       CAST(n - d AS BIGINT) AS duplicate_count,
       round(round_even(({' + '.join(f'p{i + 1} * {v}' for i, v in enumerate(w.values()))}) / {float(total)} * 100, 2), 6)
         AS quality_score,
       CAST(NOT (p1 = 1 AND p2 = 1 AND p9 = 1 AND p11 = 1 AND p18 = 1 AND p8 = 1) AS INT) AS anomaly_flag,
       round(coalesce(round_even(psi, 4), 0.0), 6) AS drift_score, CAST(iqo AS BIGINT) AS outlier_count,
       round(coalesce(CASE WHEN prev IS NULL THEN NULL
                           ELSE round_even(abs(n - pn) / CAST(greatest(pn, 1) AS DOUBLE) * 100, 2) END, 0.0), 6)
         AS volume_change_pct,
       round(coalesce(abs(round_even(sk, 4)), 0.0), 6) AS max_skewness,
       round(coalesce(abs(round_even(sk, 4)), 0.0), 6) AS max_abs_skewness,
       round(coalesce(CASE WHEN prev IS NULL THEN NULL ELSE round_even(abs(h - ph), 4) END, 0.0), 6) AS entropy_delta,
       round(coalesce(round_even(cmax, 4), 0.0), 6) AS correlation_drift,
       CAST({' + '.join(f'p{i}' for i in range(1, 22))} AS INT) AS checks_passed,
       CAST(21 - ({' + '.join(f'p{i}' for i in range(1, 22))}) AS INT) AS checks_failed,
       21 AS total_checks
FROM f"""


METRICS_SQL = _metrics_sql()
assert tuple(CRITICAL_CHECKS) == ("null_value_detection", "duplicate_detection", "schema_change_detection",
                                  "volume_anomaly", "business_rule_validation", "outlier_detection_zscore")


# ----------------------------------------------------------------- M0-M4 / P2
@register("m0_run_all_checks")
def m0(spark, sf):
    r = events_run(spark, sf).results()
    return tidy(r)


@register("m0_check_passed_matrix", f"""
WITH m AS ({METRICS_SQL}) SELECT snapshot, checks_passed, checks_failed FROM m""")
def m0_matrix(spark, sf):
    r = events_run(spark, sf).results()
    return tidy(r.groupBy(KEY).agg(F.count_if("passed").cast("int").alias("checks_passed"),
                                   F.count_if(~F.col("passed")).cast("int").alias("checks_failed")))


_FLAGS = ", ".join(f"({i}, p{i})" for i in range(1, 22))


@register("m0_check_flags", METRICS_SQL[:METRICS_SQL.rindex(f"SELECT snapshot, '{DATASET}'")] + f"""
SELECT f.snapshot, CAST(x.i AS INTEGER) AS check_index, CAST(x.p AS INTEGER) AS passed
FROM f, LATERAL (VALUES {_FLAGS}) x(i, p)""")
def m0_flags(spark, sf):
    """The verdict of every check on every day."""
    return tidy(events_run(spark, sf).results().select(KEY, "check_index", "passed"))


# figure -> (check, path in its JSON details, type, SQL over the figures of METRICS_SQL)
DETAIL_FIGURES = {
    "null_total": (1, "$.total_nulls", "long", "CAST(total_nulls AS BIGINT)"),
    "null_pct": (1, "$.overall_null_pct", "double", "round_even(null_pct, 2)"),
    "null_values": (1, "$.null_counts.value", "long", "CAST(n - vn AS BIGINT)"),
    "repeated_rows": (2, "$.duplicate_rows", "long", "CAST(n - d AS BIGINT)"),
    "repeated_ids": (2, "$.duplicate_order_ids", "long", "CAST(n - did - hn AS BIGINT)"),
    "mistyped": (3, "$.mismatches[*].column", "string", "(SELECT CASE WHEN count(*) = 1 THEN '\"' || max(x.c) || '\"' WHEN "
                 "count(*) > 1 THEN '[' || string_agg('\"' || x.c || '\"', ',') || ']' END FROM (VALUES {dts}) x(c, exp) JOIN st "
                 "ON st.column_name = x.c WHERE NOT list_contains(string_split(x.exp, '|'), st.actual))"),
    "missing_column": (4, "$.missing_columns[0]", "string",
                       "(SELECT min(c) FROM (VALUES {exp}) x(c) WHERE c NOT IN (SELECT column_name FROM st))"),
    "out_of_range": (5, "$.violations[0].violation_count", "long", "CAST(nullif(rv, 0) AS BIGINT)"),
    "off_pattern": (6, "$.props.invalid_count", "long", "CAST(pb AS BIGINT)"),
    "fence_low": (7, "$.value.lower_bound", "double", "round_even(q1 - 1.5 * (q3 - q1), 2)"),
    "fence_high": (7, "$.value.upper_bound", "double", "round_even(q3 + 1.5 * (q3 - q1), 2)"),
    "beyond_fences": (7, "$.value.outlier_count", "long", "CAST(iqo AS BIGINT)"),
    "beyond_sigmas": (8, "$.value.outlier_count", "long", "CAST(zo AS BIGINT)"),
    "most_sigmas": (8, "$.value.max_zscore", "double", "round_even(greatest(vmax - mu, mu - vmin) / sd, 2)"),
    "added": (9, "$.columns_added", "string", "CASE WHEN prev IS NOT NULL THEN '[]' END"),
    "latest": (10, "$.latest_order_date", "string", "strftime(fmax, '%Y-%m-%d')"),
    "age": (10, "$.age_days", "long", "age"),
    "rows_before": (11, "$.previous_rows", "long", "CAST(pn AS BIGINT)"),
    "change": (11, "$.change_pct", "double", "round_even(abs(n - pn) / CAST(greatest(pn, 1) AS DOUBLE) * 100, 2)"),
    "missing_pct": (12, "$.per_column.value.missing_pct", "double", "round_even(CAST(n - vn AS DOUBLE) / n * 100, 2)"),
    "psi": (13, "$.psi_score", "double", "round_even(psi, 4)"),
    "drift": (13, "$.drift_level", "string", "CASE WHEN round_even(psi, 4) < 0.1 THEN 'none' WHEN round_even(psi, 4) < 0.2 "
              "THEN 'slight' WHEN psi IS NOT NULL THEN 'significant' END"),
    "pair": (14, "$.worst_pair", "string", "worst_pair"),
    "pair_drift": (14, "$.max_correlation_drift", "double", "round_even(cmax, 4)"),
    "skewness": (15, "$.per_column.value.skewness", "double", "round_even(sk, 4)"),
    "entropy_before": (16, "$.previous_entropy", "double", "round_even(ph, 4)"),
    "entropy_now": (16, "$.current_entropy", "double", "round_even(h, 4)"),
    "gaps": (17, "$.large_gap_count", "long", "CAST(lg AS BIGINT)"),
    "not_positive": (18, "$.violations.value_positive", "long", "CAST(nullif(br_pos, 0) AS BIGINT)"),
    "other_types": (18, "$.violations.valid_event_type", "long", "CAST(nullif(br_set, 0) AS BIGINT)"),
    "unique_ids": (19, "$.event_id.unique_values", "long", "CAST(did AS BIGINT)"),
    "issue": (20, "$.issues[0]", "string", "CASE WHEN rf_blank > 0 THEN rf_blank || ' rows with empty props' WHEN rf_missing > 0 "
              "THEN rf_missing || ' rows have event_type but missing props' END"),
    "amount": (21, "$.message", "string", "'Required columns missing.'"),
}


def _detail_sql() -> str:
    dts = ", ".join(f"('{c}', '{'|'.join(v)}')" for c, v in EVENTS_CFG.expected_dtypes.items())
    exp = ", ".join(f"('{c}')" for c in EVENTS_CFG.expected_columns)
    sel = ", ".join(f"{x.replace('{dts}', dts).replace('{exp}', exp)} AS {name}"
                    for name, (_, _, _, x) in DETAIL_FIGURES.items())
    return METRICS_SQL[:METRICS_SQL.rindex(f"SELECT snapshot, '{DATASET}'")] + f"""
SELECT snapshot, {sel} FROM f JOIN (SELECT snapshot, min(value) AS vmin, max(value) AS vmax, count(value) AS vn
                                    FROM e GROUP BY snapshot) v USING (snapshot)
JOIN (SELECT snapshot, worst_pair FROM cor) USING (snapshot)"""


@register("m0_detail_figures", _detail_sql())
def m0_details(spark, sf):
    """Figures of the JSON details of all 21 checks, every day."""
    r = events_run(spark, sf).results()
    return tidy(r.groupBy(KEY).agg(*(
        F.max(F.when(F.col("check_index") == i, F.get_json_object("details", path))).cast(kind).alias(name)
        for name, (i, path, kind, _) in DETAIL_FIGURES.items())))


@register("m1_quality_score", f"WITH m AS ({METRICS_SQL}) SELECT snapshot, quality_score FROM m")
def m1(spark, sf):
    """Score recomputed from the envelope rows joined to the weight table."""
    r = events_run(spark, sf).results()
    return tidy(quality_score_of(r, EVENTS_CFG, KEY))


@register("m2_extract_metrics", f"WITH m AS ({METRICS_SQL}) SELECT * FROM m")
def m2(spark, sf):
    return tidy(events_metrics(spark, sf))


@register("m3_critical_anomaly_flag", f"WITH m AS ({METRICS_SQL}) SELECT snapshot, anomaly_flag FROM m")
def m3(spark, sf):
    return tidy(events_metrics(spark, sf).select(KEY, "anomaly_flag"))


@register("m4_quality_grade", f"""
WITH m AS ({METRICS_SQL})
SELECT snapshot, quality_score, CASE WHEN quality_score >= 90 THEN 'A' WHEN quality_score >= 75 THEN 'B'
                                     WHEN quality_score >= 60 THEN 'C' ELSE 'D' END AS grade FROM m""")
def m4(spark, sf):
    m = events_metrics(spark, sf)
    return tidy(m.select(KEY, "quality_score", grade(F.col("quality_score")).alias("grade")))


HISTORY_SQL = f"""
SELECT dataset_name, timestamp, row_count, CAST(null_percentage AS DECIMAL(7,4)) AS null_percentage,
       duplicate_count, CAST(quality_score AS DECIMAL(6,2)) AS quality_score, anomaly_flag,
       CAST(drift_score AS DECIMAL(8,4)) AS drift_score, outlier_count,
       CAST(volume_change_pct AS DECIMAL(8,2)) AS volume_change_pct,
       CAST(max_skewness AS DECIMAL(8,4)) AS max_skewness, CAST(entropy_delta AS DECIMAL(8,4)) AS entropy_delta,
       CAST(correlation_drift AS DECIMAL(8,4)) AS correlation_drift, checks_passed, checks_failed, total_checks
FROM ({METRICS_SQL})"""


HISTORY_DBL_SQL = f"""
SELECT dataset_name, timestamp, row_count, CAST(CAST(null_percentage AS DECIMAL(7,4)) AS DOUBLE) AS null_percentage,
       duplicate_count, CAST(CAST(quality_score AS DECIMAL(6,2)) AS DOUBLE) AS quality_score, anomaly_flag,
       CAST(CAST(drift_score AS DECIMAL(8,4)) AS DOUBLE) AS drift_score, outlier_count,
       CAST(CAST(volume_change_pct AS DECIMAL(8,2)) AS DOUBLE) AS volume_change_pct,
       CAST(CAST(max_skewness AS DECIMAL(8,4)) AS DOUBLE) AS max_skewness,
       CAST(CAST(entropy_delta AS DECIMAL(8,4)) AS DOUBLE) AS entropy_delta,
       CAST(CAST(correlation_drift AS DECIMAL(8,4)) AS DOUBLE) AS correlation_drift,
       checks_passed, checks_failed, total_checks
FROM ({METRICS_SQL})"""


def events_history(spark, sf):
    """History rows of the events backfill, in the history table schema."""
    return history_rows(events_metrics(spark, sf), created_at=_dt.datetime(2024, 2, 15))


def dec_to_double(df):
    from pyspark.sql import types as T
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


@register("p2_backfill_series", f"""
SELECT * EXCLUDE (null_percentage, quality_score, drift_score, volume_change_pct, max_skewness, entropy_delta,
                  correlation_drift),
       CAST(null_percentage AS DOUBLE) AS null_percentage, CAST(quality_score AS DOUBLE) AS quality_score,
       CAST(drift_score AS DOUBLE) AS drift_score, CAST(volume_change_pct AS DOUBLE) AS volume_change_pct,
       CAST(max_skewness AS DOUBLE) AS max_skewness, CAST(entropy_delta AS DOUBLE) AS entropy_delta,
       CAST(correlation_drift AS DOUBLE) AS correlation_drift
FROM ({HISTORY_SQL})""")
def p2(spark, sf):
    """All snapshots checked against their predecessors in one job and
    shaped as history rows (id/created_at left out of the comparison)."""
    return tidy(dec_to_double(events_history(spark, sf).drop("id", "created_at")))


# ----------------------------------------------------------------- R1-R11
def _report_query(name):
    sql = reports.REPORT_SQL[name].format(ds=DATASET)

    def q(spark, sf):
        return tidy(dec_to_double(reports.report(events_history(spark, sf), name, DATASET)))
    dd = sql.replace("FROM metrics_history", "FROM hist")
    register(name, f"WITH hist AS ({HISTORY_DBL_SQL}) SELECT * FROM ({dd}) t0")(q)


for _n in reports.REPORT_SQL:
    _report_query(_n)


@register("r06_kpi_latest_per_dataset", f"""
WITH h AS ({HISTORY_DBL_SQL})
SELECT dataset_name, CAST(arg_max(quality_score, timestamp) AS DOUBLE) AS quality_score,
       arg_max(anomaly_flag, timestamp) AS anomaly_flag, arg_max(row_count, timestamp) AS row_count,
       CAST(arg_max(null_percentage, timestamp) AS DOUBLE) AS null_percentage,
       arg_max(duplicate_count, timestamp) AS duplicate_count,
       CAST(arg_max(drift_score, timestamp) AS DOUBLE) AS drift_score,
       arg_max(checks_passed, timestamp) AS checks_passed, arg_max(total_checks, timestamp) AS total_checks
FROM h GROUP BY dataset_name""")
def r06_multi(spark, sf):
    return tidy(dec_to_double(reports.kpi_latest_per_dataset(events_history(spark, sf))))


@register("r09_dashboard_feeds", f"""
WITH h AS ({HISTORY_DBL_SQL}),
p(panel, series, ord) AS (VALUES ('quality_score', 'quality_score', 1), ('row_count', 'row_count', 2),
   ('null_percentage', 'null_percentage', 3), ('drift_score', 'psi', 4), ('duplicate_count', 'duplicate_count', 5),
   ('anomaly_vs_score', 'quality_score', 6))
SELECT p.panel, h.timestamp, p.series,
       round(CASE p.ord WHEN 1 THEN CAST(quality_score AS DOUBLE) WHEN 2 THEN CAST(row_count AS DOUBLE)
            WHEN 3 THEN CAST(null_percentage AS DOUBLE) WHEN 4 THEN CAST(drift_score AS DOUBLE)
            WHEN 5 THEN CAST(duplicate_count AS DOUBLE) ELSE CAST(quality_score AS DOUBLE) END, 6) AS value,
       CASE p.ord WHEN 1 THEN 80.0 WHEN 4 THEN 0.2 END AS threshold, CAST(anomaly_flag AS INT) AS flag
FROM h, p WHERE h.dataset_name = '{DATASET}'""")
def r09(spark, sf):
    return tidy(reports.dashboard_feeds(events_history(spark, sf), DATASET))


@register("r10_check_detail")
def r10(spark, sf):
    return tidy(reports.check_detail(events_run(spark, sf).results(), 13))


@register("r10_detail_figures", f"""
WITH m AS ({METRICS_SQL})
SELECT snapshot, row_count AS current_rows, lag(row_count) OVER (ORDER BY snapshot) AS previous_rows,
       CASE WHEN lag(row_count) OVER (ORDER BY snapshot) IS NOT NULL THEN drift_score END AS psi_score,
       CASE WHEN lag(row_count) OVER (ORDER BY snapshot) IS NOT NULL THEN correlation_drift END AS correlation,
       CASE WHEN lag(row_count) OVER (ORDER BY snapshot) IS NOT NULL THEN entropy_delta END AS entropy_delta,
       duplicate_count AS duplicate_rows, outlier_count FROM m""")
def r10_figures(spark, sf):
    """Figures read back from the JSON details of several checks."""
    r = events_run(spark, sf).results()
    at = lambda i, path: F.max(F.when(F.col("check_index") == i, F.get_json_object("details", path)))
    return tidy(r.groupBy(KEY).agg(
        at(11, "$.current_rows").cast("long").alias("current_rows"),
        at(11, "$.previous_rows").cast("long").alias("previous_rows"),
        at(13, "$.psi_score").cast("double").alias("psi_score"),
        at(14, "$.max_correlation_drift").cast("double").alias("correlation"),
        at(16, "$.entropy_delta").cast("double").alias("entropy_delta"),
        at(2, "$.duplicate_rows").cast("long").alias("duplicate_rows"),
        at(7, "$.value.outlier_count").cast("long").alias("outlier_count")))


@register("r11_metrics_transposed", f"""
WITH m AS ({METRICS_SQL})
SELECT snapshot, metric, round(value, 6) AS value FROM (
  UNPIVOT (SELECT snapshot, CAST(row_count AS DOUBLE) AS row_count, CAST(null_percentage AS DOUBLE) AS null_percentage,
                  CAST(duplicate_count AS DOUBLE) AS duplicate_count, CAST(quality_score AS DOUBLE) AS quality_score,
                  CAST(anomaly_flag AS DOUBLE) AS anomaly_flag, CAST(drift_score AS DOUBLE) AS drift_score,
                  CAST(outlier_count AS DOUBLE) AS outlier_count, CAST(volume_change_pct AS DOUBLE) AS volume_change_pct,
                  CAST(max_skewness AS DOUBLE) AS max_skewness, CAST(max_abs_skewness AS DOUBLE) AS max_abs_skewness,
                  CAST(entropy_delta AS DOUBLE) AS entropy_delta,
                  CAST(correlation_drift AS DOUBLE) AS correlation_drift,
                  CAST(checks_passed AS DOUBLE) AS checks_passed, CAST(checks_failed AS DOUBLE) AS checks_failed,
                  CAST(total_checks AS DOUBLE) AS total_checks FROM m)
  ON COLUMNS(* EXCLUDE (snapshot)) INTO NAME metric VALUE value)""")
def r11(spark, sf):
    return tidy(reports.metrics_transposed(events_metrics(spark, sf), KEY))
