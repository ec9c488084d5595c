"""Registered queries for the ML layer (A1-A9) and the single run.

The forest operators have no SQL oracle (randomised trees); they are checked
by row count here and by property tests (planted outliers rank first,
fixed seed reproducible, flag share near the contamination) in tests/.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from .catalog import KEY, register, table, tidy
from .catalog_monitor import (AS_OF_EVENTS, DATASET, EVENTS_CFG, HISTORY_DBL_SQL, dec_to_double,
                              events_history)
from .config import FEATURE_COLUMNS
from .operators import forecast as fc
from .operators import iforest
from .plans.pipeline import combined_anomaly, run_ml, run_pipeline
from .session import ensure_checkpoint_dir
from .sources.snapshots import series_from_table

LINE_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _feat_sql(standardized: bool) -> str:
    if not standardized:
        cols = ", ".join(f"round(CAST(coalesce({c}, 0.0) AS DOUBLE), 6) AS {c}" for c in FEATURE_COLUMNS)
        return f"SELECT CAST(timestamp AS DATE) AS snapshot, {cols} FROM ({HISTORY_DBL_SQL})"
    parts = []
    for c in FEATURE_COLUMNS:
        x = f"CAST(coalesce({c}, 0.0) AS DOUBLE)"
        sd = f"stddev_pop({x}) OVER ()"
        parts.append(f"round(({x} - avg({x}) OVER ()) / CASE WHEN {sd} > 0 THEN {sd} ELSE 1.0 END, 6) AS {c}")
    return f"SELECT CAST(timestamp AS DATE) AS snapshot, {', '.join(parts)} FROM ({HISTORY_DBL_SQL})"


def _history_features(spark, sf):
    h = events_history(spark, sf).withColumn(KEY, F.to_date("timestamp"))
    return iforest.prepare_features(h, FEATURE_COLUMNS, keep=(KEY,))


@register("a1_prepare_features", _feat_sql(False))
def a1(spark, sf):
    return tidy(_history_features(spark, sf))


@register("a2_standardize", _feat_sql(True))
def a2(spark, sf):
    f = _history_features(spark, sf)
    means, sig = iforest.fit_scaler(f, FEATURE_COLUMNS)
    return tidy(iforest.standardize(f, FEATURE_COLUMNS, means, sig, keep=(KEY,)))


def _line_forest(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("_rid", F.xxhash64("l_orderkey", "l_linenumber"))
    return li, iforest.fit(li, "_rid", LINE_FEATURES, n_trees=100, contamination=0.1, seed=42)


@register("a3_isolation_forest_fit")
def a3(spark, sf):
    _li, model = _line_forest(spark, sf)
    return model.nodes.groupBy("tree").agg(
        F.count(F.lit(1)).alias("nodes"), F.count_if(F.col("feature") < 0).alias("leaves"),
        F.sum(F.when(F.col("feature") < 0, F.col("size"))).alias("sampled_rows"))


@register("a3_tree_shape", """
SELECT CAST(t AS INTEGER) AS tree, (SELECT least(256, count(*)) FROM lineitem) AS sampled_rows, 1 AS binary
FROM range(100) r(t)""")
def a3_shape(spark, sf):
    """Every tree holds the whole sample in its leaves and is strictly binary."""
    return tidy(a3(spark, sf).select("tree", "sampled_rows", (F.col("nodes") == 2 * F.col("leaves") - 1)
                                     .alias("binary")))


@register("a5_flag_share", "SELECT count(*) AS rows, 1 AS labels_agree, 1 AS share_is_contamination FROM lineitem")
def a5_share(spark, sf):
    """No more than a tenth of the training rows lie below the threshold, and without ties just a tenth."""
    li, model = _line_forest(spark, sf)
    x = model.score(li, keep=("l_orderkey", "l_linenumber"))
    flagged = F.sum("anomaly_flag") / F.count(F.lit(1))
    return tidy(x.agg(F.count(F.lit(1)).alias("rows"),
                      F.every((F.col("anomaly_flag") == 1) == (F.col("prediction_label") == "ANOMALY"))
                      .alias("labels_agree"), flagged.between(0.09, 0.1 + 1e-3).alias("share_is_contamination")))


@register("a4_model_roundtrip")
def a4(spark, sf):
    """Fit on the events history, save, load, score: same scores as the
    in-memory model (both columns returned)."""
    h = events_history(spark, sf).withColumn("_rid", F.xxhash64("dataset_name", "timestamp"))
    m = iforest.fit(h, "_rid", FEATURE_COLUMNS)
    path = scratch(spark, "forest")
    m.save(spark, path)
    m2 = iforest.ForestModel.load(spark, path)
    a = m.score(h, keep=("_rid",)).select("_rid", F.col("raw_score").alias("raw_in_memory"))
    b = m2.score(h, keep=("_rid",)).select("_rid", F.col("raw_score").alias("raw_loaded"))
    return tidy(a.join(b, "_rid").drop("_rid"))


@register("a4_model_equal", f"SELECT count(*) AS rows, count(*) AS equal FROM ({HISTORY_DBL_SQL})")
def a4_equal(spark, sf):
    return a4(spark, sf).agg(F.count(F.lit(1)).alias("rows"),
                             F.count_if(F.col("raw_in_memory") == F.col("raw_loaded")).alias("equal"))


@register("a5_isolation_forest_score")
def a5(spark, sf):
    li, model = _line_forest(spark, sf)
    s = model.score(li, keep=("l_orderkey", "l_linenumber"))
    return tidy(s)


@register("a5_history_scores")
def a5_hist(spark, sf):
    h = events_history(spark, sf).withColumn("_rid", F.xxhash64("dataset_name", "timestamp"))
    m = iforest.fit(h, "_rid", FEATURE_COLUMNS)
    return tidy(m.score(h.withColumn(KEY, F.to_date("timestamp")), keep=(KEY,)))


FORECAST_SQL = f"""
WITH h0 AS ({HISTORY_DBL_SQL}),
h AS (SELECT dataset_name, CAST(timestamp AS DATE) AS ds, avg(CAST(row_count AS DOUBLE)) AS y FROM h0 GROUP BY ALL),
h1 AS (SELECT *, CAST(date_diff('day', min(ds) OVER (PARTITION BY dataset_name), ds) AS DOUBLE) AS x FROM h),
line AS (SELECT dataset_name, count(*) AS n, regr_intercept(y, x) AS a, regr_slope(y, x) AS b, min(ds) AS d0,
                max(ds) AS d1 FROM h1 GROUP BY dataset_name HAVING count(*) >= 5),
r AS (SELECT h1.*, line.a, line.b, dayofweek(h1.ds) AS wd, h1.y - (line.a + line.b * h1.x) AS res
      FROM h1 JOIN line USING (dataset_name)),
wk AS (SELECT dataset_name, wd, avg(res) AS w FROM r GROUP BY ALL),
sg AS (SELECT r.dataset_name, stddev_samp(r.y - (r.a + r.b * r.x + wk.w)) AS sigma FROM r JOIN wk USING (dataset_name, wd)
       GROUP BY r.dataset_name),
days AS (SELECT line.dataset_name, line.a, line.b, line.d0, CAST(g.ds AS DATE) AS ds
         FROM line, LATERAL (SELECT unnest(generate_series(CAST(line.d0 AS TIMESTAMP),
                                                             CAST(line.d1 + 7 AS TIMESTAMP), INTERVAL 1 DAY)) AS ds) g),
o AS (SELECT d.dataset_name, d.ds, d.a + d.b * CAST(date_diff('day', d.d0, d.ds) AS DOUBLE) + coalesce(wk.w, 0.0) AS yhat,
             1.96 * coalesce(sg.sigma, 0.0) AS half, h.y AS actual
      FROM days d LEFT JOIN wk ON wk.dataset_name = d.dataset_name AND wk.wd = dayofweek(d.ds)
      JOIN sg ON sg.dataset_name = d.dataset_name
      LEFT JOIN h ON h.dataset_name = d.dataset_name AND h.ds = d.ds)
SELECT dataset_name, ds, round(yhat, 6) AS yhat, round(yhat - half, 6) AS yhat_lower, round(yhat + half, 6) AS yhat_upper,
       round(actual, 6) AS actual, CAST(actual IS NOT NULL AND actual > yhat + half AS INTEGER) AS anomaly
FROM o"""


@register("a6_forecast_row_count", FORECAST_SQL)
def a6(spark, sf):
    return tidy(fc.forecast_row_count(events_history(spark, sf)))


@register("a7_forecast_anomaly", f"""
WITH f AS ({FORECAST_SQL})
SELECT dataset_name, round(yhat, 0) AS forecasted_row_count, round(yhat_lower, 0) AS lower_bound,
       round(yhat_upper, 0) AS upper_bound, anomaly AS anomaly_detected
FROM f WHERE ds = DATE '2024-01-30'""")
def a7(spark, sf):
    f = fc.forecast_row_count(events_history(spark, sf))
    return tidy(fc.forecast_for_day(f, _dt.date(2024, 1, 30)))


@register("a7_forecast_flags", f"""
WITH f AS ({FORECAST_SQL}) SELECT dataset_name, ds, anomaly FROM f WHERE anomaly = 1""")
def a7_flags(spark, sf):
    f = fc.forecast_row_count(events_history(spark, sf))
    return tidy(f.filter(F.col("anomaly") == 1).select("dataset_name", "ds", "anomaly"))


@register("a8_run_ml_pipeline")
def a8(spark, sf):
    h = events_history(spark, sf)
    cur = h.filter(F.to_date("timestamp") == F.lit(_dt.date(2024, 1, 30))).drop("id", "created_at")
    out = run_ml(spark, cur, h, model_path=None, as_of=_dt.date(2024, 1, 30))
    return tidy(dec_to_double(out))


@register("a9_combined_anomaly")
def a9(spark, sf):
    """Rule flag OR forest flag for every day of the history."""
    h = events_history(spark, sf).withColumn("_rid", F.xxhash64("dataset_name", "timestamp"))
    m = iforest.fit(h, "_rid", FEATURE_COLUMNS)
    s = m.score(h, keep=("_rid",)).select("_rid", F.col("anomaly_flag").alias("ml_flag"))
    j = h.withColumnRenamed("anomaly_flag", "rule_flag").join(s, "_rid")
    return tidy(j.select(F.to_date("timestamp").alias(KEY), "rule_flag", "ml_flag",
                         combined_anomaly(F.col("rule_flag"), F.col("ml_flag")).alias("combined_flag")))


@register("a9_flags_agree", f"""
SELECT CAST(timestamp AS DATE) AS snapshot, anomaly_flag AS rule_flag, 1 AS combined_is_or FROM ({HISTORY_DBL_SQL})""")
def a9_agree(spark, sf):
    return tidy(a9(spark, sf).select(KEY, "rule_flag", (F.col("combined_flag") == F.expr(
        "CAST(rule_flag = 1 OR ml_flag = 1 AS INT)")).alias("combined_is_or")))


@register("a8_flags_agree", f"""
SELECT row_count, quality_score, anomaly_flag, 1 AS combined_is_or FROM ({HISTORY_DBL_SQL})
WHERE CAST(timestamp AS DATE) = DATE '2024-01-30'""")
def a8_agree(spark, sf):
    return tidy(a8(spark, sf).select("row_count", "quality_score", "anomaly_flag", (F.col("combined_flag") == F.expr(
        "CAST(anomaly_flag = 1 OR ml_flag = 1 AS INT)")).alias("combined_is_or")))


def _one_run(spark, sf):
    """One run over the newest events day against the day before. Cold
    start from a real backfill: the history is first filled by the series
    run (P2) for the earlier days, so the forest and forecast have data.
    Returns the run record and the path of the history."""
    from .catalog_monitor import events_metrics
    from .sources import history as hist

    s = series_from_table(table(spark, sf, "events"), F.to_date("ts"), KEY)
    path = scratch(spark, "history")
    m = events_metrics(spark, sf)
    last = m.agg(F.max(KEY)).first()[0]
    hist.append_metrics(spark, path, m.filter(F.col(KEY) < F.lit(last)))
    return run_pipeline(spark, s, path, scratch(spark, "model"), EVENTS_CFG,
                        dataset_name=DATASET, key=KEY, as_of=last), path


@register("p1_run_pipeline")
def p1(spark, sf):
    return _one_run(spark, sf)[0].select(
        "status", "dataset_name", "quality_score", "rule_flag", "ml_flag", "ml_label",
        "combined_flag", "forecast_row_count", "error")


# what a run leaves in the history and in its record
P1_STORED = ("row_count", "quality_score", "drift_score", "outlier_count", "volume_change_pct", "checks_passed")


@register("p1_run_record", f"""
WITH h AS ({HISTORY_DBL_SQL}), n AS (SELECT * FROM h ORDER BY timestamp DESC LIMIT 1),
f AS ({FORECAST_SQL})
SELECT 'success' AS status, n.dataset_name, n.anomaly_flag AS rule_flag, (SELECT count(*) FROM h) AS stored_rows,
       {', '.join(f'CAST(n.{c} AS DOUBLE) AS {x}_{c}' for c in P1_STORED for x in ('stored', 'recorded'))},
       round(f.yhat, 0) AS forecast_row_count, 1 AS combined_is_or
FROM n JOIN f ON f.ds = CAST(n.timestamp AS DATE)""")
def p1_record(spark, sf):
    """The record of the run beside the row that the run stored, read back from the history."""
    from .sources import history as hist

    rec, path = _one_run(spark, sf)
    kept = hist.fetch_all_metrics(spark, path, DATASET, ordered=False)
    kept = kept.groupBy("dataset_name").agg(F.count("*").alias("stored_rows"), *(
        F.max_by(F.col(c).cast("double"), "timestamp").alias(f"stored_{c}") for c in P1_STORED))
    rec = rec.select("status", "dataset_name", "rule_flag", "forecast_row_count", (F.col("combined_flag") == F.expr(
        "CAST(rule_flag = 1 OR ml_flag = 1 AS INT)")).alias("combined_is_or"), *(
        F.get_json_object("metrics", f"$.{c}").cast("double").alias(f"recorded_{c}") for c in P1_STORED))
    return tidy(rec.join(kept, "dataset_name"))
