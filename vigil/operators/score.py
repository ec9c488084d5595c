"""Quality score, metrics row, rule anomaly flag and grade (M1-M4)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CHECK_ORDER, CheckConfig
from ..functions.sql import E, add, q, s
from .checks import Checks


def quality_score_sql(passed: dict, cfg: CheckConfig) -> str:
    """M1: weighted share of passed checks, 0-100, two decimals (half even)."""
    total = sum(cfg.weight(c) for c in passed)
    if total == 0:
        return "0.0"
    earned = add(f"CASE WHEN {ok} THEN {cfg.weight(c)} ELSE 0 END" for c, ok in passed.items())
    return f"bround(CAST({earned} AS DOUBLE) / {total} * 100, 2)"


def quality_score_of(results: DataFrame, cfg: CheckConfig, key: str) -> DataFrame:
    """M1 over an envelope frame ``(key, check, passed)``: joins the weights
    (a fixed 21-row table, broadcast) and aggregates per snapshot."""
    spark = results.sparkSession
    names = sorted(set(CHECK_ORDER) | set(cfg.weights))
    w = spark.createDataFrame([(n, cfg.weight(n)) for n in names], "check string, weight int")
    r = results.join(F.broadcast(w), "check", "left")
    return r.groupBy(key).agg(E(
        f"bround(try_divide(CAST(sum(CASE WHEN passed THEN coalesce(weight, {cfg.default_weight}) ELSE 0 END) "
        f"AS DOUBLE), sum(coalesce(weight, {cfg.default_weight}))) * 100, 2) AS quality_score"))


def anomaly_flag_sql(passed: dict, cfg: CheckConfig) -> str:
    """M3: 1 when any critical check failed."""
    crit = [passed[c] for c in cfg.critical_checks if c in passed]
    if not crit:
        return "0"
    return f"CAST(NOT ({' AND '.join(crit)}) AS INT)"


def grade(score: Column) -> Column:
    """M4: A >= 90, B >= 75, C >= 60, else D."""
    return (F.when(score >= 90, "A").when(score >= 75, "B").when(score >= 60, "C").otherwise("D"))


def metrics(checks: Checks, dataset_name: str, timestamp: _dt.datetime | None = None) -> DataFrame:
    """M2: the 16-field metrics row of every snapshot (plus the key and
    ``max_abs_skewness``).

    ``timestamp`` defaults to the snapshot key at 08:00:00 when the key is a
    date (the backfill convention), else the current time.
    """
    p, cfg, key = checks.p, checks.cfg, checks.key
    passed = checks.passed
    if timestamp is None and isinstance(p.series.schema[key].dataType, T.DateType):
        ts = f"CAST({q(key)} AS TIMESTAMP_NTZ) + INTERVAL 8 HOURS"
    else:
        t = timestamp or _dt.datetime.now().replace(microsecond=0)
        ts = f"CAST({s(t.strftime('%Y-%m-%d %H:%M:%S'))} AS TIMESTAMP_NTZ)"
    n_pass = add(f"CASE WHEN {passed[c]} THEN 1 ELSE 0 END" for c in CHECK_ORDER)
    return checks.facts.selectExpr(
        q(key),
        f"{s(dataset_name)} AS dataset_name",
        f"{ts} AS timestamp",
        "CAST(n AS LONG) AS row_count",
        f"coalesce(bround({checks._overall_null_pct()}, 2), 0.0) AS null_percentage",
        "CAST(coalesce(duplicate_rows, 0) AS LONG) AS duplicate_count",
        f"{quality_score_sql(passed, cfg)} AS quality_score",
        f"{anomaly_flag_sql(passed, cfg)} AS anomaly_flag",
        "coalesce(bround(_psi, 4), 0.0) AS drift_score",
        f"CAST({checks._iqr_total()} AS LONG) AS outlier_count",
        f"coalesce(CASE WHEN has_prev THEN bround({checks._change_pct()}, 2) END, 0.0)"
        f" AS volume_change_pct",
        f"coalesce(abs({checks._max_signed_skew()}), 0.0) AS max_skewness",
        f"coalesce({checks._max_abs_skew()}, 0.0) AS max_abs_skewness",
        f"coalesce(bround({checks._entropy_delta()}, 4), 0.0) AS entropy_delta",
        "coalesce(bround(_corr_max, 4), 0.0) AS correlation_drift",
        f"{n_pass} AS checks_passed",
        f"{len(CHECK_ORDER)} - {n_pass} AS checks_failed",
        f"{len(CHECK_ORDER)} AS total_checks",
    )
