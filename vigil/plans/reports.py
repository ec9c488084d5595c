"""Report queries over the metrics history.

R1-R8 are one table of columns, rows and derived expressions, run as DataFrame
expressions; R9-R11 are DataFrame reshapes (stack / unpivot / JSON).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column names and labels of the reports.
DRIFT_LEVELS = ((0.1, "No Drift"), (0.2, "Slight Drift"), (None, "Significant Drift"))
STATUS = {1: "Anomaly", 0: "Normal"}


class Report(NamedTuple):
    """``columns`` of one dataset's history (names, or keys of ``DERIVED``),
    of the rows with ``only`` set to 1, of the ``newest`` rows, or folded
    into one row (``total``)."""

    columns: str
    only: str | None = None
    newest: int = 0
    total: bool = False


def _level(value: str) -> str:
    cases = "".join(f" WHEN {value} < {top} THEN '{name}'" for top, name in DRIFT_LEVELS if top is not None)
    return f"CASE{cases} ELSE '{DRIFT_LEVELS[-1][1]}' END"


DERIVED = {
    "report_date": "CAST(timestamp AS DATE)",
    "status": f"CASE anomaly_flag WHEN 1 THEN '{STATUS[1]}' ELSE '{STATUS[0]}' END",
    "drift_level": _level("drift_score"),
    "total_runs": "count(*)", "anomalies_detected": "CAST(sum(anomaly_flag) AS BIGINT)",
    **{f"avg_{c}": f"avg({c})" for c in ("quality_score", "null_percentage", "drift_score")},
    **{f"{f}_row_count": f"{f}(row_count)" for f in ("max", "min")},
}

REPORTS = {
    "r01_quality_score_trend": Report("report_date quality_score anomaly_flag drift_score"),
    "r02_null_pct_trend": Report("report_date null_percentage duplicate_count"),
    "r03_row_count_changes": Report("report_date row_count volume_change_pct status"),
    "r04_anomaly_summary": Report("report_date quality_score anomaly_flag drift_score null_percentage outlier_count "
                                  "duplicate_count", only="anomaly_flag"),
    "r05_drift_indicators": Report("report_date drift_score correlation_drift entropy_delta max_skewness drift_level"),
    "r06_kpi_summary_latest": Report("quality_score anomaly_flag row_count null_percentage duplicate_count drift_score "
                                     "checks_passed total_checks", newest=1),
    "r07_project_summary": Report("total_runs avg_quality_score anomalies_detected avg_null_percentage "
                                  "avg_drift_score max_row_count min_row_count", total=True),
    "r08_history_tail": Report("timestamp quality_score anomaly_flag null_percentage drift_score row_count", newest=10),
}


def _sql(r: Report) -> str:
    """The report as a query over ``metrics_history`` (for the oracle)."""
    cols = ", ".join(f"{DERIVED.get(c, c)} AS {c}" for c in r.columns.split())
    rows = "SELECT * FROM metrics_history WHERE dataset_name = '{ds}'" + (f" AND {r.only} = 1" if r.only else "")
    if r.newest:
        rows += f" ORDER BY timestamp DESC LIMIT {r.newest}"
    return f"SELECT {cols} FROM ({rows}) t" + ("" if r.total else " ORDER BY timestamp")


REPORT_SQL = {name: _sql(r) for name, r in REPORTS.items()}


def report(history: DataFrame, name: str, dataset_name: str) -> DataFrame:
    """Report ``name`` over ``history`` (any DataFrame with the history
    columns)."""
    r = REPORTS[name]
    rows = history.where(F.col("dataset_name") == dataset_name)
    if r.only:
        rows = rows.where(F.col(r.only) == 1)
    if r.newest:
        rows = rows.orderBy(F.col("timestamp").desc()).limit(r.newest)
    cols = [F.expr(DERIVED.get(c, c)).alias(c) for c in r.columns.split()]
    return rows.agg(*cols) if r.total else rows.orderBy("timestamp").select(*cols)


def kpi_latest_per_dataset(history: DataFrame) -> DataFrame:
    """R6 for many datasets at once: newest row per dataset via ``max_by``
    (one aggregate, no sort of the whole history)."""
    cols = ["quality_score", "anomaly_flag", "row_count", "null_percentage", "duplicate_count",
            "drift_score", "checks_passed", "total_checks"]
    latest = F.max_by(F.struct(*cols), "timestamp").alias("k")
    return history.groupBy("dataset_name").agg(latest).select("dataset_name", "k.*")


def dashboard_feeds(history: DataFrame, dataset_name: str) -> DataFrame:
    """The six dashboard panels as one long frame
    ``(panel, timestamp, series, value, threshold, flag)``; text figures are
    coerced to numbers with ``try_cast`` (bad text -> null)."""
    h = history.filter(F.col("dataset_name") == dataset_name)

    def num(c):
        return F.col(c).cast("string").try_cast("double")

    flag = num("anomaly_flag")
    panels = [
        ("quality_score", "quality_score", num("quality_score"), F.lit(80.0)),
        ("row_count", "row_count", num("row_count"), F.lit(None).cast("double")),
        ("null_percentage", "null_percentage", num("null_percentage"), F.lit(None).cast("double")),
        ("drift_score", "psi", num("drift_score"), F.lit(0.2)),
        ("duplicate_count", "duplicate_count", num("duplicate_count"), F.lit(None).cast("double")),
        ("anomaly_vs_score", "quality_score", num("quality_score"), F.lit(None).cast("double")),
    ]
    rows = [F.struct(F.lit(p).alias("panel"), F.lit(s).alias("series"), v.alias("value"),
                     t.alias("threshold"), flag.cast("int").alias("flag")) for p, s, v, t in panels]
    return h.select("timestamp", F.explode(F.array(*rows)).alias("r")).select(
        "r.panel", "timestamp", "r.series", "r.value", "r.threshold", "r.flag")


def check_detail(results: DataFrame, check_index: int) -> DataFrame:
    """Details of check ``check_index`` (1-based) as JSON, per snapshot."""
    return results.filter(F.col("check_index") == check_index)


def metrics_transposed(metrics: DataFrame, key: str) -> DataFrame:
    """Metric rows turned into (key, metric, value) rows."""
    skip = {key, "dataset_name", "timestamp"}
    cols = [c for c in metrics.columns if c not in skip]
    m = metrics.select(key, *[F.col(c).cast("double").alias(c) for c in cols])
    return m.unpivot([key], cols, "metric", "value")
