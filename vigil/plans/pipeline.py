"""One monitoring run (P1) and its ML step.

P1: newest snapshot vs its predecessor -> 21 checks -> metrics row ->
append to the history table -> isolation forest over the history (loaded
model or refit) -> row-count forecast -> combined flag. The run record is a
one-row DataFrame, which also holds the metrics row and the ML result as JSON;
any failure yields status ``failed`` and the error text (metrics that were
stored before it stay in the record).
"""

from __future__ import annotations

import datetime as _dt
import traceback

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, FEATURE_COLUMNS, CheckConfig
from ..operators import forecast as fc
from ..operators import iforest
from ..sources import history as hist
from ..sources.snapshots import KEY, load_latest_snapshot, load_previous_snapshot, load_snapshot
from .run import current_only, run_all_checks

RUN_SCHEMA = ("status string, started_at timestamp_ntz, finished_at timestamp_ntz, dataset_name string, "
              "row_id bigint, quality_score double, rule_flag int, ml_flag int, ml_score double, "
              "ml_label string, combined_flag int, forecast_row_count double, forecast_lower double, "
              "forecast_upper double, forecast_anomaly boolean, metrics string, ml_result string, error string")


def run_ml(spark: SparkSession, current: DataFrame, history: DataFrame, model_path: str | None = None,
           retrain: bool = False, as_of: _dt.date | None = None, contamination: float = 0.1,
           min_rows: int = 5) -> DataFrame:
    """Score ``current`` metrics rows with the forest (loaded from
    ``model_path`` when present, else fitted on ``history`` and saved) and
    attach the forecast for ``as_of``. Too little history -> label
    ``insufficient_data`` and flag 0."""
    model = None
    if model_path and not retrain:
        try:
            model = iforest.ForestModel.load(spark, model_path)
        except FileNotFoundError:
            model = None
    if model is None:
        h = history.withColumn("_rid", F.xxhash64("dataset_name", "timestamp"))
        model = iforest.fit(h, "_rid", FEATURE_COLUMNS, contamination=contamination, min_rows=min_rows)
        if model is not None and model_path:
            model.save(spark, model_path)
    cur = current.withColumn("_rid", F.xxhash64("dataset_name", "timestamp"))
    if model is None:
        ml = cur.select("_rid", F.lit(0.0).alias("raw_score"), F.lit(0.0).alias("anomaly_score"),
                        F.lit(0).alias("anomaly_flag"), F.lit("insufficient_data").alias("prediction_label"))
    else:
        ml = model.score(cur, keep=("_rid",))
    out = cur.join(ml.withColumnRenamed("anomaly_flag", "ml_flag"), "_rid").drop("_rid")
    f = fc.forecast_row_count(history, min_points=min_rows)
    day = as_of or _dt.date.today()
    today = fc.forecast_for_day(f, day)
    return (out.join(today, "dataset_name", "left")
            .withColumn("combined_flag", F.greatest(F.col("anomaly_flag"), F.col("ml_flag"))))


def combined_anomaly(rule_flag, ml_flag):
    """Rule flag OR forest flag."""
    return F.greatest(rule_flag, ml_flag)


def run_pipeline(spark: SparkSession, series: DataFrame | str, history_path: str, model_path: str | None = None,
                 config: CheckConfig = DEFAULT, dataset_name: str = "ecommerce_sales", key: str = KEY,
                 as_of: _dt.date | None = None, include_current: bool = True) -> DataFrame:
    """One run over the newest snapshot of ``series`` (a series, or a folder
    of snapshot files, of which only the newest two days are read, each with
    its own header and types). Returns the run record (one row)."""
    started = _dt.datetime.now().replace(microsecond=0)
    rec = dict(status="success", started_at=started, finished_at=None, dataset_name=dataset_name,
               row_id=None, quality_score=None, rule_flag=None, ml_flag=None, ml_score=None, ml_label=None,
               combined_flag=None, forecast_row_count=None, forecast_lower=None, forecast_upper=None,
               forecast_anomaly=None, metrics=None, ml_result=None, error=None)
    try:
        if isinstance(series, str):
            cur, prev = load_snapshot(spark, series, 0, key), load_snapshot(spark, series, 1, key)
            if cur is None:
                raise FileNotFoundError(f"no snapshot files in {series}")
        else:
            cur, prev = load_latest_snapshot(series, key), load_previous_snapshot(series, key)
        ts = _dt.datetime.combine(as_of or started.date(), started.time())  # a rerun of the day is a row of its own
        run = run_all_checks(cur.drop(key), None if prev is None else prev.drop(key), config, as_of=as_of,
                             dataset_name=dataset_name)
        metrics = current_only(run.metrics(timestamp=ts))
        appended = hist.append_metrics(spark, history_path, metrics, skip_existing=False)
        as_json = lambda df: df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).first()[0]
        rec["metrics"] = as_json(appended.drop("created_at"))
        history = hist.fetch_all_metrics(spark, history_path, dataset_name, ordered=False)
        if not include_current:
            history = history.join(appended.select("id"), "id", "left_anti")
        ml = run_ml(spark, appended.drop("id", "created_at"), history, model_path, as_of=as_of)
        ml = spark.createDataFrame([ml.first()], ml.schema)  # one row, found once
        rec["ml_result"] = as_json(ml.drop(*[c for c in hist.METRIC_FIELDS if c in ml.columns and c != "dataset_name"]))
        ml = ml.first()
        rec.update(row_id=appended.select("id").first()["id"] if appended.take(1) else None,
                   quality_score=float(ml["quality_score"]), rule_flag=int(ml["anomaly_flag"]),
                   ml_flag=int(ml["ml_flag"]), ml_score=float(ml["anomaly_score"]),
                   ml_label=ml["prediction_label"], combined_flag=int(ml["combined_flag"]),
                   forecast_row_count=ml["forecasted_row_count"], forecast_lower=ml["lower_bound"],
                   forecast_upper=ml["upper_bound"], forecast_anomaly=ml["anomaly_detected"])
        run.close()
    except Exception as e:  # noqa: BLE001 - the record carries the failure
        rec.update(status="failed", error=f"{e}\n{traceback.format_exc(limit=3)}")
    rec["finished_at"] = _dt.datetime.now().replace(microsecond=0)
    return spark.createDataFrame([rec], RUN_SCHEMA)
