"""Row-count forecast (A6) and forecast anomaly (A7), grouped per dataset.

Model per dataset: ``yhat = a + b * x + w(weekday)`` where ``x`` is days since
the dataset's first date, (a, b) the least-squares line (``regr_intercept``
/ ``regr_slope``), ``w`` the mean residual of the line per weekday, and the
interval ``yhat -/+ 1.96 * stddev_samp(y - yhat)``. The horizon adds
``horizon`` days after the last date. This is an additive trend + weekly
seasonality model with a 95 % interval, solved in closed form; it has no
changepoints (documented deviation from a Bayesian curve fitter).

Everything is grouped by ``dataset_name``; one dataset's history is one
row per day, so the per-dataset windows are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def forecast_row_count(history: DataFrame, horizon: int = 7, min_points: int = 5,
                       group: str = "dataset_name", ts: str = "timestamp", y: str = "row_count") -> DataFrame:
    """``(group, ds, yhat, yhat_lower, yhat_upper, actual, anomaly)``
    for every history day plus ``horizon`` future days. Datasets with fewer
    than ``min_points`` rows are left out."""
    h = history.select(F.col(group), F.to_date(ts).alias("ds"), F.col(y).cast("double").alias("y"))
    # several runs on one day: their mean is the day's value
    h = h.groupBy(group, "ds").agg(F.avg("y").alias("y"))
    first = F.min("ds").over(Window.partitionBy(group))
    h = h.withColumn("x", F.datediff("ds", first).cast("double"))
    line = h.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.regr_intercept("y", "x").alias("a"),
                                F.regr_slope("y", "x").alias("b"), F.min("ds").alias("d0"),
                                F.max("ds").alias("d1"))
    line = line.filter(F.col("n") >= min_points)
    h = h.join(line, group)
    h = h.withColumn("wd", F.dayofweek("ds")).withColumn("res", F.col("y") - (F.col("a") + F.col("b") * F.col("x")))
    wk = h.groupBy(group, "wd").agg(F.avg("res").alias("w"))
    fit = h.join(wk, [group, "wd"]).withColumn("yhat_in", F.col("a") + F.col("b") * F.col("x") + F.col("w"))
    sig = fit.groupBy(group).agg(F.stddev_samp(F.col("y") - F.col("yhat_in")).alias("sigma"))
    # all days: history span plus the horizon
    days = (line.select(group, "a", "b", "d0",
                        F.explode(F.sequence("d0", F.date_add("d1", horizon))).alias("ds"))
            .withColumn("x", F.datediff("ds", "d0").cast("double"))
            .withColumn("wd", F.dayofweek("ds")))
    out = (days.join(wk, [group, "wd"], "left").join(sig, group)
           .withColumn("yhat", F.col("a") + F.col("b") * F.col("x") + F.coalesce("w", F.lit(0.0)))
           .join(h.select(group, "ds", F.col("y").alias("actual")), [group, "ds"], "left"))
    half = F.lit(1.96) * F.coalesce("sigma", F.lit(0.0))
    return out.select(group, "ds", "yhat", (F.col("yhat") - half).alias("yhat_lower"),
                      (F.col("yhat") + half).alias("yhat_upper"), "actual",
                      (F.col("actual").isNotNull() & (F.col("actual") > F.col("yhat") + half))
                      .cast("int").alias("anomaly"))


def forecast_for_day(forecast: DataFrame, day) -> DataFrame:
    """A7 "today" row: rounded forecast, bounds and flag for ``day`` (a date;
    compared on the date, not on a midnight timestamp)."""
    return forecast.filter(F.col("ds") == F.lit(day)).select(
        "dataset_name", F.round("yhat", 0).alias("forecasted_row_count"),
        F.round("yhat_lower", 0).alias("lower_bound"), F.round("yhat_upper", 0).alias("upper_bound"),
        (F.col("anomaly") == 1).alias("anomaly_detected"))
