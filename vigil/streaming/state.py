"""What a monitor keeps of a checked snapshot, so that the next one can be
compared with it when its data are gone.

Two append-only Parquet tables beside the history, both partitioned by
dataset:

* ``figures``: one row per (dataset, snapshot, version) with the mergeable
  figures that drift checks read of a predecessor - row count, range of the
  PSI column, covariances and deviations, entropy sums - by name, so that a
  changed configuration finds what it needs or finds it missing;
* ``values``: the distinct values of the PSI column with their counts. Bins
  over any later range follow exactly from them.

The values of a version are written first, its figures last: figures that can
be read have their values. The newest version counts; nothing is overwritten,
so a crash leaves the version before. A whole day's values stay distributed:
they are written by tasks and read by tasks."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import col

FIGURES = T.StructType([
    T.StructField("dataset_name", T.StringType()), T.StructField("snapshot", T.DateType()),
    T.StructField("version", T.LongType()), T.StructField("figures", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("corr_columns", T.ArrayType(T.StringType())), T.StructField("corr", T.ArrayType(T.DoubleType()))])
VALUES = T.StructType([
    T.StructField("dataset_name", T.StringType()), T.StructField("snapshot", T.DateType()),
    T.StructField("version", T.LongType()), T.StructField("value", T.DoubleType()), T.StructField("c", T.LongType())])


@dataclass
class StoredProfile:
    """Figures (key, n, pmin, pmax, cv_<p>, sx_<p>, sy_<p>, corr, ent_n, ent_s) and
    values (key, value, c) of some snapshots."""

    figures: DataFrame
    values: DataFrame


def _names(profile) -> dict:
    """Column of the profile -> the name under which it is stored."""
    cfg, out = profile.cfg, {"n": "rows"}
    if profile.psi_on:
        out |= {"pmin": f"min {cfg.psi_column}", "pmax": f"max {cfg.psi_column}"}
    for p, (i, j) in enumerate(profile.corr_pairs):
        pair = f"{profile.corr_cols[i]} {profile.corr_cols[j]}"
        out |= {f"cv_{p}": f"cov {pair}", f"sx_{p}": f"left {pair}", f"sy_{p}": f"right {pair}"}
    if profile.ent_on:
        out |= {"ent_n": f"values {cfg.entropy_column}", "ent_s": f"information {cfg.entropy_column}"}
    return out


def _table(spark: SparkSession, path: str, name: str, schema: T.StructType) -> DataFrame | None:
    from ..sources.snapshots import _fs_path

    fs, p = _fs_path(spark, f"{path}/{name}")
    return spark.read.schema(schema).parquet(f"{path}/{name}") if fs.exists(p) else None


def save(profile, path: str, dataset_name: str, keys: list) -> None:
    """Keep the snapshots ``keys`` of a profile that has been run."""
    version = time.time_ns() // 1000
    k, names = col(profile.key), _names(profile)
    mine = lambda df: df.where(k.isin(keys)).select(
        F.lit(dataset_name).alias("dataset_name"), k.cast("date").alias("snapshot"), F.lit(version).alias("version"), "*")
    if profile.psi_on:
        value = F.col(profile.cfg.psi_column).cast("double")
        counted = profile.series.groupBy(profile.key, value.alias("value")).agg(F.count("*").alias("c"))
        (mine(counted.where("value IS NOT NULL")).select(*VALUES.fieldNames())
         .write.mode("append").partitionBy("dataset_name").parquet(f"{path}/values"))
    f = profile.facts_with()
    figures = F.map_from_arrays(F.array(*[F.lit(x) for x in names.values()]),
                                F.array(*[F.col(x).cast("double") for x in names]))
    wide = profile.gram_on
    f = f.withColumn("corr_columns", F.array(*map(F.lit, profile.corr_cols)) if wide else F.lit(None).cast("array<string>"))
    if not wide:
        f = f.withColumn("corr", F.lit(None).cast("array<double>"))
    (mine(f).withColumn("figures", figures).select(*FIGURES.fieldNames())
     .write.mode("append").partitionBy("dataset_name").parquet(f"{path}/figures"))


def load(spark: SparkSession, path: str, dataset_name: str, days: list, profile) -> tuple[list, StoredProfile | None]:
    """The ``days`` of which everything that ``profile`` (built for its
    configuration alone) needs is kept, and their stored profile."""
    table = _table(spark, path, "figures", FIGURES)
    if table is None or not days:
        return [], None
    names = _names(profile)
    newest = (table.where((F.col("dataset_name") == dataset_name) & F.col("snapshot").isin(days))
              .groupBy("snapshot").agg(*(F.max_by(c, "version").alias(c) for c in ("figures", "corr_columns", "corr")),
                                       F.max("version").alias("version")))
    whole = newest.where(F.size(F.array_except(F.array(*[F.lit(x) for x in names.values()]), F.map_keys("figures"))) == 0)
    extra = []
    if profile.gram_on:
        whole = whole.where(F.col("corr_columns").eqNullSafe(F.array(*map(F.lit, profile.corr_cols))))
        extra = ["corr"]
    have = {r.snapshot: r.version for r in whole.select("snapshot", "version").collect()}  # one row a day asked for
    if not have:
        return [], None
    kind = profile.series.schema[profile.key].dataType
    figures = whole.select(F.col("snapshot").cast(kind).alias(profile.key), *(
        F.col("figures")[x].cast("long" if c == "n" else "double").alias(c) for c, x in names.items()), *extra)
    values = _table(spark, path, "values", VALUES)
    if values is None:
        values = spark.createDataFrame([], VALUES)
    same = F.lit(False)
    for d, v in have.items():
        same = same | ((F.col("snapshot") == F.lit(d)) & (F.col("version") == v))
    values = values.where((F.col("dataset_name") == dataset_name) & same).select(
        F.col("snapshot").cast(kind).alias(profile.key), "value", "c")
    return sorted(have), StoredProfile(figures, values)
