"""Metrics history table.

The history is a Parquet table partitioned by ``dataset_name`` with a fixed
schema, and append-only: every write adds files of row versions and touches no
other. A version that replaces (:func:`replace_metrics`) hides the older ones
of its (dataset, timestamp) on read; :func:`append_metrics` adds rows beside
those that are there, or leaves out what is (``skip_existing``). Files are
written in a folder of their own and then moved in, so writers do not meet and
a crash leaves the table as it was. :func:`compact_metrics` drops hidden
versions, as a step of its own.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column types of the history table (counts widened to bigint; the null
# share gets one more integer digit so 100 % fits).
HISTORY_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("dataset_name", T.StringType(), False),
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("row_count", T.LongType(), False),
    T.StructField("null_percentage", T.DecimalType(7, 4), False),
    T.StructField("duplicate_count", T.LongType(), False),
    T.StructField("quality_score", T.DecimalType(6, 2), False),
    T.StructField("anomaly_flag", T.IntegerType(), False),
    T.StructField("drift_score", T.DecimalType(8, 4), False),
    T.StructField("outlier_count", T.LongType(), False),
    T.StructField("volume_change_pct", T.DecimalType(8, 2), False),
    T.StructField("max_skewness", T.DecimalType(8, 4), False),
    T.StructField("entropy_delta", T.DecimalType(8, 4), False),
    T.StructField("correlation_drift", T.DecimalType(8, 4), False),
    T.StructField("checks_passed", T.IntegerType(), False),
    T.StructField("checks_failed", T.IntegerType(), False),
    T.StructField("total_checks", T.IntegerType(), False),
    T.StructField("created_at", T.TimestampNTZType(), True),
])
# as stored: with the version of a row and whether it hides older ones
STORED_SCHEMA = T.StructType([*HISTORY_SCHEMA.fields, T.StructField("row_version", T.LongType()),
                              T.StructField("replaces", T.BooleanType())])
METRIC_FIELDS = [f.name for f in HISTORY_SCHEMA.fields if f.name not in ("id", "created_at")]


def history_rows(metrics: DataFrame, created_at: _dt.datetime | None = None) -> DataFrame:
    """S8 projection: metrics rows cast to the history schema. Missing
    figures default to 0 (the table's NOT NULL DEFAULT 0)."""
    sel = [F.xxhash64("dataset_name", "timestamp").alias("id")]
    for f in HISTORY_SCHEMA.fields[1:-1]:
        c = F.col(f.name) if f.name in metrics.columns else F.lit(None)
        if f.name not in ("dataset_name", "timestamp"):
            c = F.coalesce(c.cast(f.dataType), F.lit(0).cast(f.dataType))
        sel.append(c.cast(f.dataType).alias(f.name))
    ts = created_at or _dt.datetime.now().replace(microsecond=0)
    sel.append(F.lit(ts).cast("timestamp_ntz").alias("created_at"))
    return metrics.select(*sel)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def create_metrics_history(spark: SparkSession, path: str) -> DataFrame:
    """Create the (empty) history table at ``path`` if it does not
    exist; returns it."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p)
    return fetch_all_metrics(spark, path, ordered=False)


def _add_files(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Add stored rows (one per snapshot) as files of their own."""
    fs, _ = _fs(spark, path)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    name = uuid.uuid4().hex
    staging = f"{path.rstrip('/')}/_staging-{name}"  # not seen by readers
    rows.write.partitionBy("dataset_name").parquet(staging)
    for folder in fs.listStatus(hadoop_path(staging)):
        if not folder.isDirectory():
            continue
        target = f"{path.rstrip('/')}/{folder.getPath().getName()}"
        fs.mkdirs(hadoop_path(target))
        for i, f in enumerate(fs.listStatus(folder.getPath())):
            if f.getPath().getName().endswith(".parquet"):
                fs.rename(f.getPath(), hadoop_path(f"{target}/part-{name}-{i}.parquet"))
    fs.delete(hadoop_path(staging), True)


def _versions(rows: DataFrame, replaces: bool) -> DataFrame:
    return rows.select(*HISTORY_SCHEMA.fieldNames(), F.lit(time.time_ns() // 1000).alias("row_version"),
                       F.lit(replaces).alias("replaces"))


def append_metrics(spark: SparkSession, path: str, metrics: DataFrame,
                   skip_existing: bool = False) -> DataFrame:
    """Append metrics rows; returns the appended rows (with ids). With
    ``skip_existing`` rows whose (dataset, timestamp) already exist are
    left out, so a retried job never duplicates history."""
    create_metrics_history(spark, path)
    rows = history_rows(metrics)
    if skip_existing:
        have = fetch_all_metrics(spark, path, ordered=False).select("dataset_name", "timestamp")
        rows = rows.join(have, ["dataset_name", "timestamp"], "left_anti")
    # materialise in the shared checkpoint folder first: the anti join must
    # not be re-evaluated against the table after the append
    from ..session import cut_lineage

    rows = cut_lineage(rows.select(*HISTORY_SCHEMA.fieldNames()))
    _add_files(spark, path, _versions(rows, replaces=False))
    return rows


def replace_metrics(spark: SparkSession, path: str, metrics: DataFrame) -> DataFrame:
    """Write metrics rows in the place of rows of the same (dataset,
    timestamp); returns them. Older versions stay in their files, hidden."""
    from ..session import cut_lineage

    create_metrics_history(spark, path)
    rows = cut_lineage(history_rows(metrics).select(*HISTORY_SCHEMA.fieldNames()))
    _add_files(spark, path, _versions(rows, replaces=True))
    return rows


def _visible(stored: DataFrame) -> DataFrame:
    """Stored rows that no later replacing version hides; a copy that
    compaction has made of a row counts once."""
    version = F.coalesce("row_version", F.lit(0))
    of = Window.partitionBy("dataset_name", "timestamp")
    since = F.max(F.when(F.col("replaces"), version)).over(of)
    kept = stored.withColumn("_since", since).where(F.col("_since").isNull() | (version >= F.col("_since")))
    return kept.drop("_since").dropDuplicates()


def fetch_all_metrics(spark: SparkSession, path: str, dataset_name: str | None = None,
                      ordered: bool = True) -> DataFrame:
    """All rows (optionally one dataset) in timestamp order."""
    stored = spark.read.schema(STORED_SCHEMA).parquet(path)
    if dataset_name is not None:
        stored = stored.filter(F.col("dataset_name") == dataset_name)
    df = _visible(stored).select(*HISTORY_SCHEMA.fieldNames())
    return df.orderBy("timestamp") if ordered else df


def compact_metrics(spark: SparkSession, path: str) -> int:
    """Rewrite the visible rows as one set of files and delete the files that
    were there before; returns how many. Rows keep their versions, so readers
    and writers may go on meanwhile, and a crash half-way leaves copies that
    read as one."""
    from ..session import cut_lineage

    fs, root = _fs(spark, path)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    old = [f.getPath() for d in fs.listStatus(root) if d.isDirectory() and "=" in d.getPath().getName()
           for f in fs.listStatus(d.getPath()) if f.getPath().getName().endswith(".parquet")]
    if not old:
        return 0
    stored = spark.read.schema(STORED_SCHEMA).option("basePath", path).parquet(*[p.toString() for p in old])
    _add_files(spark, path, cut_lineage(_visible(stored)).coalesce(1))
    for p in old:
        fs.delete(hadoop_path(p.toString()), False)
    return len(old)


def fetch_recent_metrics(history: DataFrame, n: int = 30) -> DataFrame:
    """Newest ``n`` rows, newest first (a top-k, not a full sort)."""
    return history.orderBy(F.col("timestamp").desc()).limit(n)


def metrics_exist_on(history: DataFrame, dataset_name: str, day: _dt.date | None = None) -> DataFrame:
    """One row ``(dataset_name, day, exists)``; ``day`` replaces the
    wall clock so the answer is reproducible."""
    d = day or _dt.date.today()
    hit = (history.filter((F.col("dataset_name") == dataset_name)
                          & (F.to_date("timestamp") == F.lit(d))).limit(1)
           .agg(F.count(F.lit(1)).alias("n")))
    return hit.select(F.lit(dataset_name).alias("dataset_name"), F.lit(d).alias("day"),
                      (F.col("n") > 0).alias("exists"))


def append_metrics_jdbc(metrics: DataFrame, url: str, table: str = "metrics_history",
                        properties: dict | None = None) -> DataFrame:
    """S8 to a relational database: the same history rows written with
    ``DataFrame.write.jdbc`` (append). Needs a reachable database and its
    JDBC driver on the classpath; not exercised in tests (no server)."""
    rows = history_rows(metrics)
    rows.write.jdbc(url, table, mode="append", properties=properties or {})
    return rows
