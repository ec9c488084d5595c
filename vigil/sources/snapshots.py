"""Snapshot sources and sinks.

A *series* is one DataFrame holding many snapshots of a table, told apart by
a key column (``snapshot_date`` by default). Checks run over the whole series
grouped by that key; a (current, previous) pair is a series of two keys.
"""

from __future__ import annotations

import csv
import datetime as _dt
import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import NULL_TOKENS
from ..functions.exprs import col, dtype_name

KEY = "snapshot_date"
NUMBER = r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?\s*$|^\s*[+-]?(inf|infinity|nan)\s*$"
# what :func:`load_csv` reads back unchanged: doubled quotes, outer spaces, microseconds
CSV_WRITE = dict(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                 timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
# the day of a data file: in its name, or in the name of its partition folder
FILE_DATE = r"(?:/snapshot_|/[^/=]+=)(\d{4}-\d{2}-\d{2})[^/]*(?:/[^/]+)?\.(?:csv|parquet)$"


# ---------------------------------------------------------------- helpers
def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def _require_file(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(f"no such snapshot file: {path}")
    if fs.getContentSummary(p).getLength() == 0:
        raise ValueError(f"snapshot file has no content: {path}")


def normalize_nulls(df: DataFrame, tokens=NULL_TOKENS, keep=()) -> DataFrame:
    """NaN -> NULL in float columns; the missing-value tokens -> NULL in text
    columns (``keep`` columns pass unchanged). Gives one null notion to every
    later check."""
    toks = list(tokens)
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        if f.name in keep:
            pass
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.nanvl(c, F.lit(None).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType):
            c = F.when(c.isin(toks), F.lit(None).cast("string")).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def nan_to_null(df: DataFrame, keep=()) -> DataFrame:
    """NaN -> NULL in float columns only (columnar sources keep their text
    as is; the text tokens are a CSV notion)."""
    if not any(isinstance(f.dataType, (T.DoubleType, T.FloatType)) for f in df.schema.fields):
        return df
    return df.select(*[F.nanvl(col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in keep
                       else col(f.name) for f in df.schema.fields])


def infer_types(df: DataFrame, keep=()) -> DataFrame:
    """Type all-text columns the way the CSV loader does: a column whose
    non-null values all parse as integers becomes ``bigint``; else all as
    numbers (or none is there, but rows are) -> ``double``; else it stays
    text. One aggregate pass."""
    cols = [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in keep]
    if not cols:
        return df
    r = df.agg(F.count("*").alias("_rows"), *_parse_counts(cols)).first()
    target = {n: _parsed_type(r, i) for i, n in enumerate(cols)}
    return df.select(*[col(f.name).cast(target.get(f.name, f.dataType)).alias(f.name) for f in df.schema.fields])


def _parse_counts(cols) -> list:
    """Per column i: values (n), values that are no integer (l), no number
    (d); nothing for a None."""
    aggs = []
    for i, n in enumerate(cols):
        if n is None:
            continue
        c = col(n)
        whole = F.coalesce(c.rlike(r"^\s*[+-]?[0-9]+\s*$") & c.try_cast("bigint").isNotNull(), F.lit(False))
        aggs.append(F.count_if(c.isNotNull() & ~whole).alias(f"l{i}"))
        # the JVM's parser also takes type suffixes: ``12D`` and ``7F`` are codes, not numbers
        number = F.coalesce(c.rlike(NUMBER) & c.try_cast("double").isNotNull(), F.lit(False))
        aggs.append(F.count_if(c.isNotNull() & ~number).alias(f"d{i}"))
        aggs.append(F.count(c).alias(f"n{i}"))
    return aggs


def _parsed_type(r, i: int) -> T.DataType:
    if r[f"n{i}"] and not r[f"l{i}"]:
        return T.LongType()
    return T.DoubleType() if r["_rows"] and not r[f"d{i}"] else T.StringType()


def _read_csv_text(spark: SparkSession, path: str, **opts) -> DataFrame:
    r = (spark.read.option("header", True).option("mode", "FAILFAST")
         .option("inferSchema", False).option("nullValue", None)
         .option("quote", '"').option("escape", '"')  # a quote in a quoted cell is doubled
         .option("emptyValue", ""))
    for k, v in opts.items():
        r = r.option(k, v)
    return r.csv(path)


# ---------------------------------------------------------------- S1
def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               multi_line: bool = False) -> DataFrame:
    """A CSV or a Parquet file (or a folder of such) by its name; a folder
    is Parquet if it holds any."""
    fs, p = _fs_path(spark, path)
    _require_file(spark, path)
    names = [path] if not fs.getFileStatus(p).isDirectory() else [f.getPath().getName() for f in fs.listStatus(p)]
    if not any(n.endswith(".parquet") for n in names):
        return load_csv(spark, path, schema, multi_line)
    data = nan_to_null(spark.read.parquet(path))
    return data if schema is None else data.select(
        *[col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def load_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             multi_line: bool = False) -> DataFrame:
    """CSV with header -> table. ``multi_line``: quoted cells may hold
    line breaks (such a file is not split over tasks). Missing or zero-byte file raises; a
    malformed file raises ``ValueError`` when read."""
    _require_file(spark, path)
    try:
        raw = normalize_nulls(_read_csv_text(spark, path, multiLine=multi_line))
        if schema is not None:
            return raw.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        return infer_types(raw)
    except Exception as e:  # noqa: BLE001 - surface parser failures uniformly
        if "FileNotFound" in type(e).__name__:
            raise
        raise ValueError(f"snapshot file cannot be parsed: {path}") from e


# ---------------------------------------------------------------- S6
def snapshot_files(spark: SparkSession, directory: str) -> dict:
    """day -> paths of its files, oldest day first: ``snapshot_YYYY-MM-DD*``
    files in ``directory`` itself and files in ``<key>=YYYY-MM-DD`` folders,
    CSV or Parquet. A file whose name holds no date is no snapshot. A listing:
    nothing is read."""
    fs, root = _fs_path(spark, directory)
    if not fs.exists(root):
        return {}
    out: dict = {}

    def add(files) -> None:
        for st in files:
            path = st.getPath().toString()
            day = _file_day(path)
            if st.isFile() and st.getLen() and day and not st.getPath().getName().startswith(("_", ".")):
                out.setdefault(day, []).append(path)

    found = list(fs.listStatus(root))
    add(found)
    folders = [st.getPath() for st in found if st.isDirectory() and _file_day(st.getPath().toString() + "/x.csv")]
    with ThreadPoolExecutor(16) as pool:
        for files in pool.map(lambda p: list(fs.listStatus(p)), folders):
            add(files)
    return dict(sorted(out.items()))


def _file_day(path: str):
    m = re.search(FILE_DATE, path)
    try:
        return m and _dt.date.fromisoformat(m.group(1))
    except ValueError:
        return None


def _cut_day(path: str) -> str:
    """What :func:`_day_column` cuts out of a path."""
    folder, name = path.split("/")[-2:]
    tail = f"{folder}/{name}"
    return name[9:19] if name.startswith("snapshot_") else tail[tail.find("=") + 1:][:10]


def _day_column(files: list) -> Column:
    """The day of a row of ``files`` (day, path), from the name of its file.
    Cut out by its place in the name where that gives the day of every file;
    else found by pattern, which searches the whole path again for every row
    and takes longer than parsing it."""
    path = F.col("_metadata.file_path")
    if all(_cut_day(p) == d.isoformat() for d, p in files):
        name, tail = F.col("_metadata.file_name"), F.substring_index(path, "/", -2)
        return F.when(name.startswith("snapshot_"), F.substring(name, 10, 10)).otherwise(
            tail.substr(F.instr(tail, "=") + 1, F.lit(10))).cast("date")
    return F.regexp_extract(path, FILE_DATE, 1).cast("date")


def _header(spark: SparkSession, path: str) -> tuple:
    """Column names of one CSV file: its first record, nothing else is read.
    A quoted name may hold line breaks."""
    fs, p = _fs_path(spark, path)
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        record = (reader.readLine() or "").lstrip("\ufeff")
        while record.count('"') % 2 and (line := reader.readLine()) is not None:
            record += "\n" + line
    finally:
        reader.close()
    return tuple(next(csv.reader([record]), ()))


def _read_days(spark: SparkSession, files: dict, key: str, multi_line: bool = False) -> tuple[DataFrame, list]:
    """The files of ``files`` bound by column name, with their day; and the
    distinct (columns, days). CSV files of one header are one scan of text
    columns, Parquet files one scan of their merged columns (footers are read
    by tasks), so the plan grows with the number of layouts, not of files.
    Where both kinds meet, Parquet columns become text too."""
    paths = [(d, p) for d, ps in files.items() for p in ps]
    text = [(d, p) for d, p in paths if not p.endswith(".parquet")]
    with ThreadPoolExecutor(16) as pool:
        heads = list(pool.map(lambda x: _header(spark, x[1]), text))
    groups: dict = {}
    day = _day_column(text)
    for (d, p), h in zip(text, heads, strict=True):
        groups.setdefault(h, ([], set()))
        groups[h][0].append(p)
        groups[h][1].add(d)
    scans = [_read_csv_text(spark, ps, multiLine=multi_line).withColumn(key, day) for ps, _ in groups.values()]
    layouts = [(h, sorted(ds)) for h, (_, ds) in groups.items()]
    typed = [(d, p) for d, p in paths if p.endswith(".parquet")]
    if typed:
        data = spark.read.option("mergeSchema", True).parquet(*[p for _, p in typed]).withColumn(key, _day_column(typed))
        if scans:
            data = data.select(*[col(c) if c == key else col(c).cast("string").alias(c) for c in data.columns])
        scans.append(data)
        layouts += _parquet_layouts(spark, typed)
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    return (normalize_nulls(raw, keep=(key,)) if text else nan_to_null(raw, keep=(key,))), layouts


def _typed(data: DataFrame, files: dict, key: str) -> DataFrame:
    """Types of text from CSV files found out; Parquet files say theirs."""
    text = any(not p.endswith(".parquet") for ps in files.values() for p in ps)
    return infer_types(data, keep=(key,)) if text else data


def _parquet_layouts(spark: SparkSession, files: list) -> list:
    """(columns, days) of Parquet files, a day's columns those of any file."""
    by: dict = {}
    for d, p in files:
        by.setdefault(d, []).append(p)
    with ThreadPoolExecutor(16) as pool:
        names = pool.map(lambda ps: tuple(spark.read.option("mergeSchema", True).parquet(*ps).columns), by.values())
        return [(h, [d]) for d, h in zip(by, names, strict=True)]


def scan_snapshot_series(spark: SparkSession, directory: str, key: str = KEY,
                         schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """Every snapshot file in ``directory`` (:func:`snapshot_files`: flat
    files or partition folders, CSV or Parquet) as one series, ``key`` = the
    date in the file's or folder's name. Columns are bound by each file's own
    header (one that a file lacks is null there). The series has one type per
    column: numeric only if it is so in every snapshot; the types of single
    snapshots are in :func:`snapshot_schemas`. An empty folder raises."""
    files = snapshot_files(spark, directory)
    if not files:
        raise FileNotFoundError(f"no snapshot files in {directory}")
    data, _ = _read_days(spark, files, key, multi_line)
    if schema is not None:
        return data.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields],
                           F.col(key))
    return _typed(data, files, key)


def snapshot_schemas(spark: SparkSession, directory: str, key: str = KEY, multi_line: bool = False) -> DataFrame:
    """(key, dtypes map<column, dtype name>): the columns and types of every
    snapshot on its own, as the single-file loader would find them. One
    aggregate per snapshot over all files; a day's columns are those of any
    of its files."""
    files = snapshot_files(spark, directory)
    if not files:
        raise FileNotFoundError(f"no snapshot files in {directory}")
    data, heads = _read_days(spark, files, key, multi_line)
    cols = [c for c in data.columns if c != key]
    known = {c: dtype_name(data.schema[c].dataType) for c in cols if not isinstance(data.schema[c].dataType, T.StringType)}
    if all(p.endswith(".parquet") for ps in files.values() for p in ps):
        known = {c: dtype_name(data.schema[c].dataType) for c in cols}
    counts = data.groupBy(key).agg(F.count("*").alias("_rows"), *_parse_counts([c if c not in known else None for c in cols]))
    names = {n: dtype_name(t) for n, t in (("l", T.LongType()), ("d", T.DoubleType()), ("s", T.StringType()))}
    kinds = F.map_from_arrays(
        F.array(*[F.lit(c) for c in cols]),
        F.array(*[F.lit(known[c]) if c in known else F.when((F.col(f"n{i}") > 0) & (F.col(f"l{i}") == 0), names["l"])
                  .when((F.col("_rows") > 0) & (F.col(f"d{i}") == 0), names["d"]).otherwise(names["s"])
                  for i, c in enumerate(cols)]))
    layouts: dict = {}
    for h, days in heads:
        for d in days:
            layouts.setdefault(d, set()).update(h)
    has = spark.createDataFrame([(d, sorted(h)) for d, h in layouts.items()], f"{key} date, _has array<string>")
    return (has.join(counts.select(key, kinds.alias("_kinds")), key, "left")
            .select(key, F.when(F.col("_kinds").isNull(),  # a header without rows
                                F.map_from_arrays("_has", F.transform("_has", lambda _: F.lit(names["s"]))))
                    .otherwise(F.map_filter("_kinds", lambda c, _: F.array_contains("_has", c))).alias("dtypes")))


def series_from_table(df: DataFrame, key_expr: Column | str, key: str = KEY) -> DataFrame:
    """A series cut from one table by a key expression, e.g. the day of a
    timestamp. The key expression is evaluated per row; nothing is
    collected. (run_series / run_all_checks turn NaN into null.)"""
    k = F.expr(key_expr) if isinstance(key_expr, str) else key_expr
    return df.withColumn(key, k)  # the runners map NaN to null


def snapshot_keys(series: DataFrame, key: str = KEY) -> DataFrame:
    """Distinct keys with ordinal and predecessor/successor key (tiny)."""
    from pyspark.sql import Window

    w = Window.orderBy(key)
    return (series.select(key).distinct()
            .withColumn("ordinal", F.row_number().over(w))
            .withColumn("prev_key", F.lag(key).over(w))
            .withColumn("next_key", F.lead(key).over(w)))


# ---------------------------------------------------------------- S2 / S3
def latest_key(series: DataFrame, key: str = KEY, steps_back: int = 0):
    """Key of the snapshot ``steps_back`` before the newest (None if too few).
    Reads only the key column (partition values for partitioned tables)."""
    rows = (series.select(key).distinct()
            .orderBy(F.col(key).desc()).limit(steps_back + 1).collect())
    if len(rows) < steps_back + 1:
        return None
    return rows[steps_back][0]


def load_latest_snapshot(series: DataFrame, key: str = KEY) -> DataFrame:
    """The newest snapshot of a series; error when the series is empty."""
    k = latest_key(series, key)
    if k is None:
        raise FileNotFoundError("the series is empty: there is no newest snapshot")
    return series.filter(F.col(key) == F.lit(k))


def load_previous_snapshot(series: DataFrame, key: str = KEY, steps_back: int = 1):
    """S3: the snapshot ``steps_back`` before the newest, or None."""
    k = latest_key(series, key, steps_back)
    if k is None:
        return None
    return series.filter(F.col(key) == F.lit(k))


def load_snapshot(spark: SparkSession, directory: str, steps_back: int = 0, key: str = KEY,
                  multi_line: bool = False) -> DataFrame | None:
    """S2 / S3 on a folder: the snapshot ``steps_back`` before the newest (None
    if there are too few) with its own header and types. The day is found in
    the listing; only its files are read."""
    files = snapshot_files(spark, directory)
    if len(files) <= steps_back:
        return None
    day = list(files)[-1 - steps_back]
    data, _ = _read_days(spark, {day: files[day]}, key, multi_line)
    return _typed(data, {day: files[day]}, key)


# ---------------------------------------------------------------- S4 / S5
def add_ingestion_timestamp(df: DataFrame, timestamp: _dt.datetime | None = None) -> DataFrame:
    """Constant ``ingestion_timestamp`` text column (default: now)."""
    ts = (timestamp or _dt.datetime.now()).strftime("%Y-%m-%d %H:%M:%S")
    return df.withColumn("ingestion_timestamp", F.lit(ts))


def write_snapshots(series: DataFrame, directory: str, key: str = KEY,
                    fmt: str = "parquet") -> None:
    """Write a series partitioned by its key; dynamic partition overwrite
    replaces only the snapshots present in ``series`` (idempotent rerun)."""
    w = series.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key)
    if fmt == "csv":
        w.options(**CSV_WRITE).csv(directory)
    else:
        w.parquet(directory)


def write_snapshot_files(series: DataFrame, directory: str, key: str = KEY) -> list:
    """S5 (CSV layout): every snapshot as ``snapshot_YYYY-MM-DD*.csv`` files
    in ``directory``. Tasks write in parallel (a big day is split over many
    part files, never funnelled into one task); the part files are then
    renamed on the file system (metadata only). Returns the file names."""
    spark = series.sparkSession
    staging = directory.rstrip("/") + "/_staging"
    data = series.withColumn(key, F.date_format(F.col(key), "yyyy-MM-dd"))
    data.write.mode("overwrite").options(**CSV_WRITE).partitionBy(key).csv(staging)
    jvm = spark.sparkContext._jvm
    fs, root = _fs_path(spark, staging)
    path = jvm.org.apache.hadoop.fs.Path
    moves, old = [], []
    for d in fs.listStatus(root):
        name = d.getPath().getName()
        if not d.isDirectory() or not name.startswith(key + "="):
            continue
        day = name.split("=", 1)[1]
        old += [f.getPath() for f in fs.globStatus(path(f"{directory.rstrip('/')}/snapshot_{day}*.csv")) or []]
        moves += [(f.getPath(), f"snapshot_{day}-{f.getPath().getName()}") for f in fs.listStatus(d.getPath())
                  if f.getPath().getName().endswith(".csv")]
    # new files first, then the old ones go: a crash leaves a day twice, never without its rows
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda m: fs.rename(m[0], path(f"{directory.rstrip('/')}/{m[1]}")), moves))
        list(pool.map(lambda f: fs.delete(f, False), old))
    fs.delete(root, True)
    return sorted(target for _, target in moves)


# ---------------------------------------------------------------- pair
def pair_series(current: DataFrame, previous: DataFrame | None, key: str = KEY):
    """(current, previous) -> (series, current_key). Current gets key 1 and
    previous key 0. The series has the current side's columns: a column the
    previous side lacks is null there, one whose type differs is coerced to
    the current type with ``try_cast`` (schema checks read the original
    schemas, not this union)."""
    cur = current.withColumn(key, F.lit(1))
    if previous is None:
        return cur, 1
    ptypes = {f.name: f.dataType for f in previous.schema.fields}
    prev_cols = []
    for f in current.schema.fields:
        if f.name not in ptypes:
            c = F.lit(None).cast(f.dataType)
        elif ptypes[f.name] != f.dataType:
            c = col(f.name).try_cast(f.dataType)
        else:
            c = col(f.name)
        prev_cols.append(c.alias(f.name))
    prev = previous.select(*prev_cols).withColumn(key, F.lit(0))
    return cur.unionByName(prev), 1
