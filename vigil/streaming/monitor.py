"""Continuous monitoring (P3) with Structured Streaming.

New snapshot files (flat or in partition folders, CSV or Parquet) arriving in
a folder are listed by a file-source stream, which tells the days that changed. The batch
function then checks those days *whole* (a bounded scan of all their files,
which may have come in several micro-batches), each against the newest day
before it that has been checked; the day after a changed one is checked again,
since its drift figures read it. The metric rows replace earlier rows of the
same (dataset, timestamp), so that late files, replayed batches and reruns
end in one row per day made from all its files.

Of every checked day the monitor keeps a profile (:mod:`.state`). A day that
is only compared with is taken from there: its files are not read again and
may be gone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, CheckConfig
from ..functions.sql import q
from ..operators.profile import Profile
from ..plans.run import run_series
from ..sources import history as hist
from ..sources.snapshots import FILE_DATE, KEY, _read_days, snapshot_files
from . import state


def process_days(spark: SparkSession, days: list, source_dir: str, schema: T.StructType,
                 history_path: str, config: CheckConfig, dataset_name: str, key: str = KEY,
                 as_of: _dt.date | None = None, state_path: str | None = None) -> int:
    """Check the snapshots of ``days`` and those that follow them; returns the
    number of history rows written.

    A day before a checked one is read from ``state_path`` (default: beside
    the history) and from its files only if nothing usable is kept there; if
    neither is left, this raises. A following day whose files are gone keeps
    its row. Days of ``days`` need their files."""
    state_path = state_path or f"{history_path.rstrip('/')}_profiles"
    hist.create_metrics_history(spark, history_path)
    day = F.to_date("timestamp")
    done = {r[0] for r in hist.fetch_all_metrics(spark, history_path, dataset_name, ordered=False)
            .select(day).distinct().collect()}  # one date per snapshot
    files = snapshot_files(spark, source_dir)
    known = sorted(done | set(days))
    at = {d: i for i, d in enumerate(known)}
    after = {known[at[d] + 1] for d in days if at[d] + 1 < len(known)}
    check = set(days) | {d for d in after if d in files}
    before = {known[at[d] - 1] for d in check if at[d]} - check
    columns = T.StructType([*schema.fields, T.StructField(key, T.DateType())])
    wanted = Profile(spark.createDataFrame([], columns), config, key=key)
    kept, stored = state.load(spark, state_path, dataset_name, sorted(before), wanted)
    read = check | (before - set(kept))
    gone = sorted(str(d) for d in read if d not in files)
    if gone:
        raise FileNotFoundError(f"neither files nor kept profiles of checked snapshots: {', '.join(gone)}")
    series, _ = _read_days(spark, {d: files[d] for d in sorted(read)}, key)
    for f in schema.fields:  # a value that is not of its type raises, as in the batch loader
        c = F.col(q(f.name)).cast(f.dataType) if f.name in series.columns else F.lit(None).cast(f.dataType)
        series = series.withColumn(f.name, c)
    with run_series(series.select(*[q(f.name) for f in schema.fields], key), config, key=key, as_of=as_of,
                    dataset_name=dataset_name, stored=stored, keep=True) as run:
        state.save(run.profile, state_path, dataset_name, sorted(check))
        return hist.replace_metrics(spark, history_path, run.metrics().filter(F.col(key).isin(list(check)))).count()


def stream_monitor(spark: SparkSession, source_dir: str, schema: T.StructType, history_path: str,
                   checkpoint_location: str, config: CheckConfig = DEFAULT,
                   dataset_name: str = "ecommerce_sales", key: str = KEY, as_of: _dt.date | None = None,
                   available_now: bool = True, max_files_per_trigger: int | None = None,
                   state_path: str | None = None):
    """Start the monitor. With ``available_now`` the query consumes every
    pending file and stops (a scheduled run); otherwise it keeps running
    and the caller owns the returned ``StreamingQuery``."""
    # the stream lists files and reads none of them: the content column is not selected
    reader = (spark.readStream.format("binaryFile").option("recursiveFileLookup", True)
              .schema("path string, modificationTime timestamp, length bigint, content binary"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    name = F.regexp_extract(F.col("path"), FILE_DATE, 1)
    stream = reader.load(source_dir).select(F.try_to_timestamp(name, F.lit("yyyy-MM-dd")).cast("date").alias(key))

    def fn(batch_df, _epoch_id):
        days = sorted(r[0] for r in batch_df.distinct().collect() if r[0])  # one date per new snapshot
        if days:
            process_days(spark, days, source_dir, schema, history_path, config, dataset_name, key, as_of, state_path)

    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    query = w.start()
    if available_now:
        query.awaitTermination()
    return query
