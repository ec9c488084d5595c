"""Cutting lineage through the folder that the cluster names."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written to and read from the shared checkpoint folder, so that
    it survives lost executors. The folder is the one already set, else
    ``spark.checkpoint.dir``; where neither is set a local session takes a
    fresh folder, a cluster is refused."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def sample_by_hash(df: DataFrame, column: str, most: int, where: Column | None = None) -> list:
    """At most ``most`` distinct values of ``column``, those with the
    smallest hashes, in hash order. Only hashes are ranked, so tasks send
    numbers and the driver gets no more than the sample."""
    if where is not None:
        df = df.where(where)
    rows = df.select(F.xxhash64(column).alias("h"), F.col(column).alias("x"))
    last = rows.select("h").distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]
    if last is None:
        return []
    got = rows.where(F.col("h") <= last).dropDuplicates(["h"]).collect()
    return [r.x for r in sorted(got, key=lambda r: r.h)]
