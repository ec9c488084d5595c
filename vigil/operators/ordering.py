"""Predecessor and successor figures over a per-snapshot table.

A window over all snapshots (``OVER (ORDER BY key)``) is one task. That is
right for some thousand rows, which a count proves; beyond, the table is
dealt to key ranges, each range is a window of its own, and the first and
last row of a range stand in for it in the ranges beside it. Nothing but range
numbers reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import col

def with_neighbours(df: DataFrame, key: str, n: int, lags: dict, leads: dict | None = None,
                    most: int = 20_000) -> DataFrame:
    """``df`` (unique ``key``, ``n`` rows) with ``lags`` and ``leads``: new
    column -> column of the row before and after in key order. A null key is
    first. ``most``: rows that one window task may take."""
    leads = leads or {}
    if n <= most:
        w = Window.orderBy(col(key))
        return df.select("*", *_neighbours(w, lags, leads))
    return _by_ranges(df, key, lags, leads)


def _neighbours(w, lags: dict, leads: dict) -> list:
    return [*(F.lag(col(c)).over(w).alias(name) for name, c in lags.items()),
            *(F.lead(col(c)).over(w).alias(name) for name, c in leads.items())]


def _by_ranges(df: DataFrame, key: str, lags: dict, leads: dict) -> DataFrame:
    from ..session import cut_lineage

    spark, names = df.sparkSession, df.columns
    dealt = cut_lineage(df.repartitionByRange(col(key)).sortWithinPartitions(col(key)))
    dealt = dealt.withColumn("_range", F.spark_partition_id())
    place = F.struct(col(key).isNotNull().alias("known"), col(key).alias("k"))  # null first, as the ranges are
    ends = cut_lineage(dealt.groupBy("_range").agg(F.min(place).alias("_lo"), F.max(place).alias("_hi")))
    ranges = sorted(r[0] for r in ends.select("_range").collect())  # one number a range
    beside = spark.createDataFrame(
        [(r, ranges[i - 1] if i else None, ranges[i + 1] if i + 1 < len(ranges) else None) for i, r in enumerate(ranges)],
        "_r int, _before int, _after int")
    ends = ends.join(beside, F.col("_range") == F.col("_r")).drop("_r")
    rows = dealt.join(F.broadcast(ends), "_range")
    guest = lambda end, to: F.when((place == F.col(end)) & F.col(to).isNotNull(), F.struct(
        F.col(to).alias("at"), F.lit(True).alias("guest")))
    stands = F.array(F.struct(F.col("_range").alias("at"), F.lit(False).alias("guest")), guest("_hi", "_after"),
                     guest("_lo", "_before"))
    rows = rows.select(*[col(c) for c in names], F.explode(F.filter(stands, lambda x: x.isNotNull())).alias("_s"))
    w = Window.partitionBy("_s.at").orderBy(col(key))
    out = rows.select("*", *_neighbours(w, lags, leads)).where(~F.col("_s.guest"))
    return out.drop("_s")
