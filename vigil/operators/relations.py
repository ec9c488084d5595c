"""Join helpers: size-checked lookup joins and parent/child orphan counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension side is broadcast only when it has at most this many rows.
BROADCAST_MAX_ROWS = 2_000_000


def lookup_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join a fact table to a dimension. The dimension is broadcast only
    after its row count is checked; above the bound the planner's shuffle
    join (with AQE skew splitting) is used instead."""
    n = dim.count()
    side = F.broadcast(dim) if n <= max_rows else dim
    return fact.join(side, on, how)


def orphan_counts(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Parent/child consistency between two tables: child rows whose key has
    no parent, and parent rows with no child. Both sides are first reduced
    to (key, rows) with map-side combine, so a hot key is one row before any
    shuffle; the anti joins then run on the key tables. One output row."""
    c = child.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    p = parent.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    a = (c.join(p.select(key), key, "left_anti")
         .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("children_without_parent")))
    b = (p.join(c.select(key), key, "left_anti")
         .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("parents_without_child")))
    return _one_row(a, b)


def _one_row(a: DataFrame, b: DataFrame) -> DataFrame:
    """Combine two single-row aggregates into one row (a 1x1 pairing)."""
    return a.withColumn("_j", F.lit(1)).join(b.withColumn("_j", F.lit(1)), "_j").drop("_j")
