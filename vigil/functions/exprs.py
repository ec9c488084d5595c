"""Column-expression helpers shared by the checks (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """Column by exact name (names may hold spaces, dashes or dots)."""
    return F.col("`" + name.replace("`", "``") + "`")


def dtype_name(dt: T.DataType) -> str:
    """Spark type -> the dtype name the original checks compare against."""
    if isinstance(dt, T.LongType):
        return "int64"
    if isinstance(dt, T.IntegerType):
        return "int32"
    if isinstance(dt, T.ShortType):
        return "int16"
    if isinstance(dt, T.ByteType):
        return "int8"
    if isinstance(dt, T.DoubleType):
        return "float64"
    if isinstance(dt, T.FloatType):
        return "float32"
    if isinstance(dt, T.BooleanType):
        return "bool"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "datetime64[ns]"
    return "object"


def join_null_safe(left: DataFrame, right: DataFrame, on: list, how: str = "inner",
                   hint=lambda df: df) -> DataFrame:
    """Join on equal ``on`` columns where null equals null; the right side's
    copies of them are dropped. ``hint`` may wrap the right side (broadcast)."""
    names = {c: f"_right_{i}" for i, c in enumerate(on)}
    right = hint(right.withColumnsRenamed(names))
    same = F.lit(True)
    for c, r in names.items():
        same = same & col(c).eqNullSafe(F.col(r))
    out = left.join(right, same, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*names.values())
