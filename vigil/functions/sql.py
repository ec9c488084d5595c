"""Spark SQL text helpers.

The engine writes its (many, wide) expressions as SQL text and hands each
finished expression to Spark once (``F.expr``): one driver->JVM call per
output column instead of one per operator node. The plans are identical.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def q(name: str) -> str:
    """Quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def s(text: str) -> str:
    """SQL string literal (backslash escapes are processed by the parser)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def num(x) -> str:
    """Numeric literal as double (so comparisons stay in double)."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def E(sql: str) -> Column:
    return F.expr(sql)


def add(parts, empty: str = "0") -> str:
    parts = list(parts)
    return "(" + " + ".join(parts) + ")" if parts else empty


def greatest(parts) -> str:
    parts = list(parts)
    return parts[0] if len(parts) == 1 else f"greatest({', '.join(parts)})"


def arr(values) -> str:
    vals = list(values)
    return f"array({', '.join(s(v) for v in vals)})" if vals else "CAST(array() AS ARRAY<STRING>)"


def ts_sql(dt: T.DataType, name: str, fmt: str | None = None) -> str:
    """Date-like column parsed with coercion (bad text -> null); text by
    ``fmt``, or as ISO."""
    c = q(name)
    if isinstance(dt, T.TimestampNTZType):
        return c
    if isinstance(dt, (T.TimestampType, T.DateType)):
        return f"CAST({c} AS TIMESTAMP_NTZ)"
    if fmt is not None:
        return f"CAST(try_to_timestamp(trim(CAST({c} AS STRING)), {s(fmt)}) AS TIMESTAMP_NTZ)"
    return f"try_cast(CAST({c} AS STRING) AS TIMESTAMP_NTZ)"
