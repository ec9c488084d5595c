"""Rows that break row-level rules, apart from those that do not.

Every rule that judges a row by itself (ranges, patterns, business rules, sets,
parent and child, amounts) is one condition of the profile, the same that the
checks count; here each row gets the names of the rules that it breaks, in one
pass, and rows go to one of two sinks by whether there are any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CheckConfig
from ..functions.sql import s
from ..sources.snapshots import KEY, nan_to_null
from .profile import Profile

BROKEN = "broken_rules"


def with_broken_rules(series: DataFrame, config: CheckConfig, key: str = KEY) -> DataFrame:
    """``series`` with ``broken_rules``: names of the rules that a row breaks,
    in rule order (empty: none)."""
    data = nan_to_null(series, keep=(key,))
    rules = Profile(data, config, key=key).row_rules
    names = ", ".join(f"CASE WHEN {cond} THEN {s(rule)} END" for _, rule, cond in rules)
    found = f"filter(array({names}), r -> r IS NOT NULL)" if rules else "CAST(array() AS ARRAY<STRING>)"
    return data.withColumn(BROKEN, F.expr(found))


def quarantine(series: DataFrame, config: CheckConfig, path: str, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """Write ``series`` in one pass: good rows to ``path/quarantined=false``,
    the others with their rules to ``path/quarantined=true``, each by
    snapshot. ``path`` belongs to this series: a rerun replaces both sinks.
    Returns them."""
    rows = with_broken_rules(series, config, key)
    (rows.withColumn("quarantined", F.size(BROKEN) > 0).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy("quarantined", key).parquet(path))
    return good_rows(series.sparkSession, path), bad_rows(series.sparkSession, path)


def good_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("CAST(quarantined AS STRING) = 'false'").drop("quarantined", BROKEN)


def bad_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("CAST(quarantined AS STRING) = 'true'").drop("quarantined")
