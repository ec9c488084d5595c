"""

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 4) and prints ONE JSON line:
``{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.
Each workload ends in an action that materialises its full result.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
REPEAT = int(os.environ.get("BENCH_REPEAT", "1"))


def session() -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("vigil-bench")
             .config("spark.driver.memory", os.environ.get("BENCH_MEM", "7g"))
             .config("spark.sql.shuffle.partitions", str(int(CPUS) * 2))
             .config("vigil.spread.partitions", str(CPUS))  # the tables are one file each
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vigil-bench-"))
    return spark


def main() -> None:
    from vigil import registry as catalog
    from vigil.catalog import LINE_CORR, LINE_RULES, LINEITEM_RANGES, table
    from vigil.catalog_monitor import AS_OF_EVENTS, EVENTS_CFG, events_series
    from vigil.config import CHECK_ORDER, blank_config
    from vigil.operators import iforest
    from vigil.plans import reports
    from vigil.plans.run import run_all_checks, run_series
    from vigil.sources.history import history_rows
    from vigil.sources.snapshots import series_from_table

    spark = session()
    sf = SF_DIR
    line_cfg = blank_config(
        expected_columns=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                          "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"),
        expected_dtypes={"l_orderkey": ("int64",), "l_quantity": ("float64",)},
        numeric_ranges=LINEITEM_RANGES, patterns={"l_returnflag": "^[ANR]$", "l_linestatus": "^[OF]$"},
        id_column="l_orderkey", iqr_columns=("l_extendedprice", "l_quantity"),
        zscore_columns=("l_extendedprice", "l_quantity", "l_discount"),
        skew_columns=("l_extendedprice", "l_quantity"), date_column="l_shipdate",
        psi_column="l_extendedprice", corr_columns=LINE_CORR, entropy_column="l_returnflag",
        parent_column="l_returnflag", child_column="l_linestatus", **LINE_RULES)

    def pair():
        li = table(spark, sf, "lineitem")
        # ranges of dates reach the scan, a function of the date would not
        year = lambda y: li.filter(f"l_shipdate >= TIMESTAMP_NTZ'{y}-01-01' AND l_shipdate < TIMESTAMP_NTZ'{y + 1}-01-01'")
        return year(1998), year(1997)

    def b1():
        cur, prev = pair()
        run = run_all_checks(cur, prev, line_cfg)
        run.metrics().collect()
        run.results().collect()
        run.close()

    # one config per check: only the roles that check reads
    roles = {
        "null_value_detection": {}, "duplicate_detection": {"id_column": "l_orderkey"},
        "data_type_validation": {"expected_dtypes": line_cfg.expected_dtypes},
        "column_existence": {"expected_columns": line_cfg.expected_columns},
        "range_validation": {"numeric_ranges": line_cfg.numeric_ranges},
        "regex_pattern_validation": {"patterns": line_cfg.patterns},
        "outlier_detection_iqr": {"iqr_columns": line_cfg.iqr_columns},
        "outlier_detection_zscore": {"zscore_columns": line_cfg.zscore_columns},
        "schema_change_detection": {}, "data_freshness": {"date_column": "l_shipdate"},
        "volume_anomaly": {}, "missing_value_percentage": {},
        "psi_distribution_drift": {"psi_column": "l_extendedprice"},
        "correlation_drift": {"corr_columns": LINE_CORR},
        "data_skew_detection": {"skew_columns": line_cfg.skew_columns},
        "entropy_change": {"entropy_column": "l_returnflag"},
        "time_gap_detection": {"date_column": "l_shipdate"},
        "business_rule_validation": LINE_RULES, "uniqueness_constraints": {"id_column": "l_orderkey"},
        "referential_consistency": {"parent_column": "l_returnflag", "child_column": "l_linestatus"},
        "sales_calculation_check": {},
    }

    def b2():
        cur, prev = pair()
        for name in CHECK_ORDER:
            r = dict(roles[name])
            r.setdefault("row_duplicates", name == "duplicate_detection")
            run = run_all_checks(cur, prev, blank_config(**r))
            run.results().filter(F.col("check") == name).collect()
            run.close()

    def b3():
        run = run_series(events_series(spark, sf), EVENTS_CFG, key="snapshot", as_of=AS_OF_EVENTS,
                         dataset_name="events")
        out = run.metrics().collect()
        run.close()
        return out

    def b4():
        o = table(spark, sf, "orders")
        s = series_from_table(o, F.trunc("o_orderdate", "month"), "snapshot")
        cfg = blank_config(id_column="o_orderkey", date_column="o_orderdate", psi_column="o_totalprice",
                           iqr_columns=("o_totalprice",), zscore_columns=("o_totalprice",),
                           skew_columns=("o_totalprice",), entropy_column="o_orderpriority",
                           corr_columns=("o_totalprice", "o_custkey"), numeric_ranges={"o_totalprice": (0, 500000)})
        run = run_series(s, cfg, key="snapshot", dataset_name="orders")
        run.metrics().collect()
        run.close()

    def b5():
        li = table(spark, sf, "lineitem").withColumn("_rid", F.xxhash64("l_orderkey", "l_linenumber"))
        feats = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        m = iforest.fit(li, "_rid", feats, n_trees=100, contamination=0.1, seed=42)
        m.score(li, keep=("_rid",)).agg(F.sum("anomaly_flag")).collect()

    def stored_history():
        run = run_series(events_series(spark, sf), EVENTS_CFG, key="snapshot", as_of=AS_OF_EVENTS,
                         dataset_name="events")
        path = spark.sparkContext.getCheckpointDir().rstrip("/") + "/bench-history"
        history_rows(run.metrics()).write.mode("overwrite").parquet(path)
        run.close()
        return spark.read.parquet(path)

    h = stored_history()  # outside the timer: B6 times the reports

    def b6():
        for name in reports.REPORT_SQL:
            reports.report(h, name, "events").collect()
        reports.dashboard_feeds(h, "events").collect()

    # warm the JVM (class loading, codegen caches) on a small query
    catalog.QUERIES["c11_volume_anomaly"](spark, sf).collect()

    work = [("B1_fused_checks_lineitem_pair", b1), ("B2_checks_one_by_one", b2),
            ("B3_series_events_30_days", b3), ("B4_series_orders_monthly", b4),
            ("B5_isolation_forest_lineitem", b5), ("B6_reports_over_history", b6)]
    times = {}
    for name, fn in work:
        ts = []
        for _ in range(REPEAT):
            t = time.perf_counter()
            fn()
            ts.append(time.perf_counter() - t)
        times[name] = round(statistics.median(ts), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf}))


if __name__ == "__main__":
    main()
