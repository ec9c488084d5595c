"""Fused per-snapshot profile: every figure the 21 checks need, computed for
all snapshots of a series at once.

Plan (independent of the number of snapshots):

* stage A - one ``groupBy(key)`` aggregate over the series: counts, null
  counts, range/pattern/rule counts, moments, quantiles, date max. Map-side
  partial aggregation means the shuffle carries one row per snapshot per
  task, whatever the data size or key skew.
* stage B - separate narrow aggregates, each built only when a check needs it
  (``PARTS``): outlier and bin counts per snapshot (one more scan, one row per
  snapshot and task leaves the map side), distinct ids ``(key, id)``, value
  counts ``(key, value, count)`` and row hashes ``(key, hash, count)``.
* time gaps - ``(key, day)`` min/max aggregate, then ``lag`` over the days of
  each snapshot (days, not rows, are ordered).
* duplicate rows - exact: where a row hash repeats, whole rows are counted
  with map-side combine (so a row repeated a billion times leaves a task once),
  and only the groups of more than one row count. Few repeated hashes are
  first joined to the rows by broadcast, so that only candidates are shuffled.

A null key is a snapshot like any other: joins on the key are null-safe.

Drift figures pair each snapshot with its predecessor by key order over the
per-snapshot table (:mod:`vigil.operators.ordering`: one window for few
snapshots, a window per key range for many).

Expressions are written as Spark SQL text (see :mod:`vigil.functions.sql`).
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, CheckConfig
from ..functions.exprs import dtype_name, join_null_safe
from ..functions.sql import E, add, num, q, s, ts_sql
from .ordering import with_neighbours

SMALL_BYTES = 64 << 20  # per-snapshot tables proven to be below this (16 bytes a cell) are broadcast
SMALL_CANDIDATES = 1 << 18  # repeated row hashes (key, hash) up to this many are broadcast
PARTS = ("iqr", "zscore", "psi", "ids", "values", "dups", "gaps", "gram")
BLANK_RE = r"(?U)^[\s\x1c-\x1f]*$"  # empty after Python-style strip()


def _num(schema: T.StructType, name) -> bool:
    return name is not None and name in schema.fieldNames() and isinstance(schema[name].dataType, T.NumericType)


def adjusted_skew_sql(x: str) -> str:
    """Bias-corrected sample skewness G1 (n<3 -> null, constant -> 0)."""
    n = f"CAST(count({x}) AS DOUBLE)"
    return (f"CASE WHEN {n} < 3 THEN CAST(NULL AS DOUBLE) "
            f"ELSE coalesce(skewness({x}) * sqrt({n} * ({n} - 1)) / ({n} - 2), 0.0) END")


def psi_bin_sql(v: str, lo: str, step: str, bins: int) -> str:
    """1-based bin of ``v`` over ``bins`` equal-width bins: edge i is
    ``i * step + lo`` (the linspace formula) and a value belongs to the last
    edge it reaches; the last bin is closed; zero width -> last bin."""
    terms = [f"CAST({v} >= CAST({i} AS DOUBLE) * {step} + {lo} AS INT)" for i in range(1, bins)]
    return "(1 + " + " + ".join(terms) + ")" if terms else "1"


class Profile:
    """All per-snapshot figures of a series (see module doc).

    ``series``          DataFrame with a ``key`` column.
    ``config``          column roles and thresholds.
    ``as_of``           reference date for freshness (default: today).
    ``prev_schema``     pair mode: schema of the previous side (schema checks
                        and column availability); series mode: None.
    ``schemas``         series mode: (key, dtypes map<column, dtype name>), the
                        columns and types of every snapshot on its own
                        (:func:`~vigil.sources.snapshots.snapshot_schemas`).
    ``keys``            optional list of keys that must appear even when a
                        snapshot has no rows (pair mode).
    ``stored``          optional :class:`~vigil.streaming.state.StoredProfile`:
                        figures of snapshots that are not in ``series`` but
                        precede some that are. They serve the drift checks and
                        have no rows in the results.
    ``keep``            every part is a pass of its own: keep the rows of the first
                        on the executors' disks for the others (text sources).
    """

    def __init__(self, series: DataFrame, config: CheckConfig = DEFAULT,
                 key: str = "snapshot_date", as_of: _dt.date | None = None,
                 prev_schema: T.StructType | None = None, keys: list | None = None,
                 schemas: DataFrame | None = None, stored=None, keep: bool = False):
        self._persisted: list[DataFrame] = []
        from ..session import allow_cached_coalescing, compilable_methods, spread

        allow_cached_coalescing(series.sparkSession)
        compilable_methods(series.sparkSession)

        self.series = spread(series, self._persisted, keep)
        self.cfg = config
        self.key = key
        self.k = q(key)
        self.as_of = as_of or _dt.date.today()
        self.schema = T.StructType([f for f in series.schema.fields if f.name != key])
        self.cols = self.schema.fieldNames()
        self.prev_schema = prev_schema
        self.keys = keys
        self.schemas = schemas
        self.stored = stored
        self.quantile_mode = self.cfg.quantiles
        self._views: dict = {}

    # ------------------------------------------------------------ columns
    def has(self, name) -> bool:
        return name is not None and name in self.cols

    def prev_has(self, name) -> bool:
        if self.prev_schema is None:
            return self.has(name)
        return name is not None and name in self.prev_schema.fieldNames()

    @cached_property
    def range_cols(self):
        return [(c, lo, hi) for c, (lo, hi) in self.cfg.numeric_ranges.items() if _num(self.schema, c)]

    @cached_property
    def pattern_cols(self):
        return [(c, p) for c, p in self.cfg.patterns.items() if self.has(c)]

    @cached_property
    def iqr_cols(self):
        return [c for c in self.cfg.iqr_columns if _num(self.schema, c)]

    @cached_property
    def z_cols(self):
        return [c for c in self.cfg.zscore_columns if _num(self.schema, c)]

    @cached_property
    def skew_cols(self):
        return [c for c in self.cfg.skew_columns if _num(self.schema, c)]

    @cached_property
    def corr_cols(self):
        return [c for c in self.cfg.corr_columns if _num(self.schema, c)]

    @cached_property
    def gram_on(self) -> bool:
        """Many correlated columns: sums of all pairs by matrix products."""
        return len(self.corr_cols) > self.cfg.gram_columns

    @cached_property
    def corr_pairs(self):
        """Pairs with expressions of their own (none for many columns)."""
        k = 0 if self.gram_on else len(self.corr_cols)
        return [(i, j) for i in range(k) for j in range(i, k)]

    @cached_property
    def psi_on(self) -> bool:
        c = self.cfg.psi_column
        return _num(self.schema, c) and self.prev_has(c)

    @cached_property
    def id_on(self) -> bool:
        return self.has(self.cfg.id_column)

    @cached_property
    def ent_on(self) -> bool:
        return self.has(self.cfg.entropy_column)

    @cached_property
    def date_on(self) -> bool:
        return self.has(self.cfg.date_column)

    @cached_property
    def amount_on(self) -> bool:
        c = self.cfg
        return all(self.has(x) for x in (c.amount_column, c.quantity_column,
                                         c.price_column, c.discount_column))

    @cached_property
    def set_rules(self):
        return [r for r in self.cfg.set_rules if self.has(r.column)]

    @cached_property
    def ref_on(self) -> bool:
        return self.has(self.cfg.parent_column) and self.has(self.cfg.child_column)

    @cached_property
    def rule_cols(self) -> dict:
        """Facts column -> rule name, for the rules that apply."""
        cfg, out = self.cfg, {}
        if _num(self.schema, cfg.positive_column):
            out["br_pos"] = cfg.rule_names[0]
        if cfg.le_pair and all(_num(self.schema, c) for c in cfg.le_pair):
            out["br_le"] = cfg.rule_names[1]
        if cfg.bounded_column and _num(self.schema, cfg.bounded_column[0]):
            out["br_bnd"] = cfg.rule_names[2]
        for i, r in enumerate(self.set_rules):
            out[f"br_set_{i}"] = r.name
        return out

    def ts(self, name: str) -> str:
        return ts_sql(self.schema[name].dataType, name, self.date_format)

    @cached_property
    def date_format(self) -> str | None:
        """The format that most values of a date column in text parse with.
        None: ISO, or not text. ISO wins ties, so where it reads every value no
        other format is tried (a failed try costs many times a good one);
        else one more aggregate counts the others."""
        cfg = self.cfg
        if not (self.date_on and isinstance(self.schema[cfg.date_column].dataType, T.StringType) and cfg.date_formats):
            return None
        x = self.schema[cfg.date_column].dataType
        iso, values = self.series.agg(E(f"count({ts_sql(x, cfg.date_column)})"), E(f"count({q(cfg.date_column)})")).first()
        if iso == values:
            return None
        tried = [None, *cfg.date_formats]
        r = [iso, *self.series.agg(*[E(f"count({ts_sql(x, cfg.date_column, fmt)}) AS f{i}") for i, fmt in enumerate(tried[1:])]).first()]
        return tried[max(range(len(tried)), key=lambda i: (r[i], -i))]

    @cached_property
    def row_rules(self) -> list:
        """(figure, rule, SQL condition) of every rule that judges a row by
        itself; the figure counts the rows that break it."""
        cfg, out = self.cfg, []
        for i, (c, lo, hi) in enumerate(self.range_cols):
            out.append((f"rv_{i}", f"range: {c}", f"{q(c)} < {num(lo)} OR {q(c)} > {num(hi)}"))
        for i, (c, p) in enumerate(self.pattern_cols):
            out.append((f"pb_{i}", f"pattern: {c}", f"NOT (CAST({q(c)} AS STRING) RLIKE {s('(?U)^(?:' + p + ')')})"))
        names = self.rule_cols
        if "br_pos" in names:
            out.append(("br_pos", names["br_pos"], f"{q(cfg.positive_column)} <= 0"))
        if "br_le" in names:
            out.append(("br_le", names["br_le"], f"{q(cfg.le_pair[0])} > {q(cfg.le_pair[1])}"))
        if "br_bnd" in names:
            c, lo, hi = cfg.bounded_column
            out.append(("br_bnd", names["br_bnd"], f"{q(c)} < {num(lo)} OR {q(c)} > {num(hi)}"))
        for i, r in enumerate(self.set_rules):
            vals = ", ".join(s(str(v)) for v in r.values)
            out.append((f"br_set_{i}", r.name, f"coalesce(NOT ({q(r.column)} IN ({vals})), true)"))
        if self.ref_on:
            p, ch = q(cfg.parent_column), q(cfg.child_column)
            out += [("rf_blank", f"empty: {cfg.child_column}",
                     f"{p} IS NOT NULL AND {ch} IS NOT NULL AND CAST({ch} AS STRING) RLIKE {s(BLANK_RE)}"),
                    ("rf_missing", f"missing: {cfg.child_column}", f"{p} IS NOT NULL AND {ch} IS NULL")]
        if self.amount_on:
            out.append(("ac_bad", f"amount: {cfg.amount_column}", f"{self.amount_pct_sql()} > {num(cfg.amount_tolerance_pct)}"))
        return out

    def amount_pct_sql(self) -> str:
        """Percent by which the amount departs from quantity x price x (1 - discount)."""
        cfg = self.cfg
        sv, qv = f"CAST({q(cfg.amount_column)} AS DOUBLE)", f"CAST({q(cfg.quantity_column)} AS DOUBLE)"
        pv, dv = f"CAST({q(cfg.price_column)} AS DOUBLE)", f"CAST({q(cfg.discount_column)} AS DOUBLE)"
        e = f"({qv} * {pv} * (1 - {dv} / 100))"
        den, nm = f"({e} + 1e-9)", f"abs({sv} - {e})"
        return (f"CASE WHEN {sv} IS NOT NULL AND {qv} IS NOT NULL AND {pv} IS NOT NULL AND {dv} IS NOT NULL "
                f"THEN (CASE WHEN {den} = 0 THEN (CASE WHEN {nm} = 0 THEN NULL ELSE CAST('Infinity' AS DOUBLE) END)"
                f" ELSE {nm} / {den} END) * 100 END")

    @cached_property
    def value_type_cols(self) -> list:
        """(column, type, SQL that is true for values of that type) per text
        column of ``value_types`` and type it may have."""
        out = []
        for c, kinds in self.cfg.value_types.items():
            if not (self.has(c) and isinstance(self.schema[c].dataType, T.StringType)):
                continue
            x = q(c)
            for kind in kinds:
                if kind.startswith("int"):
                    test = f"{x} RLIKE '^\\\\s*[+-]?[0-9]+\\\\s*$' AND try_cast({x} AS BIGINT) IS NOT NULL"
                elif kind.startswith("float"):
                    test = f"NOT ({x} RLIKE '[dDfF]\\\\s*$') AND try_cast({x} AS DOUBLE) IS NOT NULL"
                elif kind.startswith("date"):
                    test = f"{ts_sql(T.StringType(), c)} IS NOT NULL"
                elif kind == "bool":
                    test = f"try_cast({x} AS BOOLEAN) IS NOT NULL"
                else:
                    test = "true"
                out.append((c, kind, test))
        return out

    # ------------------------------------------------------------ stage A
    def stage_a_sql(self) -> list:
        cfg, a = self.cfg, ["count(1) AS n"]
        for i, c in enumerate(self.cols):
            a.append(f"count_if({q(c)} IS NULL) AS nul_{i}")
        a += [f"count_if({cond}) AS {name}" for name, _, cond in self.row_rules]
        for i, (c, _, _) in enumerate(self.range_cols):
            a += [f"CAST(min({q(c)}) AS DOUBLE) AS rmin_{i}", f"CAST(max({q(c)}) AS DOUBLE) AS rmax_{i}"]
        for i, (c, _, test) in enumerate(self.value_type_cols):
            a.append(f"count_if({q(c)} IS NOT NULL AND NOT coalesce({test}, false)) AS vt_{i}")
        for i, c in enumerate(self.iqr_cols):
            x = f"CAST({q(c)} AS DOUBLE)"
            if self.quantile_mode == "approx":
                a.append(f"percentile_approx({x}, array(0.25, 0.75), {int(cfg.approx_accuracy)}) AS q_{i}")
            elif self.quantile_mode == "exact":
                a.append(f"percentile({x}, array(0.25, 0.75)) AS q_{i}")
            a.append(f"count({x}) AS inn_{i}")
        for i, c in enumerate(self.z_cols):
            x = f"CAST({q(c)} AS DOUBLE)"
            a += [f"avg({x}) AS zm_{i}", f"stddev_pop({x}) AS zs_{i}", f"min({x}) AS zmin_{i}",
                  f"max({x}) AS zmax_{i}", f"count({x}) AS znn_{i}"]
        for i, c in enumerate(self.skew_cols):
            a.append(f"{adjusted_skew_sql(f'CAST({q(c)} AS DOUBLE)')} AS sk_{i}")
        for p, (i, j) in enumerate(self.corr_pairs):
            x, y = f"CAST({q(self.corr_cols[i])} AS DOUBLE)", f"CAST({q(self.corr_cols[j])} AS DOUBLE)"
            # merged means of a constant differ in their last digit, which is no spread
            a += [f"covar_pop({x}, {y}) AS cv_{p}",
                  f"CASE WHEN min({x}) = max({x}) THEN 0.0D ELSE stddev_pop(CASE WHEN {y} IS NOT NULL THEN {x} END) END AS sx_{p}",
                  f"CASE WHEN min({y}) = max({y}) THEN 0.0D ELSE stddev_pop(CASE WHEN {x} IS NOT NULL THEN {y} END) END AS sy_{p}"]
        for i, c in enumerate(self.corr_cols) if self.gram_on else ():
            x = f"CAST({q(c)} AS DOUBLE)"
            a.append(f"min({x}) FILTER (WHERE abs({x}) < CAST('Infinity' AS DOUBLE)) AS cmin_{i}")
        if _num(self.schema, cfg.psi_column):
            x = f"CAST({q(cfg.psi_column)} AS DOUBLE)"
            a += [f"min({x}) AS pmin", f"max({x}) AS pmax"]
        if self.date_on:
            a += [f"max({self.ts(cfg.date_column)}) AS fmax",
                  f"count_if({q(cfg.date_column)} IS NOT NULL AND {self.ts(cfg.date_column)} IS NULL) AS fbad"]
        if self.amount_on:
            a.append(f"max({self.amount_pct_sql()}) AS ac_max")
        return a

    @cached_property
    def stage_a(self) -> DataFrame:
        k = self.k
        a = self.series.groupBy(self.key).agg(*[E(x) for x in self.stage_a_sql()])
        if self.keys is not None:
            spark = self.series.sparkSession
            kt = self.series.schema[self.key].dataType
            kdf = spark.createDataFrame([(x,) for x in self.keys], T.StructType([T.StructField(self.key, kt)]))
            a = kdf.join(a, self.key, "left").withColumn("n", F.coalesce("n", F.lit(0)))
        if self.stored is not None:
            old = self.stored.figures.withColumn("_old", F.lit(True))
            a = a.withColumn("_old", F.lit(False)).unionByName(
                old.select(*[c for c in old.columns if c == "_old" or c in a.columns]), allowMissingColumns=True)
        # predecessor / successor by key order over the per-snapshot table;
        # their PSI ranges ride along so stage B needs no self-join
        lags, leads = {"has_prev": "_one"}, {"has_next": "_one"}
        if "pmin" in a.columns:
            lags |= {"pmin_prev": "pmin", "pmax_prev": "pmax"}
            leads |= {"pmin_next": "pmin", "pmax_next": "pmax"}
        if self.schemas is not None:
            a = join_null_safe(a, self.schemas.select(self.key, "dtypes"), [self.key], "left")
            lags["prev_dtypes"] = "dtypes"
        a = a.withColumn("_one", F.lit(True)).persist(StorageLevel.MEMORY_AND_DISK)
        self._persisted.append(a)
        self.n_keys = a.count()
        a = with_neighbours(a, self.key, self.n_keys, lags, leads, self.cfg.window_rows).drop("_one")
        a = a.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("has_prev", "has_next")})
        a = a.persist(StorageLevel.MEMORY_AND_DISK)
        self._persisted.append(a)
        return a

    def small(self, df: DataFrame) -> DataFrame:
        """Broadcast a per-snapshot table when its size is proven small (rows
        counted on the persisted stage-A table, times its columns); otherwise
        leave the join to the planner (shuffle join)."""
        _ = self.stage_a
        return F.broadcast(df) if self.n_keys * len(df.columns) * 16 <= SMALL_BYTES else df

    def attach(self, left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
        return join_null_safe(left, right, [self.key], how, self.small)

    @cached_property
    def quantiles(self) -> DataFrame:
        """(key, q_<i>): the quartiles of the IQR columns."""
        if self.quantile_mode != "select":
            return self.stage_a.selectExpr(self.k, *[f"q_{i}" for i in range(len(self.iqr_cols))])
        from .quantiles import select_quantiles

        qs = select_quantiles(self.series, self.key, self.iqr_cols)
        self._persisted.append(qs)
        return qs

    # ------------------------------------------------------------ stage B
    def params(self, parts) -> DataFrame:
        """Parameters (one row per snapshot) of the counts of ``parts``."""
        sel, base = [self.k], self.stage_a
        if "iqr" in parts and self.quantile_mode == "select":
            base = self.attach(base, self.quantiles)
        for i in range(len(self.iqr_cols)) if "iqr" in parts else ():
            q1, q3 = f"q_{i}[0]", f"q_{i}[1]"
            sel += [f"{q1} - 1.5 * ({q3} - {q1}) AS lo_{i}", f"{q3} + 1.5 * ({q3} - {q1}) AS hi_{i}"]
        for i in range(len(self.z_cols)) if "zscore" in parts else ():
            sel += [f"zm_{i}", f"zs_{i}"]
        if "psi" in parts:
            b = self.cfg.psi_bins
            sel += ["least(pmin, pmin_prev) AS plo_c",
                    f"(greatest(pmax, pmax_prev) - least(pmin, pmin_prev)) / {b} AS pst_c",
                    "has_prev",
                    "least(pmin, pmin_next) AS plo_n",
                    f"(greatest(pmax, pmax_next) - least(pmin, pmin_next)) / {b} AS pst_n",
                    "has_next"]
        return base.selectExpr(*sel)

    def row_hash_sql(self) -> str:
        """xxhash64 over canonical values (-0.0 -> 0.0, one NaN) plus null
        masks (xxhash64 skips nulls, the masks keep their positions)."""
        parts, masks = [], []
        fields = self.schema.fields
        for f in fields:
            c = q(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                t = "DOUBLE" if isinstance(f.dataType, T.DoubleType) else "FLOAT"
                c = f"CASE WHEN isnan({c}) THEN CAST('NaN' AS {t}) WHEN {c} = 0 THEN CAST(0 AS {t}) ELSE {c} END"
            parts.append(c)
        for st in range(0, len(fields), 60):
            bits = [f"CASE WHEN {q(f.name)} IS NULL THEN {1 << b}L ELSE 0L END"
                    for b, f in enumerate(fields[st:st + 60])]
            masks.append(add(bits, "0L"))
        return f"xxhash64({', '.join(masks + parts)})"

    def counts(self, parts) -> DataFrame:
        """(key, outlier and bin counts of ``parts``): one scan, one plain
        aggregate per snapshot."""
        cfg = self.cfg
        aggs = []
        for i, c in enumerate(self.iqr_cols) if "iqr" in parts else ():
            x = f"CAST({q(c)} AS DOUBLE)"
            aggs.append(f"count_if({x} < lo_{i} OR {x} > hi_{i}) AS iqo_{i}")
        for i, c in enumerate(self.z_cols) if "zscore" in parts else ():
            x = f"CAST({q(c)} AS DOUBLE)"
            aggs.append(f"count_if(abs(try_divide({x} - zm_{i}, zs_{i})) > {num(cfg.zscore_threshold)}) AS zo_{i}")
        d = self.attach(self.series, self.params(parts), "inner")
        if "psi" in parts:
            v = f"CAST({q(cfg.psi_column)} AS DOUBLE)"
            d = d.selectExpr("*", f"CASE WHEN has_prev AND {v} IS NOT NULL THEN "
                                  f"{psi_bin_sql(v, 'plo_c', 'pst_c', cfg.psi_bins)} END AS bc",
                             f"CASE WHEN has_next AND {v} IS NOT NULL THEN "
                             f"{psi_bin_sql(v, 'plo_n', 'pst_n', cfg.psi_bins)} END AS bn")
            for b in range(1, cfg.psi_bins + 1):
                aggs += [f"count_if(bc = {b}) AS bc_{b}", f"count_if(bn = {b}) AS bn_{b}"]
        out = d.groupBy(self.key).agg(*[E(a) for a in aggs])
        if "psi" in parts and self.stored is not None:
            out = out.unionByName(self.stored_bins(), allowMissingColumns=True)
        return out

    def stored_bins(self) -> DataFrame:
        """(key, bn_<b>): the stored values of preceding snapshots over the
        range that each shares with its successor; no data is read."""
        old = self.attach(self.stored.figures.select(self.key), self.params(["psi"]), "inner")
        d = join_null_safe(old, self.stored.values, [self.key], "left").selectExpr(
            self.k, "c", f"CASE WHEN has_next AND value IS NOT NULL THEN "
                         f"{psi_bin_sql('value', 'plo_n', 'pst_n', self.cfg.psi_bins)} END AS bn")
        return d.groupBy(self.key).agg(*[E(f"CAST(coalesce(sum(c) FILTER (WHERE bn = {b}), 0) AS LONG) AS bn_{b}")
                                         for b in range(1, self.cfg.psi_bins + 1)])

    @cached_property
    def ids(self) -> DataFrame:
        """(key, id_distinct, id_has_null) over the distinct (key, id)."""
        x = self.series.selectExpr(self.k, f"{q(self.cfg.id_column)} AS g").distinct()
        return x.groupBy(self.key).agg(E("count(g) AS id_distinct"), E("max(g IS NULL) AS id_has_null"))

    def unique_counts(self) -> DataFrame:
        """(key, key_no, total, unique): per key of ``unique_keys`` the rows
        that have all of its columns and their distinct tuples. Rows are
        tagged with the key's number and a 128-bit digest of the tuple, so all
        keys share one scan and one exchange."""
        tags = []
        for i, cols in enumerate(self.cfg.unique_keys):
            names = ", ".join(q(c) for c in cols)
            whole = " AND ".join(f"{q(c)} IS NOT NULL" for c in cols)
            tags.append(f"CASE WHEN {whole} THEN named_struct('key_no', {i}, 'a', xxhash64({names}), "
                        f"'b', xxhash64({i + 1}, {names}, 1)) END")
        x = self.series.selectExpr(self.k, f"inline(filter(array({', '.join(tags)}), x -> x IS NOT NULL))")
        x = x.groupBy(self.key, "key_no", "a", "b").agg(E("count(1) AS c"))
        return x.groupBy(self.key, "key_no").agg(E("sum(c) AS total"), E("count(1) AS `unique`"))

    @cached_property
    def values(self) -> DataFrame:
        """(key, ent_n, ent_s) from the value counts of the entropy column."""
        x = (self.series.selectExpr(self.k, f"{q(self.cfg.entropy_column)} AS g").filter("g IS NOT NULL")
             .groupBy(self.key, "g").agg(E("CAST(count(1) AS DOUBLE) AS c")))
        return x.groupBy(self.key).agg(E("sum(c) AS ent_n"), E("sum(c * log2(c)) AS ent_s"))

    @cached_property
    def gram(self) -> DataFrame:
        """(key, corr array<double>): correlations of many columns."""
        from .gram import pair_correlations

        low = self.stage_a.selectExpr(self.k, *[f"cmin_{i}" for i in range(len(self.corr_cols))])
        d = self.attach(self.series, low, "inner")
        x = [f"CAST({q(c)} AS DOUBLE) - coalesce(cmin_{i}, 0.0D) AS x_{i}" for i, c in enumerate(self.corr_cols)]
        return pair_correlations(d.selectExpr(self.k, *x), self.key, len(self.corr_cols))

    # ------------------------------------------------------------ duplicates
    @cached_property
    def duplicate_rows(self) -> DataFrame | None:
        """(key, duplicate_rows): exact count of rows equal to an earlier row
        of the same snapshot (null equals null); None when no snapshot has a
        repeated row hash (then every count is 0)."""
        if not self.cfg.row_duplicates:
            return None
        hashed = self.series.selectExpr(self.k, f"{self.row_hash_sql()} AS _h")
        cand = (hashed.groupBy(self.key, "_h").agg(E("count(1) AS c")).filter("c > 1").select(self.key, "_h")
                .persist(StorageLevel.MEMORY_AND_DISK))
        n = cand.count()
        self._persisted.append(cand)
        if n == 0:
            return None
        rows = self.series
        if n <= SMALL_CANDIDATES:
            rows = join_null_safe(rows.selectExpr("*", f"{self.row_hash_sql()} AS _h"), cand, [self.key, "_h"],
                                  "left_semi", F.broadcast)
        return (rows.groupBy(*[F.col(q(c)) for c in (self.key, *self.cols)]).agg(E("count(1) AS _c"))
                .filter("_c > 1").groupBy(self.key).agg(E("sum(_c - 1) AS duplicate_rows")))

    # ------------------------------------------------------------ time gaps
    @cached_property
    def time_gaps(self) -> DataFrame:
        """(key, gap_n, max_gap, large_gaps): whole-day gaps between
        consecutive valid dates, computed from per-day min/max. Every key of
        the series has a row; rows without a valid date count nothing."""
        k, cfg = self.k, self.cfg
        days = (self.series.selectExpr(k, f"{self.ts(cfg.date_column)} AS t")
                .groupBy(self.key, E("to_date(t) AS day"))
                .agg(E("min(t) AS tmin"), E("max(t) AS tmax"), E("count(t) AS c")))
        gaps = days.selectExpr(
            k, "c", f"floor(timestampdiff(MICROSECOND, lag(tmax) OVER (PARTITION BY {k} ORDER BY day), tmin)"
                    f" / 86400000000) AS gap")
        return gaps.groupBy(self.key).agg(E("sum(c) AS gap_n"), E("max(gap) AS max_gap"),
                                          E(f"count_if(gap > {int(cfg.max_gap_days)}) AS large_gaps"))

    # ------------------------------------------------------------ facts
    @cached_property
    def active(self) -> frozenset:
        """The parts this configuration has work for."""
        on = {"iqr": self.iqr_cols, "zscore": self.z_cols, "psi": self.psi_on, "ids": self.id_on,
              "values": self.ent_on, "dups": self.cfg.row_duplicates, "gaps": self.date_on, "gram": self.gram_on}
        return frozenset(p for p in PARTS if on[p])

    def facts_with(self, parts=PARTS) -> DataFrame:
        """One wide row per snapshot with the raw figures (unrounded) of stage A
        and of ``parts``, plus the predecessor's figures needed for drift. What
        has been built already is used again."""
        parts = frozenset(parts) & self.active
        for have in self._views:
            if parts <= have:
                return self._views[have]
        f, cfg = self.stage_a, self.cfg
        if "iqr" in parts and self.quantile_mode == "select":
            f = self.attach(f, self.quantiles)
        scan = parts & {"iqr", "zscore", "psi"}
        if scan:
            f = self.attach(f, self.counts(scan))
        if "ids" in parts:
            f = self.attach(f, self.ids)
        if "values" in parts:
            seen = self.values
            if self.stored is not None:
                seen = seen.unionByName(self.stored.figures.select(self.key, "ent_n", "ent_s"))
                f = f.drop("ent_n", "ent_s")
            f = self.attach(f, seen)
        if "gram" in parts:
            seen = self.gram
            if self.stored is not None:
                seen = seen.unionByName(self.stored.figures.select(self.key, "corr"))
                f = f.drop("corr")
            f = self.attach(f, seen)
        if "dups" in parts and self.duplicate_rows is not None:
            f = self.attach(f, self.duplicate_rows)
        if "gaps" in parts:
            f = self.attach(f, self.time_gaps)
        if "dups" in parts or not cfg.row_duplicates:
            found = "coalesce(duplicate_rows, 0)" if "duplicate_rows" in f.columns else "0"
            f = f.withColumn("duplicate_rows", E(f"CAST({found} AS LONG)"))
        derived = [f"coalesce(try_divide(cv_{p}, sx_{p} * sy_{p}), 0.0) AS corr_{p}"
                   for p in range(len(self.corr_pairs))]
        if "values" in parts:
            derived.append("CASE WHEN ent_n > 0 THEN log2(ent_n) - ent_s / ent_n END AS entropy")
        if derived:
            f = f.selectExpr("*", *derived)
        # predecessor figures over the per-snapshot rows, in key order
        lags = {"prev_n": "n"}
        if "values" in parts:
            lags["prev_entropy"] = "entropy"
        lags |= {f"pcorr_{p}": f"corr_{p}" for p in range(len(self.corr_pairs))}
        if "gram" in parts:
            lags["pcorr"] = "corr"
        if "psi" in parts:
            lags |= {f"pbn_{b}": f"bn_{b}" for b in range(1, cfg.psi_bins + 1)}
        f = with_neighbours(f, self.key, self.n_keys, lags, most=self.cfg.window_rows)
        if self.stored is not None:
            f = f.where("NOT _old")
        f = f.persist(StorageLevel.MEMORY_AND_DISK)
        self._persisted.append(f)
        self._views[parts] = f
        return f

    @property
    def facts(self) -> DataFrame:
        return self.facts_with(PARTS)

    def unpersist(self) -> None:
        for d in self._persisted:
            d.unpersist()
        self._persisted.clear()
        self._views.clear()

    # ------------------------------------------------------------ schema
    def dtype_names(self, schema: T.StructType | None = None) -> dict:
        sch = schema or self.schema
        return {f.name: dtype_name(f.dataType) for f in sch.fields}
