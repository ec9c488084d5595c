"""The 21 checks, read off the fused :class:`~vigil.operators.profile.Profile`.

Each check has
* a flat typed frame (one row per snapshot, or per snapshot and column),
  holding unrounded figures, and
* a ``passed`` flag and a ``details`` struct used by the result envelope
  ``(key, check_index, check, passed, details JSON)``; details round like the
  original (half to even, ``bround``).

Nothing here scans data: every frame is a projection of the per-snapshot
facts table (one row per snapshot). Expressions are Spark SQL text.
"""

from __future__ import annotations

from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..config import CHECK_ORDER
from ..functions.sql import add, arr, greatest, num, q, s
from .profile import Profile


def _lit(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return num(v)
    return s(str(v))


def struct(**fields) -> str:
    """named_struct SQL from keyword -> SQL text."""
    if not fields:
        return "named_struct('none', CAST(NULL AS STRING))"
    return "named_struct(" + ", ".join(f"{s(k)}, {v}" for k, v in fields.items()) + ")"


def struct_l(pairs) -> str:
    """named_struct SQL from (name, SQL) pairs (names may hold spaces)."""
    pairs = list(pairs)
    if not pairs:
        return "named_struct('none', CAST(NULL AS STRING))"
    return "named_struct(" + ", ".join(f"{s(k)}, {v}" for k, v in pairs) + ")"


def arr_num(values) -> str:
    return f"array({', '.join(map(str, values))})"


EMPTY_ARR = "CAST(array() AS ARRAY<STRING>)"
# fixed values: message texts of the result details
NO_PREVIOUS = "No previous snapshot."
NO_PSI = "Insufficient data for PSI."
NO_CORRELATION = "Insufficient data."
# the passes over the data, besides stage A, that a check needs
NEEDS = {"duplicate_detection": ("ids", "dups"), "outlier_detection_iqr": ("iqr",),
         "outlier_detection_zscore": ("zscore",), "psi_distribution_drift": ("psi",),
         "correlation_drift": ("gram",), "entropy_change": ("values",), "time_gap_detection": ("gaps",), "uniqueness_constraints": ("ids",)}


class Checks:
    """Check results of one profile (all snapshots)."""

    def __init__(self, profile: Profile):
        self.p = profile
        self.cfg = profile.cfg
        self.key = profile.key
        self.k = q(profile.key)
        self._views: dict = {}

    # ---------------------------------------------------------------- facts
    def view(self, *checks: str) -> DataFrame:
        """Profile facts with the derived figures and pass flags of ``checks``
        (all checks by default), computed once. Only the passes over the data
        that these checks need are run; a wider view that exists is used."""
        names = frozenset(checks or CHECK_ORDER)
        for have, f in self._views.items():
            if names <= have:
                return f
        f = self.p.facts_with({part for n in names for part in NEEDS.get(n, ())})
        if "psi_distribution_drift" in names:
            f = self._with_psi(f)
        if "correlation_drift" in names:
            f = f.selectExpr("*", f"{self._corr_max_sql()} AS _corr_max")
            f = f.selectExpr("*", f"{self._corr_worst_sql()} AS _corr_worst")
        f = f.selectExpr("*", *[f"{v} AS `_pass_{n}`" for n, v in self._passed_sql().items() if n in names])
        f = f.persist(StorageLevel.MEMORY_AND_DISK)
        self.p._persisted.append(f)
        self._views[names] = f
        return f

    @property
    def facts(self) -> DataFrame:
        return self.view()

    def forget(self) -> None:
        self._views.clear()

    def _with_psi(self, f: DataFrame) -> DataFrame:
        if not self.p.psi_on:
            return f.selectExpr("*", "CAST(NULL AS DOUBLE) AS _psi")
        b = self.cfg.psi_bins
        f = f.selectExpr("*", f"CAST({add(f'bc_{i}' for i in range(1, b + 1))} AS DOUBLE) AS _ct",
                         f"CAST({add(f'pbn_{i}' for i in range(1, b + 1))} AS DOUBLE) AS _pt")
        sh = []
        for i in range(1, b + 1):
            sh += [f"bc_{i} / (_ct + 1e-9) AS _cs{i}", f"pbn_{i} / (_pt + 1e-9) AS _ps{i}"]
        f = f.selectExpr("*", *sh)
        f = f.selectExpr("*", *[f"CASE WHEN _{r}{i} = 0 THEN 0.0001 ELSE _{r}{i} END AS _{r}z{i}"
                                for i in range(1, b + 1) for r in ("cs", "ps")])
        psi = add(f"(_csz{i} - _psz{i}) * ln(_csz{i} / _psz{i})" for i in range(1, b + 1))
        return f.selectExpr("*", f"CASE WHEN has_prev AND bc_1 IS NOT NULL AND pbn_1 IS NOT NULL "
                                 f"AND (_ct > 0 OR _pt > 0) THEN {psi} END AS _psi")

    @cached_property
    def passed(self) -> dict:
        """check name -> SQL reading its boolean column in a view."""
        return {n: f"`_pass_{n}`" for n in CHECK_ORDER}

    def _explode(self, rows: list, *checks: str) -> DataFrame | None:
        if not rows:
            return None
        return self.view(*checks).selectExpr(self.k, f"inline(array({', '.join(rows)}))")

    # ---------------------------------------------------------------- figures
    @staticmethod
    def _pct(i) -> str:
        return f"try_divide(CAST(nul_{i} AS DOUBLE), n) * 100"

    def _total_nulls(self) -> str:
        return add((f"nul_{i}" for i in range(len(self.p.cols))), "CAST(0 AS LONG)")

    def _overall_null_pct(self) -> str:
        k = len(self.p.cols)
        if k == 0:
            return "CAST(NULL AS DOUBLE)"
        return f"({add(f'try_divide(CAST(nul_{i} AS DOUBLE), n)' for i in range(k))} / {k} * 100)"

    def _dup_ids(self) -> str:
        if not self.p.id_on:
            return "CAST(0 AS LONG)"
        return "CAST(n - id_distinct - CASE WHEN id_has_null THEN 1 ELSE 0 END AS LONG)"

    def _iqr_total(self) -> str:
        return add((f"coalesce(iqo_{i}, 0)" for i in range(len(self.p.iqr_cols))), "CAST(0 AS LONG)")

    def _z_total(self) -> str:
        return add((f"coalesce(zo_{i}, 0)" for i in range(len(self.p.z_cols))), "CAST(0 AS LONG)")

    @staticmethod
    def _zmax(i) -> str:
        return f"try_divide(greatest(zmax_{i} - zm_{i}, zm_{i} - zmin_{i}), zs_{i})"

    def _age_days(self) -> str:
        return (f"CAST(floor(timestampdiff(MICROSECOND, fmax, CAST(DATE'{self.p.as_of.isoformat()}' AS TIMESTAMP_NTZ))"
                f" / 86400000000) AS LONG)")

    @staticmethod
    def _change_pct() -> str:
        return "(abs(n - prev_n) / CAST(greatest(prev_n, 1) AS DOUBLE) * 100)"

    def _missing_flagged(self) -> str:
        m = self.cfg.missing_max_pct
        return add((f"CASE WHEN bround({self._pct(i)}, 2) > {num(m)} THEN 1 ELSE 0 END"
                    for i in range(len(self.p.cols))), "0")

    def _corr_diffs(self):
        """Row-major list of (i, j, |diff| SQL) over the full matrix."""
        k = len(self.p.corr_cols)
        idx = {pair: p for p, pair in enumerate(self.p.corr_pairs)}
        out = []
        for i in range(k):
            for j in range(k):
                p = idx[(min(i, j), max(i, j))]
                out.append((i, j, f"abs(corr_{p} - coalesce(pcorr_{p}, 0.0))"))
        return out

    def _corr_steps(self) -> str:
        """|difference| of every pair of many columns, as an array by rows."""
        k = len(self.p.corr_cols)
        none = f"array_repeat(0.0D, {k * (k + 1) // 2})"
        return f"zip_with(coalesce(corr, {none}), coalesce(pcorr, {none}), (a, b) -> abs(a - coalesce(b, 0.0D)))"

    def _corr_max_sql(self) -> str:
        if len(self.p.corr_cols) < 2:
            return "CAST(NULL AS DOUBLE)"
        if self.p.gram_on:
            return f"CASE WHEN has_prev THEN array_max({self._corr_steps()}) END"
        return f"CASE WHEN has_prev THEN {greatest(d for _, _, d in self._corr_diffs())} END"

    def _corr_worst_sql(self) -> str:
        if len(self.p.corr_cols) < 2:
            return "CAST(NULL AS STRING)"
        names = self.p.corr_cols
        if self.p.gram_on:  # the first pair by rows, as below; its name follows from its place
            at, k = f"array_position({self._corr_steps()}, _corr_max) - 1", len(names)
            starts = arr_num([i * k - i * (i - 1) // 2 for i in range(k)])
            row = f"size(filter({starts}, x -> x <= {at}))"
            label = arr([repr(n) for n in names])
            return (f"CASE WHEN has_prev THEN concat('(', {label}[{row} - 1], ', ', "
                    f"{label}[CAST({at} - {starts}[{row} - 1] + {row} - 1 AS INT)], ')') END")
        whens = " ".join(f"WHEN {d} = _corr_max THEN {s(f'({names[i]!r}, {names[j]!r})')}"
                         for i, j, d in self._corr_diffs())
        return f"CASE WHEN has_prev THEN CASE {whens} END END"

    def _skew_flagged(self) -> str:
        t = self.cfg.skew_threshold
        return add((f"CASE WHEN abs(sk_{i}) > {num(t)} THEN 1 ELSE 0 END" for i in range(len(self.p.skew_cols))), "0")

    def _max_signed_skew(self) -> str:
        if not self.p.skew_cols:
            return "CAST(NULL AS DOUBLE)"
        return greatest(f"bround(sk_{i}, 4)" for i in range(len(self.p.skew_cols)))

    def _max_abs_skew(self) -> str:
        if not self.p.skew_cols:
            return "CAST(NULL AS DOUBLE)"
        return greatest(f"abs(bround(sk_{i}, 4))" for i in range(len(self.p.skew_cols)))

    def _entropy_delta(self) -> str:
        if not self.p.ent_on:
            return "CAST(NULL AS DOUBLE)"
        ok = "true" if self.p.prev_has(self.cfg.entropy_column) else "false"
        return f"CASE WHEN has_prev AND {ok} THEN abs(entropy - prev_entropy) END"

    @staticmethod
    def _max_gap() -> str:
        return "CASE WHEN coalesce(gap_n, 0) >= 2 THEN greatest(coalesce(max_gap, 0), 0) ELSE 0 END"

    @staticmethod
    def _drift_level(psi_r: str) -> str:
        return (f"CASE WHEN {psi_r} < 0.1 THEN 'none' WHEN {psi_r} < 0.2 THEN 'slight' "
                f"WHEN {psi_r} IS NOT NULL THEN 'significant' END")

    # ---------------------------------------------------------------- schema (metadata)
    @cached_property
    def type_mismatches(self) -> list:
        actual = self.p.dtype_names()
        return [(c, list(exp), actual[c]) for c, exp in self.cfg.expected_dtypes.items()
                if c in actual and actual[c] not in exp]

    @cached_property
    def missing_columns(self) -> list:
        return [c for c in self.cfg.expected_columns if c not in self.p.cols]

    @cached_property
    def extra_columns(self) -> list:
        return [c for c in self.p.cols
                if c not in self.cfg.expected_columns and c not in self.cfg.ignored_extra_columns]

    @cached_property
    def schema_change(self):
        """(added, removed, {col: (prev, curr)}) vs the previous side; series
        snapshots share one schema, so only pair mode can change."""
        if self.p.prev_schema is None:
            return [], [], {}
        cur = self.p.dtype_names()
        prev = self.p.dtype_names(self.p.prev_schema)
        added = sorted(set(cur) - set(prev))
        removed = sorted(set(prev) - set(cur))
        changes = {c: (prev[c], cur[c]) for c in sorted(set(cur) & set(prev)) if cur[c] != prev[c]}
        return added, removed, changes

    @cached_property
    def schema_sql(self) -> dict:
        """SQL of the schema figures: per snapshot where the series has
        ``schemas``, else constants of the one schema."""
        cfg = self.cfg
        if self.p.schemas is None:
            mism = [struct(column=s(c), expected=arr(e), actual=s(x)) for c, e, x in self.type_mismatches]
            added, removed, changes = self.schema_change
            tc = [struct(column=s(c), prev_dtype=s(x), curr_dtype=s(y)) for c, (x, y) in changes.items()]
            return dict(mismatches=f"array({', '.join(mism)})" if mism else EMPTY_ARR, missing=arr(self.missing_columns),
                        extra=arr(self.extra_columns), added=arr(added), removed=arr(removed),
                        changes=f"array({', '.join(tc)})" if tc else EMPTY_ARR)
        cur, prev = "map_keys(dtypes)", "map_keys(prev_dtypes)"
        mism = [struct(column=s(c), expected=arr(list(e)), actual=f"dtypes[{s(c)}]")
                for c, e in cfg.expected_dtypes.items()]
        known = arr([*cfg.expected_columns, *cfg.ignored_extra_columns])
        return dict(
            mismatches=(f"filter(array({', '.join(mism)}), x -> coalesce(NOT array_contains(x.expected, x.actual), "
                        f"false))" if mism else EMPTY_ARR),
            missing=f"array_except({arr(list(cfg.expected_columns))}, {cur})",
            extra=f"array_sort(array_except({cur}, {known}))",
            added=f"array_sort(array_except({cur}, {prev}))", removed=f"array_sort(array_except({prev}, {cur}))",
            changes=(f"transform(array_sort(filter({cur}, c -> coalesce(dtypes[c] <> prev_dtypes[c], false))), c -> "
                     f"named_struct('column', c, 'prev_dtype', prev_dtypes[c], 'curr_dtype', dtypes[c]))"))

    # ---------------------------------------------------------------- pass flags
    def _passed_sql(self) -> dict:
        p, cfg = self.p, self.cfg
        out = {}
        out["null_value_detection"] = f"{self._total_nulls()} = 0"
        out["duplicate_detection"] = f"(duplicate_rows = 0 AND {self._dup_ids()} = 0)"
        out["data_type_validation"] = f"size({self.schema_sql['mismatches']}) = 0"
        out["column_existence"] = f"size({self.schema_sql['missing']}) = 0"
        rv = add(f"CASE WHEN rv_{i} > 0 THEN 1 ELSE 0 END" for i in range(len(p.range_cols)))
        out["range_validation"] = f"{rv} = 0"
        out["regex_pattern_validation"] = f"{add(f'pb_{i}' for i in range(len(p.pattern_cols)))} = 0"
        out["outlier_detection_iqr"] = f"{self._iqr_total()} = 0"
        out["outlier_detection_zscore"] = f"{self._z_total()} = 0"
        same = " AND ".join(f"size({self.schema_sql[n]}) = 0" for n in ("added", "removed", "changes"))
        out["schema_change_detection"] = f"(NOT has_prev OR ({same}))"
        out["data_freshness"] = (f"coalesce({self._age_days()} <= {int(cfg.freshness_max_days)}, false)"
                                 if p.date_on else "false")
        out["volume_anomaly"] = f"(NOT has_prev OR {self._change_pct()} <= {num(cfg.volume_threshold_pct)})"
        out["missing_value_percentage"] = f"{self._missing_flagged()} = 0"
        out["psi_distribution_drift"] = "coalesce(bround(_psi, 4) < 0.2, true)"
        out["correlation_drift"] = f"coalesce(_corr_max <= {num(cfg.corr_threshold)}, true)"
        out["data_skew_detection"] = f"{self._skew_flagged()} = 0"
        d = self._entropy_delta()
        out["entropy_change"] = (f"CASE WHEN {d} IS NULL THEN true ELSE {d} < {num(cfg.entropy_threshold)} END"
                                 if p.ent_on else "true")
        out["time_gap_detection"] = "coalesce(large_gaps, 0) = 0" if p.date_on else "true"
        out["business_rule_validation"] = f"{add(f'CASE WHEN {c} > 0 THEN 1 ELSE 0 END' for c in p.rule_cols)} = 0"
        out["uniqueness_constraints"] = "n - id_distinct = 0" if p.id_on else "true"
        out["referential_consistency"] = "(rf_blank = 0 AND rf_missing = 0)" if p.ref_on else "true"
        out["sales_calculation_check"] = "ac_bad = 0" if p.amount_on else "true"
        return out

    # ---------------------------------------------------------------- flat frames
    def null_values_by_column(self) -> DataFrame:
        return self._explode([struct(column_name=s(c), null_count=f"nul_{i}", null_pct=self._pct(i))
                              for i, c in enumerate(self.p.cols)], "null_value_detection")

    def null_values(self) -> DataFrame:
        return self.view("null_value_detection").selectExpr(self.k, f"{self._total_nulls()} AS total_nulls",
                                     f"{self._overall_null_pct()} AS overall_null_pct",
                                     f"{self.passed['null_value_detection']} AS passed")

    def duplicates(self) -> DataFrame:
        return self.view("duplicate_detection").selectExpr(self.k, "duplicate_rows", f"{self._dup_ids()} AS duplicate_ids",
                                     f"{self.passed['duplicate_detection']} AS passed")

    def uniqueness(self) -> DataFrame:
        if not self.p.id_on:
            return self.view("uniqueness_constraints").selectExpr(self.k, "CAST(NULL AS LONG) AS total_rows",
                                         "CAST(NULL AS LONG) AS unique_values",
                                         "CAST(NULL AS LONG) AS duplicates", "true AS passed")
        return self.view("uniqueness_constraints").selectExpr(self.k, "n AS total_rows", "id_distinct AS unique_values",
                                     "n - id_distinct AS duplicates",
                                     f"{self.passed['uniqueness_constraints']} AS passed")

    def unique_keys(self) -> DataFrame | None:
        """(key, columns, total_rows, unique_values, duplicates, passed) per
        key of ``unique_keys``; rows without all of a key's columns do not
        count for it."""
        keys = self.cfg.unique_keys
        if not keys:
            return None
        names = arr(", ".join(cols) for cols in keys)
        return self.p.unique_counts().selectExpr(
            self.k, f"element_at({names}, key_no + 1) AS columns", "total AS total_rows", "`unique` AS unique_values",
            "total - `unique` AS duplicates", "total = `unique` AS passed")

    def value_types(self) -> DataFrame | None:
        """(key, column_name, data_type, value_count, failing): values of text
        columns that do not parse as a type that the column may have."""
        at = {c: i for i, c in enumerate(self.p.cols)}
        return self._explode([struct(column_name=s(c), data_type=s(kind), value_count=f"n - nul_{at[c]}", failing=f"vt_{i}")
                              for i, (c, kind, _) in enumerate(self.p.value_type_cols)], "data_type_validation")

    def date_parsing(self) -> DataFrame | None:
        """(key, column_name, date_format, value_count, unparsed): what the
        date checks could not read."""
        if not self.p.date_on:
            return None
        c = self.cfg.date_column
        return self.view("data_freshness").selectExpr(
            self.k, f"{s(c)} AS column_name", f"{s(self.p.date_format or 'ISO')} AS date_format",
            f"n - nul_{self.p.cols.index(c)} AS value_count", "fbad AS unparsed")

    def data_types(self) -> DataFrame:
        f, m = self.view("data_type_validation"), self.schema_sql["mismatches"]
        if m == EMPTY_ARR:
            m = "CAST(array() AS ARRAY<STRUCT<column: STRING, expected: ARRAY<STRING>, actual: STRING>>)"
        return f.selectExpr(self.k, f"inline({m}) AS (column_name, expected, actual)")

    def column_existence(self) -> DataFrame:
        x = self.schema_sql
        return self.view("column_existence").selectExpr(self.k, f"{x['missing']} AS missing_columns",
                                                        f"{x['extra']} AS extra_columns",
                                                        f"{self.passed['column_existence']} AS passed")

    def schema_changes(self) -> DataFrame:
        x = self.schema_sql
        tc = (x["changes"] if x["changes"] == EMPTY_ARR else
              f"transform({x['changes']}, t -> concat(t.column, ':', t.prev_dtype, '->', t.curr_dtype))")
        return self.view("schema_change_detection").selectExpr(
            self.k, f"CASE WHEN has_prev THEN {x['added']} END AS columns_added",
            f"CASE WHEN has_prev THEN {x['removed']} END AS columns_removed",
            f"CASE WHEN has_prev THEN {tc} END AS type_changes",
            f"{self.passed['schema_change_detection']} AS passed")

    def range_violations(self) -> DataFrame | None:
        return self._explode([struct(column_name=s(c), range_lo=num(lo), range_hi=num(hi),
                                     violation_count=f"rv_{i}", min_found=f"rmin_{i}", max_found=f"rmax_{i}")
                              for i, (c, lo, hi) in enumerate(self.p.range_cols)], "range_validation")

    def pattern_violations(self) -> DataFrame | None:
        return self._explode([struct(column_name=s(c), pattern=s(pt), invalid_count=f"pb_{i}")
                              for i, (c, pt) in enumerate(self.p.pattern_cols)], "regex_pattern_validation")

    @staticmethod
    def _iqr_fields(i):
        q1, q3 = f"q_{i}[0]", f"q_{i}[1]"
        lo, hi = f"({q1} - 1.5 * ({q3} - {q1}))", f"({q3} + 1.5 * ({q3} - {q1}))"
        cnt = f"CAST(coalesce(iqo_{i}, 0) AS LONG)"
        pct = f"try_divide(CAST({cnt} AS DOUBLE), inn_{i}) * 100"
        return q1, q3, lo, hi, cnt, pct

    def iqr_outliers(self) -> DataFrame | None:
        rows = []
        for i, c in enumerate(self.p.iqr_cols):
            q1, q3, lo, hi, cnt, pct = self._iqr_fields(i)
            rows.append(struct(column_name=s(c), q1=q1, q3=q3, lower_bound=lo, upper_bound=hi,
                               outlier_count=cnt, outlier_pct=pct))
        return self._explode(rows, "outlier_detection_iqr")

    def zscore_outliers(self) -> DataFrame | None:
        return self._explode([struct(column_name=s(c), outlier_count=f"CAST(coalesce(zo_{i}, 0) AS LONG)",
                                     max_zscore=self._zmax(i)) for i, c in enumerate(self.p.z_cols)],
                             "outlier_detection_zscore")

    def freshness(self) -> DataFrame:
        if not self.p.date_on:
            return self.view("data_freshness").selectExpr(self.k, "CAST(NULL AS DATE) AS latest_date",
                                         "CAST(NULL AS LONG) AS age_days", "false AS passed")
        return self.view("data_freshness").selectExpr(self.k, "to_date(fmax) AS latest_date", f"{self._age_days()} AS age_days",
                                     f"{self.passed['data_freshness']} AS passed")

    def volume(self) -> DataFrame:
        return self.view("volume_anomaly").selectExpr(self.k, "prev_n AS previous_rows", "n AS current_rows",
                                     f"{self._change_pct()} AS change_pct",
                                     f"{self.passed['volume_anomaly']} AS passed")

    def missing_pct(self) -> DataFrame:
        m = self.cfg.missing_max_pct
        return self._explode([struct(column_name=s(c), missing_pct=self._pct(i),
                                     exceeds_threshold=f"bround({self._pct(i)}, 2) > {num(m)}")
                              for i, c in enumerate(self.p.cols)], "missing_value_percentage")

    def psi(self) -> DataFrame:
        return self.view("psi_distribution_drift").selectExpr(self.k, "_psi AS psi_score",
                                     f"{self._drift_level('bround(_psi, 4)')} AS drift_level",
                                     f"{self.passed['psi_distribution_drift']} AS passed")

    def correlation(self) -> DataFrame:
        return self.view("correlation_drift").selectExpr(self.k, "_corr_max AS max_correlation_drift", "_corr_worst AS worst_pair",
                                     f"{self.passed['correlation_drift']} AS passed")

    def skew(self) -> DataFrame | None:
        t = self.cfg.skew_threshold
        return self._explode([struct(column_name=s(c), skewness=f"sk_{i}",
                                     highly_skewed=f"coalesce(abs(sk_{i}) > {num(t)}, false)")
                              for i, c in enumerate(self.p.skew_cols)], "data_skew_detection")

    def entropy(self) -> DataFrame | None:
        if not self.p.ent_on:
            return None
        return self.view("entropy_change").selectExpr(self.k, "prev_entropy AS previous_entropy", "entropy AS current_entropy",
                                     f"{self._entropy_delta()} AS entropy_delta",
                                     f"{self.passed['entropy_change']} AS passed")

    def time_gaps(self) -> DataFrame | None:
        if not self.p.date_on:
            return None
        if self.p.keys is None and not self._views:  # needs neither stage A nor a predecessor
            f, passed = self.p.time_gaps, self._passed_sql()["time_gap_detection"]
        else:
            f, passed = self.view("time_gap_detection"), self.passed["time_gap_detection"]
        return f.selectExpr(self.k, f"CAST({self._max_gap()} AS LONG) AS max_gap_days_found",
                            "CAST(coalesce(large_gaps, 0) AS LONG) AS large_gap_count", f"{passed} AS passed")

    def business_rules(self) -> DataFrame | None:
        return self._explode([struct(rule=s(name), violation_count=f"CAST({c} AS LONG)")
                              for c, name in self.p.rule_cols.items()], "business_rule_validation")

    def invalid_values(self) -> DataFrame | None:
        """Distinct invalid values per set rule and snapshot (null kept as a
        value), distributed - never collected."""
        if not self.p.set_rules:
            return None
        rows = []
        for r in self.p.set_rules:
            vals = ", ".join(s(str(v)) for v in r.values)
            rows.append(f"CASE WHEN coalesce(NOT ({q(r.column)} IN ({vals})), true) THEN "
                        f"named_struct('rule', {s(r.name)}, 'value', CAST({q(r.column)} AS STRING)) END")
        return (self.p.series.selectExpr(self.k, f"inline(filter(array({', '.join(rows)}), x -> x IS NOT NULL))")
                .distinct())

    def referential(self) -> DataFrame | None:
        if not self.p.ref_on:
            return None
        return self.view("referential_consistency").selectExpr(self.k, "rf_blank AS empty_child", "rf_missing AS parent_without_child",
                                     f"{self.passed['referential_consistency']} AS passed")

    def amount_calc(self) -> DataFrame | None:
        if not self.p.amount_on:
            return None
        return self.view("sales_calculation_check").selectExpr(self.k, "ac_bad AS rows_with_bad_calculation", "ac_max AS max_diff_pct",
                                     f"{self.passed['sales_calculation_check']} AS passed")

    # ---------------------------------------------------------------- envelope
    def details(self) -> dict:
        """Envelope details per check as JSON-text SQL (reference rounding)."""
        p, cfg = self.p, self.cfg
        cols = p.cols
        d = {}
        pcts = [f"bround({self._pct(i)}, 2)" for i in range(len(cols))]
        nul = ", ".join(f"nul_{i}" for i in range(len(cols)))
        d["null_value_detection"] = struct(
            null_counts=f"map_from_arrays({arr(cols)}, array({nul}))",
            null_percentages=f"map_from_arrays({arr(cols)}, array({', '.join(pcts)}))",
            total_nulls=self._total_nulls(), overall_null_pct=f"bround({self._overall_null_pct()}, 2)")
        d["duplicate_detection"] = struct(duplicate_rows="duplicate_rows", duplicate_order_ids=self._dup_ids())
        x = self.schema_sql
        d["data_type_validation"] = struct(mismatches=x["mismatches"], checked_columns=arr(list(cfg.expected_dtypes)))
        d["column_existence"] = struct(missing_columns=x["missing"], extra_columns=x["extra"])
        viol = [struct(column=s(c), expected_range=f"array({num(lo)}, {num(hi)})", violation_count=f"rv_{i}",
                       min_found=f"rmin_{i}", max_found=f"rmax_{i}") for i, (c, lo, hi) in enumerate(p.range_cols)]
        d["range_validation"] = struct(
            violations=f"filter(array({', '.join(viol)}), v -> v.violation_count > 0)" if viol else EMPTY_ARR)
        d["regex_pattern_validation"] = struct_l(
            (c, struct(pattern=s(pt), invalid_count=f"pb_{i}")) for i, (c, pt) in enumerate(p.pattern_cols))
        iq = []
        for i, c in enumerate(p.iqr_cols):
            _q1, _q3, lo, hi, cnt, pct = self._iqr_fields(i)
            iq.append((c, struct(lower_bound=f"bround({lo}, 2)", upper_bound=f"bround({hi}, 2)",
                                 outlier_count=cnt, outlier_pct=f"bround({pct}, 2)")))
        d["outlier_detection_iqr"] = struct_l(iq)
        d["outlier_detection_zscore"] = struct_l(
            (c, struct(threshold=num(cfg.zscore_threshold), outlier_count=f"coalesce(zo_{i}, 0)",
                       max_zscore=f"CASE WHEN znn_{i} > 0 THEN bround({self._zmax(i)}, 2) END"))
            for i, c in enumerate(p.z_cols))
        changed = struct(columns_added=x["added"], columns_removed=x["removed"], type_changes=x["changes"])
        d["schema_change_detection"] = (
            "CASE WHEN NOT has_prev THEN to_json(named_struct('message', 'No previous snapshot available.')) "
            f"ELSE to_json({changed}) END")
        if p.date_on:
            d["data_freshness"] = struct(latest_order_date="date_format(to_date(fmax), 'yyyy-MM-dd')",
                                         age_days=self._age_days(),
                                         max_allowed_days=str(int(cfg.freshness_max_days)))
        else:
            d["data_freshness"] = struct(error=s(f"{cfg.date_column} column missing"))
        d["volume_anomaly"] = self._either(
            "has_prev", struct(previous_rows="prev_n", current_rows="n", change_pct=f"bround({self._change_pct()}, 2)",
                               threshold_pct=num(cfg.volume_threshold_pct)),
            struct(current_rows="n", message=s(NO_PREVIOUS)))
        over = ", ".join(f"CASE WHEN {pc} > {num(cfg.missing_max_pct)} THEN {s(c)} END" for pc, c in zip(pcts, cols))
        d["missing_value_percentage"] = struct(
            per_column=struct_l((c, struct(missing_pct=pc, exceeds_threshold=f"coalesce({pc} > "
                                           f"{num(cfg.missing_max_pct)}, false)")) for c, pc in zip(cols, pcts)),
            columns_exceeding_threshold=f"filter(array({over}), x -> x IS NOT NULL)" if cols else EMPTY_ARR)
        d["psi_distribution_drift"] = self._either(
            "_psi IS NOT NULL", struct(column=_lit(cfg.psi_column or ""), psi_score="bround(_psi, 4)",
                                       drift_level=self._drift_level("bround(_psi, 4)")),
            struct(message=s(NO_PSI)))
        d["correlation_drift"] = self._either(
            "_corr_max IS NOT NULL", struct(max_correlation_drift="bround(_corr_max, 4)", worst_pair="_corr_worst",
                                            threshold=num(cfg.corr_threshold)),
            struct(message=s(NO_CORRELATION)))
        t = cfg.skew_threshold
        hs = ", ".join(f"CASE WHEN abs(sk_{i}) > {num(t)} THEN {s(c)} END" for i, c in enumerate(p.skew_cols))
        d["data_skew_detection"] = struct(
            per_column=struct_l((c, struct(skewness=f"bround(sk_{i}, 4)",
                                           highly_skewed=f"coalesce(abs(sk_{i}) > {num(t)}, false)"))
                                for i, c in enumerate(p.skew_cols)),
            highly_skewed_columns=f"filter(array({hs}), x -> x IS NOT NULL)" if p.skew_cols else EMPTY_ARR)
        if p.ent_on:
            d["entropy_change"] = self._either(
                f"{self._entropy_delta()} IS NOT NULL",
                struct(column=s(cfg.entropy_column), previous_entropy="bround(prev_entropy, 4)",
                       current_entropy="bround(entropy, 4)", entropy_delta=f"bround({self._entropy_delta()}, 4)"),
                struct(current_entropy="bround(entropy, 4)", message=s(NO_PREVIOUS)))
        else:
            d["entropy_change"] = struct(message=s(f"Column '{cfg.entropy_column}' not found."))
        if p.date_on:
            d["time_gap_detection"] = struct(max_gap_days_found=self._max_gap(),
                                             large_gap_count="coalesce(large_gaps, 0)",
                                             max_allowed_gap=str(int(cfg.max_gap_days)))
        else:
            d["time_gap_detection"] = struct(message=s(f"Column '{cfg.date_column}' not found."))
        # violated rules and their rows; the distinct bad values are rows of invalid_values(), however many
        rules = ", ".join(f"{s(nm)}, CAST({c} AS LONG)" for c, nm in p.rule_cols.items())
        d["business_rule_validation"] = struct(
            violations=f"map_filter(map({rules}), (r, c) -> c > 0)" if rules else "map()", rules_checked="6")
        d["uniqueness_constraints"] = (struct_l([(cfg.id_column, struct(
            total_rows="n", unique_values="id_distinct", duplicates="n - id_distinct",
            passed="n - id_distinct = 0"))]) if p.id_on else struct())
        issues = [f"CASE WHEN rf_blank > 0 THEN concat(rf_blank, {s(f' rows with empty {cfg.child_column}')}) END",
                  f"CASE WHEN rf_missing > 0 THEN concat(rf_missing, "
                  f"{s(f' rows have {cfg.parent_column} but missing {cfg.child_column}')}) END"]
        d["referential_consistency"] = struct(
            issues=f"filter(array({', '.join(issues)}), x -> x IS NOT NULL)" if p.ref_on else EMPTY_ARR)
        d["sales_calculation_check"] = (struct(rows_with_bad_calculation="ac_bad",
                                               tolerance_pct=num(cfg.amount_tolerance_pct),
                                               sample_max_diff_pct="bround(ac_max, 2)") if p.amount_on
                                        else struct(message=s("Required columns missing.")))
        return {n: (v if v.startswith("CASE") else f"to_json({v})") for n, v in d.items()}

    @staticmethod
    def _either(cond: str, yes: str, no: str) -> str:
        return f"CASE WHEN {cond} THEN to_json({yes}) ELSE to_json({no}) END"

    def envelope(self) -> DataFrame:
        """M0 output: (key, check_index, check, passed, details) for all 21
        checks of every snapshot."""
        det = self.details()
        rows = [f"named_struct('check_index', {i + 1}, 'check', {s(name)}, "
                f"'passed', {self.passed[name]}, 'details', {det[name]})"
                for i, name in enumerate(CHECK_ORDER)]
        return self._explode(rows)
