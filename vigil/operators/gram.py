"""Correlations of many columns at once (C14 on wide tables).

Expressions for every pair grow with the square of the columns: 200 columns
would need 60 000 aggregates. Here each Arrow batch gives its sums for all
pairs as matrix products instead, and sums are merged by addition:

* values are taken relative to the column's minimum in the snapshot (one
  aggregate per column, found before), so that a constant column is zero in
  every batch and sums of far-off values keep their digits;
* with ``M`` the mask of non-null values and ``X`` the values (0 where null),
  ``M'M``, ``X'M``, ``(X*X)'M`` and ``X'X`` are the counts, sums, squares and
  products over the rows in which both columns of a pair are present;
* a task adds the matrices of a snapshot up and hands out one row per pair,
  early if it holds more than ``CELLS`` cells; ``groupBy(key, pair)`` adds the
  rows of all tasks. No group is gathered.

A pair that meets a NaN or an infinity has the correlation NaN, as Spark's own
aggregates give it; one without spread, or without rows, has 0. Spread below
``FLAT`` of the mean square is rounding, hence none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sql import E, q

# ship this module's task-side code by value, so executors need no install
try:
    import sys as _sys

    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: the package must be installed
    pass

#: matrix cells that a task holds before it hands out its sums (8 bytes each)
CELLS = 16_000_000
FLAT = 1e-13
SUMS = ("c", "sx", "sy", "sxx", "syy", "sxy", "odd")


def batch_sums(x: np.ndarray, present: np.ndarray) -> np.ndarray:
    """(5, k, k): counts, sums, squares, products over the rows in which both
    columns are present, and how many of them are not finite on the left."""
    finite = np.isfinite(x)
    m = present.astype(float)
    x = np.where(present & finite, x, 0.0)
    odd = (present & ~finite).astype(float)
    return np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x, odd.T @ m])


def pair_correlations(centred: DataFrame, key: str, k: int) -> DataFrame:
    """``(key, corr array<double>)`` of ``centred`` (key, x_0 .. x_<k-1>: doubles
    relative to the snapshot's minimum): the upper triangle by rows."""
    kind = centred.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("p", T.IntegerType()),
                           *[T.StructField(n, T.DoubleType()) for n in SUMS]])
    left, right = np.triu_indices(k)

    def hand_out(keys: list, sums: list, key_type) -> pa.RecordBatch:
        cols = [np.concatenate(c) for c in zip(*(
            (s[0][left, right], s[1][left, right], s[1][right, left], s[2][left, right], s[2][right, left],
             s[3][left, right], s[4][left, right] + s[4][right, left]) for s in sums))]
        number = np.arange(len(keys)).repeat(len(left))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, type=key_type).take(pa.array(number)),
             pa.array(np.tile(np.arange(len(left), dtype=np.int32), len(keys))), *map(pa.array, cols)],
            names=[key, "p", *SUMS])

    def add_up(batches):
        held: dict = {}
        key_type = None
        for b in batches:
            key_type = b.column(0).type
            seen = b.column(0).dictionary_encode(null_encoding="encode")
            place = seen.indices.to_numpy(zero_copy_only=False)
            x = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in b.columns[1:]])
            present = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in b.columns[1:]])
            for at, value in enumerate(seen.dictionary.to_pylist()):
                rows = place == at
                sums = batch_sums(x[rows], present[rows])
                held[value] = held[value] + sums if value in held else sums
                if len(held) * 5 * k * k > CELLS:
                    yield from (hand_out([v], [s], key_type) for v, s in held.items())
                    held = {}
        yield from (hand_out([v], [s], key_type) for v, s in held.items())

    added = centred.mapInArrow(add_up, schema).groupBy(key, "p").agg(*[F.sum(n).alias(n) for n in SUMS])
    var = lambda s, ss: f"CASE WHEN {ss} / c - pow({s} / c, 2) > {FLAT!r}D * {ss} / c THEN {ss} / c - pow({s} / c, 2) END"
    r = (f"CASE WHEN odd > 0 THEN CAST('NaN' AS DOUBLE) WHEN c > 0 THEN "
         f"coalesce((sxy / c - sx / c * sy / c) / (sqrt({var('sx', 'sxx')}) * sqrt({var('sy', 'syy')})), 0.0D) ELSE 0.0D END")
    return added.selectExpr(q(key), "p", f"{r} AS r").groupBy(key).agg(
        E("transform(array_sort(collect_list(named_struct('p', p, 'r', r))), s -> s.r) AS corr"))
