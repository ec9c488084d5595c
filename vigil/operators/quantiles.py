"""Exact quantiles of very large snapshots by rank selection.

Spark's exact ``percentile`` keeps a value -> count map per group, and one
task merges the whole map of a snapshot: fine for millions of distinct
values, not for a multi-TB snapshot of a continuous column. This module
computes the same exact, linearly interpolated quantiles with bounded
memory: every wanted order statistic (rank) is bracketed by a mergeable sketch
and then counted exactly; what the bracket misses, or would hold too much of,
is located by histogram refinement.

* The scan that finds counts and ranges also sketches each quantile a little
  below and above its place (``percentile_approx``, rank error n / ACCURACY).
* A second scan counts the values under a bracket and each value inside it
  (map-side combine), which says whether the rank lies inside and which value
  it is: two scans in all. The sketch only chooses what is counted, so a wrong
  bracket is found out.
* Else each target (snapshot, column, rank) starts with the interval
  [min, max], ``below = 0`` values under it and ``n_in`` values inside.
* A round joins the values to the active targets (a per-target table, which
  the planner broadcasts if it is small), buckets the values inside each target's
  interval into ``bins`` equal-width buckets and counts them (``groupBy``
  with map-side combine: at most ``bins`` rows per target leave a task).
  The bucket holding the rank becomes the new interval.
* A target is resolved when its interval holds one distinct value, or
  when it holds at most ``collect_max`` values: those are gathered for that
  target alone, sorted, and the rank is picked.

A round that leaves as many values inside as the one before raises: no target
is ever left without a value. The loop over rounds runs on the driver, the
data never does.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import join_null_safe
from ..functions.sql import E, q

TKEY = ["ci", "pi", "side"]
#: of the sketch; a bracket spans two rank errors on either side
ACCURACY = 10_000
#: values that a bracket may hold, as the sketch promises
BRACKET_MAX = 5_000_000


def select_quantiles(series: DataFrame, key: str, cols: list, probs=(0.25, 0.75), bins: int = 16384,
                     collect_max: int = 100_000) -> DataFrame:
    """``(key, q_<i> array<double>)`` for every column ``cols[i]``: the exact
    quantiles at ``probs`` (linear interpolation between neighbours, as
    Spark's ``percentile``) of the non-null values per snapshot."""
    k = q(key)
    tk = [key] + TKEY
    stack = ", ".join(f"{i}, CAST({q(c)} AS DOUBLE)" for i, c in enumerate(cols))
    data = (series.selectExpr(k, f"stack({len(cols)}, {stack}) AS (ci, x)")
            .filter("x IS NOT NULL AND NOT isnan(x)"))
    places = [max(0.0, p - 2 / ACCURACY) for p in probs] + [min(1.0, p + 2 / ACCURACY) for p in probs]
    sketch = f"percentile_approx(x, array({', '.join(f'{p!r}D' for p in places)}), {ACCURACY}) AS near"
    stats = _keep(data.groupBy(key, "ci").agg(E("count(1) AS n"), E("min(x) AS lo"), E("max(x) AS hi"), E(sketch)))
    # infinities have buckets of their own; halves keep the range of finite values finite
    big, inf = "1.7976931348623157E308D", "CAST('Infinity' AS DOUBLE)"
    lo, hi = f"greatest(lo, -{big}) / 2", f"least(hi, {big}) / 2"
    bucket = (f"CASE WHEN x = -{inf} THEN -1 WHEN x = {inf} THEN {bins} WHEN {hi} > {lo} THEN "
              f"least(CAST(floor((x / 2 - {lo}) / ({hi} - {lo}) * {bins}) AS INT), {bins - 1}) ELSE 0 END AS b")
    rows = []
    for pi, p in enumerate(probs):
        pos = f"(CAST(n - 1 AS DOUBLE) * {float(p)!r})"
        rows.append(f"named_struct('pi', {pi}, 'side', 0, 'rank', CAST(floor({pos}) AS LONG))")
        rows.append(f"named_struct('pi', {pi}, 'side', 1, 'rank', CAST(ceil({pos}) AS LONG))")
    targets = (stats.selectExpr(k, "ci", "n", "lo", "hi", f"inline(array({', '.join(rows)}))")
               .selectExpr(*tk, "rank", "lo", "hi", "CAST(0 AS LONG) AS below", "n AS n_in", "n",
                           "lo = hi AS done", "CASE WHEN lo = hi THEN lo END AS value"))
    found = _bracketed(data, stats, targets, key, len(probs))
    targets = _keep(join_null_safe(targets, found, tk, "left").selectExpr(
        *tk, "rank", "lo", "hi", "below", "n_in", "n", "done OR hit IS NOT NULL AS done", "coalesce(value, hit) AS value"))
    left = None
    while True:
        active = targets.filter("NOT done")
        n_active, inside = active.agg(E("count(1)"), E("sum(n_in)")).first()
        if n_active == 0:
            break
        if left is not None and inside >= left:
            raise RuntimeError(f"{n_active} quantile targets made no progress")
        left = inside
        j = join_null_safe(data, active, [key, "ci"]).filter("x >= lo AND x <= hi")
        # small intervals: gather that target's values and pick the rank
        picked = (j.filter(f"n_in <= {collect_max}").groupBy(*tk)
                  .agg(E("element_at(array_sort(collect_list(x)), CAST(max(rank) - max(below) + 1 AS INT)) AS pv")))
        # large intervals: one histogram round
        hist = (j.filter(f"n_in > {collect_max}")
                .selectExpr(*tk, "x", bucket)
                .groupBy(*tk, "b").agg(E("count(1) AS c"), E("min(x) AS bmin"), E("max(x) AS bmax")))
        hist = hist.withColumn("before", F.sum("c").over(Window.partitionBy(*tk).orderBy("b")) - F.col("c"))
        hit = (join_null_safe(hist, active.select(*tk, "rank", "below"), tk)
               .filter("rank - below >= before AND rank - below < before + c")
               .selectExpr(*tk, "bmin AS lo2", "bmax AS hi2", "below + before AS below2", "c AS n2"))
        nxt = (join_null_safe(join_null_safe(active, hit, tk, "left"), picked, tk, "left")
               .selectExpr(*tk, "rank", "coalesce(lo2, lo) AS lo", "coalesce(hi2, hi) AS hi",
                           "coalesce(below2, below) AS below", "coalesce(n2, n_in) AS n_in", "n",
                           "pv IS NOT NULL OR coalesce(lo2 = hi2, false) AS done",
                           "coalesce(pv, CASE WHEN lo2 = hi2 THEN lo2 END) AS value"))
        targets = _keep(targets.filter("done").unionByName(nxt))
    pos = "CASE " + " ".join(f"WHEN pi = {pi} THEN CAST(n - 1 AS DOUBLE) * {float(p)!r}"
                             for pi, p in enumerate(probs)) + " END"
    vals = (targets.groupBy(key, "ci", "pi")
            .agg(E("max(CASE WHEN side = 0 THEN value END) AS v0"), E("max(CASE WHEN side = 1 THEN value END) AS v1"),
                 E("max(n) AS n"))
            .selectExpr(k, "ci", "pi", f"{pos} AS pos", "v0", "v1")
            .selectExpr(k, "ci", "pi", "CASE WHEN floor(pos) = ceil(pos) THEN v0 "
                                       "ELSE (ceil(pos) - pos) * v0 + (pos - floor(pos)) * v1 END AS qv"))
    agg = [E("array(" + ", ".join(f"max(CASE WHEN ci = {i} AND pi = {pi} THEN qv END)" for pi in range(len(probs)))
             + f") AS q_{i}") for i in range(len(cols))]
    return vals.groupBy(key).agg(*agg).persist(StorageLevel.MEMORY_AND_DISK)


def _bracketed(data: DataFrame, stats: DataFrame, targets: DataFrame, key: str, n_probs: int) -> DataFrame:
    """(target key, hit): values of the targets whose rank lies inside its
    bracket."""
    group = [key, "ci", "pi"]
    few = f"n <= {2 * ACCURACY}"  # all values of a small snapshot: there a rank error is less than a rank
    ends = ", ".join(f"named_struct('pi', {i}, 'from', CASE WHEN {few} THEN lo ELSE near[{i}] END, "
                     f"'to', CASE WHEN {few} THEN hi ELSE near[{n_probs + i}] END)" for i in range(n_probs))
    brackets = stats.filter(f"lo < hi AND n <= {BRACKET_MAX * ACCURACY // 6}L").selectExpr(
        q(key), "ci", f"inline(array({ends}))")
    seen = (join_null_safe(data, brackets, [key, "ci"]).filter("x <= `to`")
            .selectExpr(q(key), "ci", "pi", "CASE WHEN x >= `from` THEN x END AS v")  # null: under the bracket
            .groupBy(*group, "v").agg(E("count(1) AS c")))
    upto = F.sum("c").over(Window.partitionBy(*group).orderBy(F.col("v").asc_nulls_first()))
    ranked = seen.withColumn("upto", upto).filter("v IS NOT NULL")
    return (join_null_safe(targets.select(key, *TKEY, "rank"), ranked, group)
            .filter("rank >= upto - c AND rank < upto").selectExpr(q(key), *TKEY, "v AS hit"))


def _keep(df: DataFrame) -> DataFrame:
    """Materialise the (small) target table of a round with a reliable
    checkpoint: it cuts the lineage, so the plan of the next round does not
    grow with the number of rounds."""
    from ..session import cut_lineage

    return cut_lineage(df)
