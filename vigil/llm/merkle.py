"""Merkle manifest of a table by slot pivots.

Leaves are hashes of a row's columns. Per group (``lang``) they are numbered
in key order without gathering a group: rows are dealt to key ranges, sorted
there, and numbered by place plus the rows of the group in earlier ranges.

A pivot then spreads the nodes below one ancestor into columns by conditional
aggregates, one column a slot: n0_0 .. n0_31 for five levels of pairs. The
columns of a run, concatenated and hashed, are its parent's column, and so on
up to the ancestor, all in one pass; a slot's siblings are the columns of its
run but its own. One shuffle thus climbs five levels of pairs, and tables
shrink by 32 a turn. A group that has one node left is done; the subroots are
leaves of one more tree, climbed alike.

Proofs go down the same tables: a pivot row meets what its ancestor has, and
gives every slot its siblings, then the ancestor's. What moves is a row for
each ancestor, not for each leaf and level.

Nothing is gathered: a run has at most 32 slots, a range or an ancestor's
slots one task, and the driver sees the root alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpoint

#: slots of one pivot at most: as many levels a turn as fit
SLOTS = 32
#: rows of the table of range offsets that are broadcast at most
OFFSETS = 100_000

STEPS = "array<struct<left:string,right:string>>"


def field(column: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    value = column.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def number(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``idx`` (from 0 by ``order`` in each ``group``) and
    ``m`` (rows of the group). Ties stand in any order; many of them are many
    ranges, as the place in the input is the last key."""
    placed = rows.withColumn("_at", F.monotonically_increasing_id())
    keys = [group, *order, "_at"]
    dealt = checkpoint(placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_at"))
    place = F.monotonically_increasing_id()  # range number and place in it
    dealt = dealt.withColumn("_place", place).withColumn("_range", F.shiftright("_place", 33))
    spans = dealt.groupBy("_range", F.col(group).alias("_group")).agg(
        F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = checkpoint(spans.select(
        F.col("_range").alias("_r"), "_group", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy("_group")).alias("m")))
    spans = F.broadcast(spans) if spans.count() <= OFFSETS else spans  # at most ranges + groups rows
    out = dealt.join(spans, (F.col("_range") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_group")))
    return out.withColumn("idx", F.col("_place") - F.col("_first") + F.col("_before")).drop(
        "_place", "_range", "_r", "_group", "_first", "_before")


def _levels(fanout: int) -> int:
    levels = 1
    while fanout ** (levels + 1) <= SLOTS:
        levels += 1
    return levels


def _climb(nodes: DataFrame, fanout: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """The pivot of ``nodes`` (grp, idx, m, hash, extra): per ancestor
    ``grp``, ``up`` (its number), ``m`` (nodes of the group below), ``n_up``
    (of its ancestors), ``hash`` (its own) and ``slots``: array of struct
    (idx, hash, extra, steps), steps the siblings by level."""
    levels = _levels(fanout)
    width = fanout ** levels
    slot = F.pmod("idx", F.lit(width))
    what = F.struct("hash", *extra)
    wide = nodes.groupBy("grp", F.floor(F.col("idx") / width).alias("up")).agg(
        F.max("m").alias("m"), *(F.max(F.when(slot == i, what)).alias(f"s{i}") for i in range(width)))
    node = lambda level, i: F.col(f"n{level}_{i}")
    run = lambda level, these: [F.coalesce(node(level, i), F.lit("")) for i in these] or [F.lit("")]
    wide = wide.withColumns({f"n0_{i}": F.col(f"s{i}.hash") for i in range(width)})
    for level in range(levels):
        wide = wide.withColumns({f"n{level + 1}_{i}": F.when(node(level, i * fanout).isNotNull(), _hash(
            *run(level, range(i * fanout, (i + 1) * fanout)))) for i in range(fanout ** (levels - level - 1))})
    height = F.lit(levels)  # levels until the group has one node
    for level in reversed(range(levels)):
        height = F.when(F.col("m") <= fanout ** level, level).otherwise(height)
    wide = wide.withColumn("height", height)

    def steps(i: int) -> Column:
        out = []
        for level in range(levels):
            at = i // fanout ** level
            first = at - at % fanout
            out.append(F.struct(F.concat(*run(level, range(first, at))).alias("left"),
                                F.concat(*run(level, range(at + 1, first + fanout))).alias("right")))
        return F.slice(F.array(*out), F.lit(1), F.col("height"))

    slots = F.array(*(F.when(node(0, i).isNotNull(), F.struct(
        (F.col("up") * width + i).alias("idx"), node(0, i).alias("hash"), *(F.col(f"s{i}.{x}").alias(x) for x in extra),
        steps(i).alias("steps"))) for i in range(width)))
    tops = F.element_at(F.array(*(node(level, 0) for level in range(levels + 1))), F.col("height") + 1)
    return wide.select("grp", "up", "m", F.ceil(F.col("m") / width).alias("n_up"), tops.alias("hash"),
                       F.filter(slots, lambda x: x.isNotNull()).alias("slots"))


def _tree(nodes: DataFrame, fanout: int, extra: tuple[str, ...] = ()) -> tuple[list[DataFrame], DataFrame]:
    """The pivots of all turns, and (grp, hash) of every group's top."""
    turns, tops = [], []
    while not turns or not nodes.isEmpty():
        turns.append(checkpoint(_climb(nodes, fanout, extra if not turns else ())))
        up = turns[-1].select("grp", F.col("up").alias("idx"), F.col("n_up").alias("m"), "hash")
        tops.append(up.where("m = 1").select("grp", "hash"))
        nodes = up.where("m > 1")
    return turns, reduce(DataFrame.unionByName, tops)


def _down(turns: list[DataFrame], tops: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Every leaf of the tree: its idx, hash, extra, steps, and the columns
    of ``tops`` (grp, above: steps over the group's top, ...)."""
    given = [c for c in tops.columns if c not in ("grp", "above")]
    below = None
    for turn in reversed(turns):
        ended = tops.withColumn("idx", F.lit(0).cast("bigint")).withColumn("one", F.lit(True))
        if below is not None:
            ended = ended.unionByName(below)
        ended = ended.select(F.col("grp").alias("_grp"), F.col("idx").alias("_up"), "one", "above", *given)
        met = turn.join(ended, F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("up") == F.col("_up"))
                        & ((F.col("n_up") == 1) == F.col("one")))
        slots = met.select("grp", F.explode("slots").alias("s"), "above", *given)
        below = slots.select("grp", F.col("s.idx").alias("idx"), F.lit(False).alias("one"), F.concat(
            "s.steps", "above").alias("above"), *given, *((("s.hash", *(f"s.{x}" for x in extra))) if turn is turns[0] else ()))
    return below.withColumnRenamed("above", "steps").drop("one")


def fold(start: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(steps, start, lambda now, s: F.sha2(F.concat(s["left"], now, s["right"]), 256))


def manifest(df: DataFrame, key: str = "doc_id", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             group: str = "lang", bump: str = "n_chars", tampered: Column | None = None, fanout: int = 2) -> DataFrame:
    """Per row: ``key``, ``leaf`` (hash of ``columns``), ``subroot`` (of its
    ``group``), ``root``, ``proof_sha256`` (hash of its siblings, level by
    level via the subroot to the root, left to right), ``folded_root`` (from
    the row's leaf with ``bump`` one larger where ``tampered``, and the
    original siblings) and ``verified`` (whether that is the root).
    ``tampered`` defaults to: 7 divides the unsigned crc32 of the decimal key.

    Leaves ascend by key in their group, null keys first; equal keys by leaf,
    and equal rows are leaves of their own. A null in any column is ``-``; a
    null group is a group; a null ``bump`` stays null, a null key is not
    tampered with. Empty and long texts are values as any; an empty table
    gives an empty result; other columns do not enter."""
    if tampered is None:
        tampered = F.crc32(F.col(key).cast("string").cast("binary")) % 7 == 0
    leaf = lambda extra: _hash(*(field(F.col(c) + extra if extra and c == bump else F.col(c)) for c in columns))
    rows = df.select(
        F.col(group).alias("grp"), F.col(key).alias("_key"), leaf(0).alias("hash"),
        F.when(F.coalesce(tampered, F.lit(False)) & F.col(bump).isNotNull(), leaf(1)).alias("changed"))
    nodes = number(checkpoint(rows), "grp", ["_key", "hash"])
    extra = ("_key", "changed")
    turns, tops = _tree(nodes, fanout, extra)
    tops = checkpoint(tops)
    over, roots = _tree(number(tops.select(F.lit(0).alias("grp"), F.col("grp").alias("name"), "hash"), "grp", ["name"]),
                        fanout, ("name",))
    root = roots.first()
    named = _down(over, roots.select("grp", F.array().cast(STEPS).alias("above")), ("name",)).select(
        F.col("name").alias("grp"), F.col("steps").alias("above"), F.col("hash").alias("subroot"))
    leaves = _down(turns, checkpoint(named), extra)
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "")
    out = leaves.select(
        F.col("_key").alias(key), F.col("hash").alias("leaf"), "subroot",
        F.lit(root.hash if root else None).cast("string").alias("root"), F.sha2(siblings, 256).alias("proof_sha256"),
        fold(F.coalesce("changed", "hash"), F.col("steps")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
