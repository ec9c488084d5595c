"""Secret scans by multipart credential linking, in Spark functions only.

Strong findings (``assign``, ``access``, ``hex``) stand alone. Weak
candidates - bare access identifiers (``id``), bare secrets (``key``),
endpoints (``endpoint``) - are reported only when complementary parts lie
within one scope: an interval join of identifiers with secrets (strong ones
count as parts too) with at most ``scope`` code points between them, and
endpoints near such a pair.

Positions come without Python: ``split`` and ``regexp_extract_all`` walk a
text alike, so gaps and matches alternate and their lengths add up to code
point offsets. Sums run over blocks of the square root of their number, so
that no array is copied once per match.

The interval join is an equi-join on (row key, scope-wide bin): a part is
listed under the bins that it and a scope on either side cover, its partner
under the bins that it covers itself, so two parts within the scope share
one. Only whether a partner exists is asked (semi joins), so no pairs are
emitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import checkpoint

# What counts as a secret.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key(?-i))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
WEAK_ID = r"(?<![A-Za-z0-9])(?=[A-Z]*[0-9])(?=[0-9]*[A-Z])[A-Z0-9]{12,24}(?![A-Za-z0-9])"
WEAK_KEY = (r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]{0,127}[0-9])(?=[a-z0-9+/]{0,127}[A-Z])(?=[A-Z0-9+/]{0,127}[a-z])"
            r"[A-Za-z0-9+/]{32,128}={0,2}(?![A-Za-z0-9+/=])")
ENDPOINT = r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~/-]*)?"
KINDS = ("assign", "access", "hex", "id", "key", "endpoint")

#: rows with secrets whose spans are broadcast (some hundred bytes each)
BROADCAST_ROWS = 20_000

SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def _let(value: Column, then) -> Column:
    """``then(value)``, the value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _blocks(values: Column, then) -> Column:
    """``then`` of every block of a non-empty array; a block has the square
    root of the array's size."""
    def cut(v: Column, width: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / width).cast("int")),
                           lambda b: then(F.slice(v, b * width + 1, width)))

    return _let(values, lambda v: _let(F.ceil(F.sqrt(F.size(v))).cast("int"), lambda width: cut(v, width)))


def _running(values: Column, both) -> Column:
    """For every value of a non-empty array of bigint, ``both`` (sum or
    greatest, from 0) of all values before it."""
    zero = F.array(F.lit(0).cast("bigint"))
    scan = lambda v, of: F.aggregate(v, zero, lambda acc, x: F.concat(acc, F.array(both(F.element_at(acc, -1), of(x)))))
    parts = _blocks(values, lambda v: scan(v, lambda x: x))  # each one longer than its block: the last is its total

    def shift(parts: Column) -> Column:
        before = scan(parts, lambda p: F.element_at(p, -1))
        return F.flatten(F.zip_with(parts, F.slice(before, F.lit(1), F.size(parts)), lambda p, base: F.transform(
            F.slice(p, F.lit(1), F.size(p) - 1), lambda x: both(base, x))))

    return _let(parts, shift)


def _spans(text: Column, kind: str, pattern: str, size: Column | None = None, least: int = 1) -> Column:
    """Sorted spans of the matches whose ``size`` part (default: the whole
    match) has at least ``least`` code points."""
    long = lambda x: F.coalesce(F.length(x), F.lit(0)).cast("bigint")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(F.split(text, pattern, -1), found, lambda gap, match: F.struct(
        long(gap).alias("gap"), long(match).alias("match")))

    def walk(steps: Column) -> Column:
        at = _running(F.transform(steps, lambda x: x["gap"] + x["match"]), lambda a, b: a + b)
        spans = F.zip_with(steps, at, lambda x, at: F.struct(
            (at + x["gap"]).alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (at + x["gap"] + x["match"]).alias("end")))
        parts = F.transform(steps, lambda x: x["match"]) if size is None else F.transform(size, long)
        good = F.filter(F.zip_with(spans, parts, lambda s, n: F.when(n >= least, s)), lambda s: s.isNotNull())
        return good.cast(SPAN)

    # most texts have no match: those are neither split nor walked
    return F.when(text.rlike(pattern), _let(steps, walk)).otherwise(F.array().cast(SPAN))


def _label(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def find_secrets(df: DataFrame, key: str = "doc_id", text: str = "text", scope: int = 200) -> DataFrame:
    """Per row: ``key``, ``base`` and ``linked``: sorted arrays of struct
    (start, kind, end), code points, ends exclusive, kind an index into
    ``KINDS``.

    A null text counts as empty (no spans); equal rows get equal results, as
    parts are joined by (key, digest of the text); null keys join null-safe
    through that digest; an empty table gives an empty one; other columns are
    ignored. ``scope``: most code points between linked parts. Long texts with
    many matches cost time in proportion to matches times the square root of
    their number, the text itself in proportion to its length."""
    return _find(df, key, text, scope).select(key, "base", "linked")


def _row(key: str, text: str) -> Column:
    """What equal rows share: the key and a digest of the text."""
    t = F.coalesce(F.col(text), F.lit(""))
    return F.sha2(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(":"), t), 256)


def _find(df: DataFrame, key: str, text: str, scope: int) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    found = checkpoint(df.select(
        F.col(key), _row(key, text).alias("_row"),
        F.concat(_spans(t, "assign", ASSIGN, F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)), 12),
                 _spans(t, "access", ACCESS, least=18), _spans(t, "hex", HEX)).alias("base"),
        F.concat(_spans(t, "id", WEAK_ID), _spans(t, "key", WEAK_KEY),
                 _spans(t, "endpoint", ENDPOINT)).alias("weak")))

    parts = found.where("size(weak) > 0").select("_row", F.explode(F.concat("base", "weak")).alias("s")).select(
        "_row", "s.start", "s.end", F.element_at(F.array(*map(F.lit, (
            "secret", "id", "secret", "id", "secret", "endpoint"))), F.col("s.kind") + 1).alias("role"), "s").distinct()
    bins = lambda a, b: F.explode(F.sequence(F.floor(a / scope), F.floor(b / scope)))

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        """Rows of ``left`` with a row of ``right`` within the scope."""
        wide = left.withColumn("_near", bins(F.col("start") - scope, F.col("end") + scope))
        r = right.select(F.col("_row").alias("r_row"), F.col("start").alias("r_start"), F.col("end").alias("r_end")).distinct()
        r = r.withColumn("r_bin", bins(F.col("r_start"), F.col("r_end")))
        hit = wide.join(r, (wide["_row"] == r["r_row"]) & (wide["_near"] == r["r_bin"])
                        & (r["r_start"] - wide["end"] <= scope) & (wide["start"] - r["r_end"] <= scope), "left_semi")
        return hit.drop("_near").distinct()

    ids, secrets, ends = (parts.where(F.col("role") == r) for r in ("id", "secret", "endpoint"))
    paired = beside(ids, secrets).unionByName(beside(secrets, ids))
    linked = paired.unionByName(beside(ends, paired)).where(F.col("s.kind") >= 3)
    linked = linked.groupBy("_row").agg(F.array_sort(F.collect_set("s")).alias("linked"))
    return found.join(linked, "_row", "left").select(
        key, "_row", F.array_sort("base").alias("base"), F.coalesce("linked", F.array().cast(SPAN)).alias("linked"))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, ``base_sha256`` and ``spans`` of ``find_secrets``."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        key, count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_label(F.col("base")), 256).alias("base_sha256"),
        _label(F.concat("base", "linked")).alias("spans"), F.size("linked").cast("bigint").alias("n_linked"))


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span replaced by ``mark``; overlapping and
    touching spans become one. The text is cut in blocks of spans first, so
    that it is walked as often as there are blocks, not spans."""
    cut = lambda t, a, b: F.substring(t, (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))

    def pieces(spans: Column) -> Column:
        before = _running(F.transform(spans, lambda s: s["end"]), F.greatest)
        placed = F.zip_with(spans, before, lambda s, b: F.struct(b.alias("from"), s["start"].alias("to"), s["end"].alias("end")))

        def some(block: Column) -> Column:
            first = F.element_at(block, 1)["from"]
            part = cut(text, first, F.array_max(F.transform(block, lambda x: x["to"])))
            return _let(part, lambda t: F.array_join(F.transform(block, lambda x: F.when(
                (x["to"] > x["from"]) | (x["from"] == 0), F.concat(cut(t, x["from"] - first, x["to"] - first), F.lit(mark)))
                .otherwise("")), ""))

        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(_blocks(placed, some), ""), cut(text, last, F.length(text).cast("bigint")))

    return F.when(F.size(spans) > 0, _let(F.array_sort(spans), pieces)).otherwise(text)


def redact_documents(df: DataFrame, key: str = "doc_id", text: str = "text", scope: int = 200,
                     length: str | None = "n_chars") -> DataFrame:
    """``df`` with every secret in ``text`` replaced by a mark, and the code
    points in ``length`` counted anew; rows without secrets stay as they are.
    Spans of few rows are joined by broadcast, of many by a shuffle."""
    spans = _find(df, key, text, scope).select("_row", F.concat("base", "linked").alias("_spans")).where(
        "size(_spans) > 0").dropDuplicates(["_row"])
    spans = checkpoint(spans.withColumnRenamed("_row", "_of"))
    right = F.broadcast(spans) if spans.count() <= BROADCAST_ROWS else spans
    out = df.withColumn("_row", _row(key, text)).join(right, F.col("_row") == F.col("_of"), "left")
    clean = redact(F.col(text), F.coalesce("_spans", F.array().cast(SPAN)))
    out = out.withColumn(text, clean)
    if length and length in df.columns:
        out = out.withColumn(length, F.when(F.col("_spans").isNotNull(), F.length(text).cast(
            df.schema[length].dataType)).otherwise(F.col(length)))
    return out.select(*df.columns)
