"""Spelling variants by a relational trie frontier.

The vocabulary becomes a trie kept as a distributed edge table: one row per
node (a prefix) with its children (at most the alphabet: 90 letters), each
with the count of the word that ends there, a bit set of how many letters may
follow and one of the next letters (folded to 64 bits: a filter, not a proof).
States (word, position, node, edits) walk it level by level. A word's own
prefixes are its states without an edit; from them a state with one edit comes
by replacing the next letter with a later one or by inserting a letter;
states with an edit must then match letter by letter. A state whose word ends
where a word of the trie ends is a pair of neighbours. Deletions, and
replacements by earlier letters, are the same pairs seen from the other word.

Near the root a trie branches most, and a state that leaves its word there
lives on all sides. So words walk two ways: as they are for edits in their
second half, and from the end, in a trie of reversed words, for those in the
first. No edit is tried before half of a word's letters.

A level's edges are broadcast only up to ``BROADCAST_EDGES`` of them (a few
MB; counted, not guessed). Beyond that states and nodes meet by a shuffle in
which nodes of many states are salted. A state goes on only if the trie has a
word of the length it still needs, so nothing grows with pairs.

The walk has one level per letter; words of more than ``TRIE_CHARS`` letters,
which are rare but without bound, find their neighbours through their variants
with one letter less instead, exactly too."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import checkpoint

# What a word is, and which letters are lower-cased.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: longest words that walk the trie; lengths left fit a 64-bit set
TRIE_CHARS = 32
#: edges of a level that are broadcast at most
BROADCAST_EDGES = 50_000
#: words whose states one task holds
TASK_WORDS = 20_000
#: states at one node beyond which they are salted; at most states / HOT nodes are
HOT = 20_000


def words(df: DataFrame, key: str = "doc_id", text: str = "text", every: int = 199, least: int = 6,
          times: int = 5) -> DataFrame:
    """(word, n): runs of letters in all texts, A-Z lower-cased, of at least
    ``least`` code points and ``times`` occurrences. A run whose unsigned
    crc32 of ``key:run`` is divisible by ``every`` has lost one code point
    (0: none has)."""
    runs = df.select(F.col(key).cast("string").alias("_key"), F.explode(F.regexp_extract_all(
        F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    word = F.col("run")
    if every:
        h, size = F.col("h"), F.length("run")
        runs = runs.withColumn("h", F.crc32(F.concat(F.coalesce("_key", F.lit("null")), F.lit(":"), F.col("run"))))
        at = (h % size).cast("int")
        word = F.when(h % every == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(
            word, at + 2, size))).otherwise(word)
    found = runs.select(word.alias("word")).where(F.length("word") >= least)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


def _letter(word: str, at: Column | int) -> Column:
    """The letter after ``at`` ones."""
    return F.substring(word, F.lit(at) + 1, F.lit(1))


def _bit(letter: Column) -> Column:
    """The bit of a letter; 0 for none."""
    return F.when(letter == "", F.lit(0).cast("bigint")).otherwise(F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.ascii(letter) % 64))


def both_ways(vocabulary: DataFrame) -> DataFrame:
    """(way, word, n, half): words and (way 1) reversed words; ``half``:
    letters before the first edit. An edit before the middle of a word is one
    behind the middle of its reverse."""
    half = F.floor(F.length("word") / 2).cast("int")
    return vocabulary.select(F.lit(0).alias("way"), "word", "n", half.alias("half")).unionByName(vocabulary.select(
        F.lit(1).alias("way"), F.reverse("word").alias("word"), "n", (F.length("word") - half).alias("half")))


def edges(vocabulary: DataFrame) -> DataFrame:
    """The tries of (way, word, n): (depth, way, node, children: array of
    struct (letter, rest: bit set of lengths that may follow, ahead: bits of
    the letters that may, n: count of the word that ends there or null))."""
    size = F.length("word")
    steps = vocabulary.select("way", "word", "n", size.alias("size"), F.explode(F.sequence(F.lit(0), size - 1)).alias("depth"))
    step = steps.select(
        "depth", "way", F.substring("word", F.lit(1), F.col("depth")).alias("node"),
        _letter("word", F.col("depth")).alias("letter"),
        F.expr("shiftleft(1L, size - depth - 1)").alias("bit"), _bit(_letter("word", F.col("depth") + 1)).alias("ahead"),
        F.when(F.col("depth") == F.col("size") - 1, F.col("n")).alias("n"))
    child = step.groupBy("depth", "way", "node", "letter").agg(
        F.expr("bit_or(bit)").alias("rest"), F.expr("bit_or(ahead)").alias("ahead"), F.max("n").alias("n"))
    return child.groupBy("depth", "way", "node").agg(F.collect_list(F.struct("letter", "rest", "ahead", "n")).alias("children"))


def _meet(states: DataFrame, nodes: DataFrame, n_edges: int) -> DataFrame:
    """States with the children of their node."""
    if n_edges <= BROADCAST_EDGES:
        return states.join(F.broadcast(nodes), ["way", "node"])
    states = checkpoint(states)
    # at most states / HOT rows. As values, for a frame made from the states would carry the planner's estimate of their
    # size into this level's twice more, and the digits of that number would grow threefold a level
    hot = states.groupBy("way", "node").agg(F.count("*").alias("k")).where(F.col("k") > HOT).select(
        "way", "node", F.ceil(F.col("k") / HOT).cast("int").alias("_salts")).collect()
    if not hot:
        return states.join(nodes, ["way", "node"])
    hot = F.broadcast(states.sparkSession.createDataFrame(hot, "way int, node string, _salts int"))
    salts = F.coalesce("_salts", F.lit(1))
    left = states.join(hot, ["way", "node"], "left").withColumn(
        "_salt", F.pmod(F.xxhash64("word", "pos"), salts).cast("int")).drop("_salts")
    right = nodes.join(hot, ["way", "node"], "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return left.join(right, ["way", "node", "_salt"]).drop("_salt")


def _step(states: DataFrame, nodes: DataFrame, n_edges: int) -> DataFrame:
    """States one level deeper, all with one edit, that still can end."""
    pos, size = F.col("pos"), F.length("word")
    asked = states.select("*", size.alias("size"), _letter("word", pos).alias("next"),
                          _bit(_letter("word", pos)).alias("bit"), _bit(_letter("word", pos + 1)).alias("bit1"))
    met = _meet(asked, nodes, n_edges).withColumn("c", F.explode("children")).select(
        "*", "c.letter", "c.rest", "c.ahead", F.col("c.n").alias("there"))

    def fits(left: Column, bit: str) -> Column:
        """A word may end as far on as this one, and go on with its letter."""
        return (F.call_function("shiftright", F.col("rest"), left).bitwiseAND(1) == 1) & (
            F.col("ahead").bitwiseAND(F.col(bit)) == F.col(bit))

    left, same, first = F.col("size") - pos, F.col("letter") == F.col("next"), ~F.col("edited")
    # match, or replace by a later letter: one letter of both
    step = (left > 0) & F.when(first, F.col("letter") > F.col("next")).otherwise(same) & fits(left - 1, "bit1")
    # insert; before an equal letter it is the same word as after it
    insert = first & ~same & fits(left, "bit")
    made = met.select("way", "word", "n", "size", "there", F.concat("node", "letter").alias("node"), step.alias("step"),
                      insert.alias("insert"), pos).where("step OR insert")
    moves = F.when(F.col("step") & F.col("insert"), F.array(pos + 1, pos)).when(F.col("step"), F.array(pos + 1)).otherwise(
        F.array(pos))
    return made.select("way", "word", "n", F.explode(moves).alias("pos"), "node", F.lit(True).alias("edited"), "size", "there")


def _pairs_long(vocabulary: DataFrame) -> DataFrame:
    """Neighbours of which one has more than ``TRIE_CHARS`` letters. Words
    that differ in one place share a variant at that place; the longer of two
    has a variant that is the other. At most the alphabet shares a variant."""
    long = vocabulary.where(F.length("word") >= TRIE_CHARS)
    cut = long.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("at")).select(
        "word", "n", "at", F.concat(F.substring("word", F.lit(1), F.col("at")), F.substring(
            "word", F.col("at") + 2, F.length("word"))).alias("v"))
    cut = cut.withColumn("h", F.xxhash64("v"))
    other = cut.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("at").alias("at2"), F.col("h").alias("h2"),
                       F.col("v").alias("v2"))
    replaced = cut.join(other, (F.col("h") == F.col("h2")) & (F.col("at") == F.col("at2")) & (F.col("v") == F.col("v2"))
                        & (F.col("word") < F.col("b")))
    whole = long.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.xxhash64("word").alias("h2"))
    shorter = cut.join(whole, (F.col("h") == F.col("h2")) & (F.col("v") == F.col("b")))
    ends = ("word", "n", "b", "n_b")
    return replaced.select(*ends).unionByName(shorter.select(*ends)).distinct().where(
        F.greatest(F.length("word"), F.length("b")) > TRIE_CHARS)


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, n_of: count of near): both directions of all pairs of words of
    ``vocabulary`` (word, n) that differ by one inserted, deleted or replaced
    code point."""
    short = both_ways(vocabulary.where(F.length("word") <= TRIE_CHARS))
    trie = checkpoint(edges(short))
    sizes = {r.depth: r.k for r in trie.groupBy("depth").agg(F.sum(F.size("children")).alias("k")).collect()}
    tasks = max(1, -(-2 * vocabulary.count() // TASK_WORDS))
    found, frontier = [_pairs_long(vocabulary).select("word", "n", F.col("b").alias("near"), F.col("n_b").alias("n_of"))], None
    for depth in range(max(sizes, default=-1) + 1):
        own = short.where((F.col("half") <= depth) & (F.length("word") >= depth)).select(
            "way", "word", "n", F.lit(depth).alias("pos"), F.substring("word", F.lit(1), F.lit(depth)).alias("node"),
            F.lit(False).alias("edited"))
        states = own if frontier is None else own.unionByName(frontier)
        made = checkpoint(_step(states.coalesce(tasks), trie.where(F.col("depth") == depth).drop("depth"), sizes[depth]))
        ended = made.where((F.col("pos") == F.col("size")) & F.col("there").isNotNull())
        plain = lambda c: F.when(F.col("way") == 1, F.reverse(c)).otherwise(F.col(c))
        found.append(ended.select(plain("word").alias("word"), "n", plain("node").alias("near"), F.col("there").alias("n_of")))
        frontier = made.where(F.col("pos") < F.col("size")).drop("size", "there")
    way = lambda *c: F.struct(*(F.col(x).alias(y) for x, y in zip(c, ("word", "n", "near", "n_of"), strict=True)))
    one = checkpoint(reduce(DataFrame.unionByName, found).distinct())  # a letter put into a run is seen both ways
    return one.select(F.explode(F.array(way("word", "n", "near", "n_of"), way("near", "n_of", "word", "n"))).alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the rows of (word, form) that have a form: the last
    word that forms lead to. Counts grow by a factor along forms, so a chain
    is short; every turn halves it. Where many words lead to one, equal ends
    are looked up once."""
    step = checkpoint(forms.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        up = step.select(F.col("word").alias("_at"), F.col("root").alias("_up"))
        ends = checkpoint(step.select(F.col("root").alias("_end")).distinct().join(up, F.col("_end") == F.col("_at")).select(
            "_end", "_up"))
        if ends.isEmpty():
            return step
        step = checkpoint(step.join(ends, F.col("root") == F.col("_end"), "left").select(
            "word", F.coalesce("_up", "root").alias("root")))


def variants(df: DataFrame, key: str = "doc_id", text: str = "text", every: int = 199, least: int = 6, times: int = 5,
             factor: int = 5) -> DataFrame:
    """Per word of ``words``: ``word``, ``n``, ``form`` (its neighbour with
    the largest count, ties to the smallest in code-point order, if that count
    is at least ``factor`` times its own; else null), ``root`` (the last word
    that forms lead to, itself if none), ``n_near`` (number of neighbours) and
    ``form_n``.

    Null and empty texts have no words; a null key counts as the text
    ``null``; repeated rows count each time; an empty table gives an empty
    one; other columns are ignored."""
    vocabulary = checkpoint(words(df, key, text, every, least, times))
    best = neighbours(vocabulary).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_of")).alias("less"), "near")).alias("top"))
    told = vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        *(F.when(-F.col("top.less") >= factor * F.col("n"), c).alias(name)
          for name, c in (("form", F.col("top.near")), ("form_n", -F.col("top.less")))))
    told = checkpoint(told)
    ends = roots(told)
    return told.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
