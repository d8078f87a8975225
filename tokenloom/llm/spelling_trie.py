"""Spelling variants: words one edit apart, found along a distributed trie.

All words stand in a trie, forwards and backwards, kept as a table with a row
per node: its outgoing edges and the word that ends there.  A search is a
*state* ``(word, pos, node, edits)``: the first ``pos`` code points of the word
led to the node with that many edits.  Level by level all states meet the nodes
of that depth in one join.  A state without an edit moves on along its own
edge, skips a code point of its word, or takes another edge in its place; one
with an edit follows its word alone.  A state with one edit that has used up
its word at the end of another makes these two neighbours.

An edit lies in one half of a word.  The forward trie finds those of the second
half, the backward trie those of the first, so states start in the middle, where
nodes have few edges.  An edge knows which lengths the words below it have, and
a state only takes it to a word of the length it must end with.  Pairs of equal
length are found from the smaller word, others from the longer one.

Words of more than ``LONG`` code points, of which natural text has none, would
need a level each.  Those meet by hashes of themselves without one code point,
at most one group per place, and are compared by what is left.

Cases.  Words that are null count as no word.  Repeated rows of a word are
summed.  No words give no rows.  Ties between neighbours go to the smaller word
in code-point order.  A null or empty text, or one without letters, has no
runs; a null id is written as nothing before the colon.  Other columns are not
looked at, whatever their names.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.session import settled, shared_folder

# What a run of letters is, and which capitals become small.
LETTERS = "[A-Za-zÀ-ÿ]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

LONG = 64
SHORTEST, RAREST = 5, 3
# A word is a form of a neighbour that is at least so many times as frequent.
FACTOR = 2

FOUND = "word string, n long, back boolean, pos int, node long, edits int, near string, near_n long"


def letter_runs(text: Column) -> Column:
    """The runs of letters of ``text`` in order, A-Z in lower case."""
    return F.regexp_extract_all(F.translate(text, CAPITALS, CAPITALS.lower()), F.lit(LETTERS), F.lit(0))


def misspelt_words(docs: DataFrame, one_in: int = 97) -> DataFrame:
    """``word, n``: runs of letters with their number, about one in ``one_in`` short of a code point.

    Which run loses which one is told by the CRC-32 of ``doc_id:run``.  Words
    below :data:`SHORTEST` code points or :data:`RAREST` occurrences are left out.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(letter_runs(F.col("text"))).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    shorter = F.concat(F.expr("left(run, at)"), F.expr("substring(run, at + 2)"))
    words = (
        runs.select("run", h.alias("h")).select("run", "h", at.alias("at"))
        .select(F.when(F.col("h") % one_in == 0, shorter).otherwise(F.col("run")).alias("word"))
    )
    counted = words.where(F.length("word") >= SHORTEST).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= RAREST)


def _node(back: Column, prefix: Column) -> Column:
    return F.xxhash64(back, prefix)


def _at(word: Column, pos: Column) -> Column:
    """The code point of ``word`` at ``pos``, from 0; empty behind its end."""
    return F.substring(word, pos + 1, F.lit(1))


def _both_ways(words: DataFrame) -> DataFrame:
    """``word, n, back, len, start``: words forwards and backwards, and where an edit may begin."""
    size = F.length("word")
    ways = words.select("n", size.alias("len"), F.explode(F.array(
        F.struct(F.col("word").alias("word"), F.lit(False).alias("back"), F.floor(size / 2).cast("int").alias("start")),
        F.struct(F.reverse("word").alias("word"), F.lit(True).alias("back"), F.ceil(size / 2).cast("int").alias("start")),
    )).alias("w"))
    return ways.select("w.word", "n", "w.back", "len", "w.start")


def trie(ways: DataFrame) -> DataFrame:
    """``depth, node, edges, end``: the nodes of all words from their middle on.

    ``edges`` are ``(c, child, lens)``, at most one per letter; bit ``k - 1`` of
    ``lens`` tells that a word of ``k`` code points lies below.  ``end`` is the
    word that ends at the node, if any, with its number.
    """
    depth = F.explode(F.sequence("start", "len")).alias("depth")
    steps = ways.select("word", "n", "back", "len", depth).select(
        "depth", "back", _node(F.col("back"), F.expr("left(word, depth)")).alias("node"),
        _at(F.col("word"), F.col("depth")).alias("c"),
        _node(F.col("back"), F.expr("left(word, depth + 1)")).alias("child"),
        F.expr("shiftleft(1L, len - 1)").alias("bit"),
        F.when(F.col("depth") == F.col("len"), F.struct("word", "n")).alias("end"),
    )
    edges = steps.groupBy("depth", "node", "c").agg(
        F.any_value("child").alias("child"), F.bit_or("bit").alias("lens"), F.max("end").alias("end")
    )
    inner = F.collect_list(F.when(F.col("c") != "", F.struct("c", "child", "lens")))
    return edges.groupBy("depth", "node").agg(inner.alias("edges"), F.max("end").alias("end"))


def _level(states: DataFrame, nodes: DataFrame, depth: int) -> DataFrame:
    """The states one level down, and those that found a neighbour (``near``)."""
    word, pos, d = F.col("word"), F.col("pos"), F.lit(depth)
    size = F.length("word")
    # Of a run of equal code points only the last is left out: all give one word.
    skips = (F.col("edits") == 0) & (pos < size) & (_at(word, pos) != _at(word, pos + 1))
    here = states.select(
        "word", "n", "back", "node",
        F.explode(F.when(skips, F.array(
            F.struct(pos.alias("pos"), F.lit(0).alias("edits")), F.struct((pos + 1).alias("pos"), F.lit(1).alias("edits")),
        )).otherwise(F.array(F.struct(pos.alias("pos"), F.col("edits").alias("edits"))))).alias("s"),
    ).select("word", "n", "back", "node", "s.pos", "s.edits", _at(word, F.col("s.pos")).alias("next"), size.alias("len"))
    # A state that skipped one is a code point ahead of its depth, and ends one short.
    target = F.col("len") - (pos - d)
    met = here.join(nodes, "node")
    none = F.lit(None)

    def move(e: Column) -> Column:
        return F.struct(
            (pos + 1).cast("int").alias("pos"), e["child"].alias("node"),
            F.when(e["c"] == F.col("next"), F.col("edits")).otherwise(1).cast("int").alias("edits"),
            none.cast("string").alias("near"), none.cast("long").alias("near_n"),
        )

    def leads(e: Column) -> Column:
        below = F.getbit(e["lens"], (target - 1).cast("int")) == 1
        own = (e["c"] == F.col("next")) & ((F.col("edits") == 0) | below)
        other = (F.col("edits") == 0) & (e["c"] > F.col("next")) & (F.col("next") != "") & below
        return own | other

    ends = (F.col("edits") == 1) & (pos == F.col("len")) & F.col("end").isNotNull()
    found = F.when(ends, F.array(F.struct(
        pos.cast("int").alias("pos"), F.col("node").alias("node"), F.lit(1).alias("edits"),
        F.col("end.word").alias("near"), F.col("end.n").alias("near_n"),
    ))).otherwise(F.array())
    moved = F.transform(F.filter("edges", leads), move)
    return met.select("word", "n", "back", F.explode(F.concat(found, moved)).alias("s")).select(
        "word", "n", "back", "s.pos", "s.node", "s.edits", "s.near", "s.near_n"
    )


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: every ordered pair of words one edit apart, once.

    ``words`` has the columns ``word, n``, a row per word.
    """
    spark = words.sparkSession
    words = settled(words.where("word <> ''").groupBy("word").agg(F.sum("n").alias("n")))
    longest = words.agg(F.max(F.length("word"))).first()[0] or 0
    ways = _both_ways(words.where(F.length("word") <= LONG))
    folder = f"{shared_folder(spark)}/trie-{uuid.uuid4().hex}"
    # Sorted by depth, so that a level reads its own pages of each file.
    trie(ways).sortWithinPartitions("depth").write.parquet(f"{folder}/nodes")
    ways.select(
        "word", "n", "back", F.col("start").alias("pos"), _node(F.col("back"), F.expr("left(word, start)")).alias("node")
    ).sortWithinPartitions("pos").write.parquet(f"{folder}/starts")
    nodes, starts = spark.read.parquet(f"{folder}/nodes"), spark.read.parquet(f"{folder}/starts")

    entered = {row.pos for row in starts.select("pos").distinct().collect()}  # at most LONG numbers
    states = spark.createDataFrame([], FOUND)
    found = [states]
    for depth in range(min(longest, LONG) + 1):
        if depth not in entered and states.where("near IS NULL").isEmpty():
            continue
        here = starts.where(F.col("pos") == depth).withColumn("edits", F.lit(0))
        here = here.unionByName(states.where("near IS NULL").drop("near", "near_n"))
        states = settled(_level(here, nodes.where(F.col("depth") == depth).drop("depth"), depth))
        found.append(states.where("near IS NOT NULL"))
    near = reduce(DataFrame.unionByName, found).select(
        F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")).alias("word"), "n",
        F.when(F.col("back"), F.reverse("near")).otherwise(F.col("near")).alias("near"), "near_n",
    ).where(F.levenshtein("word", "near") == 1)  # nodes are known by a hash of 64 bits
    if longest >= LONG:
        near = near.unionByName(_long_neighbours(words.where(F.length("word") >= LONG)))
    other = near.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return near.unionByName(other).distinct()


def _long_neighbours(words: DataFrame) -> DataFrame:
    """:func:`neighbours` of long words, each pair once or twice."""
    spelt = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("i"))
    less = F.concat(F.expr("left(word, i)"), F.expr("substring(word, i + 2)"))
    # The word itself is looked up by what it hashes to; texts are joined back by that.
    cut = settled(spelt.select(F.xxhash64("word").alias("id"), "i", F.xxhash64(less).alias("less")))
    known = words.select(F.xxhash64("word").alias("id"), "word", "n")
    swaps = cut.alias("x").join(cut.alias("y"), F.expr("x.less = y.less AND x.i = y.i AND x.id < y.id"))
    drops = cut.alias("x").join(known.select(F.col("id").alias("less")).alias("y"), "less")
    pairs = swaps.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), "x.i", F.lit(False).alias("dropped")).unionByName(
        drops.select(F.col("x.id").alias("a"), F.col("less").alias("b"), "x.i", F.lit(True).alias("dropped"))
    )
    # A pair may agree at several places of a run; which one does not matter.
    pairs = pairs.groupBy("a", "b", "dropped").agg(F.max("i").alias("i"))
    both = pairs.join(known.select(F.col("id").alias("a"), "word", "n"), "a").join(
        known.select(F.col("id").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n")), "b"
    )
    rest = F.when(F.col("dropped"), F.col("near")).otherwise(F.concat(F.expr("left(near, i)"), F.expr("substring(near, i + 2)")))
    return both.where((less == rest) & (F.col("word") != F.col("near"))).select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for the words with a form: from word to form as long as there is one.

    ``forms`` has ``word, form``.  A form is at least twice as frequent as its
    word, so the chains are short and end; each round doubles the steps taken.
    """
    links = settled(forms.select("word", F.col("form").alias("root")))
    while True:
        step = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        links = settled(links.join(step, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        if links.where("moved").isEmpty():
            return links.drop("moved")
        links = links.drop("moved")


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word.

    ``form`` is the most frequent neighbour, if it is ``factor`` times as
    frequent as the word or more, else null; ``root`` is where forms of forms
    end, the word itself if it has none.
    """
    words = settled(words.where("word <> ''").groupBy("word").agg(F.sum("n").alias("n")))
    best = neighbours(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    known = settled(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.less") >= F.col("n") * factor, F.struct(F.col("best.near").alias("form"), (-F.col("best.less")).alias("n"))).alias("form"),
    ))
    ends = roots(known.where("form IS NOT NULL").select("word", "form.form"))
    return known.join(ends, "word", "left").select(
        "word", F.col("form.form").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("form.n").alias("form_n")
    )
