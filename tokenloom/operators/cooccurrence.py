"""Word co-occurrence within a distance, as pairs and as stripes.

Everything rests on one table of *couples*: ``lo, hi, n`` counts how often two
listed words stand at most ``d`` positions apart in a line, whatever their
order (``lo <= hi``).  Positions are those of the line as written; words that
are not listed keep theirs.  One row per couple and line occurrence is folded
in the task that reads the line, so the only shuffle moves counted couples.

Pairs mirror a couple into both orders and leave equal words out.  Stripes keep
equal words, which each see the other: such a couple counts twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.text import words
from tokenloom.operators.tokens import tokens
from tokenloom.operators.wordlists import Words, fits_broadcast, is_small_list, keep_words, short_list
from tokenloom.session import settled_if_possible

# Positions per block on the long-list path; a block also sees the `d` after it.
BLOCK = 4_096
# Rows one array makes when equal records are told apart again.
RUN = 4_096


def _couples(hits: Column, d: int, is_anchor: Callable[[Column], Column] | None = None) -> Column:
    """Couples among ``hits``, an array of ``(p, w)`` in order of position.

    A hit within ``d`` positions is among the next ``d`` hits.  ``is_anchor``
    tells which hits start couples; by default all do.
    """

    def from_hit(a: Column, k: Column) -> Column:
        reach = F.lit(d) if is_anchor is None else F.when(is_anchor(a), d).otherwise(0)
        near = F.filter(F.slice(hits, k + 2, reach), lambda b: b["p"] - a["p"] <= d)
        return F.transform(
            near,
            lambda b: F.struct(
                F.least(a["w"], b["w"]).alias("lo"),
                F.greatest(a["w"], b["w"]).alias("hi"),
                (b["p"] - a["p"]).alias("dist"),
            ),
        )

    return F.flatten(F.transform(hits, from_hit))


def couples(lines: DataFrame, vocabulary: Words, d: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """``*keys, lo, hi, dist, n``: couples of listed words at most ``d`` apart, a row standing for ``n``.

    A short vocabulary is written into the plan and a line is handled where it
    is read, a row per couple.  A longer one is joined, and the hits of a line
    are brought back together in blocks of bounded length.
    """
    if d < 0:
        raise ValueError("the distance must not be negative")
    listed = short_list(vocabulary)
    if listed is None:
        return couples_by_block(lines, vocabulary, d, keys)
    found = _hits_of_line(lines, listed, keys).select(*keys, F.explode(_couples(F.col("hits"), d)).alias("c"))
    return found.select(*keys, "c.lo", "c.hi", "c.dist", F.lit(1).cast("long").alias("n"))


def _hits_of_line(lines: DataFrame, listed: list[str], keys: tuple[str, ...]) -> DataFrame:
    """``*keys, hits``: the listed words of each line with their positions, as one array.

    What is made of ``hits`` must be exploded as an expression.  Of an exploded
    *column* Catalyst infers that its size is above 0, pushes that filter below
    the projections and spells the tokeniser out inside the lambda, where it
    runs for every hit.
    """

    def hit(w: Column, p: Column) -> Column:
        return F.when(w.isin(listed), F.struct(p.alias("p"), w.alias("w")))

    hits = F.filter(F.transform(words(F.col("text")), hit), lambda h: h.isNotNull())
    return lines.select(*keys, hits.alias("hits"))


def couples_by_block(
    lines: DataFrame, vocabulary: Words, d: int, keys: tuple[str, ...] = (), block: int = BLOCK
) -> DataFrame:
    """:func:`couples` for a vocabulary of any size: those of all words, less those with a word that is not listed."""
    if isinstance(vocabulary, DataFrame):
        vocabulary = settled_if_possible(vocabulary)
    return _listed_only(_couples_of_all_words(lines, d, keys, block), vocabulary)


def counted_by_block(
    lines: DataFrame, vocabulary: Words, d: int, by: tuple[str, ...] = ("lo", "hi"), block: int = BLOCK
) -> DataFrame:
    """``*by, n``: couples counted, for a vocabulary of any size.

    Positions are those of all words, so which couples there are does not hang on
    the list: they are made where a line is read, and the only shuffle of their
    occurrences is that of counted couples.  A list that can be broadcast is
    looked up before counting, a longer one joined with the counted couples.
    """
    if isinstance(vocabulary, DataFrame):
        vocabulary = settled_if_possible(vocabulary)
    found = _couples_of_all_words(lines, d, (), block)
    total = F.sum("n").alias("n")
    if is_small_list(vocabulary) or isinstance(vocabulary, DataFrame) and fits_broadcast(vocabulary):
        return _listed_only(found, vocabulary).groupBy(*by).agg(total)
    return _listed_only(settled_if_possible(found.groupBy(*by).agg(total)), vocabulary)


def _listed_only(found: DataFrame, vocabulary: Words) -> DataFrame:
    return keep_words(keep_words(found, vocabulary, "lo"), vocabulary, "hi")


def _couples_of_all_words(lines: DataFrame, d: int, keys: tuple[str, ...], block: int) -> DataFrame:
    """``*keys, lo, hi, dist, n``: couples of all words at most ``d`` apart.

    A line is cut into blocks of ``block`` positions, each with the ``d`` words
    after it, so no array outgrows ``block * d`` couples.
    """
    if d < 0:
        raise ValueError("the distance must not be negative")
    block = max(block, d, 1)
    size = F.size("words")
    starts = F.when(size > 0, F.sequence(F.lit(1), size, F.lit(block))).otherwise(F.array().cast("array<int>"))
    blocks = lines.select(*keys, words(F.col("text")).alias("words")).select(
        *keys, F.explode(F.transform(starts, lambda at: F.slice("words", at, block + d))).alias("block")
    )

    def apart(k: int) -> Column:
        """The couples ``k`` apart that start in a block."""
        many = F.least(F.greatest(F.size("block") - k, F.lit(0)), F.lit(block))
        return F.zip_with(
            F.slice("block", 1, many), F.slice("block", k + 1, many),
            lambda a, b: F.struct(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"), F.lit(k).alias("dist")),
        )

    couples_of_block = F.flatten(F.array(*[apart(k) for k in range(1, d + 1)])) if d else F.slice(apart(1), 1, 0)
    return blocks.select(*keys, F.explode(couples_of_block).alias("c")).select(
        *keys, "c.lo", "c.hi", "c.dist", F.lit(1).cast("long").alias("n")
    )


def _couples_of_records(
    lines: DataFrame, vocabulary: Words, d: int, keys: tuple[str, ...], block: int = BLOCK
) -> DataFrame:
    """``record, c, n``: couples of each record, ``n`` the number of records that are equal.

    A line is cut into blocks of ``block`` positions.  Each hit goes to its own
    block and, if a hit ``d`` before it lies in the block before, to that one
    too, where it is only looked at.  No group outgrows ``block + d`` hits.
    A record is known by its keys and a digest of its text, so a task that is
    computed again deals its rows as before, in whatever order they come.
    Equal records have equal hits: these fold where they are read, and their
    number is that of the hits brought together over that of the different ones.
    """
    if d < 0:
        raise ValueError("the distance must not be negative")
    block = max(block, d, 1)
    if isinstance(vocabulary, DataFrame):
        vocabulary = settled_if_possible(vocabulary)
    record = F.struct(F.unhex(F.md5("text")).alias("digest"), *keys)
    records = lines.select(record.alias("doc_id"), F.lit(0).cast("long").alias("line_no"), "text")
    found = keep_words(tokens(records), vocabulary)
    position = F.col("pos")
    own = F.floor(position / block)
    seen_from = F.floor(F.greatest(position - d, F.lit(0)) / block)
    placed = found.select(
        F.col("doc_id").alias("record"), F.struct(position.alias("p"), F.col("tok").alias("w")).alias("hit"),
        F.explode(F.array_distinct(F.array(own, seen_from))).alias("block"),
    )
    grouped = placed.groupBy("record", "block").agg(
        F.sort_array(F.collect_set("hit")).alias("hits"), F.count(F.lit(1)).alias("all_hits")
    )
    of_block = _couples(F.col("hits"), d, lambda a: F.floor(a["p"] / block) == F.col("block"))
    equal = F.expr("all_hits div size(hits)").alias("n")
    return grouped.select("record", "block", "hits", equal).select("record", F.explode(of_block).alias("c"), "n")


def couple_counts(lines: DataFrame, vocabulary: Words, d: int = 1) -> DataFrame:
    """``lo, hi, n``."""
    return _counted(lines, vocabulary, d, ("lo", "hi"))


def _counted(lines: DataFrame, vocabulary: Words, d: int, by: tuple[str, ...]) -> DataFrame:
    listed = short_list(vocabulary)
    if listed is None:
        return counted_by_block(lines, vocabulary, d, by)
    return couples(lines, listed, d).groupBy(*by).agg(F.sum("n").alias("n"))


def couple_counts_by_distance(lines: DataFrame, vocabulary: Words, max_d: int) -> DataFrame:
    """``d, lo, hi, n`` for every ``d`` from 1 to ``max_d``, in one pass over the text."""
    apart = _counted(lines, vocabulary, max_d, ("lo", "hi", "dist"))
    return up_to_distance(apart, max_d)


def up_to_distance(apart: DataFrame, max_d: int) -> DataFrame:
    """``[...,] d, lo, hi, n`` from couples counted by how far apart they stand.

    Counted rows only: a couple ``dist`` apart belongs to every ``d >= dist``.
    """
    keys = [c for c in apart.columns if c not in ("lo", "hi", "dist", "n")]
    spread = apart.select(*keys, F.explode(F.sequence("dist", F.lit(max_d))).alias("d"), "lo", "hi", "n")
    return spread.groupBy(*keys, "d", "lo", "hi").agg(F.sum("n").alias("n"))


def pairs(counts: DataFrame) -> DataFrame:
    """``[...,] w1, w2, n``: couples in both orders, equal words left out."""
    lo, hi, n = F.col("lo"), F.col("hi"), F.col("n")
    both = F.array(
        F.struct(lo.alias("w1"), hi.alias("w2"), n.alias("n")),
        F.struct(hi.alias("w1"), lo.alias("w2"), n.alias("n")),
    )
    keys = _other_columns(counts)
    return counts.filter(lo != hi).select(*keys, F.inline(both))


def stripe_rows(counts: DataFrame) -> DataFrame:
    """``[...,] word, neighbour, n``: couples seen from each of their words."""
    lo, hi, n = F.col("lo"), F.col("hi"), F.col("n")

    def row(word: Column, neighbour: Column, count: Column) -> Column:
        return F.struct(word.alias("word"), neighbour.alias("neighbour"), count.alias("n"))

    views = F.when(lo == hi, F.array(row(lo, hi, n * 2))).otherwise(F.array(row(lo, hi, n), row(hi, lo, n)))
    return counts.select(*_other_columns(counts), F.inline(views))


def stripes(rows: DataFrame) -> DataFrame:
    """``[...,] word, stripe``: a map neighbour -> count for every word.

    Works on counted rows: a stripe holds each listed word at most once.  A map
    is one row, so this form is for short lists; :func:`stripe_rows` is for any.
    """
    keys = [c for c in rows.columns if c not in ("neighbour", "n")]
    entries = F.array_sort(F.collect_list(F.struct("neighbour", "n")))
    return rows.groupBy(*keys).agg(F.map_from_entries(entries).alias("stripe"))


def couple_counts_by_line(lines: DataFrame, vocabulary: Words, d: int = 1) -> DataFrame:
    """``doc_id, line_no, lo, hi, n``: couples counted within each record.

    With a short vocabulary a record's couples are sorted and their runs
    measured where the record is read; nothing is shuffled.
    """
    if d < 0:
        raise ValueError("the distance must not be negative")
    keys = ("doc_id", "line_no")
    listed = short_list(vocabulary)
    if listed is None:
        counted = (
            _couples_of_records(lines, vocabulary, d, keys).groupBy("record", "c.lo", "c.hi")
            .agg(F.count(F.lit(1)).alias("n"), F.max("n").alias("equal"))
        )
        return _as_often(counted, "equal").select("record.doc_id", "record.line_no", "lo", "hi", "n")
    plain = F.transform(_couples(F.col("hits"), d), lambda c: F.struct(c["lo"].alias("lo"), c["hi"].alias("hi")))
    in_order = _hits_of_line(lines, listed, keys).select(*keys, F.array_sort(plain).alias("c"))
    return _runs(in_order, keys).select(*keys, "run.c.lo", "run.c.hi", "run.n")


def _as_often(rows: DataFrame, times: str) -> DataFrame:
    """Each row as often as its column ``times`` says, by arrays of bounded length."""
    last = F.floor((F.col(times) - 1) / RUN)
    runs = rows.withColumn("__run", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    rest = F.least(F.lit(RUN).cast("long"), F.col(times) - F.col("__run") * RUN)
    return runs.withColumn("__one", F.explode(F.sequence(F.lit(1).cast("long"), rest))).drop("__run", "__one")


def _runs(in_order: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``*keys, run``: the runs ``(c, n)`` of equal values in the sorted array ``c``."""
    return _with_starts(in_order, keys).select(*keys, F.explode(_measured()).alias("run"))


def _with_starts(in_order: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``*keys, c, starts``: where the runs of the sorted array ``c`` begin, from 1."""
    size = F.size("c")

    def begins(at: Column) -> Column:
        return (at == 1) | (F.get("c", at - 1) != F.get("c", at - 2))

    starts = F.filter(F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>")), begins)
    return in_order.select(*keys, "c", starts.alias("starts"))


def _measured() -> Column:
    end = F.size("c") + 1
    return F.transform(
        "starts",
        lambda at, k: F.struct(F.get("c", at - 1).alias("c"), (F.coalesce(F.get("starts", k + 1), end) - at).cast("long").alias("n")),
    )


def couple_counts_both_ways(lines: DataFrame, vocabulary: Words, max_d: int) -> DataFrame:
    """``folded, d, lo, hi, n``: couples counted one by one, and line by line first, for every distance.

    With a short vocabulary both come from one pass: a line gives its couples
    and the runs of its sorted couples, and one shuffle sums either kind.
    """
    if max_d < 0:
        raise ValueError("the distance must not be negative")
    listed = short_list(vocabulary)
    if listed is None:
        found = counted_by_block(lines, vocabulary, max_d, ("lo", "hi", "dist"))
        by_line = (
            _couples_of_records(lines, vocabulary, max_d, ("doc_id", "line_no")).groupBy("record", "c.lo", "c.hi", "c.dist")
            .agg(F.sum("n").alias("n")).drop("record")
        )
        both = found.withColumn("folded", F.lit(False)).unionByName(by_line.withColumn("folded", F.lit(True)))
    else:
        in_order = _hits_of_line(lines, listed, ()).select(F.array_sort(_couples(F.col("hits"), max_d)).alias("c"))

        def one(folded: bool, couple: Column, n: Column) -> Column:
            return F.struct(F.lit(folded).alias("folded"), couple.alias("c"), n.alias("n"))

        plain = F.transform("c", lambda c: one(False, c, F.lit(1).cast("long")))
        runs = F.transform(_measured(), lambda r: one(True, r["c"], r["n"]))
        both = _with_starts(in_order, ()).select(F.explode(F.concat(plain, runs)).alias("one")).select(
            "one.folded", "one.c.lo", "one.c.hi", "one.c.dist", "one.n"
        )
    return up_to_distance(both.groupBy("folded", "lo", "hi", "dist").agg(F.sum("n").alias("n")), max_d)


def pairs_by_line(lines: DataFrame, vocabulary: Words, d: int = 1) -> DataFrame:
    """``doc_id, line_no, w1, w2, n``: pairs counted line by line."""
    return pairs(couple_counts_by_line(lines, vocabulary, d))


def refold(by_line: DataFrame) -> DataFrame:
    """``w1, w2, n``: line-by-line couples summed over all lines, then seen from both words."""
    return pairs(by_line.groupBy("lo", "hi").agg(F.sum("n").alias("n")))


def _other_columns(counts: DataFrame) -> list[str]:
    return [c for c in counts.columns if c not in ("lo", "hi", "n")]
