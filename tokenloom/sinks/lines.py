"""Results as text lines, and writing them.

Each ``*_lines`` gives one column ``value``, sorted by the line's key where the
order is part of the format.  Sorting is a range partitioning: every part file
is sorted and so is the sequence of parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.scoring import four_decimals
from tokenloom.operators import cooccurrence as cooc


def _tabbed(*fields: Column) -> Column:
    return F.concat_ws("\t", *fields).alias("value")


def word_lines(counts: DataFrame) -> DataFrame:
    """``word<TAB>n`` in the order given."""
    return counts.select(_tabbed(F.col("word"), F.col("n")))


def pair_key() -> Column:
    """A pair as written: the order of pairs is that of the joined text."""
    return F.concat_ws(",", "w1", "w2")


def pair_lines(pair_counts: DataFrame) -> DataFrame:
    """``w1,w2<TAB>n`` sorted by the pair as written."""
    keyed = pair_counts.select(pair_key().alias("pair"), "n")
    return keyed.orderBy("pair").select(_tabbed(F.col("pair"), F.col("n")))


def stripe_text(stripe: Column) -> Column:
    """``{a:1, b:2}`` with the neighbours in byte order."""
    entries = F.transform(
        F.array_sort(F.map_entries(stripe)), lambda e: F.concat_ws(":", e["key"], e["value"])
    )
    return F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))


def stripe_lines(stripe_maps: DataFrame) -> DataFrame:
    """``word<TAB>{a:1, b:2}`` sorted by word."""
    return stripe_maps.orderBy("word").select(_tabbed(F.col("word"), stripe_text(F.col("stripe"))))


def matrix_lines(counts: DataFrame) -> DataFrame:
    """``layout, d, value``: pairs, stripes and pairs folded by line, of every distance, as their lines.

    Takes the ``folded, d, lo, hi, n`` of :func:`cooccurrence.couple_counts_both_ways`.
    Rows are in order of layout, distance and the line's key, so one range
    partitioning sorts all matrices.
    """
    both = cooc.pairs(counts).select(
        F.when(F.col("folded"), "folded_pairs").otherwise("pairs").alias("layout"), "d",
        pair_key().alias("key"), F.col("n").cast("string").alias("cells"),
    )
    maps = cooc.stripes(cooc.stripe_rows(counts.filter(~F.col("folded")).drop("folded")))
    rows = both.unionByName(maps.select(
        F.lit("stripes").alias("layout"), "d", F.col("word").alias("key"), stripe_text(F.col("stripe")).alias("cells")
    ))
    return rows.orderBy("layout", "d", "key").select("layout", "d", _tabbed(F.col("key"), F.col("cells")))


def frequency_lines(frequencies: DataFrame) -> DataFrame:
    """``stem<TAB>df`` in the order given."""
    return frequencies.select(_tabbed(F.col("stem"), F.col("df")))


def score_lines(scores: DataFrame, ordered: bool = True) -> DataFrame:
    """``doc_id<TAB>term<TAB>score``, sorted by document and term unless told otherwise."""
    rows = scores.orderBy("doc_id", "term") if ordered else scores
    return rows.select(_tabbed(F.col("doc_id"), F.col("term"), four_decimals(F.col("score"))))


def score_head(scores: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows of the score table by document and term."""
    return scores.orderBy("doc_id", "term").limit(rows)


def write_lines(lines: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Write the column ``value`` as text; an existing ``path`` is an error.

    With columns ``by`` there is a folder ``by=value`` for each of their values,
    all from one write.
    """
    lines.write.mode("errorifexists").partitionBy(*by).text(path)
