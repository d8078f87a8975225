"""Word counts and the most frequent words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.text import counted_words, strip_patterns, words
from tokenloom.operators.wordlists import Words, fits_broadcast, is_small_list, stop_list, word_frame


def word_count(lines: DataFrame, case_sensitive: bool = True, skip_patterns: Sequence[str] = ()) -> DataFrame:
    """``word, n`` over all lines, the empty words of a plain split included.

    Skip patterns are removed after lower-casing and before splitting.
    """
    text = F.col("text") if case_sensitive else F.lower("text")
    stripped = strip_patterns(lines.select(text.alias("text")), skip_patterns)
    found = stripped.select(F.explode(counted_words(F.col("text"))).alias("word"))
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_no_stop(records: DataFrame, stop_words: Words) -> DataFrame:
    """``word, n`` of the lower-case words that are not stop words."""
    found = records.select(F.explode(words(F.col("text"))).alias("word"))
    stop_words = stop_list(stop_words)
    stop = word_frame(stop_words, records, "word")
    if is_small_list(stop_words) or (isinstance(stop_words, DataFrame) and fits_broadcast(stop)):
        return _counted(found.join(F.broadcast(stop), "word", "left_anti"))
    # Too long a list to broadcast: counted words are one row each, so no key is hot.
    return _counted(found).join(stop, "word", "left_anti")


def _counted(found: DataFrame) -> DataFrame:
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def top_words(counts: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` highest distinct counts, each with the last of its words in byte order."""
    one_per_count = counts.groupBy("n").agg(F.max("word").alias("word"))
    return one_per_count.select("word", "n").orderBy(F.desc("n")).limit(k)
