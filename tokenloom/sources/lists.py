"""Side lists: stop words, vocabulary, term table, skip patterns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# English function words, the stop list used where none is given.
DEFAULT_STOP_WORDS = """
a about above after again against all also am an and any are as at be because
been before being below between both but by can could did do does doing down
during each few for from further had has have having he her here hers herself
him himself his how i if in into is it it's its itself just me more most my
myself no nor not now of off on once only or other our ours ourselves out over
own same she should so some such than that the their theirs them themselves
then there these they this those through to too under until up very was we
were what when where which while who whom why will with would you your yours
yourself yourselves
""".split()

# A list of words stands in a plan up to this length; a longer one is a table of rows.
LITERAL_WORDS = 2_000


def _trimmed(column: str):
    return F.regexp_replace(column, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def word_table(spark: SparkSession, words: Iterable[str]) -> DataFrame:
    """A one-column table ``word`` of the given words."""
    listed = sorted(set(words))
    if len(listed) > LITERAL_WORDS:
        return spark.createDataFrame([(w,) for w in listed], "word string")
    return spark.range(0, 1, 1, 1).select(F.explode(F.lit(listed)).alias("word"))


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    return parse_stop_words(spark.read.text(path))


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return parse_vocabulary(spark.read.text(path))


def read_term_table(spark: SparkSession, path: str) -> DataFrame:
    return parse_term_table(spark.read.text(path))


def read_skip_patterns(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The regular expressions in ``paths``, in file order."""
    patterns: dict[str, None] = {}
    for path in [paths] if isinstance(paths, str) else paths:
        patterns |= dict.fromkeys(parse_skip_patterns(spark.read.text(path)))
    return list(patterns)


# What follows takes lines, a frame with the text column ``value``, wherever they come from.


def parse_stop_words(lines: DataFrame) -> DataFrame:
    """``word``: one word per line, trimmed and in lower case; blank lines are skipped."""
    words = lines.select(F.lower(_trimmed("value")).alias("word"))
    return words.filter("word <> ''").distinct()


def parse_vocabulary(lines: DataFrame) -> DataFrame:
    """``word``: the first blank-separated field of each line, as written."""
    words = lines.select(F.split("value", r"\s+")[0].alias("word"))
    return words.filter("word <> ''").distinct()


def parse_term_table(lines: DataFrame) -> DataFrame:
    """``stem, df`` from tab-separated lines of two fields; other lines are skipped.

    A count that is no integer, or below 1, is an error.  Of several lines for a
    stem the last one in the order of ``lines`` holds.
    """
    fields = F.split(F.regexp_replace("value", r"\t+$", ""), "\t")
    rows = lines.select(fields.alias("f"), F.monotonically_increasing_id().alias("at"))
    number = F.when(F.col("f")[1].rlike(r"^[+-]?\d+$"), F.col("f")[1].cast("long")).otherwise(
        F.raise_error(F.concat(F.lit("document frequency is not a number: "), F.col("f")[1]))
    )
    number = F.when(number >= 1, number).otherwise(
        F.raise_error(F.concat(F.lit("document frequency is below 1: "), F.col("f")[0], F.lit(" "), F.col("f")[1]))
    )
    return (
        rows.filter(F.size("f") == 2)
        .select(F.col("f")[0].alias("stem"), number.alias("df"), "at")
        .groupBy("stem")
        .agg(F.max_by("df", "at").alias("df"))
    )


def parse_skip_patterns(lines: DataFrame) -> list[str]:
    """The regular expressions, one per line, each once, in the order of ``lines``."""
    return list(dict.fromkeys(row.value for row in lines.select("value").toLocalIterator()))
