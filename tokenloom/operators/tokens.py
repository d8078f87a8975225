"""Words as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.porter import with_stem
from tokenloom.functions.text import words


def tokens(lines: DataFrame) -> DataFrame:
    """``doc_id, line_no, pos, tok``: every word with its position in its line."""
    return lines.select("doc_id", "line_no", F.posexplode(words(F.col("text"))).alias("pos", "tok"))


def stem_vocabulary(records: DataFrame) -> DataFrame:
    """``tok, stem``: every distinct word, stemmed once."""
    return with_stem(records.select(F.explode(words(F.col("text"))).alias("tok")).distinct())
