"""Score arithmetic and its printed form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the corpus size the score assumes, whatever the corpus.
ASSUMED_DOCS = 10_000


def term_score(tf: Column, df: Column, n_docs: int = ASSUMED_DOCS) -> Column:
    """``tf * log10(n_docs / df + 1)``."""
    return tf * F.log10(F.lit(float(n_docs)) / df + F.lit(1.0))


def four_decimals(value: Column) -> Column:
    return F.format_string("%.4f", value)
