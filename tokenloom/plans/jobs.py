"""Jobs from text files to text files, one by one and all together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.scoring import ASSUMED_DOCS
from tokenloom.operators import cooccurrence as cooc
from tokenloom.operators import counting, indexing
from tokenloom.session import settled_if_possible
from tokenloom.sinks import lines as out
from tokenloom.sources import lists
from tokenloom.sources.records import file_lines


def word_count_job(
    spark: SparkSession,
    corpus: str,
    target: str,
    case_sensitive: bool = True,
    skip_patterns: str | list[str] | None = None,
    max_line_bytes: int | None = None,
) -> None:
    """Count all words.  ``skip_patterns`` names files of regular expressions."""
    patterns = lists.read_skip_patterns(spark, skip_patterns) if skip_patterns else []
    lines = file_lines(spark, corpus, max_line_bytes)
    counts = counting.word_count(lines, case_sensitive, patterns)
    out.write_lines(out.word_lines(counts.orderBy("word")), target)


def top_words_job(spark: SparkSession, corpus: str, target: str, stop_words: str, k: int = 50) -> None:
    counts = counting.word_count_no_stop(file_lines(spark, corpus), lists.read_stop_words(spark, stop_words))
    out.write_lines(out.word_lines(counting.top_words(counts, k)), target)


def pairs_job(
    spark: SparkSession, corpus: str, target: str, vocabulary: str, d: int = 1, fold_by_line: bool = False
) -> None:
    """Pairs within ``d``; ``fold_by_line`` counts each line on its own first."""
    lines, listed = file_lines(spark, corpus), lists.read_vocabulary(spark, vocabulary)
    if fold_by_line:
        found = cooc.refold(cooc.couple_counts_by_line(lines, listed, d))
    else:
        found = cooc.pairs(cooc.couple_counts(lines, listed, d))
    out.write_lines(out.pair_lines(found), target)


def stripes_job(spark: SparkSession, corpus: str, target: str, vocabulary: str, d: int = 1) -> None:
    lines, listed = file_lines(spark, corpus), lists.read_vocabulary(spark, vocabulary)
    out.write_lines(_stripes(cooc.couple_counts(lines, listed, d)), target)


def doc_freq_job(spark: SparkSession, corpus: str, target: str, stop_words: str) -> None:
    frequencies = indexing.doc_freq(file_lines(spark, corpus), lists.read_stop_words(spark, stop_words))
    out.write_lines(out.frequency_lines(frequencies.orderBy("stem")), target)


def top_terms_job(spark: SparkSession, frequencies: str, target: str, k: int = 100) -> None:
    terms = indexing.top_terms(lists.read_term_table(spark, frequencies), k)
    out.write_lines(out.frequency_lines(terms), target)


def score_job(
    spark: SparkSession, corpus: str, target: str, terms: str, n_docs: int = ASSUMED_DOCS, ordered: bool = True
) -> None:
    """Scores by document and term, or without the sort in whatever order they come."""
    scores = indexing.tf_score(file_lines(spark, corpus), lists.read_term_table(spark, terms), n_docs)
    out.write_lines(out.score_lines(scores, ordered), target)


def matrices_job(
    spark: SparkSession, corpus: str, target: str, vocabulary: str, distances: Sequence[int] = (1, 2, 3, 4)
) -> None:
    """Pairs, stripes and pairs folded by line for all ``distances``, as ``layout=.../d=.../`` below ``target``.

    One pass over the corpus and one write.
    """
    lines, listed = file_lines(spark, corpus), lists.read_vocabulary(spark, vocabulary)
    counts = cooc.couple_counts_both_ways(lines, listed, max(distances)).filter(F.col("d").isin(list(distances)))
    # Read three times below; couples of listed words only, so small beside the corpus.
    out.write_lines(out.matrix_lines(settled_if_possible(counts)), target, ("layout", "d"))


def run_all(
    spark: SparkSession,
    corpus: str,
    target: str,
    stop_words: str,
    distances: Sequence[int] = (1, 2, 3, 4),
    n_docs: int = ASSUMED_DOCS,
    ordered: bool = True,
) -> None:
    """Every result under ``target``, in four passes over the corpus.

    What one step hands to the next is read back from what it wrote.
    """
    top_words_job(spark, corpus, f"{target}/top_words", stop_words)
    matrices_job(spark, corpus, f"{target}/matrices", f"{target}/top_words", distances)
    doc_freq_job(spark, corpus, f"{target}/doc_freq", stop_words)
    top_terms_job(spark, f"{target}/doc_freq", f"{target}/top_terms")
    score_job(spark, corpus, f"{target}/scores", f"{target}/top_terms", n_docs, ordered)


def _stripes(counts: DataFrame) -> DataFrame:
    return out.stripe_lines(cooc.stripes(cooc.stripe_rows(counts)))
