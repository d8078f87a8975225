"""Document frequency, term frequency and score of stemmed words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.porter import with_stem
from tokenloom.functions.scoring import ASSUMED_DOCS, term_score
from tokenloom.functions.text import words
from tokenloom.operators.tokens import stem_vocabulary
from tokenloom.operators.wordlists import Words, drop_words, fits_broadcast, salted_join, settled_if_short, stop_list
from tokenloom.session import names_shared_folder, settled_if_possible


def doc_freq(records: DataFrame, stop_words: Words) -> DataFrame:
    """``stem, df``: in how many documents a stem occurs.

    Stop words go before stemming, and stems that are stop words after it.
    Repeated words go record by record before anything moves; what is shuffled
    is each (stem, document) once per task, keyed by both, so that no frequent
    stem ends up in one place.  Over a table bucketed by ``doc_id`` even that
    shuffle goes away.
    """
    stop_words = stop_list(stop_words)
    found = records.select("doc_id", F.explode(F.array_distinct(words(F.col("text")))).alias("tok"))
    stemmed = with_stem(drop_words(found, stop_words)).select("doc_id", "stem")
    kept = drop_words(stemmed, stop_words, "stem")
    return kept.distinct().groupBy("stem").agg(F.count(F.lit(1)).alias("df"))


def top_terms(frequencies: DataFrame, k: int = 100) -> DataFrame:
    """The ``k`` stems of highest document frequency, ties in byte order."""
    return frequencies.orderBy(F.desc("df"), F.asc("stem")).limit(k)


def stem_counts(records: DataFrame) -> DataFrame:
    """``tok, n, stem``: every distinct word, in how many records it occurs, and its stem."""
    found = records.select(F.explode(F.array_distinct(words(F.col("text")))).alias("tok"))
    return with_stem(found.groupBy("tok").agg(F.count(F.lit(1)).alias("n")))


def top_doc_freq(records: DataFrame, stop_words: Words, k: int = 100, stems: DataFrame | None = None) -> DataFrame:
    """:func:`top_terms` of :func:`doc_freq`, in documents counted only for stems that may be among them.

    A stem is in at least as many documents as its most frequent word and in at
    most as many as its words are together.  A stem whose words together stay
    below ``k`` stems' most frequent ones is none of the top.  The others are
    few, and their words alone are looked up in the documents.  Where records
    share an id, where no folder is named to keep counted words in, or where
    the words left are many, all stems are counted.  ``stems`` are the
    :func:`stem_counts` of the records if they are at hand.
    """
    stop_words = stop_list(stop_words)
    everything = doc_freq(records, stop_words)
    if not names_shared_folder(records.sparkSession):
        return top_terms(everything, k)
    if not records.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1").isEmpty():
        return top_terms(everything, k)
    stems = settled_if_possible(stem_counts(records) if stems is None else stems)
    kept = drop_words(drop_words(stems, stop_words), stop_words, "stem")
    bounds = settled_if_possible(kept.groupBy("stem").agg(F.max("n").alias("least"), F.sum("n").alias("most")))
    surest = bounds.orderBy(F.desc("least")).limit(k).collect()
    least = surest[-1].least if len(surest) == k else 0
    candidates = bounds.where(F.col("most") >= least).select("stem")
    listed = settled_if_possible(kept.join(candidates, "stem").select("tok", "stem"))
    if not fits_broadcast(listed):
        return top_terms(everything, k)
    found = records.select("doc_id", F.explode(F.array_distinct(words(F.col("text")))).alias("tok"))
    in_documents = found.join(F.broadcast(listed), "tok").select("doc_id", "stem").distinct()
    return top_terms(in_documents.groupBy("stem").agg(F.count(F.lit(1)).alias("df")), k)


def term_freq(
    records: DataFrame, terms: DataFrame, at_most: int | None = None, stems: DataFrame | None = None
) -> DataFrame:
    """``doc_id, stem, df, tf`` for the stems in ``terms``.

    Stop words are not removed here: one whose stem is listed counts.
    ``at_most`` is a bound on the length of ``terms`` if one is known, ``stems``
    are the words of the records with their stems if they are at hand.
    """
    found = records.select("doc_id", F.explode(words(F.col("text"))).alias("tok"))
    tf = F.count(F.lit(1)).alias("tf")
    # The words of a stem are looked up, so no occurrence is stemmed.
    stems = stem_vocabulary(records) if stems is None else stems.select("tok", "stem")
    terms = settled_if_short(terms, at_most)
    listed = stems.join(F.broadcast(terms), "stem") if fits_broadcast(terms) else stems.join(terms, "stem")
    surface = settled_if_possible(listed.select("tok", "stem", "df"))
    if fits_broadcast(surface):
        return found.join(F.broadcast(surface), "tok").groupBy("doc_id", "stem", "df").agg(tf)
    # Counted first, a frequent word of a long document is one row.
    counted = found.groupBy("doc_id", "tok").agg(tf)
    joined = salted_join(counted, surface, "tok", "inner")
    return joined.groupBy("doc_id", "stem", "df").agg(F.sum("tf").alias("tf"))


def tf_score(
    records: DataFrame, terms: DataFrame, n_docs: int = ASSUMED_DOCS, at_most: int | None = None,
    stems: DataFrame | None = None,
) -> DataFrame:
    """``doc_id, term, score``."""
    counted = term_freq(records, terms, at_most, stems)
    return counted.select(
        "doc_id", F.col("stem").alias("term"), term_score(F.col("tf"), F.col("df"), n_docs).alias("score")
    )
