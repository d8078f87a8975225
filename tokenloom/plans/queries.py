"""The registered queries: every operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators import cooccurrence as cooc
from tokenloom.operators import counting, indexing
from tokenloom.operators.tokens import stem_vocabulary, tokens
from tokenloom.operators.wordlists import drop_words, keep_words
from tokenloom.session import settled_if_possible, shared_folder
from tokenloom.sinks import lines as out
from tokenloom.sources import lists
from tokenloom.sources.lists import DEFAULT_STOP_WORDS
from tokenloom.sources.records import file_lines, spread_small_input, table_lines

STOP = DEFAULT_STOP_WORDS
TOP_WORDS = 50
TOP_TERMS = 100
DISTANCES = (1, 2, 3, 4)
LINE_BYTES = 200
SKIP_PATTERNS = ["[0-9]+", "http[a-z:/.]*", "'s"]
LONG_SKIP_PATTERNS = [f"x{i}y" for i in range(600)] + ["th", "e[rn]"]
# Untidy side files: line ends of another system, blanks, blank lines, repeats.
STOP_LINES = [line for word in STOP for line in (f" {word.upper()}\t\r", "", word)]
BAD_VOCABULARY_LINES = ["", " \t", "\tthe 1"]
BAD_TERM_LINES = ["", "name", "name\t1\t2", "\t\t"]
# Words this frequent make a list too long to stand in a plan.
LONG_LIST_COUNT = 2

Query = Callable[[SparkSession, str], DataFrame]


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_small_input(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_lines(_docs(spark, sf_dir))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return spread_small_input(talk.select(F.col("conv_id").alias("doc_id"), "turn", "text"))


def _turn_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _turns(spark, sf_dir).select(F.concat_ws("-", "doc_id", "turn").alias("doc_id"), "text")
    return table_lines(keyed)


def _as_lines(spark: SparkSession, lines: list[str]) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(F.explode(F.lit(lines)).alias("value"))


def _with_lines(lines: DataFrame, more: list[str]) -> DataFrame:
    """``lines`` and one row for each of ``more``."""
    return _as_lines(lines.sparkSession, more).unionByName(lines)


def _top(records: DataFrame) -> DataFrame:
    return counting.top_words(counting.word_count_no_stop(records, STOP), TOP_WORDS)


def _vocabulary(records: DataFrame) -> DataFrame:
    return _top(records).select("word")


def line_scan(spark, sf_dir):
    return _lines(spark, sf_dir)


def all_tokens(spark, sf_dir):
    return tokens(_lines(spark, sf_dir))


def tokens_no_stop(spark, sf_dir):
    return drop_words(tokens(_lines(spark, sf_dir)), STOP)


def tokens_in_vocab(spark, sf_dir):
    return keep_words(tokens(_lines(spark, sf_dir)), _vocabulary(_docs(spark, sf_dir)), at_most=TOP_WORDS)


def word_count(spark, sf_dir):
    return counting.word_count(_lines(spark, sf_dir))


def word_count_any_case(spark, sf_dir):
    return counting.word_count(_lines(spark, sf_dir), case_sensitive=False)


def word_count_skip(spark, sf_dir):
    return counting.word_count(_lines(spark, sf_dir), case_sensitive=False, skip_patterns=SKIP_PATTERNS)


def word_count_bounded(spark, sf_dir):
    return counting.word_count(table_lines(_docs(spark, sf_dir), max_line_bytes=LINE_BYTES))


def word_count_no_stop(spark, sf_dir):
    return counting.word_count_no_stop(_docs(spark, sf_dir), STOP)


def top50_words(spark, sf_dir):
    return _top(_docs(spark, sf_dir))


def top50_words_text(spark, sf_dir):
    return out.word_lines(_top(_docs(spark, sf_dir)))


def top50_words_conversations(spark, sf_dir):
    return _top(_turns(spark, sf_dir))


def cooc_pairs(d: int) -> Query:
    def query(spark, sf_dir):
        counts = cooc.couple_counts(_lines(spark, sf_dir), _vocabulary(_docs(spark, sf_dir)), d)
        return cooc.pairs(counts)

    return query


def cooc_pairs_text_d2(spark, sf_dir):
    return out.pair_lines(cooc_pairs(2)(spark, sf_dir))


def cooc_pairs_sweep(spark, sf_dir):
    vocabulary = _vocabulary(_docs(spark, sf_dir))
    return cooc.pairs(cooc.couple_counts_by_distance(_lines(spark, sf_dir), vocabulary, max(DISTANCES)))


def cooc_pairs_by_line(spark, sf_dir):
    return cooc.pairs_by_line(_lines(spark, sf_dir), _vocabulary(_docs(spark, sf_dir)), 2)


def cooc_pairs_refold(d: int) -> Query:
    def query(spark, sf_dir):
        return cooc.refold(cooc.couple_counts_by_line(_lines(spark, sf_dir), _vocabulary(_docs(spark, sf_dir)), d))

    return query


def cooc_pairs_turns_long_list_d2(spark, sf_dir):
    """Turns keyed by their conversation alone, with every word of the corpus listed."""
    turns = table_lines(_turns(spark, sf_dir))
    vocabulary = tokens(turns).select(F.col("tok").alias("word")).distinct()
    return cooc.pairs(cooc.couple_counts(turns, vocabulary, 2))


def cooc_matrices_text(spark, sf_dir):
    """All matrices of all distances, as one write lays them out."""
    vocabulary = _vocabulary(_docs(spark, sf_dir))
    counts = cooc.couple_counts_both_ways(_lines(spark, sf_dir), vocabulary, max(DISTANCES))
    # Each layout reads the counts with a filter of its own, so they would be made once for each.
    return out.matrix_lines(settled_if_possible(counts))


def cooc_pairs_from_text_d2(spark, sf_dir):
    """The vocabulary is parsed from the lines that ``top50_words_text`` gives, among lines without a word."""
    vocabulary = lists.parse_vocabulary(_with_lines(top50_words_text(spark, sf_dir), BAD_VOCABULARY_LINES))
    return cooc.pairs(cooc.couple_counts(_lines(spark, sf_dir), vocabulary, 2))


def word_count_skip_long(spark, sf_dir):
    """Hundreds of patterns, parsed from lines."""
    patterns = lists.parse_skip_patterns(_as_lines(spark, LONG_SKIP_PATTERNS))
    return counting.word_count(_lines(spark, sf_dir), case_sensitive=False, skip_patterns=patterns)


def word_count_stop_lines(spark, sf_dir):
    """The stop words are parsed from untidy lines."""
    stop = lists.parse_stop_words(_as_lines(spark, STOP_LINES))
    return counting.word_count_no_stop(_docs(spark, sf_dir), stop)


def word_count_bounded_files(spark, sf_dir):
    """The texts are written to files, and lines of these are bounded as they are read."""
    folder = f"{shared_folder(spark)}/bounded-{uuid.uuid4().hex}"
    _docs(spark, sf_dir).select("text").write.text(folder)
    return counting.word_count(file_lines(spark, folder, LINE_BYTES))


def cooc_pairs_long_list_d2(spark, sf_dir):
    counts = counting.word_count_no_stop(_docs(spark, sf_dir), STOP)
    vocabulary = counts.filter(F.col("n") >= LONG_LIST_COUNT).select("word")
    return cooc.pairs(cooc.counted_by_block(_lines(spark, sf_dir), vocabulary, 2))


def cooc_pairs_conversations_d2(spark, sf_dir):
    counts = cooc.couple_counts(_turn_lines(spark, sf_dir), _vocabulary(_turns(spark, sf_dir)), 2)
    return cooc.pairs(counts)


def cooc_stripes_rows(d: int) -> Query:
    def query(spark, sf_dir):
        counts = cooc.couple_counts(_lines(spark, sf_dir), _vocabulary(_docs(spark, sf_dir)), d)
        return cooc.stripe_rows(counts)

    return query


def cooc_stripes_text(d: int) -> Query:
    def query(spark, sf_dir):
        return out.stripe_lines(cooc.stripes(cooc_stripes_rows(d)(spark, sf_dir)))

    return query


def cooc_stripes_sweep(spark, sf_dir):
    vocabulary = _vocabulary(_docs(spark, sf_dir))
    counts = cooc.couple_counts_by_distance(_lines(spark, sf_dir), vocabulary, max(DISTANCES))
    maps = cooc.stripes(cooc.stripe_rows(counts))
    return maps.select("d", "word", out.stripe_text(F.col("stripe")).alias("stripe"))


def stem_vocab(spark, sf_dir):
    return stem_vocabulary(_docs(spark, sf_dir))


def doc_freq(spark, sf_dir):
    return indexing.doc_freq(_docs(spark, sf_dir), STOP)


def doc_freq_conversations(spark, sf_dir):
    return indexing.doc_freq(_turns(spark, sf_dir), STOP)


def top100_df(spark, sf_dir):
    return indexing.top_doc_freq(_docs(spark, sf_dir), STOP, TOP_TERMS)


def top100_df_text(spark, sf_dir):
    return out.frequency_lines(top100_df(spark, sf_dir))


def _of_top_terms(operator, spark, sf_dir):
    """``operator`` on the documents and their top terms, their words stemmed once for both."""
    docs = _docs(spark, sf_dir)
    stems = settled_if_possible(indexing.stem_counts(docs))
    return operator(docs, indexing.top_doc_freq(docs, STOP, TOP_TERMS, stems), at_most=TOP_TERMS, stems=stems)


def term_freq(spark, sf_dir):
    return _of_top_terms(indexing.term_freq, spark, sf_dir)


def _scores(spark, sf_dir):
    return _of_top_terms(indexing.tf_score, spark, sf_dir)


def tf_score(spark, sf_dir):
    return _scores(spark, sf_dir).withColumn("score", F.round("score", 4))


def tf_score_from_text(spark, sf_dir):
    """The term table is parsed from the lines that ``top100_df_text`` gives, among lines of another form."""
    terms = lists.parse_term_table(_with_lines(top100_df_text(spark, sf_dir), BAD_TERM_LINES))
    scores = indexing.tf_score(_docs(spark, sf_dir), terms, at_most=TOP_TERMS)
    return scores.withColumn("score", F.round("score", 4))


def tf_score_text(spark, sf_dir):
    return out.score_lines(_scores(spark, sf_dir))


def tf_score_head(spark, sf_dir):
    return out.score_head(tf_score(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "line_scan": line_scan,
    "tokens": all_tokens,
    "tokens_no_stop": tokens_no_stop,
    "tokens_in_vocab": tokens_in_vocab,
    "word_count": word_count,
    "word_count_any_case": word_count_any_case,
    "word_count_skip": word_count_skip,
    "word_count_skip_long": word_count_skip_long,
    "word_count_bounded": word_count_bounded,
    "word_count_bounded_files": word_count_bounded_files,
    "word_count_stop_lines": word_count_stop_lines,
    "word_count_no_stop": word_count_no_stop,
    "top50_words": top50_words,
    "top50_words_text": top50_words_text,
    "top50_words_conversations": top50_words_conversations,
    **{f"cooc_pairs_d{d}": cooc_pairs(d) for d in DISTANCES},
    "cooc_pairs_text_d2": cooc_pairs_text_d2,
    "cooc_pairs_sweep": cooc_pairs_sweep,
    "cooc_matrices_text": cooc_matrices_text,
    "cooc_pairs_from_text_d2": cooc_pairs_from_text_d2,
    "cooc_pairs_by_line": cooc_pairs_by_line,
    "cooc_pairs_refold": cooc_pairs_refold(2),
    **{f"cooc_pairs_refold_d{d}": cooc_pairs_refold(d) for d in DISTANCES},
    "cooc_pairs_turns_long_list_d2": cooc_pairs_turns_long_list_d2,
    "cooc_pairs_long_list_d2": cooc_pairs_long_list_d2,
    "cooc_pairs_conversations_d2": cooc_pairs_conversations_d2,
    **{f"cooc_stripes_rows_d{d}": cooc_stripes_rows(d) for d in DISTANCES},
    **{f"cooc_stripes_text_d{d}": cooc_stripes_text(d) for d in DISTANCES},
    "cooc_stripes_sweep": cooc_stripes_sweep,
    "stem_vocab": stem_vocab,
    "doc_freq": doc_freq,
    "doc_freq_conversations": doc_freq_conversations,
    "top100_df": top100_df,
    "top100_df_text": top100_df_text,
    "term_freq": term_freq,
    "tf_score": tf_score,
    "tf_score_from_text": tf_score_from_text,
    "tf_score_text": tf_score_text,
    "tf_score_head": tf_score_head,
}
