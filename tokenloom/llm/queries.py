"""One registered query per operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import context_tree, cross_polytope, decontamination, language_id, mixing, multiset_hash, ngram_join, prefix_free, spelling_trie, template_extraction, token_alignment, token_rollup, warc_zip
from tokenloom.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(language_id.learnable(F.col("doc_id"))))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return language_id.predict(model, docs, "doc_id").select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.round_trip(spark, table(spark, sf_dir, "pages")).drop("payload", "url")


def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.edit_report(table(spark, sf_dir, "documents"))


def extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_extraction.extract(table(spark, sf_dir, "pages"))


def ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, sf_dir, "documents"), width=3, percent=90)


def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_free.repeat_report(table(spark, sf_dir, "documents"))


def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents come in counted in words, with the length they state as their bytes, and lose their copies; where the bytes differ they are revised.

    Two batches are sent twice, and what is there before the revision is made a base.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/rollup-{uuid.uuid4().hex}"
    words = token_rollup.words(docs)
    stated = F.coalesce("n_chars", F.lit(0))
    wrong = docs.where(stated != F.coalesce(F.octet_length("text"), F.lit(0)))
    batches = {
        "load": token_rollup.inserted(words),
        "bytes": token_rollup.inserted(token_rollup.counts(docs, "bytes-1", stated)),
        "copies": token_rollup.deleted(token_rollup.copies(docs).withColumn("tokenizer", F.lit("words-1"))),
        "recount": token_rollup.revised(token_rollup.counts(wrong, "bytes-1", stated), token_rollup.utf8_bytes(wrong)),
    }
    for name in ("load", "bytes", "load", "copies"):
        token_rollup.commit(folder, name, batches[name])
    token_rollup.compact(spark, folder)
    for name in ("recount", "load", "recount"):
        token_rollup.commit(folder, name, batches[name])
    return token_rollup.totals(spark, folder)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    left_out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    return context_tree.score_texts(table(spark, sf_dir, "documents"), ~left_out, left_out)


def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_trie.variants(spelling_trie.misspelt_words(table(spark, sf_dir, "documents")))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": mix,
    "op2_token_rollup": rollup,
    "op3_ngram_join": ngram,
    "op4_language": language,
    "op5_warc_zip": warc,
    "op6_fingerprint": fingerprint,
    "op7_context_tree": scores,
    "op8_leaks": leaks,
    "op9_extraction": extraction,
    "op10_prefix_free": repeats,
    "op11_spelling_trie": spelling,
    "op12_cross_polytope": neighbours,
    "op13_token_alignment": alignment,
}
