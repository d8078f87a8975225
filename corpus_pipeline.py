"""From raw documents to a training mix, in five stages.

Each stage takes the documents its predecessor kept, written as Parquet and
read again, and returns those it keeps; all but the last return the columns of
``documents``.

Cases.  A null or empty text, or one without letters, goes in the first stage.
Of rows of one id and text one stays, also where the id is null; of rows of one
text the one of smallest id, null last.  Texts of any length are read whole.
Columns beside those of ``documents`` are carried along, whatever their names
and types; where one is called ``copy``, the last stage's is ``copy_2``.  An empty
table gives an empty result.

The stages that run Python bound the session's Arrow batches, so that an
executor's memory outside the heap does not grow with them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import decontamination, language_id, mixing, ngram_join, prefix_free
from tokenloom.session import in_small_batches, shared_folder


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear.

    The model learns from three quarters of the labelled documents, as the
    query does.  Texts without a letter and ambiguous ones go.
    """
    in_small_batches(spark)
    model = language_id.fit(docs.where(language_id.learnable(F.col("doc_id"))))
    return docs.where(language_id.is_clear(model, F.col("text")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar documents: five words, 80 %; repeated rows are a group."""
    in_small_batches(spark)
    return ngram_join.one_per_group(docs, repeated=False)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 50 bytes that earlier ones have; those of which nothing is left go."""
    in_small_batches(spark)
    kept = prefix_free.remove_repeats(docs)
    return kept.where((F.col("__pfp_removed") == 0) | (F.col("__pfp_removed") < F.col("__pfp_bytes"))).select(
        *[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    )


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    in_small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.clean(docs, benchmark)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, with ``copy`` from 0."""
    return mixing.mix_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identified),
    ("similar", distinct),
    ("repeats", unrepeated),
    ("benchmark", decontaminated),
    ("mix", mixed),
]

# Stages 1 to 4 have no SQL; tests hold "similar" and, as to which ids stay,
# "repeats" against brute force, not "language" and "benchmark".
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each keeps is written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
