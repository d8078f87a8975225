"""What the physical plans must and must not hold."""

from __future__ import annotations

import re

import pytest
from conftest import SF_DIR

from tokenloom.operators.indexing import doc_freq, tf_score
from tokenloom.plans.queries import QUERIES, STOP
from tokenloom.sources.records import spread_small_input


def plan(spark, name: str) -> str:
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> list[str]:
    return re.findall(r"Exchange (?:hash|range)partitioning\([^)]*\)", text)


@pytest.mark.parametrize("d", [1, 2, 3, 4])
def test_pairs_shuffle_counted_couples_once(spark, d):
    text = plan(spark, f"cooc_pairs_d{d}")
    assert len(shuffles(text)) == 1 and "partial_sum" in text
    assert "Join" not in text and "Window" not in text


def test_sweep_reads_the_text_once(spark):
    text = plan(spark, "cooc_pairs_sweep")
    assert text.count("FileScan") == 1 and len(shuffles(text)) == 2


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_common_rules(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text
    scans = re.findall(r"ReadSchema: struct<([^>]*)", text)
    columns = {column.split(":")[0] for scan in scans for column in scan.split(",") if column}
    assert columns <= {"doc_id", "text", "conv_id", "turn", "value"}


@pytest.mark.parametrize("name", ["word_count", "word_count_no_stop", "doc_freq", "term_freq", "cooc_pairs_d2"])
def test_counts_fold_before_they_move(spark, name):
    assert re.search("partial_(count|sum)", plan(spark, name))


@pytest.mark.parametrize("name", ["tokens_no_stop", "tokens_in_vocab", "word_count_no_stop", "doc_freq", "tf_score"])
def test_side_tables_are_broadcast(spark, name):
    text = plan(spark, name)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_document_frequency_never_groups_documents_by_stem_alone(spark):
    text = plan(spark, "doc_freq")
    keys = [set(re.findall(r"(doc_id|stem)#", shuffle)) for shuffle in shuffles(text)]
    assert {"doc_id", "stem"} in keys
    assert "collect_set" not in text


def test_top_k_is_the_only_global_step(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top50_words")
    assert "TakeOrderedAndProject" in plan(spark, "top100_df")


def test_only_small_inputs_are_spread(spark):
    many = spark.range(0, 100, 1, 64)
    assert spread_small_input(many) is many
    assert spread_small_input(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_bucketed_documents_stay_where_they_are(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    bucketed = docs.write.bucketBy(8, "doc_id").option("path", str(tmp_path / "docs"))
    bucketed.mode("overwrite").saveAsTable("bucketed_docs")
    try:
        table = spark.table("bucketed_docs")
        frequencies = doc_freq(table, STOP)
        text = frequencies._jdf.queryExecution().executedPlan().toString()
        assert len(shuffles(text)) == 1 and re.search(r"hashpartitioning\(stem#\d+, \d+\)", text)
        terms = spark.createDataFrame([("name", 2)], "stem string, df long")
        scores = tf_score(table, terms, at_most=1)
        assert not shuffles(scores._jdf.queryExecution().executedPlan().toString())
        assert sorted(frequencies.collect()) == sorted(doc_freq(docs, STOP).collect())
    finally:
        spark.sql("DROP TABLE bucketed_docs")


def test_matrices_read_the_text_once(spark):
    # The counts are kept, so what is left of the plan has no text in it.
    assert "regexp_extract_all" not in plan(spark, "cooc_matrices_text")


@pytest.mark.parametrize("name", ["top100_df", "tf_score"])
def test_top_terms_stem_no_occurrence(spark, name):
    assert "RLIKE" not in plan(spark, name)
