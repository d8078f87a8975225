from __future__ import annotations

import random
import re
import time
from collections import Counter

import model
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tokenloom import session
from tokenloom.operators import cooccurrence as cooc
from tokenloom.operators import wordlists
from tokenloom.operators.counting import top_words
from tokenloom.operators.indexing import term_freq
from tokenloom.plans.queries import QUERIES
from tokenloom.sources.lists import word_table


def as_counter(df, *keys):
    return Counter({tuple(row[k] for k in keys): row.n for row in df.collect()})


def pair_counts(df, vocabulary, d):
    return as_counter(cooc.pairs(cooc.couple_counts(df, vocabulary, d)), "w1", "w2")


def stripe_counts(df, vocabulary, d):
    return as_counter(cooc.stripe_rows(cooc.couple_counts(df, vocabulary, d)), "word", "neighbour")


def random_lines(seed: int, n: int = 60) -> list[str]:
    rng = random.Random(seed)
    return [
        " ".join(rng.choice(["hot"] * 6 + ["a", "b", "c", "A", "out", "é"]) for _ in range(rng.randint(0, 40)))
        for _ in range(n)
    ]


VOCABULARY = ["hot", "a", "b", "c", "never"]


def test_raw_distance(lines):
    df = lines({"x": ["a x b"]})
    assert pair_counts(df, ["a", "b"], 1) == {}
    assert pair_counts(df, ["a", "b"], 2) == {("a", "b"): 1, ("b", "a"): 1}


def test_lines_do_not_touch(lines):
    assert pair_counts(lines({"x": ["a", "b"], "y": ["a"]}), ["a", "b"], 4) == {}


def test_equal_neighbours(lines):
    df = lines({"x": ["a a b"]})
    assert pair_counts(df, ["a", "b"], 1) == {("a", "b"): 1, ("b", "a"): 1}
    maps = cooc.stripes(cooc.stripe_rows(cooc.couple_counts(df, ["a", "b"], 1))).collect()
    assert {r.word: r.stripe for r in maps} == {"a": {"a": 2, "b": 1}, "b": {"a": 1}}


def test_vocabulary_is_taken_as_written(lines):
    df = lines({"x": ["A b"]})
    assert pair_counts(df, ["A", "b"], 1) == {}
    assert pair_counts(df, ["a", "b"], 1) == {("a", "b"): 1, ("b", "a"): 1}


@pytest.mark.parametrize("d", [0, 1, 2, 3, 4, 50])
def test_against_the_model(lines, d):
    found = random_lines(d)
    df = lines({"x": found[:30], "y": found[30:]})
    assert pair_counts(df, VOCABULARY, d) == model.pairs(found, set(VOCABULARY), d)
    assert stripe_counts(df, VOCABULARY, d) == model.stripes(found, set(VOCABULARY), d)


def test_negative_distance(lines):
    with pytest.raises(ValueError):
        cooc.couples(lines({"x": ["a"]}), ["a"], -1)


@pytest.mark.parametrize(("d", "block"), [(1, 1), (1, 4), (3, 4), (4, 4), (5, 3), (2, 4096)])
def test_blocks_lose_and_double_nothing(spark, lines, d, block):
    found = random_lines(d + block)
    df = lines({"x": found})
    for vocabulary in (VOCABULARY, word_table(spark, VOCABULARY)):
        by_block = cooc.couples_by_block(df, vocabulary, d, block=block).groupBy("lo", "hi").agg(F.sum("n").alias("n"))
        ours = as_counter(cooc.stripe_rows(by_block), "word", "neighbour")
        assert ours == model.stripes(found, set(VOCABULARY), d)


def test_long_lists_take_the_block_path(spark, lines, monkeypatch):
    found = random_lines(11)
    monkeypatch.setattr(wordlists, "LITERAL_WORDS", 2)
    df = lines({"x": found})
    counts = cooc.couple_counts(df, word_table(spark, VOCABULARY), 3)
    assert "block" in counts._jdf.queryExecution().analyzed().toString()
    assert as_counter(cooc.pairs(counts), "w1", "w2") == model.pairs(found, set(VOCABULARY), 3)


def test_sweep_equals_single_distances(lines):
    found = random_lines(5)
    df = lines({"x": found})
    sweep = cooc.couple_counts_by_distance(df, VOCABULARY, 4)
    pairs = as_counter(cooc.pairs(sweep), "d", "w1", "w2")
    stripes = as_counter(cooc.stripe_rows(sweep), "d", "word", "neighbour")
    for d in (1, 2, 3, 4):
        assert {k[1:]: n for k, n in pairs.items() if k[0] == d} == model.pairs(found, set(VOCABULARY), d)
        assert {k[1:]: n for k, n in stripes.items() if k[0] == d} == model.stripes(found, set(VOCABULARY), d)


def test_folds_agree(lines):
    found = random_lines(6)
    df = lines({"x": found[:20], "y": found[20:]})
    by_line = cooc.pairs_by_line(df, VOCABULARY, 2)
    for doc, part in (("x", found[:20]), ("y", found[20:])):
        for i, line in enumerate(part):
            rows = by_line.filter((F.col("doc_id") == doc) & (F.col("line_no") == i)) if i < 3 else None
            if rows is not None:
                assert as_counter(rows, "w1", "w2") == model.pairs([line], set(VOCABULARY), 2)
    folded = cooc.refold(cooc.couple_counts_by_line(df, VOCABULARY, 2))
    assert as_counter(folded, "w1", "w2") == pair_counts(df, VOCABULARY, 2)


@pytest.mark.parametrize("unused", [0, 2_001])
def test_records_that_share_an_id_stay_apart(spark, unused):
    df = spark.createDataFrame([("k", 0, t) for t in ("a x", "b y", "z a")], "doc_id string, line_no long, text string")
    listed = ["a", "b", "x", "y", "z"] + [f"unused{i}" for i in range(unused)]
    found = {(r.w1, r.w2): r.n for r in cooc.pairs(cooc.couple_counts(df, listed, 1)).collect() if r.w1 < r.w2}
    assert found == {("a", "x"): 1, ("a", "z"): 1, ("b", "y"): 1}
    by_line = cooc.couple_counts_by_line(df, listed, 1)
    assert by_line.count() == 3 and by_line.columns == ["doc_id", "line_no", "lo", "hi", "n"]


def test_a_line_is_tokenised_once(lines):
    df = lines({"x": ["a b a"]})
    for made in (cooc.couples(df, VOCABULARY, 2), cooc.couple_counts_by_line(df, VOCABULARY, 2), cooc.couple_counts_both_ways(df, VOCABULARY, 2)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all") == 1


def test_time_grows_with_the_length_of_a_line(lines):
    def seconds(k):
        df = lines({"x": [" ".join(VOCABULARY[i % 4] for i in range(k))]})
        best = []
        for _ in range(3):
            start = time.perf_counter()
            assert cooc.couple_counts(df, VOCABULARY, 4).agg(F.sum("n")).first()[0] == 4 * k - 10
            best.append(time.perf_counter() - start)
        return min(best)

    seconds(500)
    # 32 times the words: quadratic work would take some hundred times as long.
    assert seconds(16_000) < 12 * seconds(500) + 2


def test_equal_records_fold_whatever_their_order(spark):
    rows = [("k", 0, "a hot b")] * 3_000 + [("k", 0, "a b"), ("j", 1, "a hot b"), (None, None, "b a"), ("k", 0, None)]
    frame = spark.createDataFrame(rows, "doc_id string, line_no long, text string")
    listed = VOCABULARY + [f"unused{i}" for i in range(2_000)]
    expected = as_counter(cooc.couple_counts(frame, VOCABULARY, 2), "lo", "hi")
    by_line = Counter((r.doc_id, r.line_no, r.lo, r.hi, r.n) for r in cooc.couple_counts_by_line(frame, VOCABULARY, 2).collect())
    assert by_line["k", 0, "a", "hot", 1] == 3_000
    for given in (frame, frame.orderBy(F.rand(1)), frame.repartition(7, F.rand(2))):
        assert as_counter(cooc.couple_counts(given, listed, 2), "lo", "hi") == expected
        long = cooc.couple_counts_by_line(given, listed, 2)
        assert Counter((r.doc_id, r.line_no, r.lo, r.hi, r.n) for r in long.collect()) == by_line
        plan = long._jdf.queryExecution().optimizedPlan().toString()
        assert "monotonically_increasing_id" not in plan and "collect_set" in plan


@pytest.mark.parametrize("unused", [0, 2_001])
def test_both_ways_give_the_same_matrices(lines, unused):
    found = random_lines(8) * 2
    listed = VOCABULARY + [f"unused{i}" for i in range(unused)]
    both = cooc.couple_counts_both_ways(lines({"x": found[:70], "y": found[70:]}), listed, 3)
    pairs = as_counter(cooc.pairs(both), "folded", "d", "w1", "w2")
    for d in (1, 2, 3):
        for folded in (False, True):
            assert {k[2:]: n for k, n in pairs.items() if k[:2] == (folded, d)} == model.pairs(found, set(VOCABULARY), d)


def test_long_lists_need_no_checkpoint_folder(spark, lines, monkeypatch):
    monkeypatch.setattr(session, "names_shared_folder", lambda spark: False)
    monkeypatch.setattr(session, "shared_folder", lambda spark: pytest.fail("a folder was asked for"))
    found = random_lines(9)
    listed = word_table(spark, VOCABULARY + [f"unused{i}" for i in range(2_000)])
    df = lines({"x": found})
    assert as_counter(cooc.pairs(cooc.couple_counts(df, listed, 2)), "w1", "w2") == model.pairs(found, set(VOCABULARY), 2)
    terms = spark.createDataFrame([("hot", 1)], "stem string, df long")
    assert term_freq(df, terms, at_most=1).first().tf == sum(model.words(line).count("hot") for line in found)


def test_fold_by_line_needs_no_shuffle(lines):
    plan = cooc.pairs_by_line(lines({"x": ["a b a", "b a"]}), VOCABULARY, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_invariants_on_test_data(spark):
    previous = None
    for d in (1, 2, 3, 4):
        pairs = as_counter(QUERIES[f"cooc_pairs_d{d}"](spark, SF_DIR), "w1", "w2")
        stripes = as_counter(QUERIES[f"cooc_stripes_rows_d{d}"](spark, SF_DIR), "word", "neighbour")
        assert pairs and all(pairs[b, a] == n for (a, b), n in pairs.items())
        assert all(a != b for a, b in pairs)
        assert all(n % 2 == 0 for (a, b), n in stripes.items() if a == b)
        assert {k: n for k, n in stripes.items() if k[0] != k[1]} == pairs
        if previous:
            assert all(pairs[k] >= n for k, n in previous.items())
        previous = pairs


def test_top_words_keep_one_word_per_count(spark):
    counts = spark.createDataFrame([("a", 2), ("b", 2), ("c", 1), ("a'x", 1), ("z", 5)], "word string, n long")
    assert [tuple(r) for r in top_words(counts).collect()] == [("z", 5), ("b", 2), ("c", 1)]
    assert [tuple(r) for r in top_words(counts, 2).collect()] == [("z", 5), ("b", 2)]


def test_long_lists_shuffle_counted_couples_only(spark):
    plan = QUERIES["cooc_pairs_long_list_d2"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(lo#\d+, hi#\d+,", plan)) == 1
    assert "record" not in plan and "collect_set" not in plan


def test_long_lists_that_are_not_broadcast(spark, lines, monkeypatch):
    found = random_lines(12)
    monkeypatch.setattr(wordlists, "BROADCAST_ROWS", 1)
    listed = word_table(spark, VOCABULARY)
    counts = cooc.counted_by_block(lines({"x": found}), listed, 3, block=4)
    assert as_counter(cooc.stripe_rows(counts), "word", "neighbour") == model.stripes(found, set(VOCABULARY), 3)
