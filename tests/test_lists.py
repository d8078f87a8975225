from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tokenloom.operators import wordlists
from tokenloom.operators.counting import word_count_no_stop
from tokenloom.operators.tokens import tokens
from tokenloom.operators.wordlists import drop_words, fits_broadcast, hot_keys, is_small_list, join_side, keep_words, salted_join, short_list
from tokenloom.sources import lists


def column(df):
    return sorted(row[0] for row in df.collect())


def test_stop_words(spark, write_file):
    path = write_file("stop.txt", "a\r\n\r\nA's \r\n \r\nwould\r\nwould\r\n\tTab\t\r\n")
    assert column(lists.read_stop_words(spark, path)) == ["a", "a's", "tab", "would"]


def test_missing_stop_words_fail(spark, tmp_path):
    with pytest.raises(PySparkException):
        lists.read_stop_words(spark, str(tmp_path / "none.txt")).collect()


def test_vocabulary(spark, write_file):
    path = write_file("vocabulary.tsv", "apos\t273057\nThe 5\nword\n\nword\t1\n")
    assert column(lists.read_vocabulary(spark, path)) == ["The", "apos", "word"]


def test_term_table(spark, write_file):
    path = write_file("terms.tsv", "s\t9836\nx\nx\t1\t2\ny\t7\t\nz\t1\nz\t2\n\n")
    rows = lists.read_term_table(spark, path).collect()
    assert sorted((r.stem, r.df) for r in rows) == [("s", 9836), ("y", 7), ("z", 2)]


@pytest.mark.parametrize("number", ["y", "1.5", " 7"])
def test_term_table_needs_numbers(spark, write_file, number):
    path = write_file("terms.tsv", f"x\t{number}\n")
    with pytest.raises(PySparkException):
        lists.read_term_table(spark, path).collect()


def test_skip_patterns_keep_file_order(spark, write_file):
    first = write_file("first.txt", "b+\n,\n")
    second = write_file("second.txt", " a\nb+\n")
    assert lists.read_skip_patterns(spark, [first, second]) == ["b+", ",", " a"]


def test_many_skip_patterns_and_repeats(spark, write_file):
    path = write_file("many.txt", "\n".join(["a"] * 501 + ["b", "c"] + [f"x{i}" for i in range(600)]))
    assert lists.read_skip_patterns(spark, path) == ["a", "b", "c"] + [f"x{i}" for i in range(600)]


def test_document_frequency_below_one(spark, write_file):
    path = write_file("terms.tsv", "a\t1\nb\t0\n")
    with pytest.raises(Exception, match="below 1: b 0"):
        lists.read_term_table(spark, path).collect()


def test_long_list_is_no_literal(spark):
    words = [f"w{i}" for i in range(60_000)]
    table = lists.word_table(spark, words)
    assert "w59999" not in table._jdf.queryExecution().optimizedPlan().toString()[:100_000] and table.count() == 60_000


def test_default_stop_words():
    assert lists.DEFAULT_STOP_WORDS == sorted(set(lists.DEFAULT_STOP_WORDS), key=lists.DEFAULT_STOP_WORDS.index)
    assert len(lists.DEFAULT_STOP_WORDS) < 200


def test_size_check(spark, monkeypatch):
    side = lists.word_table(spark, ["a", "bb", "ccc"])
    assert fits_broadcast(side)
    monkeypatch.setattr(wordlists, "BROADCAST_ROWS", 2)
    assert not fits_broadcast(side) and not is_small_list(["a", "bb", "ccc"])
    monkeypatch.setattr(wordlists, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(wordlists, "BROADCAST_BYTES", 5)
    assert not fits_broadcast(side) and not is_small_list(["a", "bb", "ccc"])
    assert is_small_list(["a"]) and not is_small_list(side)
    # A bound on the rows says nothing about their bytes.
    kept = keep_words(side.withColumnRenamed("word", "tok"), side, at_most=3)
    assert "__salt" in kept._jdf.queryExecution().analyzed().toString() and kept.count() == 3
    assert fits_broadcast(spark.createDataFrame([], "word string"))


def test_long_lists_give_the_same_rows(spark, lines, monkeypatch):
    # One word makes up most of the rows, as a hot key would.
    df = lines({str(i): ["hot " * 200 + "cold x"] for i in range(20)})
    toks = tokens(df)
    words = ["hot", "x", "unseen"]
    terms = spark.createDataFrame([("hot", 5), ("x", 6)], "tok string, df long")
    small = [
        sorted(drop_words(toks, words).collect()),
        sorted(keep_words(toks, words).collect()),
        sorted(join_side(toks, terms, "tok", "inner").collect()),
        sorted(word_count_no_stop(df, words).collect()),
    ]
    monkeypatch.setattr(wordlists, "BROADCAST_ROWS", 0)
    salted = keep_words(toks, words)
    assert "__salt" in salted._jdf.queryExecution().analyzed().toString()
    long = [
        sorted(drop_words(toks, words).collect()),
        sorted(salted.collect()),
        sorted(join_side(toks, terms, "tok", "inner").collect()),
        sorted(word_count_no_stop(df, words).collect()),
    ]
    assert long == small
    assert [len(rows) for rows in small] == [20, 20 * 201, 20 * 201, 1]


def test_short_list(spark, monkeypatch):
    assert sorted(short_list(lists.word_table(spark, "abc"))) == ["a", "b", "c"]
    assert short_list({"a"}) == ["a"]
    monkeypatch.setattr(wordlists, "LITERAL_WORDS", 2)
    assert short_list(lists.word_table(spark, "abc")) is None
    assert short_list(["a", "b", "c"]) is None


def test_hot_words_split_by_their_share(spark):
    # One word in twenty rows, the others all different.
    rows = spark.range(0, 40_000, 1, 8).selectExpr("id AS pos", "if(id % 20 = 0, 'hot', concat('w', id)) AS tok")
    side = rows.select("tok").distinct()
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [tuple(r) for r in hot_keys(rows, "tok", 200).collect()] == [("hot", 10)]
        for how in ("left_semi", "inner"):
            joined = salted_join(rows, side, "tok", how)
            tasks = joined.where("tok = 'hot'").groupBy(F.spark_partition_id()).count().collect()
            # Ten copies, of which two may be dealt to one task.
            assert len(tasks) >= 9 and max(r["count"] for r in tasks) <= 2 * 2_000 / 9
            assert joined.count() == 40_000 and joined.distinct().count() == 40_000
        assert salted_join(rows, side.where("tok <> 'hot'"), "tok", "left_anti").count() == 2_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_hot_keys_of_nothing(spark):
    empty = spark.createDataFrame([], "tok string")
    assert hot_keys(empty, "tok", 8).count() == 0
    nulls = spark.createDataFrame([(None,)] * 5 + [("a",)], "tok string")
    assert [r.tok for r in salted_join(nulls, spark.createDataFrame([("a",)], "tok string"), "tok", "left_anti").collect()] == [None] * 5


def test_lists_parse_from_lines(spark):
    def lines(*rows):
        return spark.createDataFrame([(r,) for r in rows], "value string")

    assert column(lists.parse_stop_words(lines("The\r", "", " a ", None, "the"))) == ["a", "the"]
    assert column(lists.parse_vocabulary(lines("The 5", "\tx", "word\t1", None))) == ["The", "word"]
    assert [tuple(r) for r in lists.parse_term_table(lines("x\t2", "x", "x\t1\t2", None, "")).collect()] == [("x", 2)]
    assert lists.parse_skip_patterns(lines("b+", "a", "b+")) == ["b+", "a"]
