from __future__ import annotations

import random
import re

import model
import pytest
from pyspark.sql import functions as F

from tokenloom.functions.scoring import four_decimals, term_score
from tokenloom.functions.text import NESTED_PATTERNS, counted_words, strip_patterns, words
from tokenloom.operators.counting import word_count, word_count_no_stop
from tokenloom.operators.tokens import tokens
from tokenloom.sources.records import file_lines, table_lines

TEXTS = [
    "", "...", " ", "a", '", a b. "', "it's é naïve_1 'q'", "A b C", "'", "_", "a\tb", "a--b",
    "Straße ÉTÉ x", "日本 語 abc", "a b ", " a b", "1,000.5",
]


def random_texts(n: int) -> list[str]:
    rng = random.Random(3)
    return ["".join(rng.choice("aB'_1 .,é\n\r") for _ in range(rng.randint(0, 12))) for _ in range(n)]


def apply(spark, function, found):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(found)], "i int, t string")
    return [row[1] for row in df.select("i", function(F.col("t"))).orderBy("i").collect()]


def test_words(spark):
    assert apply(spark, words, ["it's é naïve_1 'q'"]) == [["it's", "na", "ve_1", "'q'"]]
    found = TEXTS + random_texts(500)
    assert apply(spark, words, found) == [model.words(t) for t in found]


def test_counted_words(spark):
    assert apply(spark, counted_words, ["", "...", '", a b. "']) == [[""], [], ["", "a", "b"]]
    found = TEXTS + [t.replace("\n", " ").replace("\r", "-") for t in random_texts(500)]
    assert apply(spark, counted_words, found) == [model.counted_words(t) for t in found]


def test_table_lines(spark):
    found = ["", "a", "a\n", "a\nb", "\n", "\n\n", "a\r\nb\rc\n", "\r\n\r", "a\n\nb", "x\n\r"] + random_texts(500)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(found)], "doc_id int, text string")
    ours = {}
    for row in table_lines(df).orderBy("doc_id", "line_no").collect():
        ours.setdefault(row.doc_id, []).append(row.text)
        assert row.line_no == len(ours[row.doc_id]) - 1
    assert ours == {i: model.lines(t) for i, t in enumerate(found) if model.lines(t)}


def test_file_lines_match_table_lines(spark, write_file):
    text = "one\r\ntwo\n\nthree\rfour"
    path = write_file("docs/a.txt", text)
    ours = file_lines(spark, path).orderBy("line_no").collect()
    assert [r.text for r in ours] == model.lines(text)
    assert {r.doc_id for r in ours} == {"a.txt"}
    assert len({r.line_no for r in ours}) == 5


LINE_ENDS = [
    "1234\n12345\n123456\n12é\n1234", "1234\r\n123\r\n12345", "12345", "12345\n", "123456", "1234\r", "1234\r\n", "1234\n\r",
    "12345\r123\n1234\r12345", "", "\n", "\n\n12345", "12345\r\n12345", "1\n\n12é4\n\n12345\n12é4", "a\n" * 5 + "12345",
]


@pytest.mark.parametrize("limit", [4, 5, 6, 7, 8])
def test_line_bound(spark, write_file, tmp_path, limit):
    for i, text in enumerate(LINE_ENDS):
        write_file(f"docs/{i}", text)
    df = spark.createDataFrame([(str(i), text) for i, text in enumerate(LINE_ENDS)], "doc_id string, text string")
    ours = file_lines(spark, str(tmp_path / "docs"), limit)
    assert ours.dtypes == file_lines(spark, str(tmp_path / "docs")).dtypes
    rows = ours.collect()
    assert sorted((r.doc_id, r.text) for r in rows) == sorted((r.doc_id, r.text) for r in table_lines(df, max_line_bytes=limit).collect())
    assert len({r.line_no for r in rows}) == len(rows)


def test_line_bound_of_split_files_and_marked_ones(spark, write_file):
    text = "".join(f"{'x' * (i % 9)}\n" for i in range(3_000))
    at = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(at)
    spark.conf.set(at, "1000")
    try:
        for end, extra in (("12345678", 1), ("12345678\n", 0), ("123456789", 0)):
            for mark in ("", "\ufeff"):
                path = write_file("docs/a.txt", mark + text + end)
                found = [r.text for r in file_lines(spark, path, 9).collect()]
                assert len(found) == sum(i % 9 < 8 for i in range(3_000)) + extra
                assert found.count("12345678") == extra
    finally:
        spark.conf.set(at, before)


def test_many_patterns_go_in_stages_and_in_order(spark, lines):
    # Every pattern makes the match of the next one; out of order some would stay.
    marks = [chr(0x4E00 + i) for i in range(130)]
    text = "".join(marks) + "z " + "".join(reversed(marks))
    patterns = [f"{m}(?=z)" for m in reversed(marks)]
    df = lines({"x": [text, ""]})
    stripped = strip_patterns(df.select("text"), patterns)
    assert [r.text for r in stripped.collect()] == ["z " + "".join(reversed(marks)), ""]
    assert [r.text for r in strip_patterns(df.select("text"), patterns[1:]).collect()] == [text, ""]
    # No stage is nested in another.
    plan = stripped._jdf.queryExecution().optimizedPlan().toString()
    assert max(line.count("regexp_replace(") for line in plan.splitlines()) <= NESTED_PATTERNS


def test_positions_count_every_word(lines):
    rows = tokens(lines({"x": ["a é b, c", "d"]})).orderBy("line_no", "pos").collect()
    assert [(r.line_no, r.pos, r.tok) for r in rows] == [(0, 0, "a"), (0, 1, "b"), (0, 2, "c"), (1, 0, "d")]


def counts(df):
    return {row.word: row.n for row in df.collect()}


def test_word_count_flags(lines):
    df = lines({"x": ["", "A a. b1", "...", ".a"]})
    assert counts(word_count(df)) == {"": 2, "A": 1, "a": 2, "b1": 1}
    assert counts(word_count(df, case_sensitive=False)) == {"": 2, "a": 3, "b1": 1}
    # Patterns see the lower-case line and are applied one after the other.
    assert counts(word_count(df, False, ["[0-9]", "A", "b"])) == {"": 2, "a": 3}
    assert counts(word_count(df, True, [r"\.", "a"])) == {"": 3, "A": 1, "b1": 1}


def test_no_stop_words(lines):
    df = lines({"x": ["The cat", "the the dog "]})
    assert counts(word_count_no_stop(df, ["the"])) == {"cat": 1, "dog": 1}
    assert counts(word_count_no_stop(df, [])) == {"the": 3, "cat": 1, "dog": 1}


@pytest.mark.parametrize(("tf", "df", "expected"), [(3, 9836, "0.9139"), (1, 10_000, "0.3010"), (1000, 1, "4000.0434")])
def test_score(spark, tf, df, expected):
    frame = spark.createDataFrame([(tf, df)], "tf long, df long")
    assert frame.select(four_decimals(term_score(F.col("tf"), F.col("df")))).first()[0] == expected


def test_a_stage_is_skipped_where_no_pattern_matches(lines):
    patterns = [f"x{i}y" for i in range(50)] + ["ab", "abc", "a[bc]+", "e|f", "z*q", "yy"] * 2
    texts = ["", "none of them", "x1xx2yyx33y abcab", "zzq xx4yy f", "ab" * 40, "x49y" * 3]
    expected = []
    for text in texts:
        for p in patterns:
            text = re.sub(p, "", text)
        expected.append(text)
    stripped = strip_patterns(lines({"x": texts}).select("text"), patterns)
    assert [r.text for r in stripped.collect()] == expected
    plan = stripped._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == -(-len(patterns) // NESTED_PATTERNS)
