from __future__ import annotations

import random
import re

import porter_by_letter as letters
import pytest
from conftest import SF_DIR
from porter_by_letter import stem as by_letter
from pyspark.sql import functions as F

from tokenloom.functions.porter import STEP_2, STEP_3, STEP_4, with_stem
from tokenloom.functions.text import words
from tokenloom.plans import oracles

# Examples printed in the paper (whole-algorithm results) and well-known stems.
CASES = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled",
    "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl",
    "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss",
    "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky",
    "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc",
    "digitizer": "digit", "radically": "radic", "differently": "differ", "vilely": "vile",
    "vietnamization": "vietnam", "predication": "predic", "operator": "oper",
    "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope",
    "callousness": "callous", "formality": "formal", "sensitivity": "sensit",
    "sensibility": "sensibl", "triplicate": "triplic", "formative": "form",
    "formalize": "formal", "electricity": "electr", "electrical": "electr", "hopeful": "hope",
    "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer",
    "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust",
    "defensible": "defens", "irritant": "irrit", "replacement": "replac",
    "adjustment": "adjust", "dependent": "depend", "adoption": "adopt", "homologou": "homolog",
    "communism": "commun", "activate": "activ", "angularity": "angular", "homologous": "homolog",
    "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate",
    "cease": "ceas", "controlling": "control", "roll": "roll",
    "this": "thi", "day": "dai", "became": "becam", "university": "univers",
    "history": "histori", "namely": "name", "possibly": "possibl", "archaeology": "archaeolog",
    "is": "is", "as": "as", "a": "a", "yes": "ye", "say": "sai", "by": "by", "it's": "it'",
    "": "",
}
# The paper's example for each rule of steps 2 to 4, as the word each step is given.
SUFFIX_CASES = {
    "relational": "relat", "conditional": "condit", "valenci": "valenc", "hesitanci": "hesit", "digitizer": "digit",
    "conformabli": "conform", "radicalli": "radic", "differentli": "differ", "vileli": "vile", "analogousli": "analog",
    "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal",
    "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous", "formaliti": "formal",
    "sensitiviti": "sensit", "sensibiliti": "sensibl", "apologi": "apolog",
    "triplicate": "triplic", "formative": "form", "formalize": "formal", "electriciti": "electr", "electrical": "electr",
    "hopeful": "hope", "goodness": "good",
    "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin", "gyroscopic": "gyroscop",
    "adjustable": "adjust", "defensible": "defens", "irritant": "irrit", "replacement": "replac", "adjustment": "adjust",
    "dependent": "depend", "adoption": "adopt", "homologou": "homolog", "communism": "commun", "activate": "activ",
    "angulariti": "angular", "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler",
}
# Runs of y, where a letter is a vowel or a consonant by what stands before it.
Y_WORDS = ["yyy", "yyyy", "tyyed", "tyyyed", "ayyed", "ayyyed", "ayyyyed", "yyed", "yyyed", "syzygying", "eyeyed", "yying"]


def stems(spark, found):
    df = with_stem(spark.createDataFrame([(w,) for w in found], "tok string"))
    return {row.tok: row.stem for row in df.collect()}


def test_published_cases(spark):
    assert stems(spark, CASES) == CASES
    assert {w: by_letter(w) for w in CASES} == CASES


def test_every_suffix_has_a_published_word(spark):
    for table in (STEP_2, STEP_3, STEP_4):
        longest = sorted(table, key=len, reverse=True)
        shown = {next((s for s in longest if w.endswith(s)), None) for w in SUFFIX_CASES}
        assert set(table) <= shown
    assert stems(spark, SUFFIX_CASES) == SUFFIX_CASES
    assert {w: by_letter(w) for w in SUFFIX_CASES} == SUFFIX_CASES


def test_the_three_tables_agree():
    for ours, other, sql in zip((STEP_2, STEP_3, STEP_4), (letters.STEP_2, letters.STEP_3, letters.STEP_4),
                                (oracles.SQL_STEP_2, oracles.SQL_STEP_3, oracles.SQL_STEP_4), strict=True):
        assert ours == other == oracles._suffixes(sql)


def test_made_up_words_match_the_letter_form(spark):
    rng = random.Random(7)
    endings = [*STEP_2, *STEP_3, *STEP_4, "ed", "ing", "eed", "s", "sses", "ies", "y", "e", "ll", "ation", "ly", "lying"]
    found = set(Y_WORDS)
    for _ in range(30_000):
        root = "".join(rng.choice("abcdeilmnostuwxyyz1_'") for _ in range(rng.randint(0, 6)))
        found.add(root + "".join(rng.choice(endings) for _ in range(rng.randint(0, 2))))
    found.discard("")
    ours = stems(spark, found)
    assert len(ours) == len(found)
    assert {w: s for w, s in ours.items() if s != by_letter(w)} == {}


def test_test_data_words_match_the_letter_form(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    vocabulary = docs.select(F.explode(words(F.col("text"))).alias("tok")).distinct()
    rows = with_stem(vocabulary).collect()
    assert len(rows) > 10_000
    assert [(r.tok, r.stem) for r in rows if r.stem != by_letter(r.tok)] == []


def test_other_columns_and_names(spark):
    df = spark.createDataFrame([(1, "ponies")], "id int, `odd name` string")
    out = with_stem(df, "odd name", "s")
    assert out.columns == ["id", "odd name", "s"]
    assert out.collect() == [(1, "ponies", "poni")]


def test_filters_on_stems_stay_above_the_steps(spark):
    df = with_stem(spark.createDataFrame([("ponies",), ("cats",)], "tok string")).filter("stem = 'cat'")
    assert [r.tok for r in df.collect()] == ["cats"]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Filter.*stem", plan.splitlines()[0])


@pytest.mark.parametrize("aggregate", [False, True])
def test_generated_code_is_small_enough_to_be_compiled(spark, aggregate):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(2)
    df = with_stem(docs.select("doc_id", F.explode(words(F.col("text"))).alias("tok")))
    if aggregate:
        df = df.groupBy("doc_id", "stem").count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        text = df.select("*")._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(s) for s in re.findall(r"maxMethodCodeSize:\s*(\d+)", text)]
    assert sizes and max(sizes) < 8_000
