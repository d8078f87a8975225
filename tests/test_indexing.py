from __future__ import annotations

import math
import random
from collections import Counter

import model
import pytest
from porter_by_letter import stem

from tokenloom.operators import wordlists
from tokenloom.operators.indexing import doc_freq, term_freq, tf_score, top_doc_freq, top_terms

DOCS = {
    "a.txt": ["Running runs run", "names namely the name"],
    "b.txt": ["the runner namely", "RUN it's"],
    "c.txt": ["", "..."],
    "d.txt": ["hot " * 500 + "name"],
}
STOP = ["the", "namely", "it"]


def expected_df(docs, stop):
    seen = set()
    for doc, found in docs.items():
        for word in (w for line in found for w in model.words(line)):
            if word not in stop and stem(word) not in stop:
                seen.add((stem(word), doc))
    return Counter(s for s, _ in seen)


def expected_tf(docs, terms):
    return Counter(
        (doc, stem(w)) for doc, found in docs.items() for line in found for w in model.words(line) if stem(w) in terms
    )


def test_doc_freq(lines):
    ours = {r.stem: r.df for r in doc_freq(lines(DOCS), STOP).collect()}
    assert ours == expected_df(DOCS, STOP)
    assert ours["run"] == 2 and ours["hot"] == 1


def test_documents_of_one_name_merge(spark):
    rows = spark.createDataFrame([("same.txt", "cats"), ("same.txt", "cat"), ("other.txt", "cat")], "doc_id string, text string")
    assert [(r.stem, r.df) for r in doc_freq(rows, []).collect()] == [("cat", 2)]


def test_stop_words_drop_by_stem_from_df_but_count_in_tf(spark, lines):
    frequencies = {r.stem: r.df for r in doc_freq(lines(DOCS), STOP).collect()}
    # `namely` is a stop word, `it's` stems to one that is not.
    assert frequencies["name"] == 2 and "it'" in frequencies
    frequencies = {r.stem: r.df for r in doc_freq(lines({"x": ["its"]}), ["it"]).collect()}
    assert frequencies == {}
    terms = spark.createDataFrame([("name", 2)], "stem string, df long")
    assert {(r.doc_id, r.tf) for r in term_freq(lines(DOCS), terms).collect()} == {("a.txt", 3), ("b.txt", 1), ("d.txt", 1)}


def test_top_terms(spark):
    rows = [("b", 2), ("a", 2), ("c", 3), ("d", 1)]
    frame = spark.createDataFrame(rows, "stem string, df long")
    assert [tuple(r) for r in top_terms(frame, 3).collect()] == [("c", 3), ("a", 2), ("b", 2)]


def test_scores(lines, spark):
    terms = spark.createDataFrame([("run", 2), ("name", 3), ("hot", 1)], "stem string, df long")
    counted = expected_tf(DOCS, {"run", "name", "hot"})
    df = {"run": 2, "name": 3, "hot": 1}
    for n_docs in (10_000, 4):
        ours = {(r.doc_id, r.term): r.score for r in tf_score(lines(DOCS), terms, n_docs).collect()}
        assert set(ours) == set(counted)
        for key, tf in counted.items():
            assert math.isclose(ours[key], tf * math.log10(n_docs / df[key[1]] + 1), rel_tol=1e-12)


def test_long_lists_and_term_tables_give_the_same_rows(lines, spark, monkeypatch):
    terms = spark.createDataFrame([("run", 2), ("name", 3), ("hot", 1)], "stem string, df long")
    small = sorted(term_freq(lines(DOCS), terms).collect()), sorted(doc_freq(lines(DOCS), STOP).collect())
    monkeypatch.setattr(wordlists, "BROADCAST_ROWS", 0)
    long = term_freq(lines(DOCS), terms)
    assert "__salt" in long._jdf.queryExecution().analyzed().toString()
    assert (sorted(long.collect()), sorted(doc_freq(lines(DOCS), STOP).collect())) == small
    assert [r.tf for r in long.collect() if r.stem == "hot"] == [500]


@pytest.mark.parametrize("repeated", [False, True])
def test_top_terms_by_bounds(spark, repeated):
    rng = random.Random(4)
    forms = ["walk", "walks", "walked", "walking", "run", "runs", "cat", "cats", "the", "thing", "things", "sky", "skies"]
    rows = [(None if i == 0 else i // 2 if repeated else i, " ".join(rng.choices(forms, k=rng.randrange(4)))) for i in range(60)]
    records = spark.createDataFrame(rows, "doc_id long, text string")
    for k in (1, 2, 3, 50):
        expected = top_terms(doc_freq(records, STOP), k).collect()
        assert top_doc_freq(records, STOP, k).collect() == expected
    assert top_doc_freq(records.limit(0), STOP, 3).count() == 0
