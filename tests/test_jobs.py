from __future__ import annotations

import glob
import os

import model
import pytest
from pyspark.errors import PySparkException

from tokenloom.__main__ import main
from tokenloom.plans import jobs
from tokenloom.sinks import lines as out

ARTICLES = {
    "1.txt": "Red fish, blue fish. The fish's red cat; red red fish",
    "2.txt": "One blue cat\nand the red cat\n\nblue blue fish fish one",
    "3.txt": '"Cats" named fishes: naming red cats, a blue one',
}
STOP = "the\r\n\r\nand\r\na \r\n"


@pytest.fixture
def corpus(write_file, tmp_path):
    for name, text in ARTICLES.items():
        write_file(f"corpus/{name}", text)
    return str(tmp_path / "corpus"), write_file("stop.txt", STOP)


def read(path):
    parts = sorted(glob.glob(os.path.join(path, "part-*")))
    return "".join(open(p, encoding="utf-8").read() for p in parts).splitlines()


def all_lines():
    return [line for text in ARTICLES.values() for line in model.lines(text)]


def test_everything(spark, corpus, tmp_path):
    source, stop = corpus
    target = str(tmp_path / "out")
    jobs.run_all(spark, source, target, stop)
    top = [line.split("\t") for line in read(f"{target}/top_words")]
    counts = [int(n) for _, n in top]
    assert counts == sorted(set(counts), reverse=True)
    assert top[0] == ["red", "6"] or top[0] == ["fish", "6"]
    vocabulary = {w for w, _ in top}
    for d in (1, 2, 3, 4):
        pairs = model.pairs(all_lines(), vocabulary, d)
        for layout in ("pairs", "folded_pairs"):
            assert read(f"{target}/matrices/layout={layout}/d={d}") == [
                f"{k}\t{n}" for k, n in sorted((f"{a},{b}", n) for (a, b), n in pairs.items())
            ]
        stripes: dict[str, dict[str, int]] = {}
        for (a, b), n in model.stripes(all_lines(), vocabulary, d).items():
            stripes.setdefault(a, {})[b] = n
        assert read(f"{target}/matrices/layout=stripes/d={d}") == [
            f"{w}\t{{" + ", ".join(f"{k}:{n}" for k, n in sorted(stripes[w].items())) + "}" for w in sorted(stripes)
        ]
    frequencies = read(f"{target}/doc_freq")
    assert frequencies == sorted(frequencies)
    assert "fish\t3" in frequencies and "cat\t3" in frequencies and "name\t1" in frequencies
    terms = [line.split("\t") for line in read(f"{target}/top_terms")]
    assert terms == sorted(terms, key=lambda t: (-int(t[1]), t[0]))
    scores = [line.split("\t") for line in read(f"{target}/scores")]
    assert scores == sorted(scores)
    # 2 occurrences ("named", "naming") in 1 document of an assumed 10,000.
    assert ["3.txt", "name", "8.0001"] in scores


def test_an_existing_target_is_an_error(spark, corpus, tmp_path):
    source, stop = corpus
    target = str(tmp_path / "twice")
    jobs.top_words_job(spark, source, target, stop)
    with pytest.raises(PySparkException):
        jobs.top_words_job(spark, source, target, stop)


def test_single_jobs_and_command_line(spark, corpus, tmp_path, write_file):
    source, stop = corpus
    at = lambda name: str(tmp_path / "cli" / name)
    main(["top-words", source, at("top"), stop, "-k", "3"])
    assert len(read(at("top"))) == 3
    main(["pairs", source, at("pairs"), at("top"), "-d", "2"])
    main(["pairs", source, at("folded"), at("top"), "-d", "2", "--fold-by-line"])
    assert read(at("pairs")) == read(at("folded")) != []
    main(["stripes", source, at("stripes"), at("top")])
    vocabulary = {line.split("\t")[0] for line in read(at("top"))}
    assert len(read(at("stripes"))) == len({a for a, _ in model.stripes(all_lines(), vocabulary, 1)})
    main(["doc-freq", source, at("freq"), stop])
    main(["top-terms", at("freq"), at("terms"), "-k", "2"])
    assert len(read(at("terms"))) == 2
    main(["score", source, at("scores"), at("terms"), "--n-docs", "3"])
    assert all(len(line.split("\t")) == 3 for line in read(at("scores")))
    skip = write_file("skip.txt", "s\n")
    main(["word-count", source, at("count"), "--ignore-case", "--skip-patterns", skip, "--max-line-bytes", "40"])
    counted = dict(line.rsplit("\t", 1) for line in read(at("count")))
    short = [line for line in all_lines() if len(line) + 1 < 40]
    expected = [w for line in short for w in model.counted_words(line.lower().replace("s", ""))]
    assert counted == {w: str(expected.count(w)) for w in expected}
    main(["all", source, at("all"), stop, "--distances", "1", "3"])
    assert sorted(os.listdir(at("all/matrices"))) == ["._SUCCESS.crc", "_SUCCESS", "layout=folded_pairs", "layout=pairs", "layout=stripes"]
    assert sorted(os.listdir(at("all/matrices/layout=stripes"))) == ["d=1", "d=3"]
    main(["matrices", source, at("matrices"), at("top"), "--distances", "2"])
    assert read(at("matrices/layout=pairs/d=2")) == read(at("pairs"))
    main(["score", source, at("unsorted"), at("terms"), "--n-docs", "3", "--unsorted"])
    assert sorted(read(at("unsorted"))) == read(at("scores")) != []


def test_pair_lines_sort_by_the_joined_text(spark):
    rows = spark.createDataFrame([("a", "b", 1), ("a'x", "b", 2)], "w1 string, w2 string, n long")
    assert [r.value for r in out.pair_lines(rows).collect()] == ["a'x,b\t2", "a,b\t1"]


def test_score_lines_may_stay_unsorted(spark):
    rows = spark.createDataFrame([("b", "t", 1234.5), ("a", "t", 0.00005)], "doc_id string, term string, score double")
    assert [r.value for r in out.score_lines(rows).collect()] == ["a\tt\t0.0001", "b\tt\t1234.5000"]
    assert "Sort" not in out.score_lines(rows, ordered=False)._jdf.queryExecution().executedPlan().toString()
