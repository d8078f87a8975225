"""The training-data operators against brute force, round trips and edge cases."""

from __future__ import annotations

import hashlib
import io
import re
import zipfile
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, duck_rows, spark_rows
from conftest import SF_DIR
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tokenloom.llm import (
    bytetext,
    components, context_tree, decontamination, language_id, mixing, multiset_hash, ngram_join, prefix_free, template_extraction, token_rollup, warc_zip,
)
from tokenloom.llm.oracles import ORACLES
from tokenloom.llm.queries import QUERIES
from tokenloom.session import shared_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "word " * 3000, "en", "a", None), (3, "word " * 3000, "en", "a", None), (None, "null id here", "de", None, 3)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).withColumn("__host", F.lit(1)).withColumn("blk", F.lit("x"))


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == duck_rows(connect(SF_DIR), ORACLES[name])


def test_mix(spark, odd, none):
    rows = mixing.mix_report(odd).collect()
    assert len(rows) == 5 and all(r.taken <= 3 * r["size"] for r in rows) and {r.doc_id: r["size"] for r in rows}[1] == 0
    mixed = mixing.mix_documents(odd)
    assert mixed.columns == [*odd.columns, "copy"]
    assert mixed.where("doc_id = 3").count() * 3000 == sum(r.taken for r in rows if r.doc_id == 3)
    assert mixing.mix_report(none).count() == 0
    sizes = spark.createDataFrame([("a", 100, 1.0), ("b", 1, 2.0), ("c", 50, 3.0)], "source string, source_size long, weight double")
    found = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert found["b"] == 3 and found["c"] == pytest.approx(111) and found["a"] == pytest.approx(37)


def test_rollup_counts_a_batch_once(spark, docs, odd, none):
    folder = f"{shared_folder(spark)}/rollup-test"
    before = token_rollup.words(docs)
    after = before.withColumn("tokens", F.col("tokens") * 2)
    assert token_rollup.commit(folder, "a", token_rollup.inserted(before))
    assert not token_rollup.commit(folder, "a", token_rollup.inserted(before))
    assert token_rollup.commit(folder, "b", token_rollup.revised(before, after))
    total = docs.select(F.sum(mixing.size_of(F.col("text")))).first()[0]
    found = token_rollup.totals(spark, folder, ["a", "b", "never"])
    assert found.agg(F.sum("docs"), F.sum("tokens")).first() == (docs.count(), 2 * total)
    token_rollup.commit(folder, "c", token_rollup.deleted(after))
    assert token_rollup.totals(spark, folder, ["a", "b", "c"]).count() == 0
    token_rollup.commit(folder, "odd", token_rollup.inserted(token_rollup.words(odd)))
    token_rollup.commit(folder, "none", token_rollup.inserted(token_rollup.words(none)))
    assert token_rollup.totals(spark, folder, ["odd", "none"]).agg(F.sum("docs")).first()[0] == 5


def test_rollup_keeps_totals_in_a_base(spark, docs):
    folder = f"{shared_folder(spark)}/rollup-base-test"
    words = token_rollup.words(docs)
    expected = sorted(map(tuple, token_rollup.inserted(words).groupBy("source", "lang", "tokenizer").agg(F.sum("docs"), F.sum("tokens")).collect()), key=str)
    found = lambda: sorted(map(tuple, token_rollup.totals(spark, folder).collect()), key=str)
    assert found() == [] and not token_rollup.compact(spark, folder)
    marks = spark._jsc.hadoopConfiguration()
    marks.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        assert token_rollup.commit(folder, "a b/c%", token_rollup.inserted(words))
        assert found() == expected
        assert token_rollup.compact(spark, folder) and not token_rollup.compact(spark, folder)
    finally:
        marks.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    assert found() == expected
    assert not token_rollup.commit(folder, "a b/c%", token_rollup.inserted(words))
    # A batch or base that died before its marker counts for nothing.
    token_rollup.inserted(words).write.parquet(f"{folder}/batch=dead")
    token_rollup.inserted(words).write.parquet(f"{folder}/base=00000001")
    assert found() == expected
    more = words.withColumn("tokens", F.col("tokens") + 1)
    assert token_rollup.commit(folder, "dead", token_rollup.revised(words, more))
    revised = [(*r[:4], r[4] + r[3]) for r in expected]
    assert found() == revised
    assert token_rollup.compact(spark, folder)
    assert found() == revised


def test_rollup_finds_copies(spark):
    rows = [(3, "s", "en", "a b"), (1, "s", "en", "a b"), (2, "t", "en", "a b"), (4, "s", "en", None), (5, "s", None, ""), (6, "s", "en", "c"), (None, "s", "en", "c")]
    found = token_rollup.copies(spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")).collect()
    assert sorted(r.doc_id for r in found) == [2, 3, 5]


def _groups(rows, width, percent):
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets, name = {}, {}
    for i, text in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(lower)) if w]
        sets[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())
        name[i] = i
    ids = sorted(sets)
    changed = True
    links = [
        (a, b) for n, a in enumerate(ids) for b in ids[n + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(name[a], name[b])
            changed |= name[a] != low or name[b] != low
            name[a] = name[b] = low
    return {i: (len(sets[i]), name[i]) for i in ids}


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_ngram_join_is_exact(docs, width, percent):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_groups(docs, width, percent).collect()}
    assert found == _groups(rows, width, percent)


def test_ngram_join_edges(odd, none):
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.similar_groups(odd).collect()}
    assert found == {(1, 0, 1), (2, 0, 2), (3, 1, 3), (None, 1, None)}
    assert ngram_join.one_per_group(odd).count() == 5 and ngram_join.similar_groups(none).count() == 0


def test_one_row_per_group(spark, none):
    import corpus_pipeline

    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    near = a.replace("a29", "end")
    rows = [(1, a, "x"), (1, a, "y"), (2, near, "x"), (2, b, "x"), (None, a, "x"), (None, c, "x"), (None, c, "x"), (None, c, "a"), (3, "", "x"), (3, "", "x"), (4, "", "x"), (6, b, "x"), (5, b, "x")]
    given = spark.createDataFrame([(i, t, None, s, None) for i, t, s in rows], DOCS)

    def left(found):
        return sorted((r.doc_id or 0, r.text, r.source) for r in found.collect())

    assert left(corpus_pipeline.distinct(spark, given, SF_DIR)) == [(0, c, "a"), (1, a, "x"), (2, b, "x"), (3, "", "x"), (4, "", "x")]
    assert left(ngram_join.one_per_group(given)) == [(0, c, "a"), (0, c, "x"), (0, c, "x"), (1, a, "x"), (1, a, "y"), (2, b, "x"), (3, "", "x"), (3, "", "x"), (4, "", "x")]
    assert corpus_pipeline.distinct(spark, none, SF_DIR).count() == 0
    clash = given.withColumn("row", F.lit(1)).withColumn("part", F.lit(2)).withColumn("id", F.lit(3))
    assert ngram_join.one_per_group(clash, repeated=False).columns == clash.columns and ngram_join.one_per_group(clash, repeated=False).count() == 5


def test_functions_travel_without_what_the_driver_keeps():
    bytetext.span_hashes(bytetext.prefix_hash(np.zeros(9, np.uint8)), np.zeros(1, int), np.ones(1, int))
    assert len(bytetext._powers) == 2
    for f in (ngram_join._sets(5), prefix_free._ask(4, 5, 50)):
        assert len(cloudpickle.dumps(f)) < 200_000


@pytest.mark.parametrize("percent", [80, 90])
def test_fine_parities_let_linked_sets_pass(percent):
    rng = np.random.default_rng(3)
    for n in (1, 2, 90, 255, 256, 700, 5_000):
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for lost in {0, 1, n * (100 - percent) // 100}:
            y = np.concatenate([x[lost:], rng.integers(0, 1 << 63, min(lost, 1)).astype(np.uint64)])
            both = len(np.intersect1d(x, y))
            linked = 100 * both >= percent * (len(x) + len(y) - both)
            a, b = ngram_join.parities(x), ngram_join.parities(np.unique(y))
            size = min(len(a), len(b))
            apart = int((ngram_join.folded(a, size) != ngram_join.folded(b, size)).sum())
            passed = (len(x) + len(y) - apart) * (100 + percent) >= (len(x) + len(y)) * percent * 2
            assert passed or not linked


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(90, 80), (80, 90), (7, 7)], "a long, b long")
    found = {r.id: r.component for r in components.components(links).collect()}
    assert found == {i: 1 for i in range(1, 41)} | {80: 80, 90: 80}


def test_components_joined_further(spark, monkeypatch):
    rng = np.random.default_rng(7)
    pairs = [tuple(int(x) for x in p) for p in rng.integers(0, 300, (260, 2))]
    expected = {}
    for a, b in pairs * 300:
        if a != b:
            least = min(expected.get(a, a), expected.get(b, b))
            if expected.get(a) == expected.get(b) == least:
                continue
            expected[a] = expected[b] = least
    first, more = (spark.createDataFrame(p, "a long, b long") for p in (pairs[:150], pairs[150:]))
    parts = components.components(first)
    monkeypatch.setattr(components, "BROADCAST_ROWS", 0)
    found = components.joined_further(parts, more).collect()
    assert {r.id: r.component for r in found} == expected and len(found) == len(expected)


def test_stars_take_no_further_step(spark, monkeypatch):
    steps, settled = [], components.settled
    monkeypatch.setattr(components, "settled", lambda df: steps.append(1) or settled(df))
    star = spark.createDataFrame([(i, 0) for i in range(1, 40)], "a long, b long")
    assert {r.component for r in components.components(star).collect()} == {0} and len(steps) == 1


def test_language_on_held_out_documents(spark, docs, odd, none):
    rows = QUERIES["op4_language"](spark, SF_DIR).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    model = language_id.fit(docs)
    found = {r.doc_id: r for r in language_id.predict(model, odd, "doc_id", "__host").collect()}
    assert found[1].lang_pred == found[2].lang_pred == "und" and found[3].lang_pred in model.languages
    assert language_id.fit(none).languages == [] and language_id.predict(language_id.fit(none), odd, "doc_id").where("lang_pred <> 'und'").count() == 0
    assert language_id.predict(model, none, "doc_id").count() == 0


def test_codewords_differ():
    for n in (2, 3, 5, 9, 30):
        code = language_id.codewords(n)
        assert len({tuple(row) for row in code}) == n


PAGES = [(1, "http://a/1", "<p>x"), (2, None, "<p>x"), (3, "http://a/ 3%", "<p>y é"), (4, "u", None), (5, "u", ""), (5, "u", ""), (None, "u", "<p>x")]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    rows = warc_zip.round_trip(spark, pages).collect()
    found = {(r.page_id, r.record_type, r.refers_to) for r in rows}
    assert len(rows) == 7 and found == {(1, "revisit", 2), (2, "response", None), (3, "response", None), (4, "revisit", 5), (5, "response", None), (None, "revisit", 2)}
    for r in rows:
        html = {p[0]: p[2] or "" for p in PAGES}[r.page_id].encode()
        assert r.payload_digest == warc_zip.sha1_base32(html) and r.payload_bytes == len(html)
        assert r.payload == (html if r.record_type == "response" else None)
    assert {r.url for r in rows if r.page_id in (2, 3)} == {None, "http://a/ 3%"}
    assert warc_zip.round_trip(spark, pages.limit(0)).count() == 0
    assert {r.record_type for r in warc_zip.round_trip(spark, pages, 100).collect()} == {"response"}


def test_zip64_directory(monkeypatch):
    def written() -> bytes:
        out = io.BytesIO()
        package = warc_zip.Package(out)
        for k in range(3):
            package.add(k, warc_zip._record(k, "u", b"page %d" % k, None, False))
        package.close()
        return out.getvalue()

    plain = written()
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    wide = written()
    assert b"PK\x06\x06" in wide and b"PK\x06\x06" not in plain
    for raw in (plain, wide):
        assert [r[6] for r in warc_zip.read_package(io.BytesIO(raw), len(raw))] == [b"page 0", b"page 1", b"page 2"]


def test_multiset_hash():
    whole = multiset_hash.fingerprints(pa.array(["a b c\nd e f\ng h i", "g h i\na b c\n\nd e f", "a b c\nd e f", None]))
    assert (whole[0] == whole[1]).all() and not whole[3].any()
    assert (multiset_hash.delete(whole[0], ["g h i"]) == whole[2]).all() and (multiset_hash.insert(whole[2], ["g h i"]) == whole[0]).all()
    assert multiset_hash.likeness(whole[:1], whole[1:2])[0] == 1 and multiset_hash.likeness(whole[3:], whole[3:])[0] == 1


def test_likeness_of_one_run_many_times(spark):
    a, b = "word " * 40_000, "word " * 30_000
    whole = multiset_hash.fingerprints(pa.array([a, b, f"{a}\n{b}"]))
    expected = 1 - 10_000**2 / (39_998**2 + 29_998**2)
    assert multiset_hash.likeness(whole[:1], whole[1:2])[0] == pytest.approx(expected)
    assert (multiset_hash.delete(whole[2], [b]) == whole[0]).all() and (multiset_hash.insert(whole[0], [b]) == whole[2]).all()
    found = {r.doc_id: r for r in multiset_hash.edit_report(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")).collect()}
    assert all(r.near_next == pytest.approx(expected) and r.near_edited > 0.9 for r in found.values())


@pytest.mark.parametrize("range_rows", [7, 1_000])
def test_edited_texts(docs, range_rows):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    found = {r.doc_id: r for r in multiset_hash.edit_report(docs, range_rows).collect()}
    assert len(found) == len(rows)
    for k, (i, text) in enumerate(rows):
        half = len(text) // 2
        edited = text[: len(text) - half] + rows[(k + 1) % len(rows)][1][:half]
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and found[i].n_chars == len(text)


def test_edited_texts_edges(odd, none):
    assert multiset_hash.edit_report(odd).count() == 5 and multiset_hash.edit_report(none).count() == 0
    assert multiset_hash.edit_report(odd.limit(1)).first().near_next == 1


def test_context_tree(spark, docs, odd, none):
    held = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    rows = context_tree.score_texts(docs, ~held, held).orderBy("doc_id").collect()
    counts: dict = {}
    texts = {r.doc_id: r.text for r in docs.collect()}
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    tokens = {i: [w for w in re.split(r"[\x20\x09-\x0D]+", t.translate(lower)) if w] + [None] for i, t in texts.items()}
    for r in rows:
        if not r.held_out:
            for w in tokens[r.doc_id]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        base = sum(log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in tokens[r.doc_id])
        assert r.base_score == pytest.approx(base) and r.train_tokens == n and r.n_tokens == len(tokens[r.doc_id])
        assert r.n_known == sum(w in counts for w in tokens[r.doc_id]) and r.score < 0
    sliced = context_tree.score_texts(docs, ~held, held, slice_rows=20_000).orderBy("doc_id").collect()
    assert all(a.score == pytest.approx(b.score) and a.base_score == pytest.approx(b.base_score) for a, b in zip(rows, sliced, strict=True))
    assert context_tree.score_texts(odd, F.lit(True), F.lit(False)).count() == 5
    assert context_tree.score_texts(none, F.lit(True), F.lit(False)).count() == 0


def test_context_tree_is_a_distribution():
    runs = np.array([(7 << 8) | s for s in range(256)], np.uint64)  # one context, every byte
    n = np.zeros(256, np.int64)
    n[[65, 66]] = 10, 3
    levels, place, bit = context_tree._subtree(runs, n)
    mixed = levels[0].one[place[0]]
    for level, where in zip(levels[1:], place[1:], strict=True):
        mixed = level.share[where] * level.one[where] + (1 - level.share[where]) * mixed
    assert np.where(bit, mixed, 1 - mixed).reshape(-1, 8).prod(axis=1).sum() == pytest.approx(1)


def test_leaks(spark, docs, odd, none):
    item = "one two three four five six seven eight nine ten eleven twelve"
    edited = item.replace("four", "vier").replace("nine ", "")
    rows = [(1, f"before it {item} after"), (2, f"Lead, {edited.upper()}!"), (3, "one two three and nothing else at all of it"), (4, None)]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(9, item), (8, None), (7, "x y")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(given, bench).collect()}
    assert set(found) == {(1, 9), (2, 9)} and found[1, 9].score == 1 and (found[1, 9].first_word, found[1, 9].last_word) == (2, 13)
    assert sorted(r.doc_id for r in decontamination.clean(given, bench).collect()) == [3, 4]
    assert decontamination.clean(odd, bench).count() == 5 and decontamination.contaminated(none, bench).count() == 0
    assert decontamination.contaminated(given, bench.limit(0)).count() == 0


def _aligned(a, b):
    best = 0
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            step = decontamination.MATCH if a[i - 1] == b[j - 1] else decontamination.MISMATCH
            h[i][j] = max(0, h[i - 1][j - 1] + step, h[i - 1][j] + decontamination.GAP, h[i][j - 1] + decontamination.GAP)
            best = max(best, h[i][j])
    return best


def test_alignment_against_cells():
    rng = np.random.default_rng(3)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 15)), rng.integers(0, 4, rng.integers(0, 25))
        assert decontamination.align(a, b)[0] == _aligned(a, b)


def test_extraction(spark):
    menu = "<nav><a href=/>Home</a></nav><header>Site</header><div class='cookie-notice'>Cookies</div>"
    rest = "<aside>More</aside><form>Search</form><div id=comments><p>First!</p></div><footer>&copy; x</footer>"
    whole = f"<html><head><title>T</title><style>p{{}}</style></head><body>{menu}<article><h1>A &amp; B</h1><p>one\n <b>two</b><br>three<p>four</p><script>var x='</p>'</script></article>{rest}"
    rows = [(1, "http://h/1", whole), (2, "http://h/2", None), (3, None, ""), (4, "http://h/4", "plain < text &lt;"), (4, "http://h/4", "plain < text &lt;")]
    rows += [(10 + i, f"http://t/{i}", f"<body><div><p>Brought to you by T</p><p>story {i}</p><ul><li><a>next {i}</a><li><a>last {i}</a></ul></div>") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = template_extraction.extract(pages).collect()
    text = {r.page_id: r.text for r in found}
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    assert text[1] == "A & B\none two three\nfour" and text[2] == text[3] == "" and text[4] == "plain < text <"
    assert [text[10 + i] for i in range(6)] == [f"story {i}" for i in range(6)]
    assert template_extraction.extract(pages.limit(0)).count() == 0


def _texts(spark, rows):
    found = template_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == len(rows)
    return {r.page_id: r.text.split("\n") if r.text else [] for r in found}


def test_extraction_keeps_what_articles_share(spark):
    tops = "<body><div>Site</div>"
    near = [(i, f"http://near/{i}", f"{tops}<article><h1>Shared</h1><p>one<p>edited {i}<p>three</article>") for i in range(6)]
    inside = "<ul><li>first<li>second</ul><blockquote>said</blockquote><ul><li><a href=/x>see x</a></ul>"
    lists = [(10 + i, f"http://large/{i}", f"{tops}<{tag}><p>copy {i}{inside}</{tag}>") for i, tag in enumerate(["article"] * 5 + ["main"] * 5)]
    others = [(30 + i, f"http://large/o{i}", f"{tops}<article><p>other {i}</article>") for i in range(4)]
    text = _texts(spark, near + lists + others)
    assert all(text[i] == ["Shared", "one", f"edited {i}", "three"] for i in range(6))
    assert all(text[10 + i] == [f"copy {i}", "first", "second", "said", "see x"] for i in range(10))
    assert all(text[30 + i] == [f"other {i}"] for i in range(4))


@pytest.mark.parametrize(
    ("page", "kept"),
    [
        ("<body class='home has-sidebar'><p>story</p><div class=sidebar>more</div>", ["story"]),
        ("<div id='page' class='with-sidebar'><p>story</p></div>", ["story"]),
        ("<div class='content no-sidebar'>story</div><div class='no-js footer'>legal</div>", ["story"]),
        ("<article class='post discussion'><p>story</p></article>", ["story"]),
        ("<main class='post-1 search'><p>story</p></main>", ["story"]),
        ("<article><header class='entry-header'><h1>title</h1></header><p>story</p></article>", ["title", "story"]),
        ("<header class='entry-header'>site</header><p>story", ["story"]),
        ("<div class=search><article>story<div class=comments>first!</div></article></div>", ["story"]),
        ("<div class=related><article>teaser</article></div><article>story</article>", ["story"]),
        ("<article><div class='post discussion'>story</div><nav>next</nav></article>", ["story"]),
        ("<div class='page search'><p>story</p></div><nav>menu</nav>", ["story"]),
        ("<article role=dialog>box</article><p>story", ["story"]),
    ],
)
def test_extraction_by_names(page, kept):
    assert [b.text for b in template_extraction.slots(template_extraction.parse(page)[0])] == kept


def _extracted(rows):
    """Texts by occurrence vectors that are built page by page."""
    hosts: dict = {}
    for k, (_, url, page) in enumerate(rows):
        host = (re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "") or [0, ""])[1].lower()
        hosts.setdefault(host, []).append((k, *template_extraction.parse(page or "")))
    out = []
    for own in hosts.values():
        tags, texts, shares = {}, {}, {}
        for k, blocks, paths in own:
            for path, n in paths.items():
                tags.setdefault(path, {})[k] = n
            if blocks or paths:
                tags.setdefault("", {})[k] = 1
            for b in blocks:
                if not b.main:
                    vector = texts.setdefault((b.slot, b.text), {})
                    vector[k] = vector.get(k, 0) + 1
                    share = shares.setdefault(b.slot, [0, 0])
                    share[0] += b.words
                    share[1] += b.linked
        vectors = [v for v in tags.values() if len(v) >= template_extraction.SUPPORT]
        template = {t for t, v in texts.items() if v in vectors}
        menus = {p for p, (words, linked) in shares.items() if len(tags[p]) >= template_extraction.SUPPORT and 100 * linked >= template_extraction.LINKS * words}
        for k, blocks, _ in own:
            kept = template_extraction.slots(blocks)
            left = [b for b in kept if b.main or b.slot not in menus and (b.slot, b.text) not in template]
            out.append((rows[k][0], "\n".join(b.text for b in left or kept)))
    return sorted(out)


def test_extraction_drops_classes(spark):
    story = "<div>notice</div><div>story {}</div>"
    rows = [(i, f"http://plain/{i}", f"<body>{story}<div>legal line</div>".format(i)) for i in range(6)]
    rows += [(10 + i, f"http://bare/{i}", f"{story}<div>legal line</div>".format(i)) for i in range(6)]
    rows += [(20 + i, f"http://part/{i}", f"<body>{story}".format(i) + "<div>Tags:</div><ul class=tags><li>t{}</ul>".format(i) * (i < 6)) for i in range(9)]
    rows += [(40 + i, f"http://few/{i}", f"<body>{story}".format(i)) for i in range(4)]
    rows += [(60 + i, f"http://some/{i}", "<body><div>only here</div>" * (i % 2) + f"<div>story {i}</div>") for i in range(12)]
    rows += [(80 + i, f"http://index/{i}", f"<body><div>notice</div><div>story {i}</div>" + "<article>text</article>" * (i > 2)) for i in range(9)]
    text = _texts(spark, rows)
    assert all(text[k + i] == [f"story {i}"] for k in (0, 10) for i in range(6))
    assert all(text[20 + i] == [f"story {i}", *([f"t{i}"] if i < 6 else [])] for i in range(9))
    assert all(text[40 + i] == ["notice", f"story {i}"] for i in range(4))
    assert all(text[80 + i] == ([f"story {i}"] if i <= 2 else ["text"]) for i in range(9))
    assert sorted((i, "\n".join(t)) for i, t in text.items()) == _extracted(rows)


def test_extraction_keeps_what_moves(spark):
    """A class whose tokens change their gap or their order holds no template."""
    story = "<section>story {}</section>"
    rows = [(i, f"http://gap/{i}", "<body>" + ("on the move" + story if i % 2 else story + "on the move").format(i)) for i in range(6)]
    rows += [(20 + i, f"http://order/{i}", "<body>" + ("<p>a<p>b" if i % 2 else "<p>b<p>a") + story.format(i)) for i in range(6)]
    rows += [(40 + i, f"http://nested/{i}", "<body>" + "<table><td>cell</table>" * (i % 2) + story.format(i) + "read on" * (i % 2)) for i in range(12)]
    rows += [(60 + i, f"http://still/{i}", f"<body>line{story.format(i)}legal") for i in range(6)]
    text = _texts(spark, rows)
    assert all(set(text[i]) == {"on the move", f"story {i}"} for i in range(6))
    assert all(set(text[20 + i]) == {"a", "b", f"story {i}"} for i in range(6))
    assert all("read on" in text[40 + i] and "cell" not in text[40 + i] for i in range(1, 12, 2))
    assert all(text[60 + i] == [f"story {i}"] for i in range(6))


@pytest.mark.parametrize("wrap", ["article", "div", "p"])
def test_extraction_of_the_table(spark, wrap):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url", F.regexp_replace("html", "(</?)article>", f"$1{wrap}>").alias("html"))
    rows = [tuple(r) for r in pages.collect()]
    rows += [(1_000 + i, f"https://h.example/{i}", r[2]) for i, r in enumerate(rows[:20])]
    found = template_extraction.extract(spark.createDataFrame(rows, pages.schema)).collect()
    assert sorted((r.page_id, r.text) for r in found) == _extracted(rows) and all(r.text for r in found)


def _removed(rows, length):
    first, out = {}, {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if first.get(raw[s : s + length], i) < i:
                gone[s : s + length] = b"\1" * length
        for s in range(len(raw) - length + 1):
            first.setdefault(raw[s : s + length], i)
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("block_bytes", [30_000, 6 << 20])
def test_repeats_are_exact(docs, block_bytes):
    found = {r[0]: tuple(r[1:]) for r in prefix_free.repeat_report(docs, block_bytes=block_bytes).collect()}
    assert found == _removed([(r.doc_id, r.text) for r in docs.collect()], 50)


def test_repeats_of_repetitive_texts(spark, odd, none):
    rng = np.random.default_rng(5)
    rows = [(i, "".join(rng.choice(["ab", "a", "xyz" * 9, "é"], rng.integers(0, 90)))) for i in range(60)] + [(100, "a" * 200), (101, "a" * 49), (102, "a" * 50)]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    for length in (20, 50):
        found = {r[0]: tuple(r[1:]) for r in prefix_free.repeat_report(given, length, block_bytes=500).collect()}
        assert found == _removed(rows, length)
    kept = prefix_free.remove_repeats(odd)
    assert kept.count() == 5 and kept.where("text IS NULL").count() == 1 and set(odd.columns) <= set(kept.columns)
    assert prefix_free.repeat_report(none).count() == 0


def test_pipeline(spark, docs):
    import corpus_pipeline

    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, stage(spark, kept, SF_DIR)
        path = f"{shared_folder(spark)}/stage-{name}"
        kept.write.mode("overwrite").parquet(path)
        kept = spark.read.parquet(path)
        if name != "mix":
            assert kept.columns == docs.columns and kept.join(before, "doc_id", "left_anti").count() == 0
        if name == "similar":
            assert kept.count() == len({c for _, c in _groups([(r.doc_id, r.text) for r in before.collect()], 5, 80).values()})
        if name == "repeats":
            exact = _removed([(r.doc_id, r.text) for r in before.collect()], 50)
            assert {r.doc_id for r in kept.collect()} == {i for i, x in exact.items() if x[1] == 0 or x[1] < x[0]}
    assert kept.columns == [*docs.columns, "copy"]
