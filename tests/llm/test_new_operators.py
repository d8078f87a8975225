"""Spelling variants, nearest neighbours and token alignment against brute force."""

from __future__ import annotations

import hashlib
import re
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from tokenloom import session
from tokenloom.llm import cross_polytope, decontamination, prefix_free, spelling_trie, token_alignment

# -- op11 ---------------------------------------------------------------------


def misspelt(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute_variants(known):
    near = {w: set() for w in known}
    less = {}
    for w in known:
        for i in range(len(w)):
            less.setdefault((w[:i], w[i + 1 :]), []).append(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in known:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in less.values():
        for a in group:
            near[a] |= set(group) - {a}
    form = {}
    for w in known:
        best = min(near[w], key=lambda v: (-known[v], v), default=None)
        if best is not None and known[best] >= 2 * known[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), known[form[w]] if w in form else None) for w, n in known.items()}


def variant_rows(df):
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]


def test_variants_of_the_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    expected = brute_variants(misspelt([(r.doc_id, r.text) for r in docs.collect()]))
    rows = variant_rows(queries()["op11_spelling_trie"](spark, SF_DIR))
    assert len(rows) == len(set(rows)) and set(rows) == expected
    assert sum(r[1] is not None for r in rows) > 100


def test_variants_of_odd_words(spark):
    long = "x" * 30 + "yz" * 40
    known = {
        "aaaaa": 9, "aaaaaa": 3, "aaaaaaa": 4, "aabaa": 4, "Ñandú": 5, "ñandú": 11, "nandú": 3, "abcde": 8, "abcd": 16, "bcde": 3,
        "abxde": 4, "abyde": 4, "lonely": 3, "été": 7, "étés": 3, "z": 50, "y": 25, "zy": 3,
        long: 40, long[:50] + "q" + long[51:]: 4, long[1:]: 9, long + "z": 3, "k" * 64: 8, "k" * 65: 4, "k" * 63: 16, "k" * 62 + "jk": 3,
    }
    frame = spark.createDataFrame(list(known.items()) + [(None, 5), ("", 9)], "word string, n long")
    rows = variant_rows(spelling_trie.variants(frame))
    assert len(rows) == len(set(rows)) and set(rows) == brute_variants(known)
    # A row per word or several: they are added up.
    again = variant_rows(spelling_trie.variants(frame.withColumn("n", F.expr("n - 1")).unionByName(frame.withColumn("n", F.lit(1)))))
    assert sorted(r[0] for r in again) == sorted(known)


def test_variants_of_little(spark):
    docs = spark.createDataFrame(
        [(None, "Apples APPLES apples äpples"), (1, None), (2, ""), (2, "12 ... --"), (3, "äpples äpples " + "verylongtext " * 20_000)], "doc_id long, text string"
    ).withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    expected = brute_variants(misspelt([(r.doc_id, r.text) for r in docs.collect()]))
    assert set(variant_rows(spelling_trie.variants(spelling_trie.misspelt_words(docs)))) == expected
    assert variant_rows(spelling_trie.variants(spelling_trie.misspelt_words(docs.where("doc_id > 9")))) == []


# -- op12 ---------------------------------------------------------------------


def brute_nearest(rows, asks, k=20):
    rows = [(i, np.array(v, np.float64)) for i, v in dict.fromkeys((i, tuple(v)) for i, v in rows)]
    out = {}
    for q, v in rows:
        if asks(q):
            scored = sorted((-float(np.add.reduce(v * x)), i) for i, x in rows if i != q and len(x) == len(v))[:k]
            out[q] = [(i, -s) for s, i in scored]
    return out


def nearest_rows(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(found, expected):
    return sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in e}) for q, e in expected.items()) / sum(map(len, expected.values()))


def test_small_tables_are_searched_whole(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    found = nearest_rows(queries()["op12_cross_polytope"](spark, SF_DIR))
    expected = brute_nearest(rows, lambda i: i % 20 == 0)
    assert recall(found, expected) >= 0.9
    for q, list_ in found.items():
        exact = dict(brute_nearest(rows, lambda i, q=q: i == q, len(rows))[q])
        assert all(abs(exact[i] - s) < 1e-12 for i, s in list_)


@pytest.mark.parametrize("bucket", [8, 64])
def test_recall_by_hashing(spark, bucket):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    found = nearest_rows(cross_polytope.nearest(table, F.col("vec_id") % 20 == 0, bucket=bucket))
    expected = brute_nearest(rows, lambda i: i % 20 == 0)
    assert all(len(found[q]) == 20 for q in expected) and recall(found, expected) >= 0.9


def test_lengths_copies_and_clusters(spark):
    rng = np.random.default_rng(1)
    spread = rng.normal(size=(300, 7)) * rng.lognormal(size=(300, 1))
    tight = np.array([5.0] * 7) + rng.normal(size=(200, 7)) * 1e-6
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([spread, tight]))]
    rows += [(1_000 + i, [20.0, 40.0, 60.0, 80.0, 100.0, 120.0, 140.0]) for i in range(300)] + [(5, rows[5][1]), (40, rows[41][1])]
    rows += [(2_000 + i, [float(i), 1.0]) for i in range(5)]
    bad = [(3_000, None), (3_020, []), (3_040, [0.0] * 7), (3_060, [None] + [1.0] * 6), (3_080, [float("nan")] * 7), (3_100, [float("inf")] * 7), (None, [1.0] * 7)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("digest", F.lit(1)).withColumn("bucket", F.lit(2))
    found = cross_polytope.nearest(frame, F.col("vec_id") % 20 == 0, k=4, bucket=32)
    whole = cross_polytope.exact_nearest(frame, F.col("vec_id") % 20 == 0, k=4)
    # Id 40 has two vectors, so two lists.
    expected = {q: e for q, e in brute_nearest(rows, lambda i: i % 20 == 0, 4).items() if q != 40}
    exact = nearest_rows(whole.where("query_id <> 40"))
    assert {q: [i for i, _ in e] for q, e in exact.items()} == {q: [i for i, _ in e] for q, e in expected.items()}
    hashed = nearest_rows(found.where("query_id <> 40"))
    assert recall(hashed, expected) >= 0.9 and hashed[1_000] == exact[1_000] == [(1_000 + i, 56_000.0) for i in (1, 2, 3, 4)]
    assert whole.where("query_id = 40").count() == 8
    assert [len(hashed[q]) for q in (2_000,)] == [4]


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert cross_polytope.nearest(frame, F.col("vec_id") % 20 == 0).collect() == []
    one = spark.createDataFrame([(20, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert cross_polytope.nearest(one, F.col("vec_id") % 20 == 0).collect() == []


def test_least_ids(spark):
    rows = spark.range(0, 30_000).selectExpr("'hot' AS digest", "(id * 7919) % 30011 AS vec_id").unionByName(
        spark.createDataFrame([("few", 3), ("few", 3), ("few", 1)], "digest string, vec_id long")
    )
    least = {r.digest: r.ids for r in cross_polytope.least_ids(rows, 21).collect()}
    everything = sorted({i * 7919 % 30_011 for i in range(30_000)})
    assert least == {"hot": everything[:21], "few": [1, 3]}


# -- op13 ---------------------------------------------------------------------

TEXTS = [
    None, "", " ", "  a  b \n c\td \n\n e", "x ▁ y", "<|endoftext|> <s> a</s><unk>", "日本語テキスト 中文 😀👍🏽 a", "it's  don't x 　y  ",
    "ab" * 3_000, "á ﻿b\x00c \x1c d", " lead", "trail ", "1234567 89.10 --- $$$ //", "a\rb\r\n c", "word " * 5_000, "a b a b",
]


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{token_alignment.FOLDER}/{token_alignment.FILE_A}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{token_alignment.FOLDER}/{token_alignment.FILE_B}")
    letters = token_alignment.byte_letters()

    def bytes_a(i):
        return bytes(letters[c] for c in a.id_to_token(i))

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    made, held = [], Counter()
    for doc_id, text in rows:
        xs = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ys = b.encode(text) if text else []
        raw = (" " + text).encode() if text else b""
        if not text or b"".join(map(bytes_a, xs)) != raw or b"".join(map(bytes_b, ys)) != raw:
            made.append((doc_id, [], [], [], Counter()))
            continue
        ends_x, ends_y = np.cumsum([len(bytes_a(i)) for i in xs]).tolist(), np.cumsum([len(bytes_b(i)) for i in ys]).tolist()
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_x) & set(ends_y)):
            p, q = ends_x.index(end, i) + 1, ends_y.index(end, j) + 1
            groups.append((xs[i:p], ys[j:q]))
            i, j = p, q
        links = Counter()
        for ga, gb in groups:
            for x, n in Counter(ga).items():
                for y, m in Counter(gb).items():
                    links[x, y] += n * m
        held.update(links.keys())
        made.append((doc_id, xs, ys, groups, links))
    top = {}
    for (x, _), n in held.items():
        top[x] = max(top.get(x, 0), n)
    return Counter(
        (
            doc_id, len(xs), len(ys), len(groups), sum(links.values()),
            sum(n for k, n in links.items() if held[k] == top[k[0]]), sum(n * held[k] for k, n in links.items()),
            hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups).encode()).hexdigest() if xs else "",
        )
        for doc_id, xs, ys, groups, links in made
    )


def aligned_rows(df):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


def test_alignment_of_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert aligned_rows(queries()["op13_token_alignment"](spark, SF_DIR)) == brute_alignment(rows)


def test_alignment_of_odd_texts(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a b"), (3, "a b"), (3, "a b"), (7, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(0)).withColumn("pairs", F.lit("x"))
    expected = brute_alignment(rows)
    assert aligned_rows(token_alignment.alignment_report(frame)) == expected
    # A join by key, and products in small blocks, come to the same.
    monkeypatch.setattr("tokenloom.operators.wordlists.BROADCAST_ROWS", 0)
    assert aligned_rows(token_alignment.alignment_report(frame)) == expected
    assert token_alignment.alignment_report(frame.where("doc_id > 99")).count() == 0


def test_blocks_lose_nothing(monkeypatch):
    tok = token_alignment.tokenizers(token_alignment.FOLDER)
    found = ["ab" * 400, "日本語テキスト", "word", "word,word", "aaaaaaaaaaa"]
    whole = [token_alignment.Alignment(tok, found)]

    def entries(made):
        return Counter({(int(u), int(p)): int(n) for part in made.links() for u, p, n in zip(
            np.repeat(np.arange(len(found)), np.diff(part[0])), part[1], part[2], strict=True)})

    one = entries(whole[0])
    monkeypatch.setattr(token_alignment, "BLOCK", 3)
    parts = list(whole[0].links())
    assert len(parts) > 3 and entries(whole[0]) == one
    places = [(int(u), int(p)) for part in parts for u, p in zip(np.repeat(np.arange(len(found)), np.diff(part[0])), part[1], strict=True)]
    assert len(places) == len(set(places))


def test_row_product():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 3, (6, 5)), rng.integers(0, 3, (5, 7))

    def rows(m):
        r, c = np.nonzero(m)
        return token_alignment.summed(r, c, m[r, c], len(m))

    ptr, col, val = token_alignment.row_product(rows(x), rows(y))
    dense = np.zeros((6, 7), int)
    dense[np.repeat(np.arange(6), np.diff(ptr)), col] = val
    assert np.array_equal(dense, x @ y)


def test_spans(spark):
    rows = spark.createDataFrame([(1, "it's naïve"), (2, None), (3, "▁")], "doc_id long, text string")
    one, two, three = sorted(token_alignment.alignments(rows).collect(), key=lambda r: r.doc_id)
    assert two.groups == two.overlaps == three.groups == []
    assert one.groups[0].start == 0 and one.groups[-1].end == len(" it's naïve".encode())
    assert all(a.end == b.start for a, b in zip(one.groups, one.groups[1:], strict=False))
    assert sum(o.bytes for o in one.overlaps) == one.groups[-1].end


# -- op8 and the pipeline -----------------------------------------------------


def test_a_copy_is_found_among_thousands_that_share_its_trigrams(spark):
    item = [f"w{i}" for i in range(24)]
    edited = [w if i % 4 != 3 else f"other{i}" for i, w in enumerate(item)]
    left = ["", *[" ".join(edited[i : i + 3]) for i in range(0, 24, 4)]]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    for many in (0, 999, 1_001, 20_000):
        others = spark.range(1, many + 1).selectExpr("id AS doc_id", "'" + " . filler words here ".join(left) + "' AS text")
        # One other document has the whole item, so that all its n-grams occur and the shared ones are the frequent ones.
        docs = others.unionByName(spark.createDataFrame([(-1, "a b " + " ".join(edited) + " c d"), (-2, " ".join(item))], "doc_id long, text string"))
        found = {r.doc_id: r for r in decontamination.contaminated(docs, bench).where("doc_id < 0").collect()}
        assert set(found) == {-1, -2} and found[-1].matched == 18 and found[-1].score >= 0.5


def brute_leaks(docs, items):
    """Every text aligned with every item, wherever seeds may be."""
    out = set()
    fold = lambda t: decontamination.WORD.findall((t or "").encode())
    for doc_id, text in docs:
        words = np.array([hash(w.lower()) for w in fold(text)], np.int64)
        for item_id, item in items:
            own = np.array([hash(w.lower()) for w in fold(item)], np.int64)
            if len(own) >= 3 and len(words):
                score, same, _, _ = decontamination.align(own, words)
                if score >= decontamination.LEAST * decontamination.MATCH * len(own) and same >= min(decontamination.WORDS, len(own)):
                    out.add((doc_id, item_id))
    return out


def test_recall_of_edited_copies(spark):
    rng = np.random.default_rng(4)
    items = [(i, " ".join(f"w{rng.integers(0, 60)}" for _ in range(rng.integers(10, 40)))) for i in range(12)]
    docs = []
    for i in range(150):
        words = items[rng.integers(0, 12)][1].split()
        for _ in range(rng.integers(0, max(1, len(words) // 4))):
            at, kind = rng.integers(0, len(words)), rng.integers(0, 3)
            words[at : at + 1] = [[f"x{i}"], [], [words[at], f"y{i}"]][kind]
        noise = [f"w{rng.integers(0, 60)}" for _ in range(30)]
        docs.append((i, " ".join([*noise[:15], *words, *noise[15:]])))
    expected = brute_leaks(docs, items)
    given = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(*given).collect()}
    assert found <= expected and len(found) >= 0.97 * len(expected) > 100
    kept = {r.doc_id for r in decontamination.clean(*given).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in found}


def test_blocks_of_items_are_bounded_by_words(spark):
    rows = [(i, "\t".join(f"a{i}b{j}" for j in range(50))) for i in range(40)]
    blocks = list(decontamination.item_blocks(spark.createDataFrame(rows, "item_id long, text string"), 100))
    assert len(blocks) == 20 and all(sum(map(len, b.words)) == 100 for b in blocks)


def test_pipeline_with_clashing_columns_and_odd_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame(
        [(-1, None, "en", "a", 0), (-2, "", "en", "a", 0), (None, "1 2 3", None, None, None)] * 2, "doc_id long, text string, lang string, source string, n_chars long"
    )
    given = docs.unionByName(docs.limit(20)).unionByName(odd).select(
        "*", F.lit(1.5).alias("score"), F.lit("x").alias("lang_pred"), F.lit(True).alias("ambiguous"), F.lit(7).alias("copy"),
        F.lit("t").alias("__text"), F.create_map(F.lit("k"), F.lit(1)).alias("tags"), F.lit(3).alias("row"),
    )
    given.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    plain = queries()["pipeline"](spark, SF_DIR)
    clashing = queries()["pipeline"](spark, str(tmp_path))
    assert clashing.columns == [*given.columns, "copy_2"]
    ours = Counter((r.doc_id, r.text, r.copy_2) for r in clashing.collect())
    assert ours == Counter((r.doc_id, r.text, r["copy"]) for r in plain.collect())
    assert all(r["copy"] == 7 and r.tags == {"k": 1} for r in clashing.select("copy", "tags").collect())


def test_pipeline_of_nothing(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert queries()["pipeline"](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("stage", ["language", "similar", "repeats", "benchmark"])
def test_stages_send_small_batches_to_python(spark, tmp_path, stage):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    texts = [(i, f"{i} " + f"word{i} of text " * 4_000) for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text")).coalesce(1)
    docs.limit(2).selectExpr("doc_id AS item_id", "left(text, 200) AS text").write.parquet(f"{tmp_path}/benchmark.parquet")

    def sizes(batches):
        for batch in batches:
            yield batch.select(["doc_id"]).slice(0, 1).set_column(0, "bytes", pa.array([batch.get_total_buffer_size()]))

    try:
        spark.conf.set(name, "64m")
        dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path))
        found = [r.bytes for r in docs.select("doc_id", "text").mapInArrow(sizes, "bytes long").collect()]
        assert sum(found) > 2 * session.BATCH_BYTES and max(found) <= 2 * session.BATCH_BYTES
        spark.conf.set(name, "1m")
        session.in_small_batches(spark)
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.set(name, before)


AFTER_A_BLOCK = """
import re
import numpy as np, pyarrow as pa
from tokenloom.llm import prefix_free

def held():
    rollup = open("/proc/self/smaps_rollup").read()
    return int(re.search(r"Anonymous: +([0-9]+)", rollup)[1]) / 1024

def block(texts):
    docs, sink = pa.table({"doc_id": np.arange(len(texts)), "text": texts}), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema) as out:
        out.write_table(docs)
    return pa.table({"rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

letters = np.random.default_rng(3).integers(97, 123, (4_000, 3_000), np.uint8)
texts = [bytes(x).decode() for x in letters]
none = pa.schema([(n, pa.binary()) for n in ("at", "first", "docs")] + [(n, pa.int64()) for n in ("blk", "step", "bucket")]).empty_table()
run, key, few, many = prefix_free._ask(4, 7, 50), (pa.scalar(0),), block(texts[:2]), block(texts)
run(key, few, none)
before = held()
run(key, many, none)
print(held() - before)
"""


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="needs Linux")
def test_a_worker_does_not_keep_what_a_block_took():
    here = Path(__file__).resolve().parents[2]
    done = subprocess.run([sys.executable, "-c", AFTER_A_BLOCK], cwd=here, capture_output=True, text=True, check=True)
    assert float(done.stdout) < 5


# -- op10 ---------------------------------------------------------------------


def packed(texts):
    return pa.table({"rows": pa.array([prefix_free._compressed(pa.table({"doc_id": np.arange(len(texts)), "text": texts}))], pa.binary())})


def test_each_step_of_repeats_is_asked_and_answered_once(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = prefix_free.repeat_report(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapCoGroupsInArrow") == 4 and plan.count("FlatMapGroupsInArrow") == 5


def test_texts_are_parsed_in_two_steps_only(monkeypatch):
    parse, parsed = prefix_free.parse, []
    monkeypatch.setattr(prefix_free, "parse", lambda data, *more: parsed.append(len(data)) or parse(data, *more))
    rng = np.random.default_rng(11)
    passage = bytes(rng.integers(97, 123, 300, np.uint8)).decode()
    texts = [passage + bytes(rng.integers(97, 123, 200, np.uint8)).decode() for _ in range(4)]
    docs, bits, sizes = packed(texts), 5, []
    asked = prefix_free._first_ask(bits, 50)((pa.scalar(0),), docs)
    for step in (2, 3, 4):
        sizes.append(sum(parsed))
        bucket = asked.column("bucket").to_numpy()
        replies = [prefix_free._answer((pa.scalar(int(b)),), asked.filter(pa.array(bucket == b))) for b in np.unique(bucket)]
        asked = prefix_free._ask(step, bits, 50)((pa.scalar(0),), docs, pa.concat_tables(replies))
    assert sizes == [2000, 4000, 4000] and sum(parsed) == 4000


def test_keys_of_spans_do_not_depend_on_other_spans(monkeypatch):
    data = np.tile(np.random.default_rng(12).integers(0, 256, 200, np.uint8), 2)
    start = np.arange(200).repeat(6)
    end = start + np.tile([8, 9, 16, 50, 57, 84], 200)
    keys = prefix_free.span_keys(data, start, end)
    assert len(np.unique(keys)) == len(keys)
    here = end + 200 <= len(data)
    assert (prefix_free.span_keys(data, start[here] + 200, end[here] + 200) == keys[here]).all()
    monkeypatch.setattr(prefix_free, "SPANS", 1)
    assert (prefix_free.span_keys(data, start, end) == keys).all()


def test_buckets_are_fewer_than_blocks():
    for blocks in (140, 8_600):
        assert 2 <= blocks / (1 << prefix_free._bits(blocks)) < 4
