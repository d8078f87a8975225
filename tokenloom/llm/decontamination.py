"""Finding passages of benchmark items in documents.

Words are runs of letters and digits (ASCII lower-cased; bytes above 127 count
as letters).  An item's seeds are its ``SEED``-word n-grams that some document
holds; how many hold one plays no part, so a copy is not lost in a corpus that
has its n-grams in many other places.  Where a document holds a seed, the words
around it are aligned with the item by Smith-Waterman (``MATCH``, ``MISMATCH``,
``GAP`` a word).  The score is that of the best alignment over that of the item
with itself; a document holds the item if the score is at least ``LEAST`` and
``WORDS`` words (or all of the item) match.

Frequent seeds would lead to many alignments that come to nothing.  A score of
``LEAST`` needs that share of the item's words to match, so an alignment is only
made where so many of them stand in the region at all, which is cheap to see and
never wrong.  A copy is found if three words of it in a row are left as they were.

Documents are scanned twice, for counts and for alignments; nothing but the
counts of the items' n-grams is shuffled.  Benchmark items come in blocks of
``BLOCK_WORDS`` words, each block broadcast for a scan of its own, so what is
broadcast has a bound whatever the benchmark's size.  Whole texts are scanned.

Items of fewer than ``SEED`` words, and null or empty ones, are in no document.
Null and empty texts hold no item.  Repeated documents are found alike,
repeated items once each.  Without documents or items the result is empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.bytetext import Words, pieces, shingles

SEED = 3
MATCH, MISMATCH, GAP = 2, -2, -2
LEAST = 0.5
WORDS = 8
BLOCK_WORDS = 2_000_000

# A word as `_FOLD` leaves it: all other bytes become spaces.
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

_FOLD = np.full(256, 32, np.uint8)
for _lo, _hi in ((48, 58), (97, 123), (128, 256)):
    _FOLD[_lo:_hi] = np.arange(_lo, _hi)
_FOLD[65:91] = np.arange(97, 123)

FOUND = "item_id long, score double, matched long, first_word long, last_word long"


@dataclass
class Items:
    """A block of items: their words' hashes, and where their n-grams stand."""

    ids: list
    words: list[np.ndarray]
    grams: np.ndarray  # sorted and distinct
    place: np.ndarray  # rows of n-gram, item, position; by n-gram

    def plain(self) -> tuple:
        """What executors make the block from; a broadcast holds no class of this package."""
        return self.ids, self.words, self.grams, self.place

    def only(self, keep: np.ndarray) -> Items:
        """The block with these places only."""
        place = self.place[keep]
        used, gram = np.unique(place[:, 0], return_inverse=True)
        return Items(self.ids, self.words, self.grams[used], np.column_stack([gram, place[:, 1:]]))


def _texts(data: np.ndarray, off: np.ndarray) -> Words:
    return Words(_FOLD[data], off, lower=False)


def item_block(rows: list[tuple]) -> Items:
    ids, words, found = [], [], []
    column = pa.array([t or "" for _, t in rows], pa.large_string())
    for first, end, data, off in pieces(column):
        of = _texts(data, off)
        hashes = of.hashes()
        grams, bound = shingles(of, SEED)
        for i in range(end - first):
            own = hashes[of.bound[i] : of.bound[i + 1]]
            if len(own) >= SEED:
                found += [(g, len(ids), p) for p, g in enumerate(grams[bound[i] : bound[i + 1]].tolist())]
                ids.append(rows[first + i][0])
                words.append(own)
    grams, where = np.unique(np.array([f[0] for f in found], np.uint64), return_inverse=True)
    place = np.column_stack([where, np.array([f[1:] for f in found], np.int64).reshape(-1, 2)])
    return Items(ids, words, grams, place[np.argsort(place[:, 0], kind="stable")])


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Items]:
    rows, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), "text").where("text IS NOT NULL").distinct().toLocalIterator():
        rows.append(tuple(row))
        size += len(WORD.findall(row[1].encode()))
        if size >= block_words:
            yield item_block(rows)
            rows, size = [], 0
    if rows:
        yield item_block(rows)


def _look_up(grams: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Place of each n-gram in a sorted table, or -1."""
    if not len(table):
        return np.full(len(grams), -1)
    at = np.minimum(np.searchsorted(table, grams), len(table) - 1)
    return np.where(table[at] == grams, at, -1)


class _Filter:
    """Tells quickly that most n-grams are not in a table."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(table >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        maybe = np.flatnonzero(self.bits[(grams >> np.uint64(44)).astype(np.int64)])
        at = _look_up(grams[maybe], self.table)
        return maybe[at >= 0], at[at >= 0]


def _count(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Items(*block.value).grams
        table, counts = _Filter(grams), np.zeros(len(grams), np.int64)
        for batch in batches:
            for _, _, data, off in pieces(batch.column(0)):
                found, bound = shingles(_texts(data, off), SEED)
                at, gram = table.hits(found)
                text = np.searchsorted(bound, at, side="right") - 1
                counts += np.bincount(np.unique(text * len(grams) + gram) % max(len(grams), 1), minlength=len(grams))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], names=["gram", "docs"])

    return run


def seeds(block: Items, docs_of_gram: np.ndarray) -> Items:
    """The block with the n-grams only that documents hold."""
    return block.only(docs_of_gram[block.place[:, 0]] > 0)


def may_hold(item: np.ndarray, words: np.ndarray) -> bool:
    """Whether enough of the item's words stand among ``words`` for an alignment of :data:`LEAST`.

    With ``m`` matches a score is at most ``m`` times ``MATCH``, and words that
    match are words of the item, each at most as often as it stands in either.
    """
    need = max(int(np.ceil(LEAST * len(item))), min(WORDS, len(item)))
    kinds, of = np.unique(item, return_inverse=True)
    at = _look_up(words, kinds)
    both = np.minimum(np.bincount(of, minlength=len(kinds)), np.bincount(at[at >= 0], minlength=len(kinds)))
    return int(both.sum()) >= need


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment: score, matched words, first and last word in ``words``.

    Row by row; a gap in the row is a running maximum, so rows need no loop
    over their cells.  Of equal scores the first end wins.
    """
    n = len(words)
    step = np.arange(n + 1) * -GAP
    score = np.zeros(n + 1, np.int64)
    start, same = np.arange(n + 1), np.zeros(n + 1, np.int64)
    best = (0, 0, 0, 0)
    for w in item:
        hit = words == w
        diagonal = score[:-1] + np.where(hit, MATCH, MISMATCH)
        up = score[1:] + GAP
        new = np.zeros(n + 1, np.int64)
        new[1:] = np.maximum(np.maximum(diagonal, up), 0)
        from_diagonal = diagonal >= up
        new_start, new_same = np.arange(n + 1), np.zeros(n + 1, np.int64)
        new_start[1:] = np.where(from_diagonal, start[:-1], start[1:])
        new_same[1:] = np.where(from_diagonal, same[:-1] + hit, same[1:])
        zero = new == 0
        new_start[zero], new_same[zero] = np.arange(n + 1)[zero], 0
        lifted = new + step
        run = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == run, np.arange(n + 1), 0))
        along = run - step
        better = along > new
        score = np.where(better, along, new)
        start = np.where(better, new_start[source], new_start)
        same = np.where(better, new_same[source], new_same)
        end = int(score.argmax())
        if score[end] > best[0]:
            best = (int(score[end]), int(same[end]), int(start[end]), end - 1)
    return best


def _matches(block: Items, table: _Filter, data: np.ndarray, off: np.ndarray) -> list[tuple]:
    """``(text, item, score, matched, first, last)`` of the items found in the texts of a piece."""
    words = _texts(data, off)
    grams, bound = shingles(words, SEED)
    at, gram = table.hits(grams)
    if not len(at):
        return []
    hashes = words.hashes()
    first = np.searchsorted(block.place[:, 0], np.arange(len(block.grams) + 1))
    text = np.searchsorted(bound, at, side="right") - 1
    regions: dict[tuple, list[int]] = {}
    for t, p, g in zip(text.tolist(), (at - bound[text]).tolist(), gram.tolist(), strict=True):
        for _, item, q in block.place[first[g] : first[g + 1]].tolist():
            regions.setdefault((t, item), []).append(p - q)
    out = []
    for (t, item), begins in regions.items():
        own, length = block.words[item], len(block.words[item])
        of_text = hashes[words.bound[t] : words.bound[t + 1]]
        begins = sorted(set(begins))
        best = (0, 0, 0, 0)
        lo = 0
        for k in range(1, len(begins) + 1):
            if k == len(begins) or begins[k] - begins[k - 1] > length:
                a = max(0, begins[lo] - length // 2)
                region = of_text[a : begins[k - 1] + length + length // 2]
                if may_hold(own, region):
                    found = align(own, region)
                    best = max(best, (found[0], found[1], found[2] + a, found[3] + a), key=lambda x: x[0])
                lo = k
        score = best[0] / (MATCH * length)
        if score >= LEAST and best[1] >= min(WORDS, length):
            out.append((t, item, score, *best[1:]))
    return out


def _search(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*block.value)
        table = _Filter(items.grams)
        for batch in batches:
            ids = batch.column(0)
            rows = []
            for first, _, data, off in pieces(batch.column(1)):
                rows += [(ids[first + t].as_py(), items.ids[item], *rest) for t, item, *rest in _matches(items, table, data, off)]
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", *[part.split()[0] for part in FOUND.split(", ")]]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return run


def _holds(block):
    """Whether a text holds an item of the block."""

    def run(texts: pa.Array) -> pa.Array:
        items = Items(*block.value)
        table = _Filter(items.grams)
        held = np.zeros(len(texts), bool)
        for first, _, data, off in pieces(texts):
            for t, *_ in _matches(items, table, data, off):
                held[first + t] = True
        return pa.array(held)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "boolean")


def _seeded(docs: DataFrame, block: Items):
    """The broadcast block with its seeds, after counting its n-grams in all documents."""
    context = docs.sparkSession.sparkContext
    whole = context.broadcast(block.plain())
    counted = docs.select("text").mapInArrow(_count(whole), "gram long, docs long").groupBy("gram").agg(F.sum("docs").alias("docs")).collect()
    docs_of_gram = np.zeros(len(block.grams), np.int64)
    for row in counted:
        docs_of_gram[row.gram] = row.docs
    return context.broadcast(seeds(block, docs_of_gram).plain())


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, score, matched, first_word, last_word`` of every document and item it holds."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = f"doc_id long, {FOUND}"
    found = None
    for block in item_blocks(benchmark):
        part = rows.mapInArrow(_search(_seeded(rows, block)), schema)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold an item; no row is shuffled, and only texts go to Python.

    Each block is judged on all of ``docs``, so no scan waits for another's.
    """
    kept = docs
    for block in item_blocks(benchmark):
        kept = kept.where(~_holds(_seeded(docs, block))(F.col("text")))
    return kept
