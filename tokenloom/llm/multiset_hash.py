"""Homomorphic multiset hash of a text's paragraphs.

A paragraph is a line that is not empty.  Each is hashed to a wide vector and a
text's fingerprint is the sum of them, lane by lane, modulo ``2**16`` in the lanes
for equality and ``2**32`` in those for likeness, which no text overflows.  Sums do
not depend on order, so texts with the same multiset of paragraphs are equal,
and a paragraph is inserted or deleted by adding or subtracting its vector.

The vector has two parts.  ``EQUAL`` lanes hold the paragraph's SHAKE-128
output: they decide equality.  ``LIKE`` lanes hold a count sketch of the
paragraph's three-word runs, each adding +1 or -1 to one lane: since the sketch
is linear too, the difference of two fingerprints estimates how many runs the
texts do not share.  Likeness is ``1 - |a-b|^2 / (|a|^2 + |b|^2)`` over these
lanes, cut to 0..1: 1 for equal texts and for two without words, about 0 for
texts with no run in common.  Its error is about ``sqrt(2 / LIKE)`` of the
difference.

A null text is an empty one, with a fingerprint of zeros.  Rows of equal
``doc_id`` follow each other in order of text, rows without an id come first.
An empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tokenloom.llm.bytetext import PIECE, Words, pieces, runs, shingles

EQUAL = 128
LIKE = 128
RUN = 3
# Texts of one range of ids; each range is read in order by one task.
RANGE_ROWS = 1_000

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprints(column: pa.Array) -> np.ndarray:
    """One row of ``EQUAL + LIKE`` lanes per text."""
    out = np.zeros((len(column), EQUAL + LIKE), np.uint32)
    for first, end, data, off in pieces(column):
        start, stop = runs(data != 10, off)
        if not len(start):
            continue
        text = np.searchsorted(off, start, side="right") - 1
        raw = data.tobytes()
        lanes = np.frombuffer(
            b"".join(hashlib.shake_128(raw[a:b]).digest(2 * EQUAL) for a, b in zip(start.tolist(), stop.tolist(), strict=True)), "<u2"
        ).reshape(-1, EQUAL)
        at = np.flatnonzero(np.diff(text, prepend=-1))
        out[first + text[at], :EQUAL] = np.add.reduceat(lanes, at, axis=0, dtype=np.uint16)
        found, bound = shingles(Words(data, np.append(start, len(data)), lower=False), RUN)
        of = np.repeat(text, np.diff(bound))
        lane = (found % np.uint64(LIKE)).astype(np.int64)
        sign = 1.0 - 2.0 * ((found >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
        sums = np.bincount(of * LIKE + lane, weights=sign, minlength=(end - first) * LIKE)
        out[first:end, EQUAL:] = sums.astype(np.int64).astype(np.uint32).reshape(-1, LIKE)
    return out


def _wrapped(lanes: np.ndarray) -> np.ndarray:
    """Sums or differences of fingerprints as a fingerprint."""
    lanes = lanes.astype(np.uint32)
    lanes[..., :EQUAL] &= 0xFFFF
    return lanes


def insert(fingerprint: np.ndarray, paragraphs: Iterable[str]) -> np.ndarray:
    """The fingerprint after inserting paragraphs."""
    added = fingerprints(pa.array(list(paragraphs), pa.string()))
    return _wrapped(fingerprint + added.sum(axis=0, dtype=np.uint32))


def delete(fingerprint: np.ndarray, paragraphs: Iterable[str]) -> np.ndarray:
    """The fingerprint after deleting paragraphs that it holds."""
    gone = fingerprints(pa.array(list(paragraphs), pa.string()))
    return _wrapped(fingerprint - gone.sum(axis=0, dtype=np.uint32))


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness of fingerprints, row by row."""
    x, y = (v[:, EQUAL:].view(np.int32).astype(np.float64) for v in map(np.ascontiguousarray, (a, b)))
    apart, norm = ((x - y) ** 2).sum(axis=1), (x**2).sum(axis=1) + (y**2).sum(axis=1)
    like = np.clip(1.0 - apart / np.where(norm > 0, norm, 1.0), 0.0, 1.0)
    return np.where(norm > 0, like, (a == b).all(axis=1).astype(np.float64))


def spelled(fingerprint: np.ndarray) -> str:
    return base64.b64encode(fingerprint[:EQUAL].astype("<u2").tobytes() + fingerprint[EQUAL:].astype("<u4").tobytes()).decode()


def _edited(text: str, after: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _report(ids: list, texts: list[str], after: list[str]) -> pa.RecordBatch:
    """Rows of ``SCHEMA`` for texts and those that follow them."""
    edited = [_edited(a, b) for a, b in zip(texts, after, strict=True)]
    n = len(texts)
    every = fingerprints(pa.array([*texts, *edited, *after], pa.large_string()).cast(pa.large_string()))
    own, new, nxt = every[:n], every[n : 2 * n], every[2 * n :]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array([spelled(f) for f in own], pa.string()),
            pa.array([spelled(f) for f in new], pa.string()),
            pa.array(likeness(own, new), pa.float64()),
            pa.array(likeness(own, nxt), pa.float64()),
        ],
        names=[part.split()[0] for part in SCHEMA.split(", ")],
    )


def _within_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the one after it, if that is of the same range."""
    held: tuple | None = None
    ids, texts, after, size = [], [], [], 0
    for batch in batches:
        for r, doc, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if held is not None and held[0] == r:
                ids.append(held[1])
                texts.append(held[2])
                after.append(text)
                size += len(held[2])
            held = (r, doc, text)
            if size > PIECE:
                yield _report(ids, texts, after)
                ids, texts, after, size = [], [], [], 0
    if ids:
        yield _report(ids, texts, after)


def _given_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            ids, texts, after = (batch.column(i).slice(k, 1).to_pylist() for i in range(3))
            yield _report(ids, texts, after)


def edit_report(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how near they are.

    The edited text has its last half replaced by the first as many code points
    of the next text in order of ``doc_id``, the last text's next being the
    first.  Texts are shuffled once, into ranges of ids that are each read in
    order; the last text of a range meets the first of the next range, of which
    there is one row each, by a join.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    count = rows.count()
    cuts = max(0, min(4_095, count // range_rows))
    bounds = rows.where("doc_id IS NOT NULL").approxQuantile("doc_id", [(i + 1) / (cuts + 1) for i in range(cuts)], 0.001) if cuts else []
    edges = F.array(*[F.lit(int(b)) for b in sorted(set(bounds))]) if bounds else F.array().cast("array<long>")
    ranged = rows.select(
        F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(edges, lambda b: b <= F.col("doc_id")))).alias("r"), "doc_id", "text"
    )
    inner = ranged.repartition("r").sortWithinPartitions("r", "doc_id", "text").mapInArrow(_within_ranges, SCHEMA)
    ends = ranged.groupBy("r").agg(
        F.min(F.struct("doc_id", "text")).alias("first"), F.max(F.struct("doc_id", "text")).alias("last")
    )
    order = W.orderBy("r")  # one row per range, without texts
    follows = ranged.select("r").distinct().select(
        "r", F.coalesce(F.lead("r").over(order), F.first("r").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("next")
    )
    firsts = ends.select(F.col("r").alias("next"), F.col("first.text").alias("after"))
    outer = (
        ends.select("r", F.col("last.doc_id").alias("doc_id"), F.col("last.text").alias("text"))
        .join(follows, "r").join(firsts, "next").select("doc_id", "text", "after")
        .mapInArrow(_given_next, SCHEMA)
    )
    return inner.unionByName(outer)
