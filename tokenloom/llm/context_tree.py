"""Language model scores by context-tree weighting over bytes.

A byte is eight binary decisions, each with a context tree of its own: node
``s`` at depth ``k`` is the last ``k`` bytes.  A node estimates by
Krichevsky-Trofimov, ``(a + 1/2) / (a + b + 1)``, and its weighted probability is
half its own estimate and half the product of its children's, down to depth
``DEPTH``; so all tree models up to that depth are mixed by their code length
on the training texts.  A text's score is the log10 probability the mixture
gives its bytes and one end mark, from the frozen tree; ``score * log2(10) /
bytes`` is the code length per byte.  Before its first byte a text has zero
bytes.

*Counting.*  Runs of ``DEPTH + 1`` bytes hold all that the trees need.  They
and the words are counted per task and summed by Spark, over all training
texts; runs and words of the other texts come along with count 0, so every text
finds all its runs.  Runs are dealt out by their last two context bytes: the
tree below is then in one task, bounded by the number of distinct runs.
What is above, at most 2**24 nodes whatever the corpus, is mixed on the driver.

*Scoring.*  The tables of runs and words are broadcast in slices of at most
``SLICE`` rows; each slice adds its part in a scan of its own.

``base_score`` is a smoothed unigram model of lower-cased words and one end.
A null or empty text has one token, its end.  A row without id is scored and
teaches nothing.  Repeated rows are scored alike.  An empty table gives an
empty one; without training texts every byte has probability 1/256.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.bytetext import Words, pieces, signed
from tokenloom.session import settled

DEPTH = 5
SLICE = 8_000_000
# Distinct keys that a task holds before it hands them on.
HELD = 2_000_000
SMOOTH = 0.1

_HALF = np.log(0.5)
_WORD, _RUN = 0, 1


def byte_runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each byte and end mark with its context, as one number, and the bounds of each text.

    The byte before comes first in the number, then the one before that, and
    the byte itself last, so runs in order of number are a tree in order.
    """
    n = len(off) - 1
    spread = np.zeros(len(data) + (n + 1) * DEPTH, np.uint64)
    at = np.arange(len(data)) + DEPTH * (1 + np.repeat(np.arange(n), np.diff(off)))
    spread[at] = data
    code = spread[DEPTH:].copy()
    for k in range(1, DEPTH + 1):
        code |= spread[DEPTH - k : len(spread) - k] << np.uint64(8 * (DEPTH + 1 - k))
    bound = off + np.arange(n + 1)
    keep = np.arange(bound[-1]) + np.repeat(np.arange(n), np.diff(bound)) * (DEPTH - 1)
    return code[keep], bound


class _Counts:
    """Distinct keys with their counts, kept sorted in a few arrays."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray, learn: np.ndarray) -> None:
        order = np.argsort(keys)
        keys, learn = keys[order], learn[order]
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
        if len(at):
            self.keys.append(keys[at])
            self.counts.append(np.add.reduceat(learn.astype(np.int64), at))
            self.size += len(at)

    def fold(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.concatenate([np.zeros(0, np.uint64), *self.keys]), np.concatenate([np.zeros(0, np.int64), *self.counts])
        self.__init__()
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        if not len(keys):
            return keys, counts
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[at], np.add.reduceat(counts, at)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = {_WORD: _Counts(), _RUN: _Counts()}

    def rows(kind: int) -> Iterator[pa.RecordBatch]:
        keys, counts = held[kind].fold()
        for lo in range(0, len(keys), 100_000):
            part = keys[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), kind, np.int32)), pa.array(signed(part)), pa.array(counts[lo : lo + 100_000])], names=["kind", "key", "n"]
            )

    def shrink() -> Iterator[pa.RecordBatch]:
        for kind, counts in held.items():
            if counts.size > 2 * HELD:
                keys, n = counts.fold()
                if len(keys) > HELD:
                    counts.keys, counts.counts, counts.size = [keys], [n], len(keys)
                    yield from rows(kind)
                else:
                    counts.keys, counts.counts, counts.size = [keys], [n], len(keys)

    for batch in batches:
        learn = np.array(batch.column(1).to_pylist(), bool)
        for first, end, data, off in pieces(batch.column(0)):
            mine = learn[first:end]
            words = Words(data, off)
            held[_WORD].add(words.hashes(), mine[words.text])
            runs, bound = byte_runs(data, off)
            held[_RUN].add(runs, np.repeat(mine, np.diff(bound)))
            yield from shrink()
    for kind in held:
        yield from rows(kind)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift = np.where(low, shift + np.log(np.where(low, y, 1.0)), shift)
        y = np.where(low, y + 1, y)
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y - shift


def log_estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the KT probability of ``a`` zeros and ``b`` ones."""
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1.0) - np.log(np.pi)


class _Level:
    """The nodes of one depth: a context and the bits before the decision."""

    def __init__(self, nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.nodes, self.zeros, self.ones = nodes, zeros.astype(float), ones.astype(float)
        own = log_estimate(self.zeros, self.ones)
        self.weighted = own if below is None else np.logaddexp(_HALF + own, _HALF + below)
        self.share = np.ones(len(own)) if below is None else np.exp(_HALF + own - self.weighted)
        self.one = (self.ones + 0.5) / (self.zeros + self.ones + 1.0)

    def parents(self) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(((self.nodes >> np.uint64(16)) << np.uint64(8)) | (self.nodes & np.uint64(255)), return_inverse=True)

    def above(self) -> _Level:
        """The next depth up, all of whose children are here."""
        nodes, where = self.parents()
        sums = [np.bincount(where, weights=x, minlength=len(nodes)) for x in (self.zeros, self.ones, self.weighted)]
        return _Level(nodes, *sums)


def _decisions(runs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes at full depth of the eight decisions of each run, the bits, and the counts."""
    symbol = runs & np.uint64(255)
    bits = np.arange(7, -1, -1, dtype=np.uint64)
    before = (np.uint64(1) << np.arange(8, dtype=np.uint64)) | (symbol[:, None] >> (bits + np.uint64(1)))
    nodes = ((runs >> np.uint64(8))[:, None] << np.uint64(8)) | before
    return nodes.ravel(), ((symbol[:, None] >> bits) & np.uint64(1)).astype(bool).ravel(), np.repeat(n, 8)


def _subtree(runs: np.ndarray, n: np.ndarray) -> tuple[list[_Level], list[np.ndarray], np.ndarray]:
    """Levels from full depth up to 2, each decision's node in each, and the bits."""
    at, bit, count = _decisions(runs, n)
    nodes, where = np.unique(at, return_inverse=True)
    ones = np.bincount(where, weights=count * bit, minlength=len(nodes))
    levels = [_Level(nodes, np.bincount(where, weights=count, minlength=len(nodes)) - ones, ones, None)]
    place = [where]
    while len(levels) < DEPTH - 1:
        place.append(levels[-1].parents()[1][place[-1]])
        levels.append(levels[-1].above())
    return levels, place, bit


def _read(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    keys = np.concatenate([np.zeros(0, np.int64), *[k for k, _ in parts]]).astype(np.uint64)
    return keys, np.concatenate([np.zeros(0, np.int64), *[n for _, n in parts]])


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs, n = _read(batches)
    if len(runs):
        level = _subtree(runs, n)[0][-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(level.nodes)), *map(pa.array, (level.zeros, level.ones, level.weighted))], names=["node", "zeros", "ones", "weighted"]
        )


def _upper(tops: pa.Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Nodes, own shares and estimates at depths 1 and 0."""
    level = _Level.__new__(_Level)
    level.nodes = tops.column("node").to_numpy().astype(np.uint64)
    level.zeros, level.ones, level.weighted = (tops.column(c).to_numpy() for c in ("zeros", "ones", "weighted"))
    out = []
    for _ in range(2):
        level = level.above()
        out.append((level.nodes, level.share, level.one))
    return out


def _probabilities(upper) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, n = _read(batches)
        if not len(runs):
            return
        levels, place, bit = _subtree(runs, n)
        mixed = levels[0].one[place[0]]
        for level, where in zip(levels[1:], place[1:], strict=True):
            share = level.share[where]
            mixed = share * level.one[where] + (1 - share) * mixed
        node = levels[-1].nodes[place[-1]]
        for nodes, share, one in upper.value:
            node = ((node >> np.uint64(16)) << np.uint64(8)) | (node & np.uint64(255))
            where = np.searchsorted(nodes, node)
            mixed = share[where] * one[where] + (1 - share[where]) * mixed
        logs = np.log10(np.where(bit, mixed, 1 - mixed)).reshape(-1, 8).sum(axis=1)
        for lo in range(0, len(runs), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(runs[lo : lo + 100_000])), pa.array(logs[lo : lo + 100_000].astype(np.float32))], names=["key", "value"]
            )

    return run


def _lookup(keys: np.ndarray, table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Value of each key, and whether the table has it."""
    distinct, where = np.unique(keys, return_inverse=True)
    if not len(table) or not len(keys):
        return np.zeros(len(keys)), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, distinct), len(table) - 1)
    have = table[at] == distinct
    return np.where(have, values[at], 0)[where], have[where]


def _score(slice_, total: int, distinct: int) -> Callable:
    """Adds up what a slice knows of each text: known tokens, base score and score."""
    norm = np.log10(total + SMOOTH * (distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_keys, word_counts, run_keys, run_values = slice_.value
        for batch in batches:
            count, known, base, score = (np.zeros(batch.num_rows) for _ in range(4))
            for first, end, data, off in pieces(batch.column(batch.num_columns - 1)):
                rows = end - first
                words = Words(data, off)
                c, have = _lookup(words.hashes(), word_keys, word_counts)
                logs = np.where(have, np.log10(c + SMOOTH) - norm, 0.0)
                count[first:end] = np.diff(words.bound)
                known[first:end] = np.bincount(words.text, weights=c > 0, minlength=rows)
                base[first:end] = np.bincount(words.text, weights=logs, minlength=rows)
                runs, bound = byte_runs(data, off)
                values, _ = _lookup(runs, run_keys, run_values)
                score[first:end] = np.add.reduceat(values, bound[:-1])
            given = [batch.column(i) for i in range(batch.num_columns - 1)]
            new = [pa.array(count.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score)]
            yield pa.RecordBatch.from_arrays([*given, *new], names=[*batch.schema.names[:-1], "words", "known", "base", "score"])

    return run


def score_texts(docs: DataFrame, learn: Column, held_out: Column, slice_rows: int = SLICE) -> DataFrame:
    """Scores of every row's text by the models of the rows that ``learn`` marks.

    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte``.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce(learn, F.lit(False)).alias("learn"), "text"
    )
    counted = settled(rows.select("text", "learn").mapInArrow(_count, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")))
    words = counted.where(F.col("kind") == _WORD)
    size, tokens, distinct = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    texts = rows.where("learn").count()
    total, distinct = tokens + texts, distinct + (texts > 0)

    runs = counted.where(F.col("kind") == _RUN).select("key", "n").repartition(F.shiftright("key", 8 * (DEPTH - 1)))
    tops = runs.mapInArrow(_tops, "node long, zeros double, ones double, weighted double").toArrow()
    upper = context.broadcast(_upper(tops))
    values = settled(runs.mapInArrow(_probabilities(upper), "key long, value float"))

    slices = max(1, -(-(size + values.count()) // slice_rows))
    part = F.pmod(F.xxhash64("key"), F.lit(slices))
    found = None
    for k in range(slices):
        tables = []
        for frame, value in ((words, "n"), (values, "value")):
            table = frame.where(part == k).select("key", value).toArrow()
            keys, held = table.column(0).to_numpy().view(np.uint64), table.column(1).to_numpy()
            order = np.argsort(keys)
            tables += [keys[order], held[order]]
        scored = rows.select("doc_id", "held_out", F.xxhash64("text").alias("h"), F.octet_length("text").alias("bytes"), "text").mapInArrow(
            _score(context.broadcast(tuple(tables)), total, distinct),
            "doc_id long, held_out boolean, h long, bytes int, words long, known long, base double, score double",
        )
        found = scored.withColumn("k", F.lit(k)) if found is None else found.unionByName(scored.withColumn("k", F.lit(k)))
    if slices > 1:  # rows of equal id and text are alike in each slice
        key = ["doc_id", "held_out", "h", "bytes", "words"]
        alike = found.groupBy("k", *key).agg(F.count(F.lit(1)).alias("rows"), *[F.max(c).alias(c) for c in ("known", "base", "score")])
        summed = alike.groupBy(*key).agg(F.max("rows").cast("int").alias("rows"), *[F.sum(c).alias(c) for c in ("known", "base", "score")])
        found = summed.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    end = float(np.log10(texts + SMOOTH) - np.log10(total + SMOOTH * (distinct + 1)))
    return found.select(
        "doc_id", "held_out", (F.col("words") + 1).alias("n_tokens"), (F.col("known") + int(texts > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + end).alias("base_score"), "score",
        (-F.col("score") * float(np.log2(10)) / F.greatest(F.coalesce("bytes", F.lit(0)), F.lit(1))).alias("bits_per_byte"),
    )
