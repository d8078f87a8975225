"""Similarity join of documents on word n-grams, and the groups it links.

A document's set is its distinct runs of ``width`` words, lower-cased in ASCII;
with fewer words the whole sequence is its one run.  Two documents link if
``100 * |intersection| >= percent * |union|``.

1. A fixed-size sketch of counts (``2**SKETCH_BITS`` numbers, whatever the
   corpus) orders n-grams, rare ones first, ties by hash.  Any order is right;
   a good one keeps frequent n-grams out of the prefixes.
2. Documents of equal sets form a class, which the smallest id stands for.
3. A class's *prefix* is the first of its n-grams in that order, as many as it
   takes for two linked sets to share one.  Prefixes are joined on the n-gram.
   Pairs pass the length filter, the positional filter (the n-grams after the
   shared one must suffice) and the suffix filter (the n-grams are dealt to
   ranges of hash values; the parities that differ bound the difference from
   below): with 128 ranges where pairs are made, with about as many ranges as
   the set has n-grams on the distinct pairs.
4. Pairs that pass are verified once each, on the whole sets.

Groups of near copies would make all pairs.  So the first round joins each
class only with one *hub* among those that share an n-gram: the one whose
prefix is most frequent, as an original's is, edits being rare.  The second
joins what the verified links have not already brought into one component.  No
link between components is lost; links inside one are not needed.

A null or empty text has an empty set and links with nothing.  A row without
id links with nothing and has no component.  Rows that share an id are one
node.  An empty table gives an empty one.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.bytetext import Words, binary, digest, mix, pieces, shingles, signed
from tokenloom.llm.components import components, joined_further
from tokenloom.operators.wordlists import fits_broadcast
from tokenloom.session import settled

WIDTH = 5
PERCENT = 80
SKETCH_BITS = 20
CHUNK = 1 << 16
# Ranges of the parities that pairs are made with.
COARSE = 128
# Ids of documents to verify or to drop are broadcast up to this many (8 bytes each).
FEW_IDS = 4_000_000

FEATURES = "doc_id long, n int, k1 long, k2 long, prefix array<long>, b0 long, b1 long, parities binary, weight long"


def text_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct n-gram hashes of every text."""
    for first, end, data, off in pieces(column):
        found, bound = shingles(Words(data, off), width)
        for i in range(end - first):
            yield first + i, np.unique(found[bound[i] : bound[i + 1]])


def _sketch(width: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for _, found in text_sets(batch.column(0), width):
                np.add.at(counts, (found >> np.uint64(64 - bits)).astype(np.int64), 1)
        yield _chunks({i: c for i, c in enumerate(counts.reshape(-1, min(CHUNK, len(counts)))) if c.any()})

    return run


def _chunks(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), binary(list(parts.values()))], names=["chunk", "counts"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(blob, np.uint32)
            # Saturates, so a corpus of any size has a usable order.
            sums[chunk] = part.copy() if chunk not in sums else np.maximum(sums[chunk] + part, sums[chunk])
    yield _chunks(sums)


def count_sketch(docs: DataFrame, width: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """How many documents have an n-gram, summed by the first ``bits`` bits of its hash."""
    kind = "chunk int, counts binary"
    parts = docs.select("text").mapInArrow(_sketch(width, bits), kind).repartition("chunk").mapInArrow(_added, kind)
    counts = np.zeros(1 << bits, np.uint32)
    for row in parts.collect():
        part = np.frombuffer(row.counts, np.uint32)
        counts[row.chunk * len(part) : (row.chunk + 1) * len(part)] = part
    return counts


def _features(width: int, percent: int, counts, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        for batch in batches:
            ids = batch.column(0)
            rows: list[tuple] = []
            for i, found in text_sets(batch.column(1), width):
                n = len(found)
                if not n:
                    rows.append((ids[i].as_py(), 0, 0, 0, [], 0, 0, b"", 0))
                    continue
                often = table[(found >> np.uint64(64 - bits)).astype(np.int64)]
                length = n - (percent * n + 99) // 100 + 1
                order = np.lexsort((found, often))[:length]
                fine = parities(found)
                b0, b1 = np.packbits(folded(fine, COARSE)).view(np.int64)
                rows.append((ids[i].as_py(), n, *digest(found), signed(found[order]), int(b0), int(b1), np.packbits(fine).tobytes(), int(np.sum(often[order], dtype=np.int64) // length)))
                if len(rows) >= 2_000:
                    yield _feature_rows(rows)
                    rows = []
            yield _feature_rows(rows)

    return run


def _feature_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=[part.split()[0] for part in FEATURES.split(", ")]
    )


def parities(found: np.ndarray) -> np.ndarray:
    """Whether each range of hash values holds an odd number of the n-grams; a range for every one or two of them, ``COARSE`` at least."""
    bits = max(COARSE.bit_length(), len(found).bit_length()) - 1
    return np.bincount((mix(found) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits) & 1 > 0


def folded(odd: np.ndarray, size: int) -> np.ndarray:
    """The parities of ``size`` wider ranges."""
    return np.logical_xor.reduce(odd.reshape(size, -1), axis=1)


def _near(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, n in zip(*(batch.column(c) for c in ("x", "y", "total")), strict=True):
                x, y = (np.unpackbits(np.frombuffer(v.as_buffer(), np.uint8)) for v in (x, y))
                size, n = min(len(x), len(y)), n.as_py()
                apart = int(np.count_nonzero(folded(x, size) != folded(y, size)))
                keep.append((n - apart) * (100 + percent) >= n * percent * 2)
            yield batch.select(["a", "b", "w"]).filter(pa.array(keep, pa.bool_()))

    return run


def fine_suffix_filter(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """The ``a, b, w`` whose parities leave enough n-grams in common."""
    x, y = (facts.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("parities").alias(p)) for c, p in (("a", "x"), ("b", "y")))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", "w", "x", "y", (F.col("n_a") + F.col("n_b")).cast("long").alias("total"))
    return both.mapInArrow(_near(percent), "a long, b long, w long")


def may_link(x: str, y: str, percent: int) -> Column:
    """Length and positional filter for classes ``x`` and ``y`` that share the n-gram at their ``p``."""
    nx, ny, px, py = (F.col(f"{a}.{c}") for c in ("n", "p") for a in (x, y))
    length = F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent
    position = (1 + F.least(nx - px - 1, ny - py - 1)).cast("long") * (100 + percent) >= (nx + ny).cast("long") * percent
    return length & position


def suffix_filter(x: str, y: str, percent: int) -> Column:
    """Whether the parities leave enough n-grams in common."""
    apart = F.bit_count(F.col(f"{x}.b0").bitwiseXOR(F.col(f"{y}.b0"))) + F.bit_count(F.col(f"{x}.b1").bitwiseXOR(F.col(f"{y}.b1")))
    total = (F.col(f"{x}.n") + F.col(f"{y}.n")).cast("long")
    return (total - apart) * (100 + percent) >= total * percent * 2


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for i, found in text_sets(batch.column(1), width):
                rows.append((ids[i], found.tobytes()))
                if len(rows) >= 500:
                    yield _set_rows(rows)
                    rows = []
            yield _set_rows(rows)

    return run


def _set_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["id", "grams"])


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return run


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The linked ones of distinct pairs ``a, b``, compared on the whole sets.

    Only documents that are in a pair are turned into sets.  Their ids, 8 bytes
    each, are broadcast up to ``FEW_IDS`` of them; more are joined by a shuffle.
    """
    pairs = settled(pairs)
    if pairs.isEmpty():
        return pairs.select("a", "b")
    ids = settled(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct())
    side = F.broadcast(ids) if ids.count() <= FEW_IDS else ids
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(side, "id", "left_semi")
    sets = texts.mapInArrow(_sets(width), "id long, grams binary")
    few = F.broadcast(pairs) if fits_broadcast(pairs) else pairs
    joined = (
        sets.withColumnRenamed("id", "a").withColumnRenamed("grams", "x").join(few, "a")
        .join(sets.withColumnRenamed("id", "b").withColumnRenamed("grams", "y"), "b")
        .select("a", "b", "x", "y")
    )
    return settled(joined.mapInArrow(_linked(percent), "a long, b long").distinct())


def similar_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, bits: int = SKETCH_BITS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = spark.sparkContext.broadcast(count_sketch(rows, width, bits))
    features = settled(rows.mapInArrow(_features(width, percent, counts, bits), FEATURES))
    classes = (
        features.where("n > 0 AND doc_id IS NOT NULL")
        .groupBy("k1", "k2")
        .agg(F.min("doc_id").alias("id"), *[F.any_value(c).alias(c) for c in ("n", "prefix", "b0", "b1", "parities", "weight")])
    )
    classes = settled(classes)
    entries = classes.select("id", "n", F.posexplode("prefix").alias("p", "gram"))
    facts = classes.select("id", "n", "b0", "b1", "parities", "weight")

    common = entries.select("gram").groupBy("gram").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("gram")
    met = settled(entries.join(common, "gram", "left_semi").join(facts.select("id", "weight"), "id"))
    hubs = met.groupBy("gram").agg(F.max(F.struct("weight", "id", "n", "p")).alias("h"))
    shared = met.alias("x").join(hubs.alias("y"), F.col("x.gram") == F.col("y.gram")).select(
        "x.*", F.col("y.h.id").alias("hub"), F.col("y.h.n").alias("hub_n"), F.col("y.h.p").alias("hub_p"), F.col("y.h.weight").alias("hub_weight")
    )
    star = shared.select(F.struct("id", "n", "p").alias("x"), F.struct(F.col("hub").alias("id"), F.col("hub_n").alias("n"), F.col("hub_p").alias("p")).alias("y"), "hub_weight")
    star = star.where("x.id <> y.id").where(may_link("x", "y", percent)).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("hub_weight").alias("w")).distinct()
    near = fine_suffix_filter(star, facts, percent)
    best = near.groupBy("a").agg(F.max(F.struct("w", "b")).alias("h")).select("a", F.col("h.b").alias("b"))
    links = verified(best, rows, width, percent)
    parts = settled(components(links))

    placed = met.select("gram", "id", "n", "p").join(parts, "id", "left").withColumn("part", F.coalesce("component", "id"))
    open_grams = placed.groupBy("gram").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("gram")
    left = settled(placed.join(open_grams, "gram", "left_semi").join(facts.select("id", "b0", "b1"), "id").select("gram", "id", "n", "p", "part", "b0", "b1"))
    rest = left.alias("x").join(
        left.alias("y"),
        (F.col("x.gram") == F.col("y.gram")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.part") != F.col("y.part"))
        & may_link("x", "y", percent) & suffix_filter("x", "y", percent),
    ).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.lit(0).cast("long").alias("w")).distinct()
    rest = fine_suffix_filter(rest, facts, percent).select("a", "b")
    found = joined_further(parts, verified(rest, rows, width, percent))

    named = features.alias("f").join(
        classes.select("k1", "k2", "id").alias("c"),
        (F.col("f.k1") == F.col("c.k1")) & (F.col("f.k2") == F.col("c.k2")) & (F.col("f.n") > 0) & F.col("f.doc_id").isNotNull(), "left",
    ).select("f.doc_id", "f.n", "c.id")
    return named.join(found, "id", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "id", "doc_id").alias("component_id")
    )


def one_per_group(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, repeated: bool = True) -> DataFrame:
    """``docs`` with one row of each group: the one of smallest id, a null id being last.

    A row is what its id and text say, kept apart by a 64-bit hash of both: two
    texts under one id are two rows, and rows without id are in groups too.
    Rows of equal id and text stay or go together; without ``repeated`` one of
    them stays, the one whose columns written as JSON come first.
    """
    row = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    groups = similar_groups(docs.select(row.alias("doc_id"), "text"), width, percent)
    ids = settled(docs.groupBy(row.alias("row"), F.col("doc_id").cast("long").alias("id")).agg(F.count(F.lit(1)).alias("times")))
    moved = settled(groups.where("doc_id <> component_id").select(F.col("doc_id").alias("row"), F.col("component_id").alias("part")).distinct())
    members = settled(moved.unionByName(moved.select(F.col("part").alias("row"), "part").distinct()).join(ids, "row").select("row", "part", "id"))
    first = members.groupBy("part").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first")).select(F.col("first.row").alias("row"))
    kept = _joined(docs, row, members.select("row").join(first, "row", "left_anti"), "left_anti")
    if repeated:
        return kept
    again = ids.where("times > 1").select("row")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    if again.isEmpty():
        return kept
    one = _joined(kept, row, again, "left_semi").groupBy(row.alias("row")).agg(F.min_by(whole, F.to_json(whole)).alias("one")).select("one.*")
    return _joined(kept, row, again, "left_anti").unionByName(one)


def _joined(docs: DataFrame, row: Column, rows: DataFrame, how: str) -> DataFrame:
    """``docs`` joined ``how`` with the hashes ``rows``."""
    rows = settled(rows)
    side = F.broadcast(rows) if rows.count() <= FEW_IDS else rows
    return docs.join(side, row == side["row"], how)
