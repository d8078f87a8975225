"""Nearest neighbours by cross-polytope hashing.

A table turns every unit vector by a pseudo-rotation, three rounds of random
signs and a fast Hadamard transform, and files it under the signed axis nearest
to it.  Where ``2 d`` axes make too few buckets, a further rotation adds axes of
its first coordinates, so that buckets hold about ``BUCKET`` vectors whatever
their number.  A query looks into the buckets of several tables, in each into
those whose axes are nearest to it (*multiprobe*), and ranks what it finds by
the inner product of the original vectors in double precision.

How many buckets to probe is fitted: :data:`SAMPLE` queries are compared with
all vectors, and the least number of probes is taken that finds :data:`RECALL`
of their true neighbours.  That sample is the only one; every vector is filed.

Equal vectors are one row with their least ids, ``k + 1`` of which are all that
a list of ``k`` can name.  A bucket is read in blocks of :data:`BLOCK` vectors,
so a bucket that a third of all vectors share is work for as many tasks as it
has blocks; none is cut short.  What a block gives for a query is its best
``k + 1``, which is all that can be among the best ``k + 1`` of all.

Inner products order vectors of one length as angles do.  Where lengths differ,
a further coordinate brings each vector to the greatest length and queries have
0 there, which leaves the order of inner products as it is.

Cases.  Vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do rows without id.  Only vectors of as many
components are compared.  Rows of one id and one vector are one row; one id with
two vectors is two, neither a candidate of the other.  Equal scores go by id.  A
query that finds fewer than ``k`` looks into all buckets of a table.  Tables
without vectors or queries give no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.bytetext import Kept
from tokenloom.operators.wordlists import fits_broadcast, salted_join
from tokenloom.session import settled

TABLES = 10
BUCKET = 256
BLOCK = 4_096
SAMPLE = 200
RECALL = 0.96
SEED = 20
# Rows of a task's output that are ranked and cut at once.
HELD = 1 << 18

VECTORS = "digest string, size int, vec_id long, vec binary, norm double"


def valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``vec_id, embedding`` to :data:`VECTORS`; components keep their width."""
    for batch in batches:
        ids, column = batch.column(0), batch.column(1)
        out: list[list] = [[], [], [], [], []]
        values = column.values
        off = column.offsets.to_numpy()
        ok = column.is_valid().to_numpy(zero_copy_only=False) & ids.is_valid().to_numpy(zero_copy_only=False)
        bad = values.is_null().to_numpy(zero_copy_only=False)
        flat = values.fill_null(0).to_numpy(zero_copy_only=False)
        flat = flat.astype(np.float32 if flat.dtype == np.float32 else np.float64)
        bad |= ~np.isfinite(flat)
        for i in np.flatnonzero(ok):
            v = flat[off[i] : off[i + 1]]
            if len(v) == 0 or bad[off[i] : off[i + 1]].any() or not v.any():
                continue
            raw = v.astype(np.float64)
            data = v.tobytes()
            for part, value in zip(out, (hashlib.md5(data).hexdigest(), len(v), ids[i].as_py(), data, float(np.sqrt((raw * raw).sum()))), strict=True):
                part.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary()), pa.array(out[4], pa.float64())],
            names=["digest", "size", "vec_id", "vec", "norm"],
        )


# Shares in which the ids of a crowded vector are looked over for a bound.
SHARES = 256


def least_ids(rows: DataFrame, k: int) -> DataFrame:
    """``digest, ids``: the ``k`` least different ids of each vector, least first.

    Of a vector with many ids the least of each of :data:`SHARES` shares is
    taken first; the ``k``-th of these is no less than the ``k``-th of all, and
    hardly more ids are below it.  So no list grows with a group.
    """
    rows = rows.select("digest", "vec_id").distinct()
    counted = rows.groupBy("digest", F.pmod(F.xxhash64("vec_id"), F.lit(SHARES)).alias("share")).agg(F.min("vec_id").alias("least"))
    bounds = settled(
        counted.groupBy("digest").agg(F.array_sort(F.collect_list("least")).alias("least"))
        .where(F.size("least") > k).select("digest", F.element_at("least", k).alias("bound"))
    )
    bounded = rows.join(F.broadcast(bounds), "digest", "left") if fits_broadcast(bounds) else salted_join(rows, bounds, "digest", "left")
    near = bounded.where(F.col("bound").isNull() | (F.col("vec_id") <= F.col("bound")))
    return near.groupBy("digest").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, k).alias("ids"))


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, h = x.shape[1], 1
    while h < n:
        pairs = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


class Hashes:
    """The rotations of all tables, and the buckets and probes of unit vectors.

    ``dims`` has the number of coordinates used by each rotation of a table.
    """

    def __init__(self, d: int, dims: list[int], tables: int, longest: float, extra: bool, seed: int = SEED):
        self.d, self.dims, self.tables, self.longest, self.extra, self.seed = d, dims, tables, longest, extra, seed
        self.buckets = int(np.prod([2 * m for m in dims], dtype=np.int64))
        self._signs: dict[tuple[int, int], np.ndarray] = Kept()

    def __reduce__(self):
        return Hashes, (self.d, self.dims, self.tables, self.longest, self.extra, self.seed)

    def units(self, vectors: list[np.ndarray], query: bool) -> np.ndarray:
        """Unit vectors, filled up with zeros and, where lengths differ, what they lack to the greatest length."""
        x = np.zeros((len(vectors), self.d))
        for i, v in enumerate(vectors):
            x[i, : len(v)] = v
        if query or not self.extra:
            return x / np.linalg.norm(x, axis=1, keepdims=True)
        x /= self.longest
        x[:, -1] = np.sqrt(np.maximum(1 - (x * x).sum(1), 0))
        return x

    def _turned(self, x: np.ndarray, table: int, level: int) -> np.ndarray:
        signs = self._signs.get((table, level))
        if signs is None:
            rng = np.random.default_rng([self.seed, table, level])
            signs = self._signs[table, level] = rng.choice([-1.0, 1.0], (3, self.d))
        for s in signs:
            x = _hadamard(x * s)
        return x[:, : self.dims[level]]

    def codes(self, x: np.ndarray, table: int) -> np.ndarray:
        """The bucket of each row of ``x``."""
        code = np.zeros(len(x), np.int64)
        for level, m in enumerate(self.dims):
            y = self._turned(x, table, level)
            axis = np.abs(y).argmax(1)
            code = code * (2 * m) + 2 * axis + (y[np.arange(len(y)), axis] > 0)
        return code

    def costs(self, x: np.ndarray, table: int) -> list[np.ndarray]:
        """For each rotation what choosing each signed axis costs: the squared way to it from the nearest."""
        out = []
        for level in range(len(self.dims)):
            y = self._turned(x, table, level)
            signed = np.stack([-y, y], 2).reshape(len(y), -1)
            out.append((signed.max(1, keepdims=True) - signed) ** 2)
        return out

    def probes(self, x: np.ndarray, table: int, n: int) -> np.ndarray:
        """The ``n`` buckets of least cost for each row, cheapest first."""
        code, cost = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
        for level, way in enumerate(self.costs(x, table)):
            axes = np.argsort(way, 1, kind="stable")[:, :n]
            cost = (cost[:, :, None] + np.take_along_axis(way, axes, 1)[:, None, :]).reshape(len(x), -1)
            code = (code[:, :, None] * (2 * self.dims[level]) + axes[:, None, :]).reshape(len(x), -1)
            best = np.argsort(cost, 1, kind="stable")[:, :n]
            cost, code = np.take_along_axis(cost, best, 1), np.take_along_axis(code, best, 1)
        return code

    def ranks(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many buckets are cheaper for a row of ``x`` than that of the same row of ``y``, in the best table."""
        least = np.full(len(x), self.buckets, np.int64)
        for table in range(self.tables):
            total, mine = np.zeros((len(x), 1)), np.zeros(len(x))
            rest, code = self.codes(y, table), []
            for m in reversed(self.dims):
                code.insert(0, rest % (2 * m))
                rest = rest // (2 * m)
            for way, c in zip(self.costs(x, table), code, strict=True):
                mine = mine + way[np.arange(len(x)), c]
                # Beyond the cheapest few thousand a rank is not told apart.
                total = np.sort((total[:, :, None] + way[:, None, :]).reshape(len(x), -1), 1)[:, :MOST_PROBES]
            least = np.minimum(least, (total < mine[:, None]).sum(1))
        return least


MOST_PROBES = 2_048


def axes_for(n: int, d: int, bucket: int) -> list[int]:
    """Coordinates per rotation, so that ``n`` vectors make buckets of about ``bucket``."""
    dims, wanted = [], n / bucket
    while wanted > 1.5:
        m = min(d, 1 << max(0, round(np.log2(wanted / 2))))
        dims.append(m)
        wanted /= 2 * m
    return dims


def _vectors(column: pa.Array, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), kind).astype(np.float64) for v in column]


def _best(of: np.ndarray, score: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Rows of the ``k`` greatest scores of each value of ``of``, ties to the smaller ``tie``."""
    order = np.lexsort((tie, -score, of))
    first = np.flatnonzero(np.r_[True, np.diff(of[order]) != 0]) if len(order) else np.zeros(0, int)
    place = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    return order[place < k]


def _inner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products row by row, added up in one order wherever a pair meets."""
    return np.add.reduce(np.ascontiguousarray(x * y), axis=1)


def _nearest(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row of q, row of x, score)`` of the ``k`` rows of ``x`` nearest to each row of ``q``."""
    rows, cols, scores = [], [], []
    step = max(1, (1 << 22) // max(len(x), 1))
    for at in range(0, len(q), step):
        s = q[at : at + step] @ x.T
        m = min(k + 8, s.shape[1])  # more than asked for, as a product may be rounded in another way
        near = np.argpartition(-s, m - 1, 1)[:, :m] if m < s.shape[1] else np.broadcast_to(np.arange(m), s.shape)
        row, col = np.repeat(np.arange(at, at + len(s)), m), near.ravel()
        score = _inner(q[row], x[col])
        keep = _best(row, score, ids[col], k)
        rows.append(row[keep]), cols.append(col[keep]), scores.append(score[keep])
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(scores)


PAIRS = "query string, near string, least long, score double"


def _exact(sample: list[tuple[str, bytes]], kind: type, k: int) -> Callable:
    """The ``k`` nearest to each sampled vector among the vectors of a task, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size: dict[int, list[int]] = {}
        for i, (_, v) in enumerate(sample):
            by_size.setdefault(len(v), []).append(i)
        of, score, least, vecs = np.zeros(0, int), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, object)
        for batch in batches:
            vec, ids = np.array(batch.column(1).to_pylist() + [None], object)[:-1], batch.column(2).to_numpy()
            sizes = np.array([len(v) for v in vec])
            for size, which in by_size.items():
                here = np.flatnonzero(sizes == size)
                if len(here):
                    q = np.stack([np.frombuffer(sample[i][1], kind).astype(np.float64) for i in which])
                    x = np.stack([np.frombuffer(v, kind).astype(np.float64) for v in vec[here]])
                    row, col, found = _nearest(q, x, ids[here], k)
                    of, score = np.r_[of, np.array(which)[row]], np.r_[score, found]
                    least, vecs = np.r_[least, ids[here][col]], np.r_[vecs, vec[here][col]]
                    keep = _best(of, score, least, k)
                    of, score, least, vecs = of[keep], score[keep], least[keep], vecs[keep]
        yield pa.RecordBatch.from_arrays(
            [pa.array([sample[i][0] for i in of], pa.string()), pa.array(list(vecs), pa.binary()), pa.array(least), pa.array(score)],
            names=["query", "vec", "least", "score"],
        )

    return run


def fit_probes(distinct: DataFrame, queries: DataFrame, hashes: Hashes, kind: type, k: int, recall: float = RECALL, sample: int = SAMPLE) -> int:
    """The least number of probes a table that finds ``recall`` of the true neighbours of ``sample`` queries.

    The sampled queries are those of least digest; they and their neighbours,
    at most ``sample * k`` vectors, come to the driver.
    """
    if not hashes.dims:
        return 1
    chosen = [(r.digest, bytes(r.vec)) for r in queries.select("digest", "vec").orderBy("digest").limit(sample).collect()]
    if not chosen:
        return 1
    near = distinct.select("digest", "vec", "least").mapInArrow(_exact(chosen, kind, k + 1), "query string, vec binary, least long, score double")

    def cut(rows: DataFrame, *keys: Column | str) -> DataFrame:
        best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "least", "vec")))
        one = rows.groupBy("query", *keys).agg(F.slice(best, 1, k + 1).alias("best")).select("query", F.explode("best").alias("b"))
        return one.select("query", (-F.col("b.less")).alias("score"), "b.least", "b.vec")

    # A list per query and task, folded in shares before it is one per query; the first of it is the query itself.
    found = cut(cut(near, F.pmod(F.xxhash64("least"), F.lit(SHARES))))
    vectors = dict(chosen)
    x, y = [], []
    for row in found.collect():
        if bytes(row.vec) != vectors[row.query]:
            x.append(np.frombuffer(vectors[row.query], kind).astype(np.float64))
            y.append(np.frombuffer(bytes(row.vec), kind).astype(np.float64))
    if not x:
        return 1
    ranks = np.sort(hashes.ranks(hashes.units(x, True), hashes.units(y, False)))
    need = int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)]) + 1
    return min(need, hashes.buckets)


def _bucketed(hashes: Hashes, kind: type) -> Callable:
    """The buckets of ``vec``, a row for each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 2_048):
                x = hashes.units(_vectors(batch.column(0).slice(at, 2_048), kind), False)
                for table in range(hashes.tables):
                    yield pa.RecordBatch.from_arrays([pa.array((np.int64(table) << np.int64(48)) + hashes.codes(x, table))], names=["bucket"])

    return run


def _filed(hashes: Hashes, kind: type) -> Callable:
    """``digest, vec, least`` to a row for each table and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 2_048):
                part = batch.slice(at, 2_048)
                if len(part):
                    x = hashes.units(_vectors(part.column(1), kind), False)
                    for table in range(hashes.tables):
                        yield _rows(part, table, hashes.codes(x, table), False)

    return run


def _probing(hashes: Hashes, kind: type, n: int) -> Callable:
    """``digest, vec, least`` to a row for each table and bucket to look into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                if len(part):
                    x = hashes.units(_vectors(part.column(1), kind), True)
                    for table in range(hashes.tables):
                        for code in hashes.probes(x, table, n).T:
                            yield _rows(part, table, code, True)

    return run


FILED = "bucket long, asks boolean, digest string, vec binary, least long"


def _rows(part: pa.RecordBatch, table: int, code: np.ndarray, asks: bool) -> pa.RecordBatch:
    bucket = (np.int64(table) << np.int64(48)) + code
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket), pa.array(np.full(len(bucket), asks)), *part.columns], names=["bucket", "asks", "digest", "vec", "least"]
    )


def _ranked(kind: type, k: int) -> Callable:
    """Rows in order of block, filed vectors first, to the ``k`` nearest a query finds in each block."""

    def flush(held: list[tuple]) -> pa.RecordBatch:
        q, n, least, score = (np.concatenate(part) for part in zip(*held, strict=True))
        _, of = np.unique(q, return_inverse=True)
        # The same pair may come from several blocks.
        order = np.lexsort((n, of))
        new = np.r_[True, (np.diff(of[order]) != 0) | (n[order][1:] != n[order][:-1])]
        order = order[new]
        keep = order[_best(of[order], score[order], least[order], k)]
        return pa.RecordBatch.from_arrays(
            [pa.array(q[keep].astype(str)), pa.array(n[keep].astype(str)), pa.array(least[keep]), pa.array(score[keep])],
            names=["query", "near", "least", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, members, held, rows = None, [], [], 0
        x = ids = names = None
        for batch in batches:
            keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            asks = batch.column(2).to_numpy(zero_copy_only=False)
            raw = batch.column(4).to_pylist()
            size = np.array([len(v) for v in raw], int)
            cuts = np.flatnonzero((np.diff(keys[0]) != 0) | (np.diff(keys[1]) != 0) | (np.diff(size) != 0) | (np.diff(asks) != 0)) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(batch)], strict=True):
                if lo == hi:
                    continue
                key = int(keys[0][lo]), int(keys[1][lo]), int(size[lo])
                if key != block:
                    block, members, x = key, [], None
                digest = np.array(batch.column(3).slice(lo, hi - lo).to_pylist(), dtype="S32")
                vec = np.stack([np.frombuffer(v, kind) for v in raw[lo:hi]]).astype(np.float64)
                least = batch.column(5).slice(lo, hi - lo).to_numpy()
                if not asks[lo]:
                    members.append((vec, digest, least))
                    x = None
                    continue
                if not members:
                    continue
                if x is None:
                    x, names, ids = (np.concatenate(part) for part in zip(*members, strict=True))
                row, col, score = _nearest(vec, x, ids, k)
                held.append((digest[row], names[col], ids[col], score))
                rows += len(row)
                if rows >= HELD:
                    yield flush(held)
                    held, rows = [], 0
        if held:
            yield flush(held)

    return run


def _candidates(filed: DataFrame, asking: DataFrame, counts: DataFrame, kind: type, k: int) -> DataFrame:
    """:data:`PAIRS` of queries and what they find, a bucket of many vectors in blocks."""
    many = settled(counts.select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")).where("blocks > 1"))
    few = F.broadcast(many) if fits_broadcast(many) else many
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = filed.join(few, "bucket", "left").withColumn("block", F.pmod(F.xxhash64("digest"), blocks).cast("int"))
    spread = asking.join(few, "bucket", "left").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    columns = ["bucket", "block", "asks", "digest", "vec", "least"]
    parts = max(filed.rdd.getNumPartitions(), int(filed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = dealt.select(*columns).unionByName(spread.select(*columns)).repartition(parts, "bucket", "block")
    return met.sortWithinPartitions("bucket", "block", F.length("vec"), "asks").mapInArrow(_ranked(kind, k), PAIRS)


def _lists(pairs: DataFrame, k: int) -> DataFrame:
    """``query, found``: the ``k`` best of each query as ``(less, least, near)``, ``less`` being the score turned round."""
    once = pairs.groupBy("query", "near").agg(F.max("score").alias("score"), F.min("least").alias("least"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "least", "near")))
    return once.groupBy("query").agg(F.slice(ordered, 1, k).alias("found"))


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, tables: int = TABLES, bucket: int = BUCKET,
    recall: float = RECALL, vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of each row for which ``queries`` holds, among all others."""
    spark = vectors.sparkSession
    kind = np.float32 if vectors.select(embedding).dtypes[0][1] == "array<float>" else np.float64
    asks = F.coalesce(queries, F.lit(False))
    given = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"), asks.alias("asks"))
    rows = settled(given.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select("vec_id", "embedding").mapInArrow(valid, VECTORS))
    distinct = settled(
        rows.groupBy("digest").agg(F.any_value("vec").alias("vec"), F.min("vec_id").alias("least"), F.max("size").alias("size"), F.max("norm").alias("norm"))
    )
    count, widest, shortest, longest = distinct.agg(F.count(F.lit(1)), F.max("size"), F.min("norm"), F.max("norm")).first()
    ask = given.where("asks").select("vec_id").distinct()
    asked = settled(rows.select("digest", "vec_id").distinct().join(ask, "vec_id"))
    asking = settled(distinct.join(asked.select("digest").distinct(), "digest", "left_semi").select("digest", "vec", "least"))
    extra = bool(count) and longest - shortest > 1e-6 * longest
    d = 1 << max(1, int(np.ceil(np.log2((widest or 1) + extra))))
    hashes = Hashes(d, axes_for(count, d, bucket), tables, longest or 1.0, extra)
    if not hashes.dims:
        hashes.tables = 1
    members = distinct.select("digest", "vec", "least")
    probes = fit_probes(members, asking, hashes, kind, k, recall)

    filed = members.mapInArrow(_filed(hashes, kind), FILED)
    counts = members.select("vec").mapInArrow(_bucketed(hashes, kind), "bucket long").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    looks = asking.mapInArrow(_probing(hashes, kind, probes), FILED)
    lists = settled(_lists(_candidates(filed, looks, counts, kind, k + 1), k + 1))
    if hashes.dims:
        # Too few were found only where the probed buckets are all but empty.
        enough = lists.where(F.size("found") >= min(k + 1, count)).select(F.col("query").alias("digest"))
        short = settled(asking.join(enough, "digest", "left_anti"))
        if not short.isEmpty():
            every = short.select(
                F.explode(F.sequence(F.lit(0).cast("long"), F.lit(hashes.buckets - 1).cast("long"))).alias("bucket"),
                F.lit(True).alias("asks"), "digest", "vec", "least",
            )
            first = filed.where(F.col("bucket") < (1 << 48))
            more = _lists(_candidates(first, every, counts, kind, k + 1), k + 1)
            lists = lists.join(short.select(F.col("digest").alias("query")), "query", "left_anti").unionByName(more)

    # From vectors back to the ids that have them: the least k + 1 of each.
    found = lists.select(F.col("query").alias("digest_q"), F.explode("found").alias("f")).select("digest_q", F.col("f.near").alias("digest"), (-F.col("f.less")).alias("score"))
    named = salted_join(found, least_ids(rows, k + 1), "digest", "inner").select("digest_q", "score", F.explode("ids").alias("vec_id"))
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id"))), 1, 2 * k + 2)
    answers = named.groupBy(F.col("digest_q").alias("digest")).agg(best.alias("best"))
    side = settled(answers)
    joined = asked.join(F.broadcast(side), "digest") if fits_broadcast(side) else salted_join(asked, side, "digest", "inner")
    mine = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("vec_id")), 1, k)
    return joined.select(F.col("vec_id").alias("query_id"), F.posexplode(mine).alias("at", "b")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.less")).alias("score")
    )


def exact_nearest(vectors: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """The true nearest, all queries against all rows in blocks; to measure recall against."""
    return nearest(vectors, queries, k, tables=1, bucket=1 << 62)
