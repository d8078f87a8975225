"""Removal of repeated byte strings by prefix-free parsing.

Every byte covered by a string of ``LENGTH`` bytes that also starts in a
document of smaller ``doc_id`` is removed; strings overlap, do not cross
documents, and are judged on the input.

*Parse.*  A rolling hash of ``GRAM`` bytes sets triggers: the trigger of a
string is the place of its least hash, the leftmost of equals.  So every string
has one, and equal strings have it at the same place.  The strings that share a
trigger in a document are a run of neighbours; the bytes they cover are a
*phrase*, and a document's parse is its sequence of phrases.

*Dictionary.*  Equal phrases hold equal strings.  A phrase whose trigger occurs
in one place only is not repeated and drops out.  Of the others the dictionary
keeps, once per distinct phrase, the first document and the number of places.  A
phrase with an earlier document is repeated as a whole.  If a phrase occurs as
often as its trigger, all places of the trigger have it, and the first document
keeps it as a whole.  Only for what is left, and only where the half of it next
to the trigger is in several places, are the phrase's own suffixes, cut to ``LENGTH`` bytes,
compared with those of other phrases.

Whether strings are equal is all that the removal needs from corpus order, so
suffixes are brought together by 64-bit hash, not by a sort of the bytes: a
range sort would put the suffixes of a frequent passage into one task.

*Spark.*  Documents are dealt once to blocks of about ``BLOCK_BYTES``.  Each
step sends a block's distinct keys to buckets, folded to the first document and
a count, and gets back what other blocks know of them; so a key held by a third
of all documents is one entry per block.  With the keys goes a *note* of the
block to itself, which a bucket hands back as it is: the phrases still in
question and the bytes known to be repeated.  So a step needs the answers of the
step before it only, and no more than two steps parse.  All steps read the same
shuffle, of compressed batches of rows.

A null text is an empty one and comes back null; texts below ``LENGTH`` bytes
lose nothing.  A null id counts as larger than any other; rows of equal id do
not remove from each other, repeated rows fare alike.  Columns other than
``doc_id`` and ``text`` stay; names beginning with ``__pfp_`` are this module's.
An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.llm.bytetext import give_back, mix, pieces, text_bytes

LENGTH = 50
GRAM = 16
BLOCK_BYTES = 6 << 20
# A task packs the rows of a block together as often as it has read so much.
PACK_BYTES = 24 << 20
# Texts are parsed in pieces of so many bytes, or one longer text.
PIECE = 1 << 16
# Spans hashed at once.
SPANS = 1 << 15
LAST = (1 << 63) - 1

REQUEST = "bucket int, blk long, keys binary, first binary, docs binary, note binary"
REPLY = "blk long, bucket int, at binary, first binary, docs binary, note binary"

_RANK = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]
_NONE = np.zeros(0, np.int64)


def _ranks(data: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the ``GRAM`` bytes from each place on."""
    four = np.empty(len(data) - 3, "<u4")
    for p in range(min(4, len(four))):
        here = four[p::4]
        here[:] = data[p : p + 4 * len(here)].view("<u4")
    n = len(data) - GRAM + 1
    out = four[:n] * _RANK[0]
    for k in range(1, GRAM // 4):
        out += four[4 * k : 4 * k + n] * _RANK[k]
    return out


def _least(ranks: np.ndarray, width: int) -> np.ndarray:
    """Least rank in each run of ``width`` places, above its leftmost place in the lower 32 bits."""
    both = np.empty((len(ranks), 2), "<u4")
    both[:, 0], both[:, 1] = np.arange(len(ranks), dtype=np.uint32), ranks
    low = both.view("<u8")[:, 0]
    spare = np.empty_like(low)
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        n = len(low) - step
        np.minimum(low[:n], low[step:], out=spare[:n])
        low, spare = spare[:n], low
        reach += step
    return low


def parse(data: np.ndarray, off: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of texts: first and last string start, and the trigger's place."""
    n = len(data) - length + 1
    if n < 1:
        return _NONE, _NONE, _NONE
    low = _least(_ranks(data), length - GRAM + 1)
    new = np.ones(n, bool)
    np.not_equal(low[1:], low[:-1], out=new[1:])
    first, past = off[:-1], off[1:] - length + 1
    new[first[first < n]] = True
    new[past[(past > first) & (past < n)]] = True
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], n) - 1
    whole = hi + length <= off[np.searchsorted(off, lo, side="right")]
    lo, hi = lo[whole], hi[whole]
    return lo, hi, (low[lo] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def span_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit keys of spans of eight bytes or more; equal spans have equal keys wherever they stand."""
    out = np.empty(len(start), np.uint64)
    if not len(start):
        return out
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    for k in range(0, len(start), SPANS):
        at, last = start[k : k + SPANS], end[k : k + SPANS] - 8
        reach = last - at + 8
        h = mix(reach.astype(np.uint64))
        for ahead in range(0, int(reach.max()), 8):
            # a span's words are its own affair, however long its neighbours here are
            np.copyto(h, mix(h + words[np.minimum(at + ahead, last)]), where=ahead < reach)
        out[k : k + SPANS] = h
    return out


def _written(columns: dict[str, np.ndarray]) -> bytes:
    """A note of columns, each of its own length, as compressed differences."""
    return _compressed(pa.table({name: pa.array([np.diff(x, prepend=0).astype(np.int64)], pa.list_(pa.int64())) for name, x in columns.items()}))


def _noted(replies: pa.Table, names: tuple[str, ...]) -> list[np.ndarray]:
    """The columns of a block's note; without one they are empty."""
    notes = replies.column("note").drop_null() if "note" in replies.column_names else ()
    if not len(notes):
        return [_NONE] * len(names)
    table = pa.ipc.open_stream(notes[0].as_buffer()).read_all()
    return [np.cumsum(table.column(name)[0].values.to_numpy()) for name in names]


def _united(lo: np.ndarray, end: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of bytes that spans cover; a run stays in its document."""
    order = np.argsort(lo)
    lo, end, doc = lo[order], end[order], doc[order]
    reach = np.maximum.accumulate(end + doc)
    new = np.ones(len(lo), bool)
    new[1:] = (lo + doc)[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return lo[at], np.maximum.reduceat(end, at) if len(at) else end


class Block:
    """The documents of a block in order of id."""

    def __init__(self, table: pa.Table, length: int):
        self.length = length
        self.half = (length - GRAM + 1) // 2
        ids = table.column("doc_id").cast(pa.int64()).fill_null(LAST).to_numpy()
        texts = table.column("text").combine_chunks()
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
        raw = texts.cast(pa.large_binary()).fill_null(b"")
        self.order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], raw[i].as_py())) if len(set(ids.tolist())) < len(ids) else np.argsort(ids), np.int64)
        self.ids = ids[self.order]
        self.texts = raw.take(pa.array(self.order))
        self.data, self.off = text_bytes(self.texts)

    def doc(self, at: np.ndarray) -> np.ndarray:
        """The document of each place."""
        return np.searchsorted(self.off, at, side="right") - 1

    def keys(self, start: np.ndarray, end: np.ndarray) -> Keys:
        return Keys(span_keys(self.data, start, end), self.ids[self.doc(start)])

    def parsed(self) -> tuple[np.ndarray, ...]:
        """All phrases."""
        found = [(_NONE,) * 3]
        for first, _, data, off in pieces(self.texts, PIECE):
            found.append(tuple(x + self.off[first] for x in parse(data, off, self.length)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def triggers(self, at: np.ndarray) -> Keys:
        return self.keys(at, at + GRAM)

    def phrases(self, lo: np.ndarray, hi: np.ndarray) -> Keys:
        return self.keys(lo, hi + self.length)

    def sides(self, lo: np.ndarray, hi: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, Keys]:
        """First and last string starts on either side of the trigger, and the keys of the sides.

        A string holds its trigger and half of the other bytes on the left or on
        the right of it.  So it is repeated only if that side is.
        """
        half = self.half
        before, after = lo <= at - half, hi > at - half
        reach = self.length - half + 1
        return (
            np.concatenate([lo[before], np.maximum(lo, at - half + 1)[after]]),
            np.concatenate([np.minimum(hi, at - half)[before], hi[after]]),
            self.keys(np.concatenate([(at - half)[before], at[after]]), np.concatenate([(at + GRAM)[before], (at + reach)[after]])),
        )

    def suffixes(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, Keys]:
        """All string starts of the ranges, and their keys."""
        n = hi - lo + 1
        start = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return start, self.keys(start, start + self.length)

    def kept(self, lo: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
        """Bytes, removed bytes and runs, and the bytes that stay, of each document."""
        raw = memoryview(np.ascontiguousarray(self.data))
        edges = np.searchsorted(lo, self.off).tolist()
        off, lo, end = self.off.tolist(), lo.tolist(), end.tolist()
        for a, b, i, j in zip(off[:-1], off[1:], edges[:-1], edges[1:], strict=True):
            left = b"".join([raw[x:y] for x, y in zip([a, *end[i:j]], [*lo[i:j], b], strict=True)])
            yield b - a, b - a - len(left), j - i, left


class Keys:
    """A block's distinct keys with the first document of each and how often it occurs."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray):
        order = np.argsort(keys)
        sorted_keys = keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = sorted_keys[1:] != sorted_keys[:-1]
        at = np.flatnonzero(new)
        self.keys = sorted_keys[at]
        self.ids = ids
        self.first = np.minimum.reduceat(ids[order], at) if len(at) else _NONE
        self.times = np.diff(np.append(at, len(keys))).astype(np.uint32)
        self.where = np.empty(len(keys), np.int64)
        self.where[order] = np.cumsum(new) - 1

    def base(self, bits: int) -> np.ndarray:
        """Where the keys of each bucket begin."""
        return np.searchsorted(self.keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))

    def requests(self, blk: int, bits: int, with_first: bool, note: bytes | None = None) -> pa.Table:
        """A row for each bucket, and one with the note."""
        edges = np.append(self.base(bits), len(self.keys))
        used = np.flatnonzero(np.diff(edges))
        cut = np.append(edges[used], len(self.keys))
        first = _cells(self.first, cut) if with_first else None  # without, only counts are asked for
        asked = _rows(REQUEST, len(used), bucket=used, blk=np.full(len(used), blk), keys=_cells(self.keys, cut), first=first, docs=_cells(self.times, cut))
        return asked if note is None else pa.concat_tables([asked, _rows(REQUEST, 1, bucket=[blk % (1 << bits)], blk=[blk], note=[note])])

    def told(self, replies: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether an earlier document has each span, and its number of places over all blocks."""
        first, docs = self.first.copy(), self.times.astype(np.int64)
        at, edges = _values(replies, "at", np.uint32)
        at = at + np.repeat(self.base(bits)[replies.column("bucket").to_numpy()], np.diff(edges))
        docs[at] = _values(replies, "docs", np.uint32)[0]
        given = _values(replies, "first", np.int64)[0]
        if len(given):
            first[at] = given
        return first[self.where] < self.ids, docs[self.where]


def _cells(values: np.ndarray, cut: np.ndarray) -> pa.Array:
    """The bytes of ``values[cut[i]:cut[i + 1]]`` in each row."""
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer((cut * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _values(table: pa.Table, name: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of cells, and the bounds of each row's; a null cell has none."""
    column = table.column(name)
    data, off = text_bytes(pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type))
    return data.copy().view(kind), off // np.dtype(kind).itemsize


def _rows(schema: str, n: int, **columns: pa.Array | np.ndarray | list | None) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = dict(field.split() for field in schema.split(", "))
    given = {name: columns.get(name) for name in fields}
    return pa.table({name: pa.nulls(n, kinds[fields[name]]) if x is None else x if isinstance(x, pa.Array) else pa.array(x, kinds[fields[name]]) for name, x in given.items()})


def _answer(key: tuple, table: pa.Table) -> pa.Table:
    """Tell each block what others know of its keys; its note goes back to it."""
    bucket, is_note = key[0].as_py(), table.column("note").is_valid()
    notes, table = table.filter(is_note), table.filter(pc.invert(is_note))
    back = _rows(REPLY, len(notes), blk=notes.column("blk").to_numpy(), bucket=np.full(len(notes), bucket), note=notes.column("note").to_pylist())
    keys, edges = _values(table, "keys", np.uint64)
    docs, given = _values(table, "docs", np.uint32)[0], _values(table, "first", np.int64)[0]
    _, where = np.unique(keys, return_inverse=True)
    total = np.bincount(where, weights=docs).astype(np.int64)
    more = total[where] > docs
    at = (np.arange(len(keys)) - np.repeat(edges[:-1], np.diff(edges)))[more].astype(np.uint32)
    count = np.diff(np.append(0, np.cumsum(more))[edges])
    used = count > 0
    cut = np.append(0, np.cumsum(count[used]))
    first = None
    if len(given):
        least = np.full(len(total), LAST, np.int64)
        np.minimum.at(least, where, given)
        first = _cells(least[where[more]], cut)
    blk = table.column("blk").to_numpy()[used]
    out = _rows(REPLY, len(blk), blk=blk, bucket=np.full(len(blk), bucket), at=_cells(at, cut), first=first, docs=_cells(total[where[more]].astype(np.uint32), cut))
    return pa.concat_tables([out, back])


def _requests(blk: int, docs: pa.Table, replies: pa.Table | None, step: int, bits: int, length: int) -> pa.Table:
    block = Block(unpacked(docs), length)
    if step == 1:
        _, _, at = block.parsed()
        return block.triggers(at).requests(blk, bits, False)
    if step == 2:
        lo, hi, at = block.parsed()
        _, places = block.triggers(at).told(replies, bits)
        lo, hi, at, places = (x[places > 1] for x in (lo, hi, at, places))
        return block.phrases(lo, hi).requests(blk, bits, True, _written({"lo": lo, "hi": hi, "at": at, "places": places}))
    if step == 3:
        lo, hi, at, places = _noted(replies, ("lo", "hi", "at", "places"))
        whole, docs_of = block.phrases(lo, hi).told(replies, bits)
        gone, end = _united(lo[whole], hi[whole] + length, block.doc(lo[whole]))
        left = ~whole & (docs_of != places)
        lo, hi, at = lo[left], hi[left], at[left]
        return block.sides(lo, hi, at)[2].requests(blk, bits, False, _written({"lo": lo, "hi": hi, "at": at, "gone": gone, "end": end}))
    lo, hi, at, gone, end = _noted(replies, ("lo", "hi", "at", "gone", "end"))
    lo, hi, sides = block.sides(lo, hi, at)
    many = sides.told(replies, bits)[1] > 1
    lo, hi = lo[many], hi[many]
    return block.suffixes(lo, hi)[1].requests(blk, bits, True, _written({"lo": lo, "hi": hi, "gone": gone, "end": end}))


def _ask(step: int, bits: int, length: int) -> Callable:
    """The requests of a step, from a block's documents and the answers to the step before."""

    def run(key: tuple, docs: pa.Table, replies: pa.Table | None = None) -> pa.Table:
        asked = _requests(key[0].as_py(), docs, replies, step, bits, length)
        give_back()
        return asked

    return run


def _first_ask(bits: int, length: int) -> Callable:
    run = _ask(1, bits, length)

    def alone(key: tuple, docs: pa.Table) -> pa.Table:
        return run(key, docs)

    return alone


def _compressed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _pack() -> Callable:
    """Rows of a task packed by block: the shuffle moves compressed batches instead of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            held.clear()
            order = pc.sort_indices(table.column("__pfp_block"))
            table = table.take(order).combine_chunks()
            blk = table.column("__pfp_block").to_numpy()
            edges = np.flatnonzero(np.diff(blk, prepend=-1, append=-1))
            rows = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                part = table.slice(lo, hi - lo).drop_columns(["__pfp_block"]).take(pa.array(range(hi - lo)))
                rows.append((int(blk[lo]), _compressed(part)))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["blk", "rows"])

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= PACK_BYTES:
                del batch
                yield packed()
                pa.default_memory_pool().release_unused()
                size = 0
        if held:
            yield packed()
            pa.default_memory_pool().release_unused()

    return run


def unpacked(table: pa.Table) -> pa.Table:
    parts = [pa.ipc.open_stream(blob.as_buffer()).read_all() for blob in table.column("rows")]
    return pa.concat_tables(parts)


def _kept(docs: pa.Table, replies: pa.Table, bits: int, length: int, schema: T.StructType, with_text: bool) -> pa.Table:
    docs = unpacked(docs)
    block = Block(docs, length)
    null = docs.column("text").is_null().combine_chunks().take(pa.array(block.order)).to_pylist()
    given = docs.drop_columns(["text"]).take(pa.array(block.order))
    del docs  # the block has the texts
    lo, hi, gone, end = _noted(replies, ("lo", "hi", "gone", "end"))
    start, keys = block.suffixes(lo, hi)
    start = start[keys.told(replies, bits)[0]]
    del keys
    gone, end = np.concatenate([gone, start]), np.concatenate([end, start + length])
    gone, end = _united(gone, end, block.doc(gone))
    report, texts = [], []
    for none, (size, removed, spans, left) in zip(null, block.kept(gone, end), strict=True):
        report.append((size, removed, spans, hashlib.sha256(left).hexdigest()))
        if with_text:
            texts.append(None if none else left.decode(errors="ignore"))
    columns = {name: given.column(name) for name in given.column_names}
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    columns |= {f"__pfp_{name}": pa.array([r[k] for r in report], kinds[k]) for k, name in enumerate(("bytes", "removed", "spans", "sha256"))}
    if with_text:
        columns["text"] = pa.array(texts, pa.string())
    return pa.Table.from_pydict({f.name: columns[f.name] for f in schema.fields})


def _finish(bits: int, length: int, schema: T.StructType, with_text: bool) -> Callable:
    def run(key: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        kept = _kept(docs, replies, bits, length, schema, with_text)
        give_back()
        return kept

    return run


def _bits(blocks: int) -> int:
    """The buckets' number as a power of two; a bucket is asked what two to four blocks ask.

    Each block sends each bucket a row, so more buckets would cost more in rows.
    """
    return max(5, min(17, blocks.bit_length() - 2))


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the repeated bytes, and ``__pfp_bytes, __pfp_removed, __pfp_spans, __pfp_sha256``.

    Bytes of a character that was cut in two are left out of ``text``; the
    digest is of the bytes that stay.  Without ``with_text`` the text is not
    returned.
    """
    if length < GRAM:
        raise ValueError(f"strings must have {GRAM} bytes or more")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    bits = _bits(int(blocks))
    dealt = docs.withColumn("__pfp_block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).mapInArrow(_pack(), "blk long, rows binary")
    asked = dealt.groupBy("blk").applyInArrow(_first_ask(bits, length), REQUEST)
    replies = asked.groupBy("bucket").applyInArrow(_answer, REPLY)
    for step in (2, 3, 4):
        asked = dealt.groupBy("blk").cogroup(replies.groupBy("blk")).applyInArrow(_ask(step, bits, length), REQUEST)
        replies = asked.groupBy("bucket").applyInArrow(_answer, REPLY)
    report = [T.StructField(f"__pfp_{n}", T.LongType()) for n in ("bytes", "removed", "spans")] + [T.StructField("__pfp_sha256", T.StringType())]
    schema = T.StructType([f for f in docs.schema.fields if with_text or f.name != "text"] + report)
    return dealt.groupBy("blk").cogroup(replies.groupBy("blk")).applyInArrow(_finish(bits, length, schema, with_text), schema)


def repeat_report(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""
    found = remove_repeats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), length, False, block_bytes)
    return found.select(
        "doc_id", F.col("__pfp_bytes").alias("n_bytes"), F.col("__pfp_removed").alias("n_removed"),
        F.col("__pfp_spans").alias("n_spans"), F.col("__pfp_sha256").alias("kept_sha256"),
    )
