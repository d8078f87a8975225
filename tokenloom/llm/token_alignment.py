"""How the tokens of two tokenizers cover the same bytes.

Two incidence matrices, tokens by bytes, are built by hand in compressed rows
(CSR).  The row product (Gustavson) of one with the other's transpose gives the
*overlap links*: pairs of tokens that share bytes, and how many.  Where both
tokenizers end a token the text is cut into *groups*; the product of the two
incidence matrices of tokens and groups gives the *shared-group links*.

A text is taken in units that neither tokenizer joins: it is cut before each
space that follows something else than a space and comes before something else
than white space.  Tokenizer A starts a new run there, and no piece of tokenizer
B has a space behind its first code point that is none; both are checked when
the vocabularies are read.  So each different unit is encoded and multiplied
once per process and piece of text, and a document is the product of its units'
numbers with the units' links.

How many documents hold a pair of ids linked is counted over all documents; the
counts are joined back to each document's pairs, by broadcast only up to a
measured size, else by key with frequent pairs dealt out.

Cases.  A text that is null or empty, or whose tokens do not give its bytes
back, has no tokens: all its numbers are 0 and its groups text ''.  Rows that
share an id or a text stay rows of their own, each a document.  Very long texts
and units without spaces are multiplied in blocks, their pairs written in parts;
nothing is cut off.  An empty table gives no rows.  Ties for the highest count
are all best.  Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.bytetext import Kept, pieces
from tokenloom.operators.wordlists import join_side
from tokenloom.session import shared_folder

FOLDER = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Fixed value: how a byte-level BPE splits text before it merges.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A pair of ids is one number, A's id in the upper bits.
ID_BITS = 20
# Bytes of text handled at once, units kept, code points up to which a unit is kept, entries of a product at once.
PIECE = 1 << 20
KEPT_UNITS = 250_000
KEPT_LENGTH = 64
BLOCK = 1 << 22


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves; the others take the code points from 256 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, and the bytes of every token."""

    def __init__(self, folder: str, file_a: str = FILE_A, file_b: str = FILE_B):
        import sentencepiece
        import tiktoken

        with open(f"{folder}/{file_a}", encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = byte_letters()
        special = {t for t in model["vocab"] if any(c not in letters for c in t)}
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in special and t != "<|endoftext|>"}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merged = [ranks[bytes(letters[c] for c in x + y)] for x, y in merges]
        if merged != sorted(merged):
            raise ValueError("the ids of the byte-level vocabulary are not in the order of its merges")
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{file_b}")
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError(f"piece {piece!r} goes on behind a space")
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.size_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.size_b = np.array([len(t) for t in self.bytes_b], np.int64)
        if max(len(self.bytes_a), len(self.bytes_b)) >= 1 << ID_BITS:
            raise ValueError("too many ids")


_loaded: dict[tuple[str, str, str], Tokenizers] = Kept()


def tokenizers(folder: str, file_a: str = FILE_A, file_b: str = FILE_B) -> Tokenizers:
    key = folder, file_a, file_b
    if key not in _loaded:
        _loaded[key] = Tokenizers(*key)
    return _loaded[key]


# A space that no token need start at: one at either end, or before white space.
UNEVEN = re.compile(r"^ | (?:\s|$)")


def units(text: str) -> list[str]:
    """``text`` cut before spaces that both tokenizers start a token at; the space itself goes."""
    parts = text.split(" ")
    if not UNEVEN.search(text):
        return parts
    out = [parts[0]]
    for before, part in zip(parts, parts[1:], strict=False):
        if before and part and not part[0].isspace():
            out.append(part)
        else:
            out[-1] += " " + part
    return out


# -- matrices in compressed rows ----------------------------------------------

Rows = tuple[np.ndarray, np.ndarray, np.ndarray]  # pointers to rows, columns, values


def expanded(ptr: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the given rows of a matrix: which of them, and where, each entry is."""
    count = ptr[rows + 1] - ptr[rows]
    of = np.repeat(np.arange(len(rows)), count)
    first = np.cumsum(count) - count
    return of, np.arange(len(of)) - first[of] + ptr[rows][of]


def summed(row: np.ndarray, col: np.ndarray, val: np.ndarray, n_rows: int) -> Rows:
    """Entries as a matrix, those of one place added up; columns are below 2 ** 40."""
    key = (row.astype(np.int64) << np.int64(40)) | col
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    row, col = key[first] >> np.int64(40), key[first] & np.int64((1 << 40) - 1)
    total = np.add.reduceat(val[order], first) if len(first) else np.zeros(0, np.int64)
    return np.searchsorted(row, np.arange(n_rows + 1)), col, total


def row_product(a: Rows, b: Rows) -> Rows:
    """``a @ b``: each row of the product is the sum of the rows of ``b`` that its entries name."""
    rows = np.repeat(np.arange(len(a[0]) - 1), np.diff(a[0]))
    of, at = expanded(b[0], a[1])
    return summed(rows[of], b[1][at], a[2][of] * b[2][at], len(a[0]) - 1)


def byte_rows(size: np.ndarray) -> Rows:
    """Tokens by bytes, of tokens that follow each other with ``size`` bytes each."""
    ptr = np.concatenate([[0], np.cumsum(size)])
    return ptr, np.arange(ptr[-1]), np.ones(ptr[-1], np.int64)


def transposed(a: Rows, n_cols: int) -> Rows:
    rows = np.repeat(np.arange(len(a[0]) - 1), np.diff(a[0]))
    order = np.argsort(a[1], kind="stable")
    return np.searchsorted(a[1][order], np.arange(n_cols + 1)), rows[order], a[2][order]


Ids = tuple[np.ndarray, np.ndarray]  # of all units in order, and how many each has


def _alone(tok: Tokenizers, unit: str) -> tuple[list[int], list[int]]:
    """The ids of one unit by either tokenizer; none if they do not give its bytes back."""
    a, b, raw = tok.a.encode_ordinary(" " + unit), tok.b.encode(unit), (" " + unit).encode()
    same = b"".join(map(tok.bytes_a.__getitem__, a)) == raw == b"".join(map(tok.bytes_b.__getitem__, b))
    return (a, b) if same else ([], [])


def _together(tok: Tokenizers, found: list[str]) -> tuple[Ids, Ids] | None:
    """The ids of units that both tokenizers keep apart, encoded as one text; None if its bytes do not come back."""
    joined = " ".join(found)
    raw = (" " + joined).encode()
    ends = np.cumsum([len(u) + 1 if u.isascii() else len(u.encode()) + 1 for u in found])
    out = []
    for ids, spelt, size in ((tok.a.encode_ordinary(" " + joined), tok.bytes_a, tok.size_a), (tok.b.encode(joined), tok.bytes_b, tok.size_b)):
        if b"".join(map(spelt.__getitem__, ids)) != raw:
            return None
        ids = np.array(ids, np.int64)
        end = np.cumsum(size[ids])
        last = np.searchsorted(end, ends)
        if not np.array_equal(end[last], ends):
            return None
        out.append((ids, np.diff(last + 1, prepend=0)))
    return out[0], out[1]


def encoded(tok: Tokenizers, found: list[str]) -> tuple[Ids, Ids, np.ndarray]:
    """The ids of each unit by A and by B, and whether they give its bytes back."""
    n = len(found)
    plain = np.fromiter((u != "" and u[-1] != " " and not u[0].isspace() and "▁" not in u for u in found), bool, n)
    many = [u for u, p in zip(found, plain, strict=True) if p]
    made = _together(tok, many) if many else None
    if made is None:
        plain[:] = False
    rest = [(i, _alone(tok, found[i])) for i in np.flatnonzero(~plain).tolist()]
    valid = plain.copy()
    out = []
    for k in (0, 1):
        count, place = np.zeros(n, np.int64), np.flatnonzero(plain)
        if made is not None:
            count[place] = made[k][1]
        for i, ids in rest:
            count[i] = len(ids[k])
            valid[i] = count[i] > 0
        flat, ptr = np.empty(int(count.sum()), np.int64), np.concatenate([[0], np.cumsum(count)])
        if made is not None:
            _, at = expanded(ptr, place)
            flat[at] = made[k][0]
        for i, ids in rest:
            flat[ptr[i] : ptr[i + 1]] = ids[k]
        out.append((flat, count))
    return out[0], out[1], valid


class Alignment:
    """Tokens, overlap links and groups of some texts laid end to end."""

    def __init__(self, tok: Tokenizers, found: list[str], overlaps: bool = False):
        (self.a, self.n_a), (self.b, self.n_b), self.valid = encoded(tok, found)
        size_a, size_b = tok.size_a[self.a], tok.size_b[self.b]
        self.end_a, self.end_b = np.cumsum(size_a), np.cumsum(size_b)
        if overlaps:
            bytes_a, bytes_b = byte_rows(size_a), byte_rows(size_b)
            self.overlaps = row_product(bytes_a, transposed(bytes_b, int(self.end_b[-1]) if len(self.b) else 0))
        at = np.searchsorted(self.end_b, self.end_a)  # both go up, and end at the same byte
        self.ends = self.end_a[self.end_b[at] == self.end_a] if len(self.b) else self.end_a
        self.group_a, self.group_b = np.searchsorted(self.ends, self.end_a), np.searchsorted(self.ends, self.end_b)
        self.unit_a = np.repeat(np.arange(len(found)), self.n_a)
        self.unit_b = np.repeat(np.arange(len(found)), self.n_b)
        self.first_a = np.searchsorted(self.group_a, np.arange(len(self.ends) + 1))
        self.first_b = np.searchsorted(self.group_b, np.arange(len(self.ends) + 1))
        self.unit = self.unit_a[self.first_a[:-1]] if len(self.ends) else np.zeros(0, np.int64)
        self.n_groups = np.bincount(self.unit, minlength=len(found))
        self.n_links = np.bincount(self.unit, np.diff(self.first_a).astype(float) * np.diff(self.first_b), len(found)).astype(np.int64)

    def texts(self) -> list[str]:
        """Each unit's groups as ``a1,a2|b1;a3|b2,b3``."""
        a, b = list(map(str, self.a.tolist())), list(map(str, self.b.tolist()))
        fa, fb = self.first_a.tolist(), self.first_b.tolist()
        groups = [
            (a[i] if j == i + 1 else ",".join(a[i:j])) + "|" + (b[k] if m == k + 1 else ",".join(b[k:m]))
            for i, j, k, m in zip(fa, fa[1:], fb, fb[1:], strict=False)
        ]
        at = np.concatenate([[0], np.cumsum(self.n_groups)]).tolist()
        return [";".join(groups[i:j]) for i, j in zip(at, at[1:], strict=False)]

    def links(self) -> Iterator[Rows]:
        """Units by pairs of ids that share a group, with their number, in parts of about ``BLOCK`` entries.

        The product of A's tokens by groups with groups by B's tokens.  A pair
        of a unit is whole within one part, as the rows of one id stay together.
        """
        n = len(self.n_a)
        order = np.lexsort((self.a, self.unit_a))
        unit, ids, group = self.unit_a[order], self.a[order], self.group_a[order]
        by_group = self.first_b, self.b, np.ones(len(self.b), np.int64)
        work = np.cumsum(np.diff(self.first_b)[group]) if len(group) else np.zeros(0, np.int64)
        new = np.flatnonzero(np.r_[True, (np.diff(unit) != 0) | (np.diff(ids) != 0)]) if len(unit) else np.zeros(0, np.int64)
        lo = 0
        while lo < len(unit):
            hi = int(np.searchsorted(work, (work[lo - 1] if lo else 0) + BLOCK, side="right"))
            later = new[(new > lo) & (new <= hi)] if hi < len(unit) else []
            if hi < len(unit):
                hi = int(later[-1]) if len(later) else int(np.append(new[new > lo], len(unit))[0])
            of, at = expanded(by_group[0], group[lo:hi])
            pair = (ids[lo:hi][of] << np.int64(ID_BITS)) | by_group[1][at]
            yield summed(unit[lo:hi][of], pair, by_group[2][at], n)
            lo = hi


class Units:
    """What is known of the units met so far in this process."""

    def __init__(self, tok: Tokenizers):
        self.tok = tok
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.text: list[str] = []
        self.numbers = np.zeros((5, 0), np.int64)
        self.ptr, self.pairs, self.times = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, found: list[str]) -> None:
        made = Alignment(self.tok, found)
        self.index.update(zip(found, range(len(self.index), len(self.index) + len(found)), strict=True))
        self.text += made.texts()
        self.numbers = np.concatenate([self.numbers, [made.n_a, made.n_b, made.n_groups, made.n_links, made.valid]], 1)
        parts = list(made.links())
        unit = np.concatenate([np.repeat(np.arange(len(found)), np.diff(p[0])) for p in parts] or [np.zeros(0, np.int64)])
        pairs = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)])
        times = np.concatenate([p[2] for p in parts] or [np.zeros(0, np.int64)])
        order = np.argsort(unit, kind="stable")
        self.ptr = np.concatenate([self.ptr, self.ptr[-1] + np.cumsum(np.bincount(unit, minlength=len(found)))])
        self.pairs, self.times = np.concatenate([self.pairs, pairs[order]]), np.concatenate([self.times, times[order]])


_units: dict[tuple[str, str, str], Units] = Kept()

ROWS = (
    "row long, doc_id long, part int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<long>"
)
COLUMNS = [column.split()[0] for column in ROWS.split(", ")]


def _documents(known: Units, rows: pa.Array, ids: pa.Array, texts: list[str | None]) -> Iterator[pa.RecordBatch]:
    """Some documents to :data:`ROWS`."""
    found = [units(t) if t else [] for t in texts]
    met = set(chain.from_iterable(found))
    fresh = met.difference(known.index)
    if len(known.index) + len(fresh) > KEPT_UNITS:
        known.clear()
        fresh = met
    if fresh:
        known.learn(list(fresh))
    index = known.index
    n = len(texts)
    count = np.array([len(us) for us in found], np.int64)
    unit = np.array(list(map(index.__getitem__, chain.from_iterable(found))), np.int64)
    doc = np.repeat(np.arange(n), count)
    numbers = np.stack([np.bincount(doc, row[unit], n).astype(np.int64) for row in known.numbers])
    valid = (numbers[4] == count) & (count > 0)
    numbers = numbers[:4] * valid
    at = np.concatenate([[0], np.cumsum(count)])
    text = known.text
    digests = [
        hashlib.sha256(";".join(map(text.__getitem__, unit[at[i] : at[i + 1]].tolist())).encode()).hexdigest() if valid[i] else "" for i in range(n)
    ]
    keep = valid[doc]
    ptr, of_unit, times = summed(doc[keep], unit[keep], np.ones(int(keep.sum()), np.int64), n)
    # Documents by units, times units by pairs; in parts by the pair where there are many entries.
    _, where = expanded(known.ptr, of_unit)
    entries = len(where)
    n_parts = max(1, -(-entries // BLOCK))
    del where
    for part in range(n_parts):
        if n_parts == 1:
            links = known.ptr, known.pairs, known.times
        else:
            mine = known.pairs % n_parts == part
            links = np.concatenate([[0], np.cumsum(mine)])[known.ptr], known.pairs[mine], known.times[mine]
        p_ptr, pairs, p_times = row_product((ptr, of_unit, times), links)
        yield pa.RecordBatch.from_arrays(
            [
                rows, ids, pa.array(np.full(n, part, np.int32)), *(pa.array(row) for row in numbers), pa.array(digests, pa.string()),
                pa.ListArray.from_arrays(pa.array(p_ptr.astype(np.int32)), pa.array(pairs)),
                pa.ListArray.from_arrays(pa.array(p_ptr.astype(np.int32)), pa.array(p_times)),
            ],
            names=COLUMNS,
        )
    # Units that are no words would only fill the memory.
    if any(len(u) > KEPT_LENGTH for u in fresh):
        known.clear()


def _aligned(folder: str, file_a: str, file_b: str) -> Callable:
    """``row, doc_id, text`` to :data:`ROWS`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = folder, file_a, file_b
        if key not in _units:
            _units[key] = Units(tokenizers(*key))
        known = _units[key]
        for batch in batches:
            for lo, hi, _, _ in pieces(batch.column(2), PIECE):
                part = batch.slice(lo, hi - lo)
                yield from _documents(known, part.column(0), part.column(1), part.column(2).to_pylist())

    return run


def linked_pairs(docs: DataFrame, folder: str = FOLDER, file_a: str = FILE_A, file_b: str = FILE_B) -> DataFrame:
    """:data:`ROWS`: the numbers of each document and its linked pairs of ids, written once and read back.

    A pair is ``a * 2**20 + b``.  A document of very many pairs has several
    rows, told apart by ``part``; the numbers stand in each.
    """
    target = f"{shared_folder(docs.sparkSession)}/aligned-{uuid.uuid4().hex}"
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows.mapInArrow(_aligned(folder, file_a, file_b), ROWS).write.option("compression", "zstd").parquet(target)
    return docs.sparkSession.read.parquet(target)


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair, docs, best``: how many documents hold each pair, and whether no pair of its A id is held by more."""
    counts = links.groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    of_a = F.shiftright("pair", ID_BITS)
    # One row per id of vocabulary A, so of a size the vocabulary bounds.
    top = counts.groupBy(of_a.alias("a")).agg(F.max("docs").alias("top"))
    return counts.join(F.broadcast(top), of_a == F.col("a")).select("pair", "docs", (F.col("docs") == F.col("top")).alias("best"))


def alignment_report(docs: DataFrame, folder: str = FOLDER, file_a: str = FILE_A, file_b: str = FILE_B) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row."""
    found = linked_pairs(docs, folder, file_a, file_b)
    links = found.select("row", F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times"))
    joined = join_side(links, pair_counts(links), "pair", "inner")
    sums = joined.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum")
    )
    first = found.where("part = 0").select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    none = F.lit(0).cast("long")
    return first.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    )


SPANS = (
    "doc_id long, groups array<struct<start:long,end:long,a:array<int>,b:array<int>>>, "
    "overlaps array<struct<a:int,b:int,bytes:int>>"
)


def _spans(folder: str, file_a: str, file_b: str) -> Callable:
    def one(tok: Tokenizers, text: str | None) -> tuple[list, list]:
        if not text:
            return [], []
        made = Alignment(tok, units(text), overlaps=True)
        if not made.valid.all():
            return [], []
        ends = made.ends.tolist()
        a, b, fa, fb = made.a.tolist(), made.b.tolist(), made.first_a.tolist(), made.first_b.tolist()
        groups = [
            {"start": s, "end": e, "a": a[i:j], "b": b[k:m]}
            for s, e, i, j, k, m in zip([0, *ends], ends, fa, fa[1:], fb, fb[1:], strict=False)
        ]
        ptr, col, val = made.overlaps
        row = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
        return groups, [{"a": x, "b": y, "bytes": v} for x, y, v in zip(row.tolist(), col.tolist(), val.tolist(), strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizers(folder, file_a, file_b)
        group = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])
        overlap = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("bytes", pa.int32())])
        for batch in batches:
            for lo, hi, _, _ in pieces(batch.column(1), PIECE):
                part = batch.slice(lo, hi - lo)
                made = [one(tok, t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([m[0] for m in made], pa.list_(group)), pa.array([m[1] for m in made], pa.list_(overlap))],
                    names=["doc_id", "groups", "overlaps"],
                )

    return run


def alignments(docs: DataFrame, folder: str = FOLDER, file_a: str = FILE_A, file_b: str = FILE_B) -> DataFrame:
    """:data:`SPANS`: the groups of each document with their bytes in space + text, and its overlap links.

    ``overlaps`` names tokens by their place in the document, from 0.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_spans(folder, file_a, file_b), SPANS)
