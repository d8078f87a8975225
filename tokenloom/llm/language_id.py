"""Language identification by error-correcting output codes.

Each language has a codeword of bits.  For every bit a binary classifier over
byte n-grams (one to three bytes, hashed to ``FEATURES`` numbers) tells the
languages whose bit is 1 from those whose bit is 0.  A text's margins are held
against every codeword; a margin that contradicts a bit costs a logistic loss,
weighted by how well that bit separates the languages, and the codeword of
least loss wins.  A text whose two best codewords are nearly as cheap is flagged
ambiguous.

Up to seven languages have the exhaustive code (every split of the languages
into two sides); more have random splits, ``10 log2(languages)`` of them.

The classifiers are naive Bayes: all they need is how often each n-gram occurs
in each language, which is counted over all labelled texts, folded per task.
What reaches the driver is ``FEATURES`` counts per language.

A null or empty text, or one without a letter, is ``und`` with score 0, as is
everything if nothing is labelled.  Labels that are null, and rows whose id is
null, teach nothing.  Texts are read whole; ties go to the first language in
code point order.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.bytetext import pieces

FEATURES = 1 << 14
# Below this share of the decoding's weight a text is ambiguous.
SURE = 0.5
GAIN = 4.0
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _grams(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1, 2, 3: hashed n-grams and their texts; runs of blanks only are left out."""
    folded = _FOLD[data].astype(np.uint32)
    text = np.repeat(np.arange(len(off) - 1), np.diff(off))
    code = folded
    blank = folded == 32
    for n in (1, 2, 3):
        if n > 1:
            code = code[:-1] * np.uint32(257) + folded[n - 1 :]
            blank = blank[:-1] & (folded[n - 1 :] == 32)
        if not len(code):
            return
        whole = (text[: len(code)] == text[n - 1 :]) & ~blank
        h = (code[whole] + np.uint32(n)) * np.uint32(0x9E3779B1)
        yield (h >> np.uint32(18)).astype(np.int64), text[: len(code)][whole]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for first, end, data, off in pieces(batch.column(0)):
            names, index = np.unique(np.array(langs[first:end], dtype=object).astype(str), return_inverse=True)
            sums = np.zeros(len(names) * FEATURES, np.int64)
            for grams, text in _grams(data, off):
                sums += np.bincount(index[text] * FEATURES + grams, minlength=len(sums))
            for k, name in enumerate(names.tolist()):
                part = sums[k * FEATURES : (k + 1) * FEATURES]
                found[name] = found[name] + part if name in found else part
    yield _blobs(found)


def _blobs(found: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.string()), pa.array([v.tobytes() for v in found.values()], pa.binary())], names=["lang", "counts"]
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, np.ndarray] = {}
    for batch in batches:
        for name, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(blob, np.int64)
            found[name] = found[name] + part if name in found else part
    yield _blobs(found)


def codewords(n: int) -> np.ndarray:
    """``n`` rows of bits, told apart by as many columns as possible."""
    if n < 2:
        return np.zeros((n, 0), bool)
    if n <= 7:
        splits = np.arange(1, 1 << (n - 1))
        return np.array([[bool(s >> i & 1) if i < n - 1 else False for s in splits] for i in range(n)])
    rng = np.random.default_rng(7)
    best = None
    for _ in range(50):
        code = rng.random((n, int(np.ceil(10 * np.log2(n))))) < 0.5
        code = code[:, code.any(axis=0) & ~code.all(axis=0)]
        apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        if best is None or apart > best[0]:
            best = apart, code
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # bits x features
    bit_weight: np.ndarray


def fit(labelled: DataFrame) -> Model:
    """A model of ``text, lang``; rows without a label are left out."""
    rows = labelled.where("lang IS NOT NULL").select("text", "lang")
    parts = rows.mapInArrow(_counts, "lang string, counts binary").repartition("lang")
    counted = {r.lang: np.frombuffer(r.counts, np.int64) for r in parts.mapInArrow(_added, "lang string, counts binary").collect()}
    languages = sorted(lang for lang, counts in counted.items() if counts.sum())
    code = codewords(len(languages))
    if not languages:
        return Model([], np.zeros((0, 0)), np.zeros((0, FEATURES), np.float32), np.zeros(0))
    shares = np.array([counted[lang] + 0.5 for lang in languages], float).reshape(len(languages), FEATURES)
    shares /= shares.sum(axis=1, keepdims=True)
    weights = np.array([np.log(shares[bit].mean(axis=0) / shares[~bit].mean(axis=0)) for bit in code.T]).reshape(code.shape[1], FEATURES)
    sign = np.where(code, 1.0, -1.0)
    margins = sign * (shares @ weights.T)  # of each language's own n-grams
    scale = np.maximum(np.abs(margins).mean(axis=0), 1e-9)
    return Model(languages, sign, (weights / scale[:, None]).astype(np.float32), np.clip((margins / scale).min(axis=0), 0.05, 1.0))


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best language of each row of margins, its share of the decoding and the second's."""
    z = margins[:, None, :] * model.code[None]
    loss = (np.logaddexp(0.0, -GAIN * z) * model.bit_weight).sum(axis=2)
    share = np.exp(loss.min(axis=1, keepdims=True) - loss)
    share /= share.sum(axis=1, keepdims=True)
    ranked = np.sort(share, axis=1)
    second = ranked[:, -2] if share.shape[1] > 1 else np.zeros(len(share))
    return share.argmax(axis=1), share.max(axis=1), second


def _judge(model: Model, text: pa.Array, lettered: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Language, score and ambiguity of each text."""
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    n = len(text)
    lettered = np.array(lettered.fill_null(False).to_pylist(), bool)
    best = np.full(n, len(names) - 1)
    score, second = np.zeros(n), np.zeros(n)
    for first, end, data, off in pieces(text):
        if not model.languages:
            break
        sums = np.zeros((end - first, model.code.shape[1]))
        seen = np.zeros(end - first)
        for grams, of in _grams(data, off):
            seen += np.bincount(of, minlength=end - first)
            for bit, weights in enumerate(model.weights):
                sums[:, bit] += np.bincount(of, weights=weights[grams], minlength=end - first)
        found = decode(model, sums / np.maximum(seen, 1)[:, None])
        known = lettered[first:end]
        best[first:end] = np.where(known, found[0], len(names) - 1)
        score[first:end] = np.where(known, found[1], 0.0)
        second[first:end] = np.where(known, found[2], 0.0)
    return pa.array(names[best].tolist(), pa.string()), pa.array(score), pa.array((best < len(names) - 1) & (score < SURE))


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = [batch.column(i) for i in range(batch.num_columns - 2)]
            found = _judge(model, batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*given, *found], names=[*batch.schema.names[:-2], "lang_pred", "score", "ambiguous"])

    return run


def is_clear(model: Model, text: Column) -> Column:
    """Whether the language of ``text`` is known and unambiguous.

    Only the text goes to Python and only the answer comes back, so other
    columns may have any name and type.
    """

    def run(texts: pa.Array, lettered: pa.Array) -> pa.Array:
        language, _, ambiguous = _judge(model, texts, lettered)
        return pc.and_(pc.not_equal(language, UNKNOWN), pc.invert(ambiguous))

    # Without annotations that executors would have to look up.
    run.__annotations__ = {"texts": pa.Array, "lettered": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "boolean")(text, has_letter(text))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(model: Model, docs: DataFrame, *carry: str) -> DataFrame:
    """The columns ``carry``, then ``lang_pred, score, ambiguous``, of every row; only ``text`` is judged."""
    thin = docs.select(*carry, F.col("text").alias("__text"), has_letter(F.col("text")).alias("__lettered"))
    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in carry] + ["lang_pred string", "score double", "ambiguous boolean"])
    return thin.mapInArrow(_predict(model), schema)


def learnable(doc_id: Column) -> Column:
    """Whether a document may be learnt from: its id's CRC-32 modulo 4 is not 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 != 2, F.lit(False))
