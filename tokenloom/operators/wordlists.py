"""Filtering by word lists and joining small tables, with their size checked."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.session import settled_if_possible
from tokenloom.sources.lists import LITERAL_WORDS, word_table

# A side table is broadcast only up to these sizes.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20
# Different keys a task of the frequency sketch tells apart; more tasks than a third
# of it could be kept busy by one key each only beyond what the sketch can see.
SKETCH_KEYS = 1 << 16

Words = Collection[str] | DataFrame


def fits_broadcast(side: DataFrame) -> bool:
    """Whether ``side`` is small, by its measured rows and bytes."""
    text_bytes = [
        F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in side.columns
    ]
    row_bytes = sum(text_bytes[1:], text_bytes[0])
    rows, size = side.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes), F.lit(0))).first()
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def settled_if_short(side: DataFrame, at_most: int | None) -> DataFrame:
    """``side``, computed once for its measuring and its use, if the caller bounds its rows by ``at_most``."""
    return settled_if_possible(side) if at_most is not None and at_most <= BROADCAST_ROWS else side


def join_side(left: DataFrame, side: DataFrame, on: str, how: str, at_most: int | None = None) -> DataFrame:
    """Join ``left`` with a side table that has one row per key.

    A small side is broadcast; beyond that see :func:`salted_join`.  A bound on
    its rows spares computing it twice; its bytes are measured all the same.
    """
    side = settled_if_short(side, at_most)
    if fits_broadcast(side):
        return left.join(F.broadcast(side), on, how)
    return salted_join(left, side, on, how)


def hot_keys(left: DataFrame, on: str, tasks: int) -> DataFrame:
    """``on, copies``: the keys that hold more than one task's share of ``left``, and how many tasks' they hold.

    One pass with a sketch that folds where rows are read.  Its counts are never
    too low for keys above its error, 3.5 in :data:`SKETCH_KEYS`, so none that
    fills a task is missed while there are fewer tasks than its inverse; at most
    ``tasks`` keys can hold such a share, which bounds the result.
    """
    k = max(1, min(tasks, SKETCH_KEYS // 4))
    counted = left.agg(
        F.expr(f"approx_top_k(`{on}`, {k}, {SKETCH_KEYS})").alias("top"), F.count(F.lit(1)).alias("rows")
    )
    share = F.ceil(F.col("one.count") * tasks / F.col("rows")).cast("int")
    return (
        counted.select("rows", F.explode("top").alias("one"))
        .select(F.col("one.item").alias(on), share.alias("copies"))
        .filter(F.col("copies") > 1)
    )


def salted_join(left: DataFrame, side: DataFrame, on: str, how: str) -> DataFrame:
    """Join on a key that may make up much of ``left``, with any size of side.

    Keys that hold more than one task's share, by :func:`hot_keys`, are copied
    on the side as often as they hold it, and their rows, told apart by their
    other columns, are dealt out over the copies.  All other keys are joined as
    they are.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # At most `tasks` rows, some tens of bytes each, so a broadcast of known size.
    hot = F.broadcast(settled_if_possible(hot_keys(left, on, tasks)))
    copies = F.coalesce(F.col("copies"), F.lit(1))
    others = [F.col(f"`{c}`") for c in left.columns if c != on] or [F.col(f"`{on}`")]
    salt = F.pmod(F.xxhash64(*others), copies).cast("int").alias("__salt")
    dealt = left.join(hot, on, "left").select(*[F.col(f"`{c}`") for c in left.columns], salt)
    copied = side.join(hot, on, "left").select(
        *[F.col(f"`{c}`") for c in side.columns], F.explode(F.sequence(F.lit(0), copies - 1)).alias("__salt")
    )
    return dealt.join(copied, [on, "__salt"], how).drop("__salt")


def short_list(words: Words) -> list[str] | None:
    """``words`` as a list if it is short enough to stand in a plan, else None."""
    if isinstance(words, DataFrame):
        head = words.limit(LITERAL_WORDS + 1).collect()
        return [row[0] for row in head] if len(head) <= LITERAL_WORDS else None
    return list(words) if len(words) <= LITERAL_WORDS else None


def stop_list(words: Words) -> Words:
    """``words`` as a list if short, so that its size need not be measured again."""
    listed = short_list(words)
    return words if listed is None else listed


def word_frame(words: Words, like: DataFrame, name: str) -> DataFrame:
    """``words`` as a one-column frame ``name``, each word once."""
    if isinstance(words, DataFrame):
        return words.toDF(name).distinct()
    return word_table(like.sparkSession, words).toDF(name)


def drop_words(tokens: DataFrame, words: Words, on: str = "tok", at_most: int | None = None) -> DataFrame:
    """Rows of ``tokens`` whose word is not listed."""
    return _by_list(tokens, words, on, "left_anti", at_most)


def keep_words(tokens: DataFrame, words: Words, on: str = "tok", at_most: int | None = None) -> DataFrame:
    """Rows of ``tokens`` whose word is listed."""
    return _by_list(tokens, words, on, "left_semi", at_most)


def _by_list(tokens: DataFrame, words: Words, on: str, how: str, at_most: int | None) -> DataFrame:
    side = word_frame(words, tokens, on)
    if is_small_list(words):
        kept = tokens.join(F.broadcast(side), on, how)
    elif isinstance(words, DataFrame):
        kept = join_side(tokens, side, on, how, at_most)
    else:
        kept = salted_join(tokens, side, on, how)
    return kept.select(*tokens.columns)


def is_small_list(words: Words) -> bool:
    """Whether ``words`` is a list, not a table, and short enough to broadcast."""
    if isinstance(words, DataFrame):
        return False
    return len(words) <= BROADCAST_ROWS and sum(len(w.encode()) for w in words) <= BROADCAST_BYTES
