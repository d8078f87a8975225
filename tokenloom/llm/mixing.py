"""Mixing sources to target weights.

Words are counted per source, which gives each source its target and the rate
``target / size`` at which its documents repeat.  A document is taken
``floor(rate)`` times, plus once more if its hash, read as a number in [0, 1),
is below the fraction that is left.  The hash depends on a seed and the
document alone, so a rerun takes the same copies whatever the partitioning.

A null or empty text has size 0.  A null source is a source like any other.  A
source of no words has target 0 and its documents are not taken.  Rows that
repeat a document (or have a null id) draw by ``doc_id`` and are taken alike.
An empty table gives an empty one.  Other columns stay as they are in
:func:`mix_documents`; names that begin with ``__mix_`` are this module's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tokenloom.operators.wordlists import fits_broadcast
from tokenloom.session import settled

WORD = r"[^\x20\x09-\x0D]+"
# No source is repeated more often than this.
MOST = 3
# Copies of a source table too large to broadcast, so that a hot source meets in as many tasks.
SALTS = 64


def size_of(text: Column) -> Column:
    """Number of words; 0 if null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: str, doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the id only: 52 bits of their MD5."""
    named = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(2.0**52)


def cyclic_weights(sources: DataFrame) -> DataFrame:
    """Adds ``weight`` 1, 2, 3, 1, ... to sources in code point order, null last."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    return sources.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Adds ``target`` to ``source, source_size, weight``.

    The targets share the sum of all sizes by weight.  A target stops at
    ``most`` times its source's size, and what is over is shared again among the
    others.  So a target is ``least(most * size, weight * level)`` for one
    level: with sources in order of ``size / weight``, those that stop come
    first, each that stops raises the level for the rest, and taking out one
    that does not stop would lower it; so the level is the highest met.  The
    windows run over one row per source, never over documents.
    """
    total = W.partitionBy()
    upto = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = upto.rowsBetween(W.unboundedPreceding, -1), upto.rowsBetween(0, W.unboundedFollowing)
    level = (
        F.sum("source_size").over(total) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    ) / F.sum("weight").over(after)
    ranked = sources.withColumn("__mix_level", level)
    stops = F.col("source_size") * most <= F.col("weight") * F.col("__mix_level")
    shared = F.max("__mix_level").over(total)
    return ranked.withColumn(
        "target", F.when(stops, (F.col("source_size") * most).cast("double")).otherwise(F.col("weight") * shared)
    ).drop("__mix_level")


def source_rates(docs: DataFrame, weights=cyclic_weights, most: int = MOST) -> DataFrame:
    """``source, source_size, weight, target``; ``weights`` adds the weights to ``source, source_size``."""
    sizes = docs.groupBy("source").agg(F.sum(size_of(F.col("text"))).alias("source_size"))
    return targets(weights(sizes), most)


def with_copies(docs: DataFrame, rates: DataFrame, seed: str = "mix") -> DataFrame:
    """``docs`` with ``__mix_source_size``, ``__mix_target`` and ``__mix_copies``.

    The rates, one row per source, are broadcast if they are measured to be
    small.  Beyond that documents are dealt out over copies of them, so that a
    hot source does not meet in one task.
    """
    side = settled(rates.select(
        F.col("source").alias("__mix_source"), F.col("source_size").alias("__mix_source_size"), F.col("target").alias("__mix_target")
    ))
    same = docs["source"].eqNullSafe(side["__mix_source"])
    if fits_broadcast(side):
        joined = docs.join(F.broadcast(side), same)
    else:
        salt = F.pmod(F.xxhash64(docs["doc_id"]), F.lit(SALTS)).cast("int")
        dealt = side.withColumn("__mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = docs.join(dealt, docs["source"].eqNullSafe(dealt["__mix_source"]) & (salt == dealt["__mix_salt"])).drop("__mix_salt")
    rate = F.when(F.col("__mix_source_size") > 0, F.col("__mix_target") / F.col("__mix_source_size")).otherwise(0.0)
    more = draw(seed, F.col("doc_id")) < rate - F.floor(rate)
    return joined.withColumn("__mix_copies", F.floor(rate) + more.cast("long")).drop("__mix_source")


def mix_documents(docs: DataFrame, weights=cyclic_weights, most: int = MOST, seed: str = "mix") -> DataFrame:
    """Every document as often as the mix takes it, with ``copy`` from 0.

    Where ``docs`` has a column of that name the number is called ``copy_2``,
    or the first of ``copy_3`` and so on that is free.
    """
    taken_names = {c.lower() for c in docs.columns}
    name = next(n for n in ("copy", *(f"copy_{k}" for k in range(2, len(taken_names) + 3))) if n not in taken_names)
    taken = with_copies(docs, source_rates(docs, weights, most), seed)
    return taken.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.explode(F.filter(F.sequence(F.lit(0), F.col("__mix_copies")), lambda k: k < F.col("__mix_copies"))).alias(name),
    )


def mix_report(docs: DataFrame, weights=cyclic_weights, most: int = MOST, seed: str = "mix") -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every document; texts are not moved."""
    thin = docs.select("doc_id", "source", size_of(F.col("text")).alias("__mix_size"))
    return with_copies(thin, source_rates(docs, weights, most), seed).select(
        "doc_id",
        F.col("__mix_size").alias("size"),
        F.col("__mix_source_size").alias("source_size"),
        F.col("__mix_target").alias("target"),
        (F.col("__mix_size") * F.col("__mix_copies")).alias("taken"),
    )
