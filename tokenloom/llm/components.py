"""Connected components of a table of links, by alternating large and small stars.

Every step is an aggregate and a join over the links; nothing is gathered in
one task or on the driver but one row that tells whether all links are stars.
Links shrink to stars around the smallest id of each component in a number of
steps that grows with the logarithm of a component's size.  A node with very
many links is a hot key of a join, which Spark splits, and of a minimum, which
folds before it is shuffled.  While links are few, by their count, the smallest
neighbours are broadcast instead, and no step has more tasks than run at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.wordlists import BROADCAST_ROWS
from tokenloom.session import settled


def _star(links: DataFrame, least: DataFrame) -> DataFrame:
    """Link the ``v`` of each ``u, v`` to the ``m`` of ``u`` in ``least``."""
    return links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _odd_and_links(now: DataFrame) -> tuple[int, int]:
    """How many nodes keep the ``u, v`` from being stars, by a second ``v`` or as a ``v`` that is a ``u``; how many links there are."""
    ends = now.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        now.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    odd, links = nodes.agg(F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))), F.sum("up")).first()
    return odd, links or 0


def _gathered(few: DataFrame) -> DataFrame:
    """``few`` rows in no more tasks than run at once; a task for each shuffle partition would take longer to start than to run."""
    return few.coalesce(few.sparkSession.sparkContext.defaultParallelism)


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every id in ``a, b``; a component's name is its smallest id."""
    now = settled(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while True:
        odd, count = _odd_and_links(now)
        if not odd:
            break
        few = count <= BROADCAST_ROWS
        if few:
            now = _gathered(now)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = F.broadcast(_gathered(least)) if few else least
        large = _star(both.where("v > u"), least).unionByName(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        large = _gathered(large) if few else large
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        least = F.broadcast(_gathered(least)) if few else least
        now = _star(large, least).unionByName(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        now = settled(_gathered(now) if few else now)
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())


def joined_further(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``id, component`` of the components ``parts`` after more ``links`` between ids in them or beside them."""
    links = settled(links)
    if links.isEmpty():
        return parts
    for end in ("a", "b"):
        name = parts.select(F.col("id").alias(end), F.col("component").alias("__part"))
        links = links.join(name, end, "left").withColumn(end, F.coalesce("__part", end)).drop("__part")
    further = settled(components(links))
    named = parts.join(further.select(F.col("id").alias("component"), F.col("component").alias("__further")), "component", "left")
    return named.select("id", F.coalesce("__further", "component").alias("component")).unionByName(further.join(parts.select("id"), "id", "left_anti"))
