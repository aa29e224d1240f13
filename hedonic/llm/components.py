"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hedonic.llm.common import tasks_for
from hedonic.session import release, settle

#: Links that one task writes.
LINKS_EACH = 100_000


def _both(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(sides: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours on one side are linked to the smallest node around it.

    A node with very many neighbours is a key with many rows on one side of the join only,
    which adaptive execution splits; the minimum is combined before the shuffle.
    """
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    if large:
        far = sides.where(F.col("v") > F.col("u"))
        found = far.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        near = sides.where(F.col("v") < F.col("u"))
        least = near.groupBy("u").agg(F.min("v").alias("m"))
        found = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        found = found.union(least.select("u", F.col("m").alias("v")))
    return found.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of all nodes of ``links`` (``u, v``, in any order, repeated or not).

    Links stay distributed; each round writes the remaining ones, whose number never
    grows, and two numbers tell the driver whether anything changed.
    """
    known = links.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    known, last = settle(known.distinct()), None
    while True:
        state = known.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == last:
            break
        last, old = state, known
        # Links are short and soon few; a task takes many of them.
        tasks = tasks_for(state[0], LINKS_EACH)
        wide = settle(_star(_both(old), large=True).coalesce(tasks))
        known = settle(_star(_both(wide), large=False).coalesce(tasks))
        release(old, wide)
    ends = known.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.union(known.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
