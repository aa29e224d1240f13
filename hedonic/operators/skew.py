"""Equi-joins that stay balanced when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hedonic.session import settle

# Rows of one key that one task should join.  A key with more, on either side, is
# cut into as many pieces as it takes.
HOT_ROWS = 1_000_000
# What a side may have, measured beforehand, to be broadcast.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 << 20


def stored_bytes(df: DataFrame) -> int:
    """Size of a settled frame as its files say."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Has the settled ``df`` at most ``limit`` rows and ``size`` bytes?"""
    return stored_bytes(df) <= size and df.limit(limit + 1).count() <= limit


def _pieces(rows: Column, most: int) -> Column:
    return F.greatest(F.ceil(rows / most), F.lit(1)).cast("int")


def hot_keys(sides: Sequence[DataFrame], keys: Sequence[str], rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys owning more than ``rows`` rows of a side, with their rows in each, ``n0, n1, ...``; None when there are none.

    Reads only the key columns and combines before the shuffle; a side of n rows has
    fewer than n / ``rows`` such keys.
    """
    counts = [
        side.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows) for side in sides
    ]
    hot = settle(reduce(DataFrame.union, [c.select(*keys) for c in counts]).distinct())
    if hot.isEmpty():
        return None
    for i, side in enumerate(sides):
        own = side.select(*keys).join(hot.select(*keys), keys, "left_semi") if not is_small(hot) else side.select(*keys).join(
            F.broadcast(hot.select(*keys)), keys, "left_semi"
        )
        own = own.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"n{i}"))
        hot = hot.join(own, keys, "left").fillna({f"n{i}": 0})
    return settle(hot)


def join_lookups(
    df: DataFrame,
    lookups: Sequence[DataFrame],
    keys: Sequence[str],
    how: str = "left",
    rows: int = HOT_ROWS,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join every lookup to ``df`` in turn on ``keys``; ``how`` is ``left`` or ``inner``.

    Rows of ordinary keys are shuffled once for the whole chain.  A key with many rows in
    ``df`` or in a lookup is cut into pieces on both sides, as many as its counts ask
    for, and every piece of one side meets every piece of the other.  Rows are dealt to
    pieces by their place, not by their content, so equal rows spread too.  Rows with a
    NULL key match nothing and are not shuffled.
    """
    keys = list(keys)

    def chain(left: DataFrame, step) -> DataFrame:
        return reduce(step, range(len(lookups)), left)

    hot = hot_keys([df, *lookups], keys, rows)
    if hot is None:
        return chain(df, lambda left, i: left.join(lookups[i], keys, how))

    few = F.broadcast(hot) if is_small(hot, limit) else hot
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    complete = df.where(known)
    names = few.select(*keys)
    calm = chain(complete.join(names, keys, "left_anti"), lambda left, i: left.join(lookups[i], keys, how))

    def meet(left: DataFrame, i: int) -> DataFrame:
        """Hot rows of the left with the lookup's rows of their keys."""
        size = few.select(*keys, _pieces(F.col("n0"), rows).alias("_a"), _pieces(F.col(f"n{i + 1}"), rows).alias("_b"), f"n{i + 1}")
        here = left.join(size, keys)
        place = F.monotonically_increasing_id()
        found = here.where(F.col(f"n{i + 1}") > 0)
        # Written down, so that a retried task finds its rows in the pieces they were dealt to.
        found = settle(found.withColumn("_x", F.pmod(place, F.col("_a"))))
        found = found.withColumn("_y", F.explode(F.sequence(F.lit(0), F.col("_b") - 1)))
        there = lookups[i].join(size.drop(f"n{i + 1}"), keys)
        there = settle(there.withColumn("_y", F.pmod(place, F.col("_b")).cast("int")))
        there = there.withColumn("_x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_a").cast("long") - 1)))
        drop = ["_a", "_b", "_x", "_y", f"n{i + 1}"]
        met = found.drop("_a", "_b", f"n{i + 1}").join(there.drop("_a", "_b"), [*keys, "_x", "_y"]).drop(*drop)
        if how == "inner":
            return met
        return met.unionByName(here.where(F.col(f"n{i + 1}") == 0).drop(*drop), allowMissingColumns=True)

    whole = calm.unionByName(chain(complete.join(names, keys, "left_semi"), meet).select(calm.columns))
    if how == "left":
        whole = whole.unionByName(df.where(~known), allowMissingColumns=True).select(calm.columns)
    return whole
