"""Latest row per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Keep rows for which no later row with the same key exists.

    Ties for the latest are all kept, and so is a row whose date or key is NULL,
    since nothing compares as later than it.

    The newest date per key is a map-side combined aggregate, and rows are
    matched to it on key *and* date.  A key that owns a large share of the
    history is thereby spread over its dates; ranking inside a window would put
    it in one task.
    """
    cols = [*keys, order_col]
    unknown = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    known = df.where(~unknown)
    newest = known.groupBy(*keys).agg(F.max(order_col).alias(order_col))
    return known.join(newest, cols, "left_semi").select(df.columns).unionByName(df.where(unknown))
