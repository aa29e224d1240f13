"""Reproducible train/test membership and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 123
TEST_SHARE = 0.2
STEPS = 1000


def bucket(key: str, n: int, seed: int = SEED) -> Column:
    """A number in ``0..n-1`` fixed by the key and the seed alone.

    Row order and partitioning play no part, so a retried task cannot move a row
    to the other side, and any engine with MD5 can recompute it.
    """
    text = F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))
    head = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
    return F.pmod(head, F.lit(n)).cast("int")


def split(df: DataFrame, key: str, test: float = TEST_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; all rows of one key stay together."""
    in_test = bucket(key, STEPS, seed) < round(test * STEPS)
    return df.where(~in_test), df.where(in_test)


def with_folds(df: DataFrame, key: str, folds: int = 5, seed: int = SEED, out: str = "fold") -> DataFrame:
    return df.withColumn(out, bucket(key, folds, seed))
