"""Joins with a hot key give what a plain join gives."""

import pytest
from pyspark.sql import functions as F

from hedonic.operators.skew import hot_keys, join_lookups
from tests.conftest import rows


@pytest.fixture(scope="module")
def tables(spark):
    # Key 0 owns a third of the rows, NULL another part.
    left = spark.range(900).select(
        F.expr("case when id % 3 = 0 then 0 when id % 10 = 1 then null else id % 40 end").alias("k"), F.col("id").alias("v")
    )
    one = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("a"))
    many = spark.range(50).select((F.col("id") % 7).alias("k"), F.col("id").alias("b"))
    return left, one, many


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limit", [100, 3])
def test_hot_split_equals_plain_join(tables, how, limit):
    left, one, many = tables
    plain = left.join(one, "k", how).join(many, "k", how)
    split = join_lookups(left, [one, many], ["k"], how, rows=50, limit=limit)
    assert split.columns == plain.columns
    assert rows(split) == rows(plain)


def test_two_column_keys(tables):
    left, one, _ = tables
    left, one = left.withColumn("k2", F.lit(1)), one.withColumn("k2", F.col("k") % 2)
    plain = left.join(one, ["k", "k2"], "left")
    assert rows(join_lookups(left, [one], ["k", "k2"], rows=50)) == rows(plain)


def test_hot_keys(tables):
    left, one, many = tables
    assert rows(hot_keys([left, one], ["k"], 50)) == [(0, 315, 1)]
    assert hot_keys([left, one], ["k"]) is None


def test_hot_key_of_a_lookup_and_map_columns(spark, tables):
    left, *_ = tables
    crowded = spark.range(400).select((F.col("id") % 2 * 7).alias("k"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    for how in ("left", "inner"):
        plain = left.join(crowded, "k", how).withColumn("m", F.col("m")["a"])
        split = join_lookups(left, [crowded], ["k"], how, rows=50).withColumn("m", F.col("m")["a"])
        assert rows(split) == rows(plain)


def test_equal_rows_are_dealt_to_different_pieces(spark):
    same = spark.range(300).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    other = spark.createDataFrame([(1, "y")], "k int, w string")
    split = join_lookups(same, [other], ["k"], rows=50)
    assert split.count() == 300
    assert split.distinct().count() == 1
