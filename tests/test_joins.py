"""Latest rows and lookups."""

from pyspark.sql import functions as F

from hedonic.operators.latest import latest_per_key
from hedonic.operators.lookups import aligned_divide, attach_location, left_lookup_chain
from tests.conftest import plan_of, rows

HISTORY = [
    (1, 1, "2020-01-01", 10), (1, 1, "2021-01-01", 20), (1, 1, "2021-01-01", 30), (1, 1, None, 40),
    (2, 1, None, 50), (None, 1, "2020-01-01", 60), (None, 1, "2019-01-01", 70), (3, 1, "2019-05-05", 80),
]


def test_latest_keeps_ties_and_unknowns(spark):
    df = spark.createDataFrame(HISTORY, "Major int, Minor int, d string, v int")
    df = df.withColumn("d", F.col("d").cast("timestamp_ntz"))
    kept = latest_per_key(df, ["Major", "Minor"], "d")
    assert sorted(r.v for r in kept.collect()) == [20, 30, 40, 50, 60, 70, 80]
    assert kept.columns == df.columns


def test_latest_equals_not_exists(spark):
    df = spark.range(5000).select(
        (F.col("id") % 40).alias("k"), F.expr("int(hash(id) % 50)").alias("d"), "id"
    ).withColumn("k", F.expr("nullif(k, 7)")).withColumn("d", F.expr("if(id % 31 = 0, null, d)"))
    df.createOrReplaceTempView("history")
    expected = spark.sql(
        "SELECT * FROM history a WHERE NOT EXISTS (SELECT 1 FROM history b WHERE b.k = a.k AND b.d > a.d)"
    )
    assert rows(latest_per_key(df, ["k"], "d").select("id")) == rows(expected.select("id"))


def test_latest_uses_no_window_or_nested_loop(spark):
    df = spark.createDataFrame(HISTORY, "Major int, Minor int, d string, v int")
    plan = plan_of(latest_per_key(df, ["Major", "Minor"], "d"))
    assert "Window" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_location_join_and_cap(spark):
    props = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "pin string, v int")
    addr = spark.createDataFrame([("a", "x"), ("a", "y"), ("c", "z")], "pin string, addr string")
    assert rows(attach_location(props, addr)) == [("a", 1, "x"), ("a", 1, "y"), ("c", 3, "z")]


def test_lookup_chain_fans_out_and_keeps_unmatched(spark):
    props = spark.createDataFrame([("a",), ("b",)], "pin string")
    one = spark.createDataFrame([("a", 1)], "pin string, n int")
    two = spark.createDataFrame([("a", "x"), ("a", "y")], "pin string, s string")
    assert rows(left_lookup_chain(props, [one, two])) == [("a", 1, "x"), ("a", 1, "y"), ("b", None, None)]


def test_aligned_division(spark):
    a = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0)], "k string, n double")
    b = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "k string, d double")
    got = rows(aligned_divide(a, b, "k", "n", "d", mode="index"))
    assert got == [("a", 0.5), ("a", 1.0), ("a", 1.0), ("a", 2.0), ("b", None)]
    both = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 0.0)], "k string, n double, d double")
    assert rows(aligned_divide(both, both, "k", "n", "d", mode="rows")) == [("a", None), ("a", 0.5)]
