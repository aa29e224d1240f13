"""Column functions on hand-checked cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hedonic.functions.geo import project_2926, ring_distance, within
from hedonic.functions.keys import add_pin, clean_keys
from hedonic.functions.points import parse_point
from hedonic.functions.predicates import between_open, exclude_codes, sale_filters
from hedonic.functions.scalars import clean_dates, log1p_cols, map_values, replace_where
from tests.conftest import rows


def test_pin_pads_but_never_cuts(spark):
    df = add_pin(spark.createDataFrame([(123, 7), (1234567, 5)], "Major int, Minor int"))
    assert rows(df.select("pin")) == [("0001230007",), ("12345670005",)]


def test_keys_are_stripped_and_blanks_dropped(spark):
    df = spark.createDataFrame(
        [(" 12 ", "1"), ("  ", "1"), ("", "1"), (None, "1"), ("\t7\n", " 2　"), ("3", None)],
        "Major string, Minor string",
    )
    assert rows(clean_keys(df, ["Major", "Minor"])) == [(7, 2), (12, 1)]


def test_bad_key_raises_or_is_dropped(spark):
    df = spark.createDataFrame([("x", "1"), ("4", "2")], "Major string, Minor string")
    with pytest.raises(Exception, match="not a number"):
        clean_keys(df, ["Major", "Minor"]).collect()
    assert rows(clean_keys(df, ["Major", "Minor"], strict=False)) == [(4, 2)]


def test_point_text(spark):
    df = spark.createDataFrame([("(47.6, -122.3)",), (None,)], "Shape string")
    assert rows(parse_point(df).select("lat", "long")) == [(None, None), (47.6, -122.3)]
    plain = spark.createDataFrame([(1,)], "a int")
    assert parse_point(plain).columns == ["a"]


def test_dates_are_cut_to_midnight(spark):
    noon = dt.datetime(2015, 3, 1, 12, 30)
    df = spark.createDataFrame([("2015-03-01 12:30:00", noon), (None, None)], "a string, b timestamp_ntz")
    midnight = dt.datetime(2015, 3, 1)
    assert rows(clean_dates(df, ["a", "b"])) == [(None, None), (midnight, midnight)]


def test_excluded_codes_keep_null(spark):
    df = spark.createDataFrame([(1,), (None,), (10,)], "c int")
    assert rows(exclude_codes(df, "c", [10, 8])) == [(None,), (1,)]


def test_open_interval(spark):
    df = spark.createDataFrame([(-122.0,), (-121.9,), (-118.0,), (None,)], "lon double")
    assert rows(between_open(df, "lon", -122, -118)) == [(-121.9,)]


@pytest.mark.parametrize(
    "good, expected", [("ratio", [True, False, False, False, False]), ("band", [True, False, False, False, False])]
)
def test_good_sale(spark, good, expected):
    cases = [(1, 100000, 90000), (2, 0, 0), (3, 500000, 0), (4, 300000, 300), (5, None, 90000)]
    df = spark.createDataFrame(cases, "id int, sale_price long, appr_tot_val long")
    df = df.withColumn("sale_date", F.lit("2014-01-01").cast("timestamp_ntz"))
    out = df.orderBy("id").select(sale_filters(good=good)["good"])
    assert [r[0] for r in out.collect()] == expected


def test_sale_limits(spark):
    df = spark.createDataFrame(
        [(1, 80000, "2012-12-31"), (2, 80001, "2013-01-01"), (3, 4000000, None), (4, 4000001, "2014-01-01")],
        "id int, sale_price long, sale_date string",
    ).withColumn("appr_tot_val", F.lit(1))
    f = sale_filters()
    out = df.orderBy("id").select(f["recent"], f["nonzero"], f["under"])
    assert [tuple(r) for r in out.collect()] == [
        (False, False, True), (True, True, True), (False, True, True), (True, True, False)
    ]


def test_map_replace_log(spark):
    df = spark.createDataFrame([("Y", 0, 0.0), ("N", 1990, -1.0), ("?", None, 1.0)], "p string, y int, v double")
    assert rows(map_values(df, "p", {"Y": 1, "N": 0}).select("p")) == [(None,), (0,), (1,)]
    assert rows(replace_where(df, "y", F.col("y") == 0, 2000).select("y")) == [(None,), (1990,), (2000,)]
    assert rows(log1p_cols(df, ["v"]).select("v"))[:2] == [(None,), (0.0,)]


@pytest.mark.parametrize(
    "lon, lat, x, y", [(-(120 + 50 / 60), 47.0, 1640416.667, 0.0), (-122.3321, 47.6062, 1270714.8, 224723.5)]
)
def test_projection(spark, lon, lat, x, y):
    got = spark.range(1).select(*project_2926(F.lit(lon), F.lit(lat))).head()
    assert got[0] == pytest.approx(x, abs=0.05) and got[1] == pytest.approx(y, abs=0.05)


@pytest.mark.parametrize("turn, d, inside", [(0.0, 999.0, True), (0.5, 999.0, False), (0.5, 995.0, True), (7.0, 999.0, True)])
def test_polygon_buffer(spark, turn, d, inside):
    import math

    angle = turn * math.pi / 16
    dx, dy = F.lit(d * math.cos(angle)), F.lit(d * math.sin(angle))
    assert spark.range(1).select(within(dx, dy, 1000.0, quad_segs=8)).head()[0] is inside
    assert spark.range(1).select(within(dx, dy, 1000.0)).head()[0] is True


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("point, distance", [((5, 5), 0), ((15, 5), 5), ((13, 14), 5), ((5, -2), 2), ((7.5, 9), 0.0)])
def test_ring_distance(spark, point, distance, closed):
    corners = [(0, 0), (10, 0), (10, 10), (0, 10)] + ([(0, 0)] if closed else [])
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in corners])
    got = spark.range(1).select(ring_distance(F.lit(float(point[0])), F.lit(float(point[1])), ring)).head()[0]
    assert got == pytest.approx(distance)


def test_ring_distance_to_notch(spark):
    # A U shape: the notch between its arms lies outside.
    corners = [(0, 0), (9, 0), (9, 9), (6, 9), (6, 3), (3, 3), (3, 9), (0, 9)]
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in corners])
    got = spark.range(1).select(
        ring_distance(F.lit(4.0), F.lit(6.0), ring), ring_distance(F.lit(1.0), F.lit(6.0), ring)
    ).head()
    assert tuple(got) == (1.0, 0.0)
