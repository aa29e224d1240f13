"""Map layers that arrive as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.functions.geo import PLANAR_SRID
from hedonic.sources.csv import read_csv

GEOJSON = "properties map<string, string>, geometry struct<type: string, coordinates: string>"
RINGS = "array<array<struct<x: double, y: double>>>"


def _rings(rings: Column) -> Column:
    """Rings of coordinate lists as rings of corners."""
    return F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))


def _unknown(kind: Column) -> Column:
    return F.raise_error(F.concat(F.lit("unsupported geometry: "), F.coalesce(kind, F.lit("without a type"))))


def geojson_geometry(geometry: Column) -> tuple[Column, Column, Column]:
    """``x, y`` of a point and ``rings`` of a polygon, of one or several parts; anything else is an error.

    The coordinates of ``geometry`` (``type, coordinates``) are JSON text, as their nesting
    follows the type.  A feature without a geometry has neither.
    """
    kind, text = geometry["type"], geometry["coordinates"]
    point = F.from_json(text, "array<double>")
    rings = (
        F.when(geometry.isNull() | (kind == "Point"), F.lit(None))
        .when(kind == "Polygon", _rings(F.from_json(text, "array<array<array<double>>>")))
        .when(kind == "MultiPolygon", _rings(F.flatten(F.from_json(text, "array<array<array<array<double>>>>"))))
        .otherwise(_unknown(kind))
    )
    return F.when(kind == "Point", F.get(point, 0)), F.when(kind == "Point", F.get(point, 1)), rings.cast(RINGS)


def wkt_geometry(text: Column) -> tuple[Column, Column, Column]:
    """The same from well-known text, as shapefiles are exported to CSV."""
    kind = F.upper(F.regexp_extract(text, r"^\s*([A-Za-z]+)", 1))
    lists = F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), F.lit(1))

    def corner(pair: Column) -> Column:
        return F.transform(F.slice(F.split(F.trim(pair), r"\s+"), 1, 2), lambda v: v.cast("double"))

    corners = F.transform(lists, lambda ring: F.transform(F.split(ring, ","), corner))
    rings = (
        F.when(text.isNull() | (kind == "POINT"), F.lit(None))
        .when(kind.isin("POLYGON", "MULTIPOLYGON"), _rings(corners))
        .otherwise(_unknown(kind))
    )
    return F.when(kind == "POINT", corners[0][0][0]), F.when(kind == "POINT", corners[0][0][1]), rings.cast(RINGS)


def load_layer(
    spark: SparkSession,
    path: str,
    x_col: str = "point_x",
    y_col: str = "point_y",
    srid: int = PLANAR_SRID,
    fmt: str = "parquet",
    schema: str | None = None,
    wkt_col: str | None = None,
) -> DataFrame:
    """A layer as rows with double columns ``x, y`` and a constant ``srid``; outlines have ``rings``.

    ``fmt`` is ``parquet``, ``csv`` or ``geojson``, the last with one feature per line so
    that files split.  Geometry comes from the columns ``x_col`` and ``y_col``, or with
    GeoJSON, or with text of ``wkt_col``, as points, polygons or multipolygons; other kinds
    are an error.  Rings hold outer boundaries and holes of all parts alike.
    """
    if fmt == "geojson":
        x, y, rings = geojson_geometry(F.col("geometry"))
        return spark.read.schema(GEOJSON).json(path).select(
            "properties", x.alias("x"), y.alias("y"), rings.alias("rings"), F.lit(srid).alias("srid")
        )
    if fmt == "csv":
        rows = read_csv(spark, path, schema)
    else:
        rows = spark.read.parquet(path)
    if wkt_col is not None:
        x, y, rings = wkt_geometry(F.col(wkt_col))
        return rows.withColumns({"x": x, "y": y, "rings": rings, "srid": F.lit(srid)})
    return rows.withColumns(
        {"x": F.col(x_col).cast("double"), "y": F.col(y_col).cast("double"), "srid": F.lit(srid)}
    )

