"""Planar geometry as column arithmetic."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

GEOGRAPHIC_SRID = 4326
PLANAR_SRID = 2926

# EPSG:2926, Lambert conformal conic with two standard parallels
# on GRS80, in US survey feet (public registry).
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257222101
PARALLEL_1 = 48 + 44 / 60
PARALLEL_2 = 47 + 30 / 60
ORIGIN_LAT = 47.0
ORIGIN_LON = -(120 + 50 / 60)
FALSE_EASTING = 500000.0001016001
FOOT = 0.3048006096012192


def _cone() -> tuple[float, float, float, float]:
    """Eccentricity, cone constant, scaled radius and origin radius."""
    f = 1 / INVERSE_FLATTENING
    e = math.sqrt(2 * f - f * f)

    def m(lat: float) -> float:
        return math.cos(lat) / math.sqrt(1 - (e * math.sin(lat)) ** 2)

    def t(lat: float) -> float:
        s = e * math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (e / 2)

    p1, p2, p0 = (math.radians(d) for d in (PARALLEL_1, PARALLEL_2, ORIGIN_LAT))
    n = math.log(m(p1) / m(p2)) / math.log(t(p1) / t(p2))
    scaled = SEMI_MAJOR * m(p1) / (n * t(p1) ** n)
    return e, n, scaled, scaled * t(p0) ** n


def project_2926(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Longitude and latitude in degrees to state-plane ``(x, y)`` in feet."""
    e, n, scaled, origin = _cone()
    phi = F.radians(lat)
    s = F.sin(phi) * e
    t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(e / 2))
    rho = F.pow(t, F.lit(n)) * scaled
    theta = F.radians(lon - ORIGIN_LON) * n
    x = (rho * F.sin(theta) + FALSE_EASTING) / FOOT
    y = (origin - rho * F.cos(theta)) / FOOT
    return x, y


def sector(quad_segs: int) -> float:
    """Angle of one side of a buffer drawn with ``quad_segs`` sides per quarter."""
    return math.pi / (2 * quad_segs)


def buffer_metric(dx: Column, dy: Column, quad_segs: int | None = None) -> tuple[Column, Callable[[float], float]]:
    """A measure of an offset, and the bound it has to meet inside the buffer of a radius.

    With ``quad_segs`` the buffer is the polygon inscribed in the circle (eight
    sides per quarter is the usual GIS default) rather than the circle itself.
    """
    d2 = dx * dx + dy * dy
    if quad_segs is None:
        return d2, lambda r: float(r) * float(r)
    step = sector(quad_segs)
    phi = F.pmod(F.atan2(dy, dx), F.lit(step)) - step / 2
    return F.sqrt(d2) * F.cos(phi), lambda r: r * math.cos(step / 2)


def within(dx: Column, dy: Column, radius: float, quad_segs: int | None = None) -> Column:
    """Is the offset inside the buffer of ``radius``, boundary included?"""
    metric, bound = buffer_metric(dx, dy, quad_segs)
    return metric <= bound(radius)


def ring_sides(ring: Column) -> Column:
    """Sides ``array<struct<ax,ay,bx,by>>`` of an outline given as ``array<struct<x,y>>``.

    The outline may repeat its first corner at the end or not.
    """
    after = F.concat(F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(
        ring,
        after,
        lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")),
    )


def side_distance(x: Column, y: Column, side: Column) -> Column:
    """Distance from a point to one side."""
    ux, uy = side["bx"] - side["ax"], side["by"] - side["ay"]
    px, py = x - side["ax"], y - side["ay"]
    length2 = ux * ux + uy * uy
    along = F.when(length2 > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (px * ux + py * uy) / length2)))
    along = F.coalesce(along, F.lit(0.0))
    return F.hypot(px - along * ux, py - along * uy)


def sides_distance(x: Column, y: Column, sides: Column) -> Column:
    """Distance from a point to an outline of one ring, 0 inside it, as an expression of one row.

    :func:`hedonic.operators.proximity.outline_counts` measures many points and any number of rings.
    """
    nearest = F.array_min(F.transform(sides, lambda s: side_distance(x, y, s)))

    def crosses(s: Column) -> Column:
        straddles = (s["ay"] > y) != (s["by"] > y)
        at = F.when(straddles, s["ax"] + (y - s["ay"]) * (s["bx"] - s["ax"]) / (s["by"] - s["ay"]))
        return straddles & (x < at)

    inside = F.size(F.filter(sides, crosses)) % 2 == 1
    return F.when(inside, F.lit(0.0)).otherwise(nearest)


def ring_distance(x: Column, y: Column, ring: Column) -> Column:
    """Distance from a point to the outline ``ring``, 0 inside it."""
    return sides_distance(x, y, ring_sides(ring))
