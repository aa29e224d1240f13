"""Point-of-interest layers described by configuration."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hedonic.functions.geo import GEOGRAPHIC_SRID, PLANAR_SRID, project_2926


@dataclass(frozen=True)
class LayerSpec:
    """Where a layer comes from and which columns hold its position."""

    source: str
    name: str
    lon: str = "long"
    lat: str = "lat"
    srid: int = GEOGRAPHIC_SRID


# The layers, their short names and coordinate columns.
DEFAULT_LAYERS = (
    LayerSpec("Landmarks", "landmarks"),
    LayerSpec("Light_Rail_Map", "light_rail", "Longitude", "Latitude"),
    LayerSpec("Parks_Map", "parks", "Longitude", "Latitude"),
    LayerSpec("Private_Schools", "priv_school"),
    LayerSpec("Public_Schools", "pub_school"),
)


def poi_layer(df: DataFrame, spec: LayerSpec, gid: str | None = None) -> DataFrame:
    """Standardise one layer to ``layer, long, lat, x, y`` in planar feet.

    A missing coordinate leaves ``x`` and ``y`` NULL, so the point matches
    nothing.  ``gid="null"`` adds an empty id column, ``gid="fill"`` a unique one.
    """
    lon, lat = F.col(spec.lon).cast("double"), F.col(spec.lat).cast("double")
    if spec.srid == GEOGRAPHIC_SRID:
        x, y = project_2926(lon, lat)
    elif spec.srid == PLANAR_SRID:
        x, y = lon, lat
    else:
        raise ValueError(f"unsupported SRID {spec.srid}")
    cols = [F.lit(spec.name).alias("layer"), lon.alias("long"), lat.alias("lat"), x.alias("x"), y.alias("y")]
    if gid == "null":
        cols.append(F.lit(None).cast("int").alias("gid"))
    elif gid == "fill":
        cols.append(F.monotonically_increasing_id().alias("gid"))
    return df.select(*cols)


def stack_layers(
    read: Callable[[str], DataFrame], specs: Iterable[LayerSpec] = DEFAULT_LAYERS
) -> DataFrame:
    """All layers of ``specs`` as one table; ``read`` maps a source name to its rows."""
    return reduce(DataFrame.unionByName, [poi_layer(read(s.source), s) for s in specs])
