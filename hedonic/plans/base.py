"""The residential base table and the complete property table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hedonic.operators.latest import latest_per_key
from hedonic.operators.layers import DEFAULT_LAYERS
from hedonic.operators.lookups import left_lookup_chain
from hedonic.operators.proximity import RADII, count_name
from hedonic.operators.skew import join_lookups

KEYS = ["Major", "Minor"]
RESIDENTIAL = "R"

# Output columns per source table; a pair renames.
PARCEL_COLUMNS = (
    "PropType", "Area", "DistrictName", ("SqFtLot", "ParcSqFtLot"), "CurrentZoning", "Topography",
    "StreetSurface", "InadequateParking", "PcntUnusable", "MtRainier", "Olympics", "Cascades",
    "SeattleSkyline", "PugetSound", "LakeWashington", "LakeSammamish", "LotDepthFactor",
    "TrafficNoise", "AirportNoise", "PowerLines", "HistoricSite", "SteepSlopeHazard", "WaterProblems",
)
BUILDING_COLUMNS = (
    "SqFtTotLiving", ("Stories", "no_stories"), ("BathFullCount", "bath_count"),
    ("Bedrooms", "bedroom_count"), ("YrBuilt", "year_built"), ("YrRenovated", "year_renovated"),
    ("HeatSystem", "heat_system"), ("BrickStone", "brick_stone"), ("SqFtUpperFloor", "sq_ft_upper_floor"),
)
SALE_COLUMNS = (("DocumentDate", "sale_date"), ("SalePrice", "sale_price"), ("SaleReason", "sale_reason"))
SALE_NAMES = tuple(b for _, b in SALE_COLUMNS)
APPRAISAL_COLUMNS = (("UpdateDate", "appr_date"), ("LandVal", "appr_land_val"), ("ImpsVal", "appr_imprv_val"))


def pairs_of(columns) -> list[tuple[str, str]]:
    return [c if isinstance(c, tuple) else (c, c) for c in columns]


def pick(df: DataFrame, keys: Sequence[str], columns) -> DataFrame:
    """Select ``keys`` and ``columns``, applying the renames."""
    return df.select(*keys, *[F.col(a).alias(b) for a, b in pairs_of(columns)])


def residential_base(parcel: DataFrame, building: DataFrame, sale: DataFrame, appraisal: DataFrame) -> DataFrame:
    """Residential parcels with their buildings, sales and latest appraisals: 41 columns.

    One row per combination of the four, as the tables hold them.
    """
    homes = pick(parcel.where(F.col("PropType") == RESIDENTIAL), KEYS, PARCEL_COLUMNS)
    newest = latest_per_key(appraisal.select(*KEYS, "UpdateDate", "LandVal", "ImpsVal"), KEYS, "UpdateDate")
    buildings = pick(building, KEYS, BUILDING_COLUMNS)
    values = pick(newest, KEYS, APPRAISAL_COLUMNS)
    # Sales are the long table; the others are looked up for them.
    joined = join_lookups(pick(sale, KEYS, SALE_COLUMNS), [homes, buildings, values], KEYS, "inner")
    total = F.col("appr_land_val").cast("long") + F.col("appr_imprv_val").cast("long")
    order = [*homes.columns, *buildings.columns[2:], *SALE_NAMES, *values.columns[2:]]
    return joined.select(*order, total.alias("appr_tot_val"))


# Column order of the complete table ahead of the counts.
COMPLETE_HEAD = ("sale_date", "sale_price", "sale_reason", "appr_land_val", "appr_imprv_val", "appr_tot_val", "appr_date")
COMPLETE_TAIL = ("major_str", "minor_str", "pin", "addr_full", "lat", "lon")


def complete(
    located: DataFrame,
    addresses: DataFrame,
    counts: DataFrame,
    layers: Sequence[str] = tuple(spec.name for spec in DEFAULT_LAYERS),
    radii: Sequence[float] = RADII,
) -> DataFrame:
    """The located base table with coordinates and all counts: 62 columns by default.

    ``addresses`` is joined on ``pin`` once more for ``lat`` and ``lon``, so a pin
    with several addresses repeats; ``counts`` has one row per pin.
    """
    lookups = [addresses.select("pin", "lat", "lon"), counts]
    wide = left_lookup_chain(located.drop("lat", "lon"), lookups)
    parcel = [b for _, b in pairs_of(PARCEL_COLUMNS)]
    building = [b for _, b in pairs_of(BUILDING_COLUMNS)]
    named = [count_name(layer, r) for layer in layers for r in radii]
    return wide.select(*KEYS, *parcel, *building, *COMPLETE_HEAD, *COMPLETE_TAIL, *named)
