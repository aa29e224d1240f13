"""From the complete property table to the feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hedonic.functions.predicates import sale_filters
from hedonic.functions.scalars import map_values, replace_where
from hedonic.operators.encode import (
    BEDROOM_EDGES, BEDROOM_LABELS, YEAR_EDGES, YEAR_LABELS, bin_column, categories, dummies, proximity_features,
)
from hedonic.operators.proximity import RADII, count_name
from hedonic.operators.scale import pca_features

# Feature group names by layer, and the view grades that are reduced.
PROXIMITY_GROUPS = {
    "landmark_prox": "landmarks",
    "light_rail_prox": "light_rail",
    "park_prox": "parks",
    "priv_schl_prox": "priv_school",
    "pub_schl_prox": "pub_school",
}
VIEW_GRADES = ["Olympics", "Cascades", "SeattleSkyline", "PugetSound", "LakeWashington", "LakeSammamish"]
YES_NO = {"Y": 1, "N": 0}
DEFAULT_RENOVATION = 2000

# Order of the feature table around its generated columns.
HOUSE = ["PowerLines", "HistoricSite", "no_stories", "bath_count", "bin_bedroom_count"]
YEARS_AND_SIZES = ["year_renovated", "year_built", "ParcSqFtLot", "SqFtTotLiving", "sq_ft_upper_floor"]
CLOSING = ["lat", "lon", "appr_tot_val", "appr_date", "sale_date", "sale_price"]


def add_bins(df: DataFrame) -> DataFrame:
    """Bin bedrooms and years, then read a renovation year of 0 as the usual one.

    The replacement follows the binning, so the bin of a 0 stays missing.
    """
    df = bin_column(df, "bedroom_count", BEDROOM_EDGES, BEDROOM_LABELS)
    df = bin_column(df, "year_built", YEAR_EDGES, YEAR_LABELS)
    df = bin_column(df, "year_renovated", YEAR_EDGES, YEAR_LABELS)
    return replace_where(df, "year_renovated", F.col("year_renovated") == 0, DEFAULT_RENOVATION)


def proximity_groups(radii: Sequence[float] = RADII) -> dict[str, list[str]]:
    return {g: [count_name(layer, r) for r in radii] for g, layer in PROXIMITY_GROUPS.items()}


def model_rows(df: DataFrame, good: str = "ratio") -> DataFrame:
    """Recent sales at a plausible price: the rows models are fitted on."""
    f = sale_filters(good=good)
    return df.where(f["recent"] & f["nonzero"] & f["good"] & f["under"])


def build_features(
    df: DataFrame,
    radii: Sequence[float] = RADII,
    good: str = "ratio",
    keep: Sequence[str] = ("pin",),
    levels: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Feature table over the model rows of the complete table.

    Every block is computed on the row it belongs to, so nothing is joined.
    District and street categories are learned from the model rows unless
    ``levels`` gives them under ``DistrictName`` and ``StreetSurface``.
    """
    rows = model_rows(add_bins(df), good)
    known = dict(levels or {})
    for col in ("DistrictName", "StreetSurface"):
        known.setdefault(col, categories(rows, col))
    out = dummies(rows, "DistrictName", "dist", values=known["DistrictName"])
    out = dummies(out, "StreetSurface", "str_surf", values=known["StreetSurface"])
    out = pca_features(out, VIEW_GRADES, 3, "View")
    out = map_values(out, "PowerLines", YES_NO)
    out = out.withColumn("bin_bedroom_count", F.col("bin_bedroom_count").cast("double"))
    groups = proximity_groups(radii)
    out = proximity_features(out, groups)
    return out.select(
        *keep,
        *[f"dist_{v}" for v in known["DistrictName"][1:]],
        "Topography",
        *[f"str_surf_{v}" for v in known["StreetSurface"][1:]],
        "View_1", "View_2", "View_3",
        *HOUSE, *YEARS_AND_SIZES,
        *[f"{g}_{i}" for g in groups for i in (1, 2)],
        *CLOSING,
    )
