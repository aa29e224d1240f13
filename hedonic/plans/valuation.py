"""The whole study: raw tables to fitted models."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.functions.keys import add_pin, clean_keys
from hedonic.functions.scalars import clean_dates
from hedonic.operators.forest import FOREST_SIZES, forest_sweep
from hedonic.operators.layers import DEFAULT_LAYERS, LayerSpec, stack_layers
from hedonic.operators.lookups import attach_location
from hedonic.operators.proximity import RADII, outline_counts, proximity_counts
from hedonic.operators.regress import best_of, coefficient_report, feature_columns, lasso_sweep, null_rmse, ridge_sweep
from hedonic.operators.scale import transform_target
from hedonic.operators.split import split
from hedonic.plans.base import KEYS, complete, residential_base
from hedonic.plans.features import build_features
from hedonic.sources.tables import materialize


@dataclass(frozen=True)
class Raw:
    """The input tables; ``layers`` by source name, ``addresses`` in planar feet, with ``rings`` where outlines are used."""

    parcel: DataFrame
    building: DataFrame
    sale: DataFrame
    appraisal: DataFrame
    addresses: DataFrame
    layers: Mapping[str, DataFrame]


def property_table(
    raw: Raw,
    database: str,
    specs: Iterable[LayerSpec] = DEFAULT_LAYERS,
    radii: Sequence[float] = RADII,
    mode: str = "rows",
    geometry: str = "point",
) -> DataFrame:
    """Base table, locations and proximity counts, with dates cut to days.

    Distances are taken from ``point_x, point_y``, or with ``geometry="outline"`` from the
    parcel outlines ``rings`` of the addresses.

    The base table and the located base table are each read several times, so
    they are saved in ``database`` and read back.
    """
    specs = tuple(specs)
    base = residential_base(raw.parcel, raw.building, clean_keys(raw.sale, KEYS), raw.appraisal)
    base = materialize(add_pin(base), f"{database}.residential")
    located = materialize(attach_location(base, raw.addresses), f"{database}.located_residential")
    pois = stack_layers(raw.layers.__getitem__, specs)
    names = [spec.name for spec in specs]
    counts = located_counts(located, pois, names, radii, mode, geometry)
    table = complete(located.drop("rings"), raw.addresses, counts, names, radii)
    return clean_dates(table, ["sale_date", "appr_date"])


def located_counts(
    located: DataFrame, pois: DataFrame, names: Sequence[str], radii: Sequence[float] = RADII, mode: str = "rows", geometry: str = "point"
) -> DataFrame:
    """Counts per pin of located rows, around their points or their outlines."""
    if geometry == "outline":
        return outline_counts(located.select("pin", "rings"), pois, names, radii, mode=mode)
    if geometry != "point":
        raise ValueError(f"geometry must be 'point' or 'outline', not {geometry!r}")
    props = located.select("pin", F.col("point_x").alias("x"), F.col("point_y").alias("y"))
    return proximity_counts(props, pois, names, radii, mode=mode)


@dataclass(frozen=True)
class Study:
    features: DataFrame
    ridge: DataFrame
    lasso: DataFrame
    forest: DataFrame | None
    best_ridge: DataFrame
    best_lasso: DataFrame
    coefficients: DataFrame
    picked: DataFrame
    baseline: DataFrame


def study(
    spark: SparkSession,
    raw: Raw,
    database: str,
    key: str = "pin",
    forest_sizes: Sequence[int] = FOREST_SIZES,
    forest_depth: int = 30,
) -> Study:
    """Run everything; intermediate tables are saved in ``database``."""
    table = materialize(property_table(raw, database), f"{database}.complete_residential")
    features = materialize(build_features(table), f"{database}.features")
    cols = [c for c in feature_columns(features) if c != key]
    train, test = split(features, key)
    ridge = ridge_sweep(train, test, cols)
    lasso = lasso_sweep(train, test, cols)
    picked, coefficients = coefficient_report(train, cols)
    forest = forest_sweep(features, cols, key, sizes=forest_sizes, max_depth=forest_depth) if forest_sizes else None
    baseline = null_rmse(transform_target(test, "sale_price"), "sale_price")
    return Study(
        features, ridge, lasso, forest, best_of(ridge), best_of(lasso), coefficients, picked, baseline
    )
