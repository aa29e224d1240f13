"""The study end to end, from assessor-shaped tables to fitted models."""

import pytest
from pyspark.sql import functions as F

from hedonic.operators.regress import feature_columns
from hedonic.plans.features import build_features, model_rows
from hedonic.plans.valuation import Raw, property_table, study
from workload.common import view
from workload.joins import ASSESSOR
from workload.spatial import LAYERS
from workload.study import SPECS

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def raw(spark):
    tables = {name: view(spark, SF_DIR, name) for name in ASSESSOR}
    tables["parcel"] = tables["parcel"].withColumn("PowerLines", F.coalesce("PowerLines", F.lit("N")))
    # Sale keys arrive as padded text, some of them blank.
    keys = {"Major": F.expr("concat(' ', Major, '  ')"), "Minor": F.expr("if(SaleReason = 19, ' ', string(Minor))")}
    tables["sale"] = tables["sale"].withColumns(keys)
    pois = view(spark, SF_DIR, "pois")
    return Raw(
        **tables,
        addresses=view(spark, SF_DIR, "addresses"),
        layers={name: pois.where(F.col("layer") == name) for name in LAYERS},
    )


def test_property_table(spark, db, raw):
    table = property_table(raw, db, SPECS)
    assert len(table.columns) == 62
    assert dict(table.dtypes)["sale_date"] == "timestamp_ntz"
    assert table.count() > 0 and table.where("PropType <> 'R' OR sale_reason = 19").isEmpty()


def test_features_hold_no_leaks_and_no_gaps(spark, db, raw):
    table = property_table(raw, db, SPECS)
    features = build_features(table)
    assert features.count() == model_rows(table).count() > 0
    cols = feature_columns(features)
    assert "sale_price" not in cols and "View_3" in cols and "park_prox_2" in cols
    missing = features.select([F.count_if(F.col(c).isNull()).alias(c) for c in cols if c != "bin_bedroom_count"]).head()
    assert set(missing) == {0}


def test_study(spark, db, raw, monkeypatch):
    import hedonic.plans.valuation as valuation

    real = valuation.property_table
    monkeypatch.setattr(valuation, "property_table", lambda raw, database: real(raw, database, SPECS))
    done = study(spark, raw, db, forest_sizes=(2,), forest_depth=3)
    assert done.ridge.count() == 16 and done.lasso.count() == 6
    assert done.best_ridge.head().rmse > 0 and done.baseline.head().rmse > 0
    assert done.forest.head().rmse > 0
    assert done.coefficients.count() == 26
    assert spark.table(f"{db}.features").count() == done.features.count()
