"""Files, tables and snapshots."""

import pytest
from pyspark.sql import functions as F

from hedonic.sources.csv import ingest_csv_dir, ingest_open_data, table_name
from hedonic.sources.layers import load_layer
from hedonic.sources.tables import load_snapshot, materialize, read_table, save_snapshot, write_table
from tests.conftest import rows


@pytest.mark.parametrize("path, name", [("/d/EXTR_Parcel.csv", "Parcel"), ("s3a://b/RPSale.csv", "RPSale"), ("a.b.csv", "a.b")])
def test_table_name(path, name):
    assert table_name(path) == name


def test_latin1_quotes_and_schema(spark, db, tmp_path):
    folder = tmp_path / "data"
    folder.mkdir()
    (folder / "EXTR_Parcel.csv").write_bytes('Major,Minor,Name\n"000123","  ","Caf\xe9, ""x"""\n'.encode("latin1"))
    (folder / "notes.txt").write_text("not a table")
    names = ingest_csv_dir(spark, str(folder), db, {"Parcel": "Major string, Minor string, Name string"})
    assert names == ["Parcel"]
    assert rows(read_table(spark, f"{db}.Parcel")) == [("000123", "  ", 'Café, "x"')]
    with pytest.raises(Exception, match="already exists"):
        ingest_csv_dir(spark, str(folder), db)


def test_open_data_keeps_all_rows_and_skips_existing(spark, db, tmp_path):
    folder = tmp_path / "open data"
    folder.mkdir()
    lines = "".join(f'n{i},"(47.{i}, -122.5)"\n' for i in range(20))
    (folder / "Landmarks.csv").write_text("Name,Shape\n" + lines)
    (folder / "Parks_Map.csv").write_text("Longitude,Latitude\n-122.1,47.1\n")
    assert ingest_open_data(spark, str(folder), db) == ["Landmarks", "Parks_Map"]
    (folder / "Landmarks.csv").write_text("Name,Shape\n")
    ingest_open_data(spark, str(folder), db)
    table = read_table(spark, f"{db}.Landmarks")
    assert table.count() == 20 and table.where("Name = 'n3'").head().lat == 47.3
    assert rows(read_table(spark, f"{db}.Parks_Map")) == [(-122.1, 47.1)]


def test_write_modes(spark, db):
    one = spark.range(1)
    write_table(one, f"{db}.t")
    write_table(spark.range(5), f"{db}.t", "ignore")
    assert read_table(spark, f"{db}.t").count() == 1
    assert materialize(spark.range(5), f"{db}.t").count() == 5


def test_snapshot_prunes_partitions(spark, tmp_path):
    df = spark.range(10).withColumn("year", F.col("id") % 2)
    save_snapshot(df, str(tmp_path / "snap"), ["year"])
    back = load_snapshot(spark, str(tmp_path / "snap"))
    assert back.count() == 10
    plan = back.where("year = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_layer_formats(spark, tmp_path):
    (tmp_path / "l.csv").write_text("name,point_x,point_y\na,1.5,2.5\nb,,3\n")
    got = load_layer(spark, str(tmp_path / "l.csv"), fmt="csv", schema="name string, point_x double, point_y double")
    assert rows(got.select("name", "x", "y", "srid")) == [("a", 1.5, 2.5, 2926), ("b", None, 3.0, 2926)]
    feature = '{"type":"Feature","properties":{"pin":"7"},"geometry":{"type":"Point","coordinates":[1.0,2.0]}}\n'
    (tmp_path / "l.geojson").write_text(feature)
    got = load_layer(spark, str(tmp_path / "l.geojson"), fmt="geojson", srid=4326).head()
    assert (got.properties["pin"], got.x, got.y, got.srid) == ("7", 1.0, 2.0, 4326)


def test_polygons_and_unknown_geometry(spark, tmp_path):
    square = "[[0, 0], [2, 0], [2, 2.5], [0, 0]]"
    shapes = {
        "a": f'{{"type": "Polygon", "coordinates": [{square}, [[1, 1], [1.5, 1], [1, 1]]]}}', "b": "null",
        "c": f'{{"type": "MultiPolygon", "coordinates": [[{square}], [{square}, {square}]]}}', "d": '{"type": "Point", "coordinates": [3, 4]}',
    }
    lines = [f'{{"type": "Feature", "properties": {{"pin": "{k}"}}, "geometry": {v}}}' for k, v in shapes.items()]
    (tmp_path / "p.geojson").write_text("\n".join(lines))
    got = {r.properties["pin"]: r for r in load_layer(spark, str(tmp_path / "p.geojson"), fmt="geojson").collect()}
    assert [len(r) for r in got["a"].rings] == [4, 3] and tuple(got["a"].rings[0][2]) == (2.0, 2.5) and got["a"].x is None
    assert len(got["c"].rings) == 3 and got["b"].rings is None and got["b"].x is None and (got["d"].x, got["d"].y, got["d"].rings) == (3.0, 4.0, None)
    (tmp_path / "w.csv").write_text('pin;shape\na;"POLYGON ((0 0, 2 0, 2 2.5, 0 0),(1 1, 1.5 1, 1 1))"\nc;"MULTIPOLYGON (((0 0, 1 0, 1 1)), ((5 5, 6 5, 6 6)))"\nd;POINT (3 4)\nn;\n'.replace(";", "|"))
    text = spark.read.option("header", True).option("sep", "|").csv(str(tmp_path / "w.csv"))
    text.write.parquet(str(tmp_path / "w"))
    rows = {r.pin: r for r in load_layer(spark, str(tmp_path / "w"), wkt_col="shape").collect()}
    assert rows["a"].rings == got["a"].rings and len(rows["c"].rings) == 2 and (rows["d"].x, rows["d"].y) == (3.0, 4.0) and rows["n"].rings is None
    for kind in ("LineString", "GeometryCollection"):
        (tmp_path / "u.geojson").write_text(f'{{"properties": {{}}, "geometry": {{"type": "{kind}", "coordinates": [[1, 2], [3, 4]]}}}}')
        with pytest.raises(Exception, match="unsupported geometry"):
            load_layer(spark, str(tmp_path / "u.geojson"), fmt="geojson").collect()


def test_quoted_line_breaks(spark, tmp_path):
    from hedonic.sources.csv import read_csv

    (tmp_path / "notes.csv").write_text('id,note,n\n1,"two\nlines, ""quoted""",5\n2,plain,6\n')
    got = read_csv(spark, str(tmp_path / "notes.csv"), "id int, note string, n int", line_breaks=True)
    assert sorted(map(tuple, got.collect())) == [(1, 'two\nlines, "quoted"', 5), (2, "plain", 6)]
