"""Writing tables out and reading them back."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hedonic.session import ensure_checkpoint_dir
from hedonic.sources.csv import ingest_csv_dir, ingest_open_data, list_csv
from hedonic.sources.layers import load_layer
from hedonic.sources.tables import load_snapshot, materialize, read_table, save_snapshot, write_table
from workload.common import VIEWS, cte, load, query, view

CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def scratch(spark) -> str:
    """A fresh folder next to the checkpoints, which every executor can reach."""
    return f"{ensure_checkpoint_dir(spark)}/roundtrip-{uuid.uuid4().hex}"


def fresh_db(spark) -> str:
    name = f"hedonic_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch(spark)}'")
    return name


def part_name(path: str) -> str:
    """Catalog-safe name of a part file."""
    return "t_" + "".join(ch if ch.isalnum() else "_" for ch in path.rsplit("/", 1)[-1].split(".")[0])


def same_schema(spark, where, schema) -> dict:
    return {part_name(p): schema for p in list_csv(spark, where)}


def together(spark, db, names) -> DataFrame:
    """The tables made from the part files, as one again."""
    return reduce(DataFrame.unionByName, [read_table(spark, f"{db}.{n}") for n in names])


@query("csv_round_trip", CUSTOMER_SQL)
def csv_round_trip(spark, sf):
    customer = load(spark, sf, "customer")
    where, db = scratch(spark), fresh_db(spark)
    noted = customer.withColumn("c_name", F.concat(F.lit('Café, "'), "c_name", F.lit('"')))
    writer = noted.repartition(3).write.option("header", True).option("escape", '"')
    writer.option("encoding", "ISO-8859-1").csv(where)
    names = ingest_csv_dir(spark, where, db, same_schema(spark, where, customer.schema), name_rule=part_name)
    return together(spark, db, names).withColumn("c_name", F.regexp_extract("c_name", '^Café, "(.*)"$', 1))


@query("csv_default_names", CUSTOMER_SQL)
def csv_default_names(spark, sf):
    """Files named like the extracts become tables by the default rule."""
    customer = load(spark, sf, "customer")
    where, db = scratch(spark), fresh_db(spark)
    customer.repartition(3).write.option("header", True).option("escape", '"').csv(where)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(where).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = list_csv(spark, where)
    for i, part in enumerate(parts):
        files.rename(path(part), path(f"{where}/EXTR_Customer{i}.csv"))
    expected = {f"Customer{i}": customer.schema for i in range(len(parts))}
    names = ingest_csv_dir(spark, where, db, expected)
    if set(names) != set(expected):
        raise ValueError(f"tables {names} do not follow the files' names")
    return together(spark, db, names)


VIEWS["landmarks"] = (
    "customer",
    (
        "c_name AS name",
        "concat('(47.', CAST(c_nationkey AS STRING), ', -122.', CAST(c_custkey % 1000 AS STRING), ')') AS Shape",
    ),
)


@query(
    "open_data_round_trip",
    cte("landmarks")
    + """
SELECT name, Shape, CAST(split_part(substr(Shape, 2, length(Shape) - 2), ', ', 1) AS DOUBLE) AS lat,
  CAST(split_part(substr(Shape, 2, length(Shape) - 2), ', ', 2) AS DOUBLE) AS long FROM landmarks
""",
)
def open_data(spark, sf):
    where, db = scratch(spark), fresh_db(spark)
    rows = view(spark, sf, "landmarks")
    rows.repartition(3).write.option("header", True).option("escape", '"').csv(where)
    schemas = same_schema(spark, where, "name string, Shape string")
    names = ingest_open_data(spark, where, db, schemas, part_name)
    ingest_open_data(spark, where, db, schemas, part_name)  # finds the tables and leaves them alone
    return together(spark, db, names)


@query("snapshot", "SELECT * FROM orders")
def snapshot(spark, sf):
    where = scratch(spark)
    save_snapshot(load(spark, sf, "orders"), where)
    return load_snapshot(spark, where)


@query("snapshot_partitioned", "SELECT *, CAST(year(o_orderdate) AS INT) AS sale_year FROM orders")
def snapshot_partitioned(spark, sf):
    where = scratch(spark)
    dated = load(spark, sf, "orders").withColumn("sale_year", F.year("o_orderdate"))
    save_snapshot(dated.repartition("sale_year"), where, ["sale_year"])
    return load_snapshot(spark, where)


@query("write_modes", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def write_modes(spark, sf):
    db, supplier = fresh_db(spark), load(spark, sf, "supplier")
    write_table(supplier, f"{db}.supplier")
    write_table(supplier.where("s_suppkey < 0"), f"{db}.supplier", "ignore")
    return read_table(spark, f"{db}.supplier")


@query("materialize", "SELECT n_nationkey, n_name FROM nation")
def rebuilt(spark, sf):
    db, nation = fresh_db(spark), load(spark, sf, "nation")
    materialize(nation.select("n_nationkey"), f"{db}.nation")
    return materialize(nation.select("n_nationkey", "n_name"), f"{db}.nation")


LAYER_SQL = cte("props") + "\nSELECT pin, x, y, CAST(2926 AS INT) AS srid FROM props"


@query("load_layer", LAYER_SQL)
def layer_csv(spark, sf):
    where = scratch(spark)
    view(spark, sf, "props").withColumnsRenamed({"x": "point_x", "y": "point_y"}).write.option("header", True).csv(where)
    schema = "pin string, point_x double, point_y double"
    return load_layer(spark, where, fmt="csv", schema=schema).select("pin", "x", "y", "srid")


# Frames of two squares around each customer's point, and a part beside them, as GeoJSON multipolygons.
CORNERS = ((-1, -1), (1, -1), (1, 1), (-1, 1))


def frame(x, y):
    """Rings of a square with a hole and of a smaller part to the right of it."""
    squares = ((x, 100.0), (x, 60.0), (x + 400.0, 50.0))
    return F.array(*[F.array(*[F.struct((cx + i * w).alias("x"), (y + j * w).alias("y")) for i, j in CORNERS]) for cx, w in squares])


@query(
    "load_layer_outline",
    cte("props")
    + """
SELECT pin, srid, CAST(ring AS INT) AS ring, CAST(corner AS INT) AS corner,
  x + CASE WHEN ring = 2 THEN 400 ELSE 0 END + CASE WHEN corner IN (0, 3) THEN -1 ELSE 1 END * [100, 60, 50][ring + 1] AS x,
  y + CASE WHEN corner < 2 THEN -1 ELSE 1 END * [100, 60, 50][ring + 1] AS y
FROM (SELECT pin, 2926 AS srid, x, y FROM props), range(3) AS r(ring), range(4) AS c(corner)
""",
)
def layer_outline(spark, sf):
    where = scratch(spark)
    rings = F.transform(frame(F.col("x"), F.col("y")), lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    # One part with a hole, one without.
    parts = F.array(F.slice(rings, 1, 2), F.slice(rings, 3, 1))
    geometry = F.struct(F.lit("MultiPolygon").alias("type"), parts.alias("coordinates")).alias("geometry")
    feature = F.struct(F.create_map(F.lit("pin"), "pin").alias("properties"), geometry)
    view(spark, sf, "props").select(F.to_json(feature).alias("value")).write.text(where)
    rows = load_layer(spark, where, fmt="geojson")
    rows = rows.select(F.col("properties")["pin"].alias("pin"), "srid", F.posexplode("rings").alias("ring", "corners"))
    return rows.select("pin", "srid", "ring", F.posexplode("corners").alias("corner", "p")).select("pin", "srid", "ring", "corner", "p.x", "p.y")


@query("load_layer_geojson", LAYER_SQL)
def layer_geojson(spark, sf):
    where = scratch(spark)
    feature = F.struct(
        F.create_map(F.lit("pin"), "pin").alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array("x", "y").alias("coordinates")).alias("geometry"),
    )
    view(spark, sf, "props").select(F.to_json(feature).alias("value")).write.text(where)
    return load_layer(spark, where, fmt="geojson").select(F.col("properties")["pin"].alias("pin"), "x", "y", "srid")
