"""Uniform shuffles of exact sizes."""

import numpy as np
from pyspark.sql import functions as F

from hedonic.llm.sharding import communication_matrix, hypergeometric, op1_sharding, shuffle_into_shards
from tests.llm.conftest import SF_DIR


def test_draws_follow_the_hypergeometric_law(spark):
    rng = np.random.default_rng(1)
    for good, total, drawn in ((10, 100, 30), (3, 7, 4), (60, 200, 100)):
        draw = hypergeometric(F.lit(good), F.lit(total), F.lit(drawn), F.col("u"))
        got = np.array([r[0] for r in spark.range(4000).select(F.rand(5).alias("u")).select(draw).collect()])
        true = rng.hypergeometric(good, total - good, drawn, 200_000)
        width = max(got.max(), true.max()) + 1
        seen, law = np.bincount(got, minlength=width) / len(got), np.bincount(true, minlength=width) / len(true)
        assert np.abs(seen - law).max() < 0.03


def test_certain_draws(spark):
    row = spark.range(1).select(*[
        hypergeometric(F.lit(a), F.lit(b), F.lit(c), F.lit(0.5)).alias(f"c{i}")
        for i, (a, b, c) in enumerate([(0, 5, 3), (5, 5, 3), (4, 9, 9), (4, 9, 0), (0, 0, 0)])
    ]).first()
    assert list(row) == [0, 3, 4, 0, 0]


def test_matrix_has_exact_margins(spark):
    sizes = [0, 1, 17, 40, 5, 5, 88]
    blocks = spark.createDataFrame(list(enumerate(sizes)), "block long, n long")
    rows = communication_matrix(blocks, 5, seed=3).orderBy("block").collect()
    matrix = np.array([r.sent for r in rows])
    assert matrix.min() >= 0 and matrix.sum(axis=1).tolist() == sizes
    assert sorted(matrix.sum(axis=0).tolist()) == [31, 31, 31, 31, 32]


def test_shards_are_exact_gapless_and_mixed(spark):
    df = spark.range(1000, numPartitions=7)
    out = shuffle_into_shards(df, 6, seed=1, bucket_rows=40).toPandas()
    assert sorted(out["id"]) == list(range(1000))
    for _, part in out.groupby("shard"):
        assert len(part) in (166, 167) and sorted(part["slot"]) == list(range(len(part)))
        assert abs(np.corrcoef(part["slot"], part["id"])[0, 1]) < 0.35
    assert abs(np.corrcoef(out["shard"], out["id"])[0, 1]) < 0.15


def test_odd_rows_and_empty_table(odd, none):
    docs = odd.drop("shard", "slot")
    out = shuffle_into_shards(docs, 4)
    assert out.columns == [*docs.columns, "shard", "slot"]
    assert out.count() == docs.count()
    assert shuffle_into_shards(none.drop("shard", "slot"), 4).count() == 0


def test_query(spark, tables):
    out = op1_sharding(spark, SF_DIR).toPandas().set_index("doc_id").sort_index()
    docs = tables("documents").select("doc_id", F.octet_length("text").alias("b"), F.crc32(F.col("text").cast("binary")).alias("c")).toPandas()
    docs = docs.set_index("doc_id").sort_index()
    assert (out["size"] == docs["b"] + 8).all() and (out["text_crc32"] == docs["c"]).all()
    assert set(out["shard"]) == set(range(24)) and out.groupby("shard").size().max() - out.groupby("shard").size().min() <= 1


def test_plan_runs_no_python(spark):
    plan = op1_sharding(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
