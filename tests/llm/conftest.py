import pytest

SF_DIR = "/root/testdata/sf0.001"
LONG = "word " * 30_000

# Nulls, empty and very long texts, repeated rows, ties, and columns whose names the operators use inside.
ODD = [
    (1, "Some plain words that make a short line of text.", "en"), (2, None, "en"), (3, "", None), (4, LONG, "fr"),
    (None, "A row without an id, but with enough words to be seen.", "de"), (6, "12 34 !!", None),
    (7, "Repeated row with enough words in it.", "en"), (7, "Repeated row with enough words in it.", "en"),
    (8, "Repeated row with enough words in it.", "en"), (9, "\n\n  \n", "en"),
]
CLASHING = ("key", "at", "line", "shard", "slot", "node", "label", "_range", "next", "words", "ids", "n", "part", "start",
            "_bucket", "_gone", "_id", "_doc", "_mark", "_judged", "mark", "head", "first", "gone", "row", "folded")


@pytest.fixture(scope="session")
def tables(spark):
    """The driver's smallest tables by name."""
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string")
    docs = docs.withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    return docs.withColumns({c: F.lit("clash") for c in CLASHING})


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
