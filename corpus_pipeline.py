"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the columns
of ``documents`` (where a stage changes a text, ``n_chars`` follows).

1. ``language``: documents that language identification rejects go, those without letters
   above all.  Labels of the stage's own input are learned from, but for the held-out third.
2. ``line_dedup``: of lines that are alike one stays; a document without any line left goes.
3. ``ngram_jaccard``: of documents that are near copies, through any chain of links, the
   one with the smallest id stays.
4. ``decontamination``: documents that hold a benchmark item's question and answer go.
5. ``packing``: what is left, cut into pieces and packed into sequences of 2048 tokens.

Rows without an id or a text pass as their operators say: missing texts are rejected by
the first stage, ids are only compared where there is one.  No stage collects documents,
links or ids; ids that are to go meet the documents behind a sieve of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.llm.common import rows_without, table
from hedonic.llm.decontaminate import contamination
from hedonic.llm.language import held_out, identify, train
from hedonic.llm.line_dedup import dedup_lines
from hedonic.llm.ngram_join import ngram_components
from hedonic.llm.packing import pack
from hedonic.llm.tokens import word_bpe_path
from hedonic.session import settle, tune

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    judged = identify(docs, train(docs.where(~held_out())), prefix="_language_")
    return judged.where(~F.col("_language_rejected")).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    found = ngram_components(docs.select("doc_id", "text"))
    return rows_without(docs, settle(found.where("component_id != doc_id").select("doc_id").distinct()), "doc_id")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    found = contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return rows_without(docs, settle(found.select("doc_id").distinct()), "doc_id")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return pack(docs.select("doc_id", "text"), word_bpe_path())


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL states none of the learned, hashed or packed stages; the tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all sequences made from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return settle(STAGES[-1][1](spark, docs, sf_dir))
