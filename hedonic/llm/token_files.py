"""Token-id files: ids of a whole collection, Huffman coded in independent blocks.

A collection is written in ascending document order as a folder of two parquet tables:

* ``lengths`` (id, length): the canonical code, fitted to the counts of all ids;
* ``blocks`` (part, block, before, n_tokens, doc_ids, doc_tokens, payload): a block holds
  whole documents, about ``BLOCK_TOKENS`` ids; ``payload`` is described in
  :mod:`hedonic.llm.huffman`.  ``before`` counts the ids of the part ahead of the block.
  Parts follow each other in document order; each is written by one task, so a lost
  executor costs the parts it was writing.

Ids are tokenized once and kept in a settled table, from which the counts are taken and
which is then dealt out by document id.  Only the counts of the vocabulary's ids (not of
documents) come to the driver.

Missing text counts as empty: such a document holds its end id only.  Rows without an id
come first; rows with the same id follow each other in any order.  An empty table gives a
readable collection without rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.llm.common import query, running_before, table, tasks_for
from hedonic.llm.huffman import LIMIT, STEP, Coder, code_lengths
from hedonic.llm.tokens import encoder, word_bpe_path
from hedonic.session import ensure_checkpoint_dir, release, settle

BLOCK_TOKENS = 1 << 17
PART_TOKENS = 1 << 22

BLOCKS = (
    "part int, block int, before long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, payload binary"
)


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, n``: ids as little-endian bytes in the encoder's type, the end id included."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(tokenizer)
        end = np.array([end_id], dtype=of.dtype).tobytes()
        for batch in batches:
            ids = [of(t) + end for t in batch.column("text").to_pylist()]
            sizes = pa.array([len(x) // of.dtype.itemsize for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), sizes], names=["doc_id", "ids", "n"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(encode, "doc_id long, ids binary, n long")


def count_ids(tokenized: DataFrame, tokenizer: str) -> np.ndarray:
    """How often each id of the vocabulary occurs in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = encoder(tokenizer), np.zeros(0, dtype=np.int64)
        for batch in batches:
            joined = np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype=of.dtype)
            got = np.bincount(joined, minlength=len(total))
            got[: len(total)] += total
            total = got
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    rows = tokenized.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r.id for r in rows), default=-1) + 1, dtype=np.int64)
    for r in rows:
        counts[r.id] = r.n
    return counts


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    step: int = STEP,
    block_tokens: int = BLOCK_TOKENS,
    part_tokens: int = PART_TOKENS,
) -> None:
    """Encode every whole text and write the collection to ``path``."""
    spark = docs.sparkSession
    tokenized = settle(tokenize(docs, tokenizer, end_id, id_col, text_col))
    counts = count_ids(tokenized, tokenizer)
    lengths = code_lengths(counts, limit)
    used = np.flatnonzero(lengths).tolist()
    spark.createDataFrame([(i, int(lengths[i])) for i in used], "id long, length int").coalesce(1).write.parquet(f"{path}/lengths")
    shipped = spark.sparkContext.broadcast(lengths)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, coder = encoder(tokenizer), Coder(shipped.value, limit)
        part, block, before, held = TaskContext.get().partitionId(), 0, 0, 0
        names, ids = [], []

        def full() -> pa.RecordBatch:
            joined = np.frombuffer(b"".join(ids), dtype=of.dtype)
            sizes = [len(x) // of.dtype.itemsize for x in ids]
            columns = [[part], [block], [before], [len(joined)], [names], [sizes], [coder.encode(joined, step)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            fields = ["part", "block", "before", "n_tokens", "doc_ids", "doc_tokens", "payload"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=fields)

        for batch in batches:
            for name, x in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                names.append(name)
                ids.append(x)
                held += len(x) // of.dtype.itemsize
                if held >= block_tokens:
                    yield full()
                    block, before, held, names, ids = block + 1, before + held, 0, [], []
        if ids:
            yield full()

    parts = tasks_for(int(counts.sum()), part_tokens)
    ordered = tokenized.select("doc_id", "ids").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(encode, BLOCKS).write.parquet(f"{path}/blocks")
    release(tokenized)


def read_blocks(spark: SparkSession, path: str) -> tuple[DataFrame, np.ndarray]:
    """The blocks of a collection and its code lengths."""
    rows = spark.read.parquet(f"{path}/lengths").collect()
    lengths = np.zeros(max((r.id for r in rows), default=-1) + 1, dtype=np.uint8)
    for r in rows:
        lengths[r.id] = r.length
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks"), lengths


def read_tokens(spark: SparkSession, path: str, *, limit: int = LIMIT, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids`` of every document of a collection.

    ``start`` counts the ids of all documents before it.  ``ids`` are little-endian
    unsigned 32-bit numbers, or null without ``with_ids``.
    """
    blocks, lengths = read_blocks(spark, path)
    shipped = spark.sparkContext.broadcast(lengths)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shipped.value, limit)
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["doc_tokens"], dtype=np.int64)
                ends = np.cumsum(sizes)
                raw = coder.decode(row["payload"]).astype("<u4").tobytes()
                each = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(each), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["before"] + ends - sizes, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([zlib.crc32(x) for x in each], pa.int64()),
                        pa.array(each if with_ids else [None] * len(each), pa.binary()),
                    ],
                    names=["part", "doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    decoded = blocks.mapInArrow(decode, "part int, doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
    # An outer join: a part without any block has no rows to lose, and no row may go.
    ahead = running_before(blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")), "part", "n", "ahead")
    start = (F.col("start") + F.col("ahead")).alias("start")
    return decoded.join(ahead, "part", "left").select("doc_id", start, "n_tokens", "ids_crc32", "ids")


@query("op2_token_files")
def op2_token_files(spark, sf_dir):
    """All documents written as a token collection and read back."""
    path = f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), path, word_bpe_path())
    return read_tokens(spark, path, with_ids=False).drop("ids")
