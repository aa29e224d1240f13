"""Cost-balanced packing of documents into training sequences of bounded length.

The cost of a sequence is estimated as ``linear * tokens + quadratic * sum(piece ** 2)``:
the feed-forward part grows with all tokens, attention only inside each piece.  Documents,
longest first, go to the cheapest sequence that still has room.  The number of sequences
is the smallest that can hold all tokens, so that padding stays below one sequence per
group; a piece for which no sequence has room is cut and fills the room that is left.

Documents are dealt by a hash into groups of about ``GROUP_DOCS``, packed independently: a
group is the unit of work and of retry, its size does not depend on the corpus, and a
source or a family of copies spreads over all groups.  Every id lies in exactly one piece.

Missing text counts as empty: such a document is one piece, its end id.  Repeated rows and
rows without an id are packed like any others.  An empty table gives no rows.  Only the two
named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hedonic.llm.common import query, table, tasks_for
from hedonic.llm.tokens import encoder, word_bpe_path

CAPACITY = 2048
#: Documents packed together.
GROUP_DOCS = 2048
LINEAR, QUADRATIC = 1.0, 1.0 / CAPACITY

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_tokens long, sequence_cost double, ids binary"
)


def pack_group(
    lengths: np.ndarray, capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC
) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of one group of document lengths."""
    bins = -(-int(lengths.sum()) // capacity)
    used = np.zeros(bins, dtype=np.int64)
    square = np.zeros(bins)
    out: list[tuple[int, int, int, int, int]] = []

    def put(doc: int, start: int, length: int, to: int) -> None:
        out.append((doc, start, length, to, int(used[to])))
        used[to] += length
        square[to] += float(length) ** 2

    # Whole sequences first: an empty sequence is the cheapest there is.
    rest, taken = [], 0
    for doc, n in enumerate(lengths.tolist()):
        for start in range(0, n - n % capacity, capacity):
            put(doc, start, capacity, taken)
            taken += 1
        if n % capacity:
            rest.append((-(n % capacity), doc, n - n % capacity))
    heapq.heapify(rest)
    while rest:
        length, doc, start = heapq.heappop(rest)
        length = -length
        free = capacity - used[taken:]
        cost = np.where(free >= length, linear * used[taken:] + quadratic * square[taken:], np.inf)
        to = int(cost.argmin())
        if np.isfinite(cost[to]):
            put(doc, start, length, taken + to)
        else:  # cut: fill the widest gap, and go on with what is left
            to = int(free.argmax())
            part = int(free[to])
            put(doc, start, part, taken + to)
            heapq.heappush(rest, (part - length, doc, start + part))
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    capacity: int = CAPACITY,
    group_docs: int = GROUP_DOCS,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents with their place in a sequence, :data:`PIECES`.

    One shuffle moves the ids, tokenized before it, to their groups.  ``with_ids=False``
    leaves the column ``ids`` null.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    groups = tasks_for(rows.count(), group_docs)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(tokenizer)
        end = np.array([end_id], dtype=of.dtype).tobytes()
        for batch in batches:
            ids = [of(t) + end for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), batch.column("pack_group")],
                names=["doc_id", "ids", "pack_group"],
            )

    # Equal rows draw different numbers, so that no family of copies stays together.
    group = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(groups)).cast("int")
    dealt = rows.withColumn("pack_group", group).mapInArrow(encode, "doc_id long, ids binary, pack_group int")

    def pack_all(key: tuple, got: pa.Table) -> pa.Table:
        of = encoder(tokenizer)
        ids = [np.frombuffer(x, dtype=of.dtype) for x in got.column("ids").to_pylist()]
        names = got.column("doc_id").to_pylist()
        lengths = np.array([len(x) for x in ids], dtype=np.int64)
        pieces = pack_group(lengths, capacity, linear, quadratic)
        tokens: dict[int, int] = {}
        cost: dict[int, float] = {}
        for _, _, n, to, _ in pieces:
            tokens[to] = tokens.get(to, 0) + n
            cost[to] = cost.get(to, 0.0) + linear * n + quadratic * n * n
        first = key[0].as_py() << 32
        wide = [ids[d][s : s + n].astype("<u4").tobytes() for d, s, n, _, _ in pieces]
        return pa.table({
            "doc_id": pa.array([names[d] for d, *_ in pieces], pa.int64()),
            "start": pa.array([s for _, s, *_ in pieces], pa.int64()),
            "length": pa.array([n for _, _, n, *_ in pieces], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(x) for x in wide], pa.int64()),
            "doc_tokens": pa.array([len(ids[d]) for d, *_ in pieces], pa.int64()),
            "sequence_id": pa.array([first + to for *_, to, _ in pieces], pa.int64()),
            "offset": pa.array([at for *_, at in pieces], pa.int64()),
            "sequence_tokens": pa.array([tokens[to] for *_, to, _ in pieces], pa.int64()),
            "sequence_cost": pa.array([cost[to] for *_, to, _ in pieces], pa.float64()),
            "ids": pa.array(wide if with_ids else [None] * len(wide), pa.binary()),
        })

    return dealt.groupBy("pack_group").applyInArrow(pack_all, PIECES)


@query("op10_packing")
def op10_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), word_bpe_path(), with_ids=False).drop("ids")
