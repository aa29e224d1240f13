"""Byte-level BPE by monoid tree reduction: halves are encoded apart and joined at their seam.

A rank file's pattern splits a text into matches, and each match is merged on its own, the
pair of lowest rank first.  Neither step can be cut anywhere, so an encoded stretch is an
element that knows its matches and their ids, and two neighbours are joined in two layers:

* *Matches.*  A split goes from left to right and looks at most ``LOOKAHEAD`` characters past
  a match.  So of the left element every match that ends that far before the seam is final;
  the others are split again together with the first matches of the right one.  Where the
  new split and the right element's have a border in common, all that follows is final as
  well.  As long as they have none, the window takes twice as many matches.
* *Ids inside a match.*  Ids are the encoding of their bytes if and only if each two
  neighbours are what their joint bytes are encoded to: the first merge across a border
  would also happen between these two alone.  So the last ids of the left and the first
  of the right half are merged anew, with more of them on a side until its border holds.

Texts are halved down to ``LEAF`` characters, matches to ``LEAF`` bytes; a text over ``PIECE``
characters is first cut into pieces, which other tasks encode and its own group joins by the
same rule.  Decoding concatenates the ids' bytes up the same kind of tree.

A missing text counts as empty; empty texts have no ids.  Rows that repeat an id, or have
none, stay rows of their own.  An empty table gives no rows.  Only the two named columns are
read.  Surrogates, which UTF-8 does not have, cannot stand in a Spark string.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hedonic.llm.common import query, table

#: Characters of a text, and bytes of a match, that are encoded without being halved.
LEAF = 512
#: Characters of a text that one task encodes by itself.
PIECE = 1 << 18
#: How far past the end of a match the pattern may look (the two letters of a contraction).
LOOKAHEAD = 2
#: Matches kept per worker process, and the longest that is kept.  A full cache is emptied.
CACHED, CACHED_CHARS = 500_000, 64
DECODED = 4096


def _splitter(source: str):
    """``findall`` of a pattern whose classes are ``\\p{L}``, ``\\p{N}``, ``\\s`` and, outside sets, ``\\S``.

    What a letter is depends on a Unicode version, so the library itself is asked for the
    members of each class, which then stand in the pattern as ranges.  Texts of a smaller
    character set take a pattern with fewer of them.
    """
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}

    def members(name: str) -> list[list[int]]:
        probe = tiktoken.Encoding("probe", pat_str=f"{name}+", mergeable_ranks=single, special_tokens={})
        found: list[list[int]] = []
        for c in map(ord, probe.decode_bytes(probe.encode_ordinary(every)).decode()):
            if found and found[-1][1] == c - 1:
                found[-1][1] = c
            else:
                found.append([c, c])
        return found

    known = {name: members(name) for name in (r"\p{L}", r"\p{N}", r"\s")}

    def compiled(most: int):
        spans = {name: "".join(f"\\U{a:08x}-\\U{min(b, most):08x}" for a, b in found if a <= most) for name, found in known.items()}
        out, at, inside = [], 0, False
        while at < len(source):
            name = next((x for x in (*spans, r"\S") if source.startswith(x, at)), None)
            if name == r"\S":
                out.append(f"[^{spans[chr(92) + 's']}]")
            elif name:
                out.append(spans[name] if inside else f"[{spans[name]}]")
            else:
                inside = source[at] == "[" or (inside and source[at] != "]")
                out.append(source[at])
            at += len(name or " ")
        return re.compile("".join(out)).findall

    plain, usual, whole = compiled(0x7F), compiled(0xFFFF), compiled(0x10FFFF)

    def split(text: str) -> list[str]:
        if text.isascii():
            return plain(text)
        return usual(text) if len(text.encode("utf-16-le")) == 2 * len(text) else whole(text)

    return split


class _Codes(dict):
    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, match: str) -> bytes:
        ids = self.encode(match.encode())
        found = pack(f"<{len(ids)}I", *ids)
        if len(match) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.clear()
            self[match] = found
        return found


Element = tuple[list[str], list[bytes]]


class ByteBpe:
    """Encodes and decodes with a rank file and its pattern."""

    def __init__(self, path: str, pattern: str, leaf: int = LEAF):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.leaf = leaf
        self.merge = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.tokens = np.empty(max(ranks.values()) + 1, dtype=object)
        self.tokens[list(self.bytes_of)] = list(self.bytes_of.values())
        self.split = _splitter(pattern)
        self.codes = _Codes(self.match)
        self.pairs: dict[tuple[int, int], bool] = {}

    def holds(self, a: int, b: int) -> bool:
        """Is the border between two neighbouring ids one that merging never crosses?"""
        if (a, b) not in self.pairs:
            if len(self.pairs) >= CACHED:
                self.pairs.clear()
            self.pairs[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return self.pairs[a, b]

    def join_ids(self, a: list[int], b: list[int]) -> list[int]:
        """Ids of two stretches of one match in a row."""
        if not a or not b:
            return a or b
        i = j = 1
        while True:
            i, j = min(i, len(a)), min(j, len(b))
            seam = self.merge(b"".join(map(self.bytes_of.__getitem__, a[-i:] + b[:j])))
            left = i == len(a) or self.holds(a[-i - 1], seam[0])
            right = j == len(b) or self.holds(seam[-1], b[j])
            if left and right:
                return a[:-i] + seam + b[j:]
            i, j = i * (1 if left else 2), j * (1 if right else 2)

    def match(self, raw: bytes) -> list[int]:
        """Ids of one match."""
        if len(raw) <= self.leaf:
            return self.merge(raw)
        half = len(raw) // 2
        return self.join_ids(self.match(raw[:half]), self.match(raw[half:]))

    def join(self, left: Element, right: Element) -> Element:
        """The element of two neighbouring stretches; ``left`` is used up."""
        (a, a_codes), (b, b_codes) = left, right
        if not a or not b:
            return left if a else right
        k = size = 0
        while k < len(a) and size < LOOKAHEAD:
            k += 1
            size += len(a[-k])
        j, tail = 2, "".join(a[-k:])
        while True:
            j = min(2 * j, len(b))
            new = self.split(tail + "".join(b[:j]))
            found = self._border(new, b, j, size)
            if found:
                break
        n, i = found
        codes = []
        at = 0
        for match in new[:n]:
            whole = i and at + len(a[-1]) == size and len(match) == len(a[-1]) + len(b[0]) and len(match) > self.leaf
            if whole:  # two halves of one long match
                ids = self.join_ids(np.frombuffer(a_codes[-1], "<u4").tolist(), np.frombuffer(b_codes[0], "<u4").tolist())
                codes.append(np.array(ids, dtype="<u4").tobytes())
            else:
                codes.append(self.codes[match])
            at += len(match)
        a[-k:], a_codes[-k:] = new[:n] + b[i:], codes + b_codes[i:]
        return a, a_codes

    @staticmethod
    def _border(new: list[str], b: list[str], j: int, size: int) -> tuple[int, int] | None:
        """How many matches of ``new`` and of ``b`` end at the first border both have, if one is final."""
        whole = j == len(b)
        last = size + sum(map(len, b[:j])) - (0 if whole else LOOKAHEAD)
        i, there, here = 0, size, 0
        for n, match in enumerate(new, 1):
            here += len(match)
            if here > last:
                return None
            while there < here and i < j:
                there += len(b[i])
                i += 1
            if there == here:
                return n, i
        return None

    def element(self, text: str) -> Element:
        """A stretch of text as an element."""
        if len(text) <= self.leaf:
            found = self.split(text)
            return found, list(map(self.codes.__getitem__, found))
        half = len(text) // 2
        return self.join(self.element(text[:half]), self.element(text[half:]))

    def reduce(self, elements: list[Element]) -> Element:
        """Neighbouring elements joined up a tree."""
        while len(elements) > 1:
            elements = [self.join(*elements[i : i + 2]) if i + 1 < len(elements) else elements[i] for i in range(0, len(elements), 2)]
        return elements[0] if elements else ([], [])

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        return b"".join(self.element(text or "")[1])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes behind ids."""
        if len(ids) <= DECODED:
            return b"".join(self.tokens[ids].tolist())
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_KNOWN: dict[tuple[str, str], ByteBpe] = {}


def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """The worker process's encoder of a file, kept from task to task."""
    if (path, pattern) not in _KNOWN:
        _KNOWN[path, pattern] = ByteBpe(path, pattern)
    return _KNOWN[path, pattern]


def rank_file() -> tuple[str, str]:
    """Path and pattern of the public byte-level ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """``doc_id, ids`` of every row: ids as little-endian unsigned 32-bit numbers."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = byte_bpe(path, pattern)
        for batch in batches:
            ids = [of.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc, text in zip(*[batch.column(c).to_pylist() for c in ("row", "doc_id", "text")], strict=True):
                for at in range(0, len(text), piece):
                    columns = [pa.array([row]), pa.array([doc], pa.int64()), pa.array([at]), pa.array([text[at : at + piece]])]
                    yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "at", "text"])

    def encode_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = byte_bpe(path, pattern)
        for batch in batches:
            made = [of.element(t) for t in batch.column("text").to_pylist()]
            lengths = pa.array([[len(m) for m in found] for found, _ in made], pa.list_(pa.int32()))
            counts = pa.array([[len(c) // 4 for c in codes] for _, codes in made], pa.list_(pa.int32()))
            ids = pa.array([b"".join(codes) for _, codes in made], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, lengths, counts, ids], names=[*batch.schema.names, "lengths", "counts", "ids"])

    def join(got: pa.Table) -> pa.Table:
        of, elements = byte_bpe(path, pattern), []
        got = got.sort_by("at")
        for text, lengths, counts, ids in zip(*[got.column(c).to_pylist() for c in ("text", "lengths", "counts", "ids")], strict=True):
            ends, stops = np.cumsum(lengths).tolist(), (4 * np.cumsum(counts)).tolist()
            elements.append(([text[a:b] for a, b in zip([0, *ends], ends)], [ids[a:b] for a, b in zip([0, *stops], stops)]))
        found = b"".join(of.reduce(elements)[1])
        return pa.table({"doc_id": got.column("doc_id")[:1], "ids": pa.array([found], pa.binary())})

    short = rows.where(F.length("text") <= piece).mapInArrow(whole, "doc_id long, ids binary")
    # Row numbers only tell rows apart; all pieces of a row come from one task.
    long = rows.withColumn("row", F.monotonically_increasing_id()).where(F.length("text") > piece)
    pieces = long.mapInArrow(cut, "row long, doc_id long, at long, text string").repartition("row", "at")
    made = "row long, doc_id long, at long, text string, lengths array<int>, counts array<int>, ids binary"
    joined = pieces.mapInArrow(encode_piece, made).groupBy("row").applyInArrow(join, "doc_id long, ids binary")
    return short.union(joined)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` (``doc_id, ids``) with the bytes ``decoded``."""

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = byte_bpe(path, pattern)
        for batch in batches:
            got = [of.decode(np.frombuffer(x, "<u4")) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.binary())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(back, "doc_id long, ids binary, decoded binary")


@query("op11_byte_bpe")
def op11_byte_bpe(spark, sf_dir):
    """All documents encoded to byte-level ids and decoded again."""
    ranks = rank_file()
    coded = decode(encode(table(spark, sf_dir, "documents"), *ranks), *ranks)
    return coded.select(
        "doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
