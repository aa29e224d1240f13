"""Homomorphic multiset fingerprints of documents.

A text is the multiset of its paragraphs: the trimmed, non-empty stretches between line
breaks, a long one ending at each sentence as well.  Every paragraph is hashed to a wide
vector and the vectors are added, each lane modulo 2**32:

* 8 lanes of uniformly random numbers tell multisets apart: two different ones agree in
  all of them with a chance of about 2**-256 (for texts not made to collide);
* 128 lanes of random bits count, for each bit, the paragraphs that have it, and one lane
  counts all.  ``2 * bits - count`` is a random-sign projection of the multiset, so the
  cosine of two such vectors estimates the cosine of the multisets, with an error of
  about 0.09 for unrelated texts and none for equal ones.

The sum does not depend on the order of paragraphs.  Adding or removing one is adding or
subtracting its vector, so a fingerprint follows edits without the whole text
(:func:`insert`, :func:`delete`).  Two bit lanes share one long, whose halves cannot
overflow before 2**32 paragraphs.

Missing and empty texts have no paragraphs: the all-zero fingerprint, like only itself.
Equal texts, repeated rows and ties of ids get equal fingerprints.  Everything is column
expressions; a document's work stays in its row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hedonic.llm.common import let, query, table, unused
from hedonic.session import settle

#: Ends of paragraphs: a line break, or the white space after the end of a sentence.
BREAK = r"\n+|(?<=[.!?])\s+"
IDENTITY, SIGNS = 4, 2  # 64-bit hashes for the random lanes and for the bit lanes
LANES = 2 * IDENTITY + 32 * SIGNS + 1
WIDTH = 0xFFFFFFFF
PAIRED = 0x0000000100000001  # one bit in each half of a long


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text, in order."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), BREAK), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def add(a: Column, b: Column, sign: int = 1) -> Column:
    """Sum or difference of two fingerprints; the counts of a part that is taken away must be in there."""
    keep = F.sequence(F.lit(0), F.lit(LANES - 1))
    both = F.zip_with(a, b, lambda x, y: x + y if sign > 0 else x - y)
    return F.zip_with(both, keep, lambda x, i: F.when(i < 2 * IDENTITY, x.bitwiseAND(_long(WIDTH))).otherwise(x))


def lanes(text: Column) -> Column:
    """The fingerprint of a text as an array of ``LANES`` longs.

    Each lane is a sum over the paragraphs' hashes, and only the hashes are kept: no
    paragraph needs a vector of its own.
    """
    def total(values: Column, part) -> Column:
        return F.aggregate(values, _long(0), lambda a, h: a + part(h))

    def pair(bit: int):
        return lambda h: F.shiftrightunsigned(h, bit).bitwiseAND(_long(PAIRED))

    def hashes(parts: Column, seed: int) -> Column:
        return F.transform(parts, lambda p: F.xxhash64(p, F.lit(seed)))

    def sums(h: Column) -> Column:
        out = []
        for i in range(IDENTITY):
            # Sums of halves of hashes stay far from overflow; the modulus comes last.
            out.append(total(h[f"h{i}"], lambda x: x.bitwiseAND(_long(WIDTH))).bitwiseAND(_long(WIDTH)))
            out.append(total(h[f"h{i}"], lambda x: F.shiftrightunsigned(x, 32)).bitwiseAND(_long(WIDTH)))
        for i in range(IDENTITY, IDENTITY + SIGNS):
            out += [total(h[f"h{i}"], pair(bit)) for bit in range(32)]
        return F.array(*out, F.size(h["h0"]).cast("long"))

    every = range(IDENTITY + SIGNS)
    return let(paragraphs(text), lambda ps: let(F.struct(*[hashes(ps, i).alias(f"h{i}") for i in every]), sums))


def insert(fingerprint: Column, text: Column) -> Column:
    """The fingerprint after the paragraphs of ``text`` have been added."""
    return add(fingerprint, lanes(text))


def delete(fingerprint: Column, text: Column) -> Column:
    """The fingerprint after the paragraphs of ``text`` have been taken away."""
    return add(fingerprint, lanes(text), sign=-1)


def as_hex(fingerprint: Column) -> Column:
    """All lanes as hexadecimal digits, the identity lanes first."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated cosine of two multisets, 0 to 1; 1 only for equal fingerprints."""
    def signs(x: Column) -> Column:
        n = F.element_at(x, LANES)
        pairs = F.slice(x, 2 * IDENTITY + 1, 32 * SIGNS)
        low = F.transform(pairs, lambda p: (2 * p.bitwiseAND(_long(WIDTH)) - n).cast("double"))
        return F.concat(low, F.transform(pairs, lambda p: (2 * F.shiftrightunsigned(p, 32) - n).cast("double")))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    def cosine(both: Column) -> Column:
        norm = F.sqrt(dot(both["a"], both["a"])) * F.sqrt(dot(both["b"], both["b"]))
        return F.when(norm > 0, dot(both["a"], both["b"]) / norm).otherwise(0.0)

    apart = let(F.struct(signs(a).alias("a"), signs(b).alias("b")), cosine)
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(0.999999), apart)))


def _above(blocks: DataFrame, low: int, high: int, bits: int = 11) -> DataFrame:
    """``block, above``: the next larger of all different ``block`` values, none for the largest.

    Values that share all but their last ``bits`` bits are ordered in one task, and the last of
    such a group meets the first of the next group, which is found in the same way.
    """
    if high - low < 1 << bits:  # so few that one task orders them
        return blocks.select("block", F.lead("block").over(Window.orderBy("block")).alias("above"))
    grouped = blocks.select("block", F.shiftright("block", bits).alias("group"))
    inside = grouped.withColumn("above", F.lead("block").over(Window.partitionBy("group").orderBy("block")))
    first = settle(grouped.groupBy("group").agg(F.min("block").alias("first")))
    climbed = _above(first.select(F.col("group").alias("block")), low >> bits, high >> bits, bits)
    after = climbed.join(first.withColumnRenamed("group", "above"), "above").select(F.col("block").alias("group"), "first")
    return inside.join(after, "group", "left").select("block", F.coalesce("above", "first").alias("above"))


def with_next(
    docs: DataFrame, carried: list[str], group_docs: int = 256, derive: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """Rows with ``next``: a struct of ``carried`` columns of the row with the next smaller ``doc_id``.

    The smallest id is followed by a row without an id, if there is one, and the last row by
    the largest id; rows that repeat an id follow each other.  A block is ``group_docs`` (a
    power of two, 2 or more) neighbouring ids, ordered in one task; the row of its largest id goes to the
    block before it as well.  Blocks come from the ids alone: nothing is sampled, and the
    driver sees the smallest and largest block only.  ``derive`` adds columns once rows are in their blocks.
    """
    bits = group_docs.bit_length() - 1
    if bits < 1 or group_docs != 1 << bits:
        raise ValueError(f"group_docs must be a power of two and at least 2, not {group_docs}")
    nameless = -(1 << 63)  # the block of rows without an id, smaller than any other
    block, head, guest = (unused(f"_{stem}", docs) for stem in ("block", "head", "guest"))
    number = F.col("doc_id").cast("long")
    own = F.coalesce(F.shiftright(number, bits), _long(nameless))
    ids = docs.select("doc_id", own.alias("block"))
    heads = settle(ids.groupBy("block").agg(F.max("doc_id").alias(head)))
    named = heads.where(F.col("block") != nameless)
    low, high, missing = heads.agg(
        F.min(F.when(F.col("block") != nameless, F.col("block"))), F.max("block"), F.count_if(F.col("block") == nameless)
    ).first()
    before = _above(named.select("block"), low, high) if low is not None else named.select("block", F.col("block").alias("above"))
    last = nameless if missing else low
    sent = named.join(before, "block").select(head, F.coalesce("above", _long(last)).alias(guest))
    if missing:
        sent = sent.union(heads.where(F.col("block") == nameless).select(head, _long(nameless if low is None else low)))

    spots = F.array(F.struct(own.alias(block), F.lit(False).alias(guest)), F.struct(F.col(guest).alias(block), F.lit(True).alias(guest)))
    rows = docs.join(settle(sent), F.col("doc_id").eqNullSafe(F.col(head)), "left")
    rows = rows.select(*[F.col(f"`{c}`") for c in docs.columns], F.inline(F.filter(spots, lambda x: x[block].isNotNull())))
    rows = derive(rows.repartition(block))
    down = Window.partitionBy(block).orderBy(F.col(guest), F.desc_nulls_last("doc_id"))
    return rows.withColumn("next", F.lead(F.struct("doc_id", *carried)).over(down)).where(~F.col(guest)).drop(block, guest)


@query("op7_fingerprints")
def op7_fingerprints(spark, sf_dir):
    """Fingerprints of all documents and of their texts with the last third replaced from the next one."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    own = with_next(docs, ["text", "lanes"], derive=lambda rows: rows.withColumn("lanes", lanes(F.col("text"))))
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring(F.col("next.text"), F.lit(1), cut))
    both = own.withColumn("edited", edited).select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "lanes", lanes(F.col("edited")).alias("edited_lanes"), F.col("next.lanes").alias("next_lanes"),
    )
    return both.select(
        "doc_id", "n_chars", "edited_sha256",
        as_hex(F.col("lanes")).alias("fingerprint"), as_hex(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"),
    )
