"""Fuzzy line deduplication by MinHash over character shingles.

Lines are compared after folding case and white space.  A line is the set of its character
shingles: ``SHINGLE`` characters from every character on, blanks too (a shorter line is one
shingle).  Signatures are ``BANDS * ROWS`` minimum hashes (of one hash of
a shingle, its bits turned by a mask for each), a band is ``ROWS`` of them: lines of Jaccard
similarity 0.8 share a band with a chance of ``1 - (1 - 0.8 ** ROWS) ** BANDS``, 99.1 per cent.
Lines that share a band are verified on their exact shingles (similarity ``LIKE`` per cent or more),
links are joined by distributed union-find, and of each component one line stays: the
first of the document with the smallest id.

Equal lines are one line from the start, through a partial aggregate by their 64-bit hash:
a line found in a third of all documents is one row per task.  A family of near lines shares
its bands; its pairs are never listed.  Each band first links its lines to its smallest
line, its head; then pairs are formed only between components that still differ inside a band,
and only of lines whose differences from the head, which are few, let them be alike.

Every line that is not empty takes part, in scripts with blanks or without: one of fewer than
``SHINGLE`` characters is a single shingle, and so like its equals only.  Empty lines stay.  Everything runs as column expressions: for signatures, lines are cut into stretches
that hold ``STRETCH`` shingles each, so that a text is cut out per stretch and not per character.

Missing texts have no lines and stay missing.  A document all of whose lines go is dropped
by :func:`dedup_lines`; rows that repeat an id and a text keep the same lines, an id's different
texts are documents of their own, rows without an id count like others.  An empty table gives no rows.
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hedonic.llm.common import let, query, rows_near, rows_outside, table, unused
from hedonic.llm.components import components
from hedonic.session import release, settle

#: A shingle's characters.
SHINGLE = 8
ROWS, BANDS = 5, 12
LIKE = 80
#: Buckets (as a power of two) of the sieve before lines are joined.
SIEVE = 21

#: Shingles that start in one stretch of a line, and the bits of their hashes.
STRETCH, BITS = 8, 20

#: Every shingle of a line.
SHINGLES = r"(?s)(?=(.{%d}|\A.{1,%d}\z))." % (SHINGLE, SHINGLE - 1)
#: Every stretch, with the characters of its last shingle.
STRETCHES = r"(?s)(?=(.{%d,%d}|\A.{1,%d}\z)).{1,%d}" % (SHINGLE, STRETCH + SHINGLE - 1, SHINGLE - 1, STRETCH)
#: White space that is not a single blank, and its likely signs.
GAPS = r"[\s&&[^ ]]\s*| \s+"
SIGNS = ("  ", "\t", "\r", "\v", "\f")


def _masks() -> list[int]:
    draw = random.Random(ROWS * BANDS)
    return [draw.getrandbits(BITS) for _ in range(ROWS * BANDS)]


def folded(line: Column) -> Column:
    def fold(low: Column) -> Column:
        # Few lines need the pattern, and to see which is cheap.
        odd = reduce(lambda a, b: a | b, [F.contains(low, F.lit(s)) for s in SIGNS])
        return F.trim(F.when(odd, F.regexp_replace(low, GAPS, " ")).otherwise(low))

    return let(F.lower(line), fold)


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, mark, at, line, folded, filled, key``: every line with its place.

    ``key`` is the folded line's hash, ``mark`` the whole text's: an id may come with several texts.
    """
    mark = F.xxhash64(text_col).alias("mark")
    rows = docs.select(F.col(id_col).alias("doc_id"), mark, F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("at", "line"))
    rows = rows.withColumn("folded", folded(F.col("line")))
    return rows.withColumn("filled", F.col("folded") != "").withColumn("key", F.xxhash64("folded"))


def shingles(line: Column) -> Column:
    """The shingles of a folded line, repeated ones too."""
    return F.regexp_extract_all(line, F.lit(SHINGLES), F.lit(1))


def signatures(lines: DataFrame) -> DataFrame:
    """``key, bands`` of every distinct line of ``lines`` (``key, folded``)."""
    parts = lines.select("key", F.explode(F.regexp_extract_all(F.col("folded"), F.lit(STRETCHES), F.lit(1))).alias("part"))
    # So many bits tell a line's shingles apart, and minima of them are short.
    hashes = [F.hash(F.substring("part", i + 1, SHINGLE)).bitwiseAND((1 << BITS) - 1) for i in range(STRETCH)]
    # The stretch at a line's end holds fewer shingles; its first stands in for the others.
    hashes[1:] = [F.when(F.length("part") >= i + SHINGLE, h).otherwise(hashes[0]) for i, h in enumerate(hashes[1:], 1)]
    hashed = parts.select("key", *[h.alias(f"h{i}") for i, h in enumerate(hashes)])
    # A stretch's least value comes first, so that a group's minima are touched once for all its shingles.
    least = [F.least(*[F.col(f"h{i}").bitwiseXOR(F.lit(m)) for i in range(STRETCH)]) for m in _masks()]
    signed = hashed.groupBy("key").agg(*[F.min(v).alias(f"m{i}") for i, v in enumerate(least)])
    bands = [F.xxhash64(F.lit(b), *[F.col(f"m{b * ROWS + r}") for r in range(ROWS)]) for b in range(BANDS)]
    return signed.select("key", F.array(*bands).alias("bands"))


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs ``u, v`` of lines with ``common``, ``nu``, ``nv`` and ``apart``.

    These are the sizes of their sets' intersection and of the sets, and short hashes of what stands in one of them only.
    """
    left = texts.select(F.col("key").alias("u"), F.col("folded").alias("a"))
    right = texts.select(F.col("key").alias("v"), F.col("folded").alias("b"))
    sides = [F.size(F.array_intersect("a", "b")).alias("common"), F.array_except("a", "b").alias("x"), F.array_except("b", "a").alias("y")]
    # Lines are moved, not their shingles.
    both = pairs.join(left, "u").join(right, "v").select("u", "v", shingles(F.col("a")).alias("a"), shingles(F.col("b")).alias("b"))
    both = both.select("u", "v", *sides)
    apart = F.array_distinct(F.transform(F.concat("x", "y"), lambda s: F.xxhash64(s).bitwiseAND(0x7FFF).cast("short")))
    sizes = [(F.size(s) + F.col("common")).alias(n) for s, n in (("x", "nu"), ("y", "nv"))]
    return both.select("u", "v", "common", *sizes, apart.alias("apart"))


def _may_link(a: str, b: str, like: int) -> Column:
    """Whether two lines of a band can be alike, by what sets each (``n, apart``) apart from the band's head.

    What sets the two apart is what stands in one of these sets only; hashes that clash can hide some of it, never add to it.
    """
    every, x, y = F.col(f"{a}.n") + F.col(f"{b}.n"), F.col(f"{a}.apart"), F.col(f"{b}.apart")
    most, each = (100 - like) * every, 100 + like
    sizes = (each * F.abs(F.col(f"{a}.n") - F.col(f"{b}.n")) <= most) & (each * F.abs(F.size(x) - F.size(y)) <= most)
    return sizes & (each * (F.size(x) + F.size(y) - 2 * F.size(F.array_intersect(x, y))) <= most)


def line_components(lines: DataFrame, like: int = LIKE) -> DataFrame:
    """``key, component`` of every line (``key, folded``) that is like another; no empty lines are to be passed."""
    inside = Window.partitionBy("band")
    banded = signatures(lines).select("key", F.explode("bands").alias("band"))
    # Most bands hold one line, which goes.
    banded = banded.select("band", "key", F.min("key").over(inside).alias("head"), F.max("key").over(inside).alias("last"))
    members = settle(banded.where("head != last").drop("last"))

    wanted = settle(members.select("key").distinct())
    near = rows_near(lines.select("key", "folded"), wanted, "key", SIEVE)
    texts = settle(near.join(wanted, "key", "left_semi").dropDuplicates(["key"]))
    star = members.where("key != head").select(F.col("key").alias("u"), F.col("head").alias("v")).distinct()
    star = settle(_compared(star, texts))
    linked = f"{100 + like} * common >= {like} * (nu + nv)"
    links = settle(star.where(linked).select("u", "v"))
    label = settle(components(links))

    known = members.join(label.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("component", "key"))
    mixed = known.groupBy("band").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a != b").select("band")
    about = star.select(F.col("u").alias("key"), F.col("v").alias("head"), F.col("nu").alias("n"), "apart")
    heads = star.groupBy(F.col("v").alias("key")).agg(F.col("v").alias("head"), F.max("nv").alias("n"))
    about = about.union(heads.withColumn("apart", F.array().cast("array<smallint>")))
    open_ = settle(known.join(mixed, "band").join(about, ["key", "head"]).select("band", "key", "label", "n", "apart"))
    pair = F.expr("a.band = b.band AND a.label < b.label") & _may_link("a", "b", like)
    rest = open_.alias("a").join(open_.alias("b"), pair).select(F.col("a.key").alias("u"), F.col("b.key").alias("v"))
    rest = settle(rest.distinct())
    more = settle(_compared(rest, texts).where(linked).select("u", "v"))
    release(members, wanted, texts, star, open_, rest)
    return components(links.union(more)).withColumnRenamed("node", "key")


def repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", like: int = LIKE) -> DataFrame:
    """``doc_id, mark, at``: the places of all lines that go."""
    lines = lines_of(docs, id_col, text_col)
    alike = settle(line_components(lines.where("filled").select("key", "folded"), like))
    places = settle(lines.where("filled").select("doc_id", "mark", "at", "key"))
    # Where each distinct line first stands; combined before the shuffle.
    first = places.groupBy("key").agg(F.min(F.struct("doc_id", "mark", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.join(alike, "key", "left").withColumn("component", F.coalesce("component", "key"))
    best = first.groupBy("component").agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    # Only lines of components with more than one occurrence can go.
    repeated = settle(first.select("key", "component").join(best.where("n > 1"), "component").select("key", "first"))
    judged = places.join(repeated, "key")
    here = F.struct("doc_id", "mark", "at").eqNullSafe(F.col("first"))
    return judged.where(~here).select("doc_id", "mark", "at").distinct()


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", like: int = LIKE) -> DataFrame:
    """``docs`` with repeated lines taken out of the text; a document left without any line is dropped."""
    places = repeated_lines(docs, id_col=id_col, text_col=text_col, like=like)
    gone = settle(places.groupBy(F.col("doc_id").alias(id_col), "mark").agg(F.collect_list("at").alias("gone")))
    # Most documents lose nothing and stay where they are.
    near = rows_near(docs, gone, id_col)
    doc, mark, lost = unused("_doc", docs), unused("_mark", docs), unused("_gone", docs)
    same = F.col(id_col).eqNullSafe(F.col(doc)) & (F.xxhash64(text_col) == F.col(mark))
    joined = near.join(gone.select(F.col(id_col).alias(doc), F.col("mark").alias(mark), F.col("gone").alias(lost)), same, "left")
    parts = F.split(F.col(text_col), "\n", -1)
    rest = F.filter(F.transform(parts, lambda x, i: F.when(~F.array_contains(F.col(lost), i), x)), lambda x: x.isNotNull())
    text = F.when(F.col(lost).isNull(), F.col(text_col)).otherwise(F.array_join(rest, "\n"))
    empty = F.col(lost).isNotNull() & (folded(text) == "")
    edited = joined.where(~empty).select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
    return rows_outside(docs, gone, id_col).union(edited)


@query("op5_line_dedup")
def op5_line_dedup(spark, sf_dir):
    """All documents that keep a line, with the text of the lines they keep."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs)
