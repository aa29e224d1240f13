"""Exact Jaccard join of documents on word n-grams, small and large sets apart.

A document is the set of its distinct word five-grams.  Two documents link when
``100 * intersection >= 80 * union``; the result is each document's connected component.

* Documents with equal sets are one numbered node, named after the smallest id.
* Small sets (fewer than a boundary of n-grams) enumerate subsets of fixed size: sizes s
  and t can only link by ``o(s, t)`` common n-grams, so linked sets share a subset of that
  size, whose hash is a key.
* Large sets scan inverted lists.  N-grams are ordered by a global count sketch (rare
  first); linked sets share at least ``k`` n-grams among the first ``n - ceil(0.8 n) + k``
  of each, so only these are listed, and pairs with fewer hits are dropped.  Small sets
  that a large one can link with are listed too.
* The boundary is the size for which the estimated number of subset keys and list entries
  visited is least.

Candidates are verified on the whole texts.  A family of near copies shares its keys: its
pairs are never listed.  First every key links its members to one leader, the member with
the largest share of frequent n-grams; verified links join components.  Then pairs inside
a key are formed only between different components, which finds every link that could
still matter: no link between different components is left.

Counts cover all documents.  Sketch and leaders only steer the search; links are exact up
to clashes of 64-bit hashes inside a pair.  The sketch has a fixed size, so its broadcast
does not grow.  Sets are rebuilt from texts where needed, not stored.

Missing texts and texts without words have no n-grams and link with nothing; texts with
fewer than five words are one n-gram.  Rows without an id stay alone, repeated rows give
the same result twice, an id's different texts are documents of their own (with the id as
name), an empty table none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hedonic.llm.common import query, rows_near, table
from hedonic.llm.components import components
from hedonic.session import release, settle

NGRAM = 5
PERCENT = 80
#: Sizes up to this may be enumerated; beyond, subsets outnumber any list.
SMALL = 16
#: N-grams of a set per extra list entry that a candidate must hit.
PER_HIT = 40
#: The sketch has 2**SKETCH_BITS counters.
SKETCH_BITS = 20
LANES = 64
#: Keys of more rows than this are crowded; their sets' differences from the leader are counted before pairs are formed.
CROWD = 32
CACHED_WORDS = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_HASHES = _Hashes()


def ngram_set(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of a text; A-Z are folded and words end at ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    ids = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(NGRAM, len(ids))
    found = np.full(len(ids) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        found = (found ^ ids[i : len(ids) - size + 1 + i]) * _MIX
        found ^= found >> np.uint64(29)
    return np.unique(found)


def needed(a: int, b: int) -> int:
    """Common n-grams that sets of these sizes need to link: 100 i >= 80 (a + b - i)."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def hits(n: int) -> int:
    return 1 + n // PER_HIT


def listed(n: int) -> int:
    """Entries of a set of ``n`` n-grams in the inverted lists."""
    return min(n, n - -(-PERCENT * n // 100) + hits(n))


def subset_keys(tokens: list[int], boundary: int) -> list[int]:
    """Keys of all subsets by which a small set can link with another small one."""
    n, out = len(tokens), []
    tokens = sorted(tokens)
    for other in range(-(-PERCENT * n // 100), min(100 * n // PERCENT, boundary - 1) + 1):
        low, high = min(n, other), max(n, other)
        for part in combinations(tokens, needed(n, other)):
            out.append(xxhash.xxh3_64_intdigest(np.array([low, high, *part], dtype=np.uint64).tobytes()))
    return out


def subsets_of(n: int, boundary: int) -> int:
    return sum(comb(n, needed(n, t)) for t in range(-(-PERCENT * n // 100), min(100 * n // PERCENT, boundary - 1) + 1))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def count_sketch(docs: DataFrame, bits: int) -> np.ndarray:
    """How many documents have an n-gram of each hash bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                np.add.at(total, (ngram_set(text) >> np.uint64(64 - bits)).astype(np.int64), 1)
        chunks = total.reshape(-1, LANES)
        some = np.flatnonzero(chunks.any(axis=1))
        for at in range(0, len(some), 8192):
            part = some[at : at + 8192]
            columns = [pa.array(part, pa.int32()), *[pa.array(chunks[part, i], pa.int64()) for i in range(LANES)]]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", *[f"c{i}" for i in range(LANES)]])

    schema = "chunk int, " + ", ".join(f"c{i} long" for i in range(LANES))
    counted = docs.select("text").mapInArrow(count, schema).groupBy("chunk").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(LANES)])
    got = counted.toPandas()
    out = np.zeros((1 << bits) // LANES * LANES, dtype=np.int64).reshape(-1, LANES)
    out[got["chunk"].to_numpy()] = got[[f"c{i}" for i in range(LANES)]].to_numpy()
    return np.minimum(out.reshape(-1), np.iinfo(np.int32).max).astype(np.int32)


SETS = "doc_id long, mark long, n long, f1 long, f2 long, rank long, cost long, tokens array<long>"


def _sets(docs: DataFrame, sketch: np.ndarray, bits: int) -> DataFrame:
    """Size, fingerprint and first n-grams (rare first) of every document's set."""
    shipped = docs.sparkSession.sparkContext.broadcast(sketch)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shipped.value
        mean = float(counts.mean())
        often = mean + 4 * mean**0.5 + 1
        for batch in batches:
            rows: list[tuple] = []
            for doc, mark, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "mark", "text")], strict=True):
                found = ngram_set(text)
                n = len(found)
                if n == 0:
                    rows.append((doc, mark, 0, 0, 0, 0, 0, []))
                    continue
                seen = counts[(found >> np.uint64(64 - bits)).astype(np.int64)]
                first = _signed(found[np.argsort(seen, kind="stable")[: max(listed(n), min(n, SMALL))]])
                f1 = int(_signed(np.bitwise_xor.reduce(found * _MIX)[None])[0])
                f2 = int(_signed(np.add.reduce(found ^ (found >> np.uint64(31)))[None])[0])
                visits = float(np.maximum(np.sort(seen)[: listed(n)] - mean, 1.0).sum())
                rows.append((doc, mark, n, f1, f2, -int(1000 * (seen > often).mean()), int(visits), first))
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int64())]
            fields = ["doc_id", "mark", "n", "f1", "f2", "rank", "cost", "tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=fields)

    return docs.mapInArrow(make, SETS)


def choose_boundary(sizes: dict[int, tuple[int, int]]) -> int:
    """The boundary of least cost from ``size -> (nodes, list entries visited)`` for sizes up to ``SMALL``."""
    def total(boundary: int) -> int:
        small = sum(nodes * subsets_of(n, boundary) for n, (nodes, _) in sizes.items() if n < boundary)
        return small + sum(visits for n, (_, visits) in sizes.items() if 100 * n >= PERCENT * boundary)

    return min(range(1, SMALL + 2), key=total)


def _keys(nodes: DataFrame, boundary: int) -> DataFrame:
    """``key, node, n, rank, at``: list entries of large sets and what they can link with, subset keys of small ones."""
    n = F.col("n")
    part = F.least(n, n - F.ceil(n * PERCENT / 100) + 1 + F.floor(n / PER_HIT)).cast("int")
    large = nodes.where(100 * n >= PERCENT * boundary).select("node", "n", "rank", F.posexplode(F.slice("tokens", 1, part)).alias("at", "key"))

    def enumerate_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, size, rank, tokens in zip(*[batch.column(c).to_pylist() for c in ("node", "n", "rank", "tokens")], strict=True):
                unsigned = [t & 0xFFFFFFFFFFFFFFFF for t in tokens]
                for key in subset_keys(unsigned, boundary):
                    rows.append((key - (1 << 64) if key >> 63 else key, node, size, rank, -1))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "node", "n", "rank", "at"])

    small = nodes.where(n < boundary).select("node", "n", "rank", "tokens")
    small = small.mapInArrow(enumerate_, "key long, node long, n long, rank long, at int")
    return large.select("key", "node", "n", "rank", "at").unionByName(small)


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs with the sizes of their intersection and union: ``u, v, common, every``, from whole texts."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def of(node: int, text: str) -> np.ndarray:
            if node not in held:
                if len(held) > 64:
                    held.clear()
                held[node] = ngram_set(text)
            return held[node]

        for batch in batches:
            common, every = [], []
            for u, v, a, b in zip(*[batch.column(c).to_pylist() for c in ("u", "v", "a", "b")], strict=True):
                x, y = of(u, a), of(v, b)
                common.append(len(np.intersect1d(x, y, assume_unique=True)))
                every.append(len(x) + len(y) - common[-1])
            sizes = [pa.array(common, pa.int64()), pa.array(every, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), *sizes], names=["u", "v", "common", "every"])

    left = texts.select(F.col("node").alias("u"), F.col("text").alias("a"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("b"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(check, "u long, v long, common long, every long")


def _unlike(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, head, token``: the n-grams that only one of the two has."""
    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, head, a, b in zip(*[batch.column(c).to_pylist() for c in ("node", "head", "a", "b")], strict=True):
                found = _signed(np.setxor1d(ngram_set(a), ngram_set(b), assume_unique=True))
                ends = [pa.array(np.full(len(found), x), pa.int64()) for x in (node, head)]
                yield pa.RecordBatch.from_arrays([*ends, pa.array(found, pa.int64())], names=["node", "head", "token"])

    left = texts.select("node", F.col("text").alias("a"))
    right = texts.select(F.col("node").alias("head"), F.col("text").alias("b"))
    return pairs.join(left, "node").join(right, "head").select("node", "head", "a", "b").mapInArrow(differ, "node long, head long, token long")


def _echoed(open_: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, head, echoed``: how many n-grams that tell a node from its leader also tell one of another label from it.

    Only for nodes in crowded keys that are not too far from the leader.
    """
    crowded = open_.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > CROWD).select("key")
    pairs = settle(open_.where("node != head AND far <= 0.5").join(crowded, "key").select("node", "head", "label").distinct())
    tokens = settle(_unlike(pairs.select("node", "head"), texts).join(pairs, ["node", "head"]))
    spread = tokens.groupBy("head", "token").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a != b").select("head", "token")
    echoes = tokens.join(spread, ["head", "token"], "left_semi").groupBy("node", "head").agg(F.count(F.lit(1)).alias("echoed"))
    return pairs.join(echoes, ["node", "head"], "left").select("node", "head", F.coalesce("echoed", F.lit(0)).alias("echoed"))


def _linked(verified: DataFrame) -> DataFrame:
    return verified.where(100 * F.col("common") >= PERCENT * F.col("every")).select("u", "v")


def _fits(a: str, b: str):
    """Can sets of these sizes link?"""
    return (100 * F.least(a, b) >= PERCENT * F.greatest(a, b))


def _meeting(open_: DataFrame) -> DataFrame:
    """``u, v, n, m, i, j`` of nodes of different labels in a key: sizes and places, without pairs that cannot link."""
    a, b = open_.alias("a"), open_.alias("b")
    most = "least(a.before, b.before) + 1 + least(a.n - a.at, b.n - b.at) - 1"
    common = f"ceil({PERCENT} * (a.n + b.n) / {100 + PERCENT})"
    fits = f"100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)"
    close = f"coalesce(abs(a.far - b.far) <= {1 - PERCENT / 100 + 1e-9}, true)"
    # Two sets differ where just one of them differs from the leader, and may differ in a ninth of their sizes' sum.
    less = f"coalesce({100 + PERCENT} * (a.apart + b.apart - 2 * least(a.echoed, b.echoed)) <= {100 - PERCENT} * (a.n + b.n), true)"
    met = a.join(b, F.expr(f"a.key = b.key AND a.label < b.label AND {fits} AND {close} AND {less} AND (a.at < 0 OR {most} >= {common})"))
    return met.select(
        F.col("a.node").alias("u"), F.col("b.node").alias("v"), F.col("a.n").alias("n"), F.col("b.n").alias("m"),
        F.col("a.at").alias("i"), F.col("b.at").alias("j"),
    )


def ngram_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    sets = settle(_sets(rows, count_sketch(rows, SKETCH_BITS), SKETCH_BITS))

    whole = ["f1", "f2", "n"]
    named = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    # An id may come with several texts, so sets have numbers of their own; the table is written, which fixes them.
    reps = sets.where(named).groupBy(*whole).agg(F.min(F.struct("doc_id", "mark")).alias("head"))
    reps = settle(reps.select(*whole, "head.doc_id", "head.mark").withColumn("node", F.monotonically_increasing_id()))
    numbers = F.when(F.col("doc_id").isNotNull(), F.col("node"))
    member = sets.select("doc_id", *whole).join(reps.select(*whole, "node"), whole, "left").select("doc_id", "n", numbers.alias("node"))
    member = settle(member)
    heads = reps.select("doc_id", "mark", "node")
    nodes = settle(sets.where(named).join(heads, ["doc_id", "mark"]).drop("doc_id", "mark").dropDuplicates(["node"]))
    release(sets)

    costs = nodes.where(F.col("n") <= SMALL).groupBy("n").agg(F.count(F.lit(1)).alias("nodes"), F.sum("cost").alias("visits"))
    boundary = choose_boundary({r.n: (r.nodes, r.visits) for r in costs.collect()})
    keys = _keys(nodes.select("node", "n", "rank", "tokens"), boundary)

    # Keys of a single node are most of all; only the others are kept, each row with its key's leader.
    best = F.min(F.struct("rank", "node", "n"))
    shared = keys.groupBy("key").agg(best.alias("head"), F.count(F.lit(1)).alias("rows")).where("rows > 1").select("key", "head")
    shared = settle(keys.join(shared, "key").select("key", "node", "n", "at", F.col("head.node").alias("head"), F.col("head.n").alias("head_n")))
    release(nodes)

    wanted = F.least(F.col("n"), F.col("head_n"))
    star = shared.where((F.col("node") != F.col("head")) & _fits("n", "head_n")).groupBy(F.col("node").alias("u"), F.col("head").alias("v"))
    # Leaders only have to be plausible: half the hits, as some of the pair's keys have other leaders.
    star = star.agg(F.count(F.lit(1)).alias("hits"), F.min(wanted).alias("least"), F.min("at").alias("at"))
    star = settle(star.where((F.col("at") < 0) | (2 * F.col("hits") >= 1 + F.floor(F.col("least") / PER_HIT))).select("u", "v"))
    texts = _texts(rows, star, heads)
    verified = settle(_verify(star, texts))
    links = _linked(verified)
    label = settle(components(links))

    # What is left: pairs of different components that share a key.
    known = shared.select("key", "node", "n", "at", "head").join(label, "node", "left")
    known = known.withColumn("label", F.coalesce("component", "node")).drop("component")
    # Jaccard distances obey the triangle inequality: two sets whose distances to their
    # key's leader differ by more than a link allows cannot link.
    apart = F.col("every") - F.col("common")
    far = verified.select(F.col("u").alias("node"), F.col("v").alias("head"), (apart / F.col("every")).alias("far"), apart.alias("apart"))
    known = known.join(far, ["node", "head"], "left").withColumns({c: F.when(F.col("node") == F.col("head"), 0).otherwise(F.col(c)) for c in ("far", "apart")})
    mixed = known.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a != b").select("key")
    # Entries of a set that no set of another component lists cannot be common to a pair whose shared key comes later in both.
    earlier = F.row_number().over(Window.partitionBy("node", F.col("at") < 0).orderBy("at")) - 1
    open_ = settle(known.join(mixed, "key").withColumn("before", earlier))
    open_ = settle(open_.join(_echoed(open_, texts), ["node", "head"], "left").withColumn("echoed", F.coalesce("echoed", "apart")))
    met = _meeting(open_)
    need = F.ceil(PERCENT * (F.col("n") + F.col("m")) / (100 + PERCENT))
    # Subset keys (at < 0) say everything.  Of list entries a pair must share enough, and
    # what follows its last shared entry must be enough for the rest.
    met = met.groupBy("u", "v").agg(
        F.count(F.lit(1)).alias("hits"), F.min("i").alias("i"), F.min(1 + F.floor(F.least("n", "m") / PER_HIT)).alias("hits_needed"),
        F.min(F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j")) - 1).alias("after"), F.first(need).alias("need"),
    )
    enough = (F.col("hits") >= F.col("hits_needed")) & (F.col("hits") + F.col("after") >= F.col("need"))
    rest = met.where((F.col("i") < 0) | enough).select("u", "v")
    rest = settle(rest)
    more = settle(_linked(_verify(rest, _texts(rows, rest, heads))))
    both = settle(components(links.union(more)))

    # A linked set's name is the smallest id in its component, another's the smallest id that has it.
    ids = heads.select("node", F.col("doc_id").alias("own"))
    linked = settle(both.join(ids, "node"))
    least = linked.groupBy("component").agg(F.min("own").alias("least"))
    names = linked.join(least, "component").select("node", "least")
    found = member.join(ids, "node", "left").join(names, "node", "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "own", "doc_id").alias("component_id"))


def _texts(rows: DataFrame, pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """Whole texts of the nodes in ``pairs``, taken from their first rows (``heads``)."""
    ids = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    ids = settle(heads.join(ids, "node", "left_semi"))
    found = rows_near(rows, ids, "doc_id").join(ids, ["doc_id", "mark"]).dropDuplicates(["node"])
    return settle(found.select("node", "text"))


@query("op4_ngram_join")
def op4_ngram_join(spark, sf_dir):
    """Near copies among all documents: their components under five-gram Jaccard similarity."""
    return ngram_components(table(spark, sf_dir, "documents"))
