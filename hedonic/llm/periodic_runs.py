"""Runs of periodic words, by uniting suffix classes from the longest common prefix down.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are
equal) of at least ``max(LEAST, TIMES * q)`` words that no neighbouring word extends.

Suffixes of a text are ordered by their words.  Neighbours in that order are united by
decreasing length of their common prefix, Kruskal's way: a class is an ordered set of
positions, and the smaller of two classes goes into the larger.  Positions ``p < p + d`` that
become neighbours in a class while prefixes of length ``l`` are united share exactly ``l`` words,
so the words from ``p`` to ``p + d + l`` have period ``d`` and no word after them continues it.
For ``l >= d`` this seeds a run, which starts at ``p`` if the word before does not fit either.
Every run with start ``s`` and period ``q`` shows up: a position between ``s`` and ``s + q`` in
their class would give the run a smaller period, so these two do become neighbours, once.
Likewise ``d`` is the smallest period of every seed, since a smaller one would stand between.

A run has ``d + l >= TIMES * d`` and ``LEAST`` words, so that suffixes whose neighbours share fewer
than ``LEAST - 1`` words take no part (:data:`FLOOR`).  Suffixes are ordered by doubling, all texts
of a batch in one sort, and what is alone in its class drops out: in plain text nearly
everything within three rounds.  No text meets another, so no shuffle is needed; a batch's
memory is bounded by ``BATCH_WORDS`` or by its longest text.

Words are ``[^\\x20\\x09-\\x0D]+``.  Missing, empty and blank texts have no words, no runs and the
empty text as ``collapsed``.  Equal texts give equal results; rows without an id are treated
like others.  An empty table gives no rows.  Only the two named columns are read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hedonic.llm.common import let, query, table

#: A run has LEAST words and TIMES periods at least.
LEAST, TIMES = 6, 4
#: Words that the suffixes of a run's first two periods share at least: LEAST - 1 for period 1, more for others.
FLOOR = LEAST - 1
#: Words of the texts that are ordered together.
BATCH_WORDS = 400_000

Run = tuple[int, int, int]


def suffix_order(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose suffixes share at least two words with another of their text, in suffix order, and their classes.

    ``words`` are numbers, ``ends`` the position after the text a word belongs to.  Suffixes
    are compared inside their text, a shorter one before its continuations.
    """
    n = len(words)
    rank = np.empty(n + 1, dtype=np.int64)
    order = np.lexsort((words, ends))
    new = np.ones(n, dtype=bool)
    new[1:] = (words[order[1:]] != words[order[:-1]]) | (ends[order[1:]] != ends[order[:-1]])
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    active, width = order, 1
    classes = members = None
    while len(active):
        group = rank[active]
        same = np.zeros(len(active) + 1, dtype=bool)
        same[1:-1] = group[1:] == group[:-1]
        active = active[same[1:] | same[:-1]]  # in a class with others
        if width == 2:
            members, classes = active, rank[active]
        if not len(active):
            break
        group, after = rank[active], active + width
        second = np.where(after < ends[active], rank[np.minimum(after, n)] + 1, 0)
        by = np.lexsort((second, group))
        active, group, second = active[by], group[by], second[by]
        first = np.ones(len(active), dtype=bool)
        first[1:] = group[1:] != group[:-1]
        start = np.flatnonzero(first)[np.cumsum(first) - 1]
        split = first.copy()
        split[1:] |= second[1:] != second[:-1]
        rank[active] = group + np.flatnonzero(split)[np.cumsum(split) - 1] - start
        width *= 2
    if members is None:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    by = np.argsort(rank[members], kind="stable")
    return members[by], classes[by]


def common_prefixes(words: list[int], ends: np.ndarray, order: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Words that each suffix of ``order`` shares with the one before it (0 in another class)."""
    before = {}
    for a, b in zip(order[:-1][classes[1:] == classes[:-1]].tolist(), order[1:][classes[1:] == classes[:-1]].tolist()):
        before[b] = a
    got, last, h = {}, -2, 0
    for p in sorted(before):
        h, q = (max(h - 1, 0) if last == p - 1 else 0), before[p]
        most = int(ends[p]) - max(p, q)
        while h < most and words[p + h] == words[q + h]:
            h += 1
        got[p], last = h, p
    return np.array([got.get(p, 0) for p in order.tolist()], dtype=np.int64)


def seeds(order: np.ndarray, shared: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``p, d, l``: positions at distance ``d`` that become neighbours while prefixes of ``l`` words are united."""
    place = np.flatnonzero(shared >= FLOOR)
    place = place[np.argsort(-shared[place], kind="stable")]
    home: dict[int, int] = {}
    held: dict[int, list[int]] = {}

    def find(p: int) -> int:
        while (up := home.setdefault(p, p)) != p:
            home[p] = p = home[up]
        return p

    for u, v, l in zip(order[place - 1].tolist(), order[place].tolist(), shared[place].tolist()):
        u, v = find(u), find(v)
        large, small = held.pop(u, None) or [u], held.pop(v, None) or [v]
        if len(small) > len(large):
            large, small, u, v = small, large, v, u
        home[v] = u
        last = -1
        for i, p in enumerate(small):
            at = bisect_left(large, p)
            if at and large[at - 1] > last:
                yield large[at - 1], p - large[at - 1], l
            if at < len(large) and (i + 1 == len(small) or large[at] < small[i + 1]):
                yield p, large[at] - p, l
            last = p
        if 4 * len(small) > len(large):
            large = sorted(large + small)
        else:
            for p in small:
                insort(large, p)
        held[u] = large


def runs_of(texts: list[list[bytes]]) -> list[list[Run]]:
    """``(start, length, period)`` of all runs of each text, by start, then period."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    numbers: dict[bytes, int] = {}
    words = [numbers.setdefault(w, len(numbers)) for t in texts for w in t]
    stops = np.cumsum(sizes)
    out: list[list[Run]] = [[] for _ in texts]
    if not words:
        return out
    ends = np.repeat(stops, sizes)
    order, classes = suffix_order(np.array(words, dtype=np.int64), ends)
    if not len(order):
        return out
    shared = common_prefixes(words, ends, order, classes)
    for p, d, l in seeds(order, shared):
        if l + d < max(LEAST, TIMES * d):
            continue
        text = int(np.searchsorted(stops, p, side="right"))
        start = p - int(stops[text] - sizes[text])
        if start == 0 or words[p - 1] != words[p - 1 + d]:
            out[text].append((start, d + l, d))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that repeat a run's first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join(words[i] for i in np.flatnonzero(keep).tolist())


RUNS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, runs, collapsed`` of every row: all runs, and the text without what repeats in them."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def found(names: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        every = runs_of(texts)
        listed = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in every], kind)
        kept = pa.array([collapse(t, r).decode() for t, r in zip(texts, every, strict=True)], pa.string())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), listed, kept], names=["doc_id", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts, held = [], [], 0
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                names.append(name)
                texts.append((text or "").encode().split())  # bytes split at exactly these six characters
                held += len(texts[-1])
                if held >= BATCH_WORDS:
                    yield found(names, texts)
                    names, texts, held = [], [], 0
            if names:
                yield found(names, texts)

    return rows.mapInArrow(run, RUNS)


def with_planted(text: Column, doc_id: Column) -> Column:
    """The text, or for each tenth id (by checksum) its words repeated periodically from a place that the id decides."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")

        def rebuilt(w: Column) -> Column:
            a = w["a"]
            p = 1 + F.floor((w["n"] - a) / (3 + g % 8))
            from_ = F.transform(F.sequence(F.lit(0).cast("long"), w["n"] - 1), lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i))
            return F.array_join(F.transform(from_, lambda i: F.get(w["words"], i.cast("int"))), " ")

        some = F.struct(words.alias("words"), n.alias("n"), (g % F.greatest(n, F.lit(1))).alias("a"))
        return F.when(n > 0, let(some, rebuilt)).otherwise("")

    split = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when(h % 10 == 0, let(split, repeated)).otherwise(text)


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    """Runs of all documents, with repeats planted in a tenth of them."""
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", with_planted(F.col("text"), F.col("doc_id")).alias("text")))
    first = F.sort_array(F.transform("runs", lambda r: F.struct((-r["length"]).alias("rank"), r["start"].alias("start"), r["period"].alias("period"))))[0]
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(""))
    return found.withColumn("best", F.when(F.size("runs") > 0, first)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.rank")).alias("length"),
        F.col("best.period").alias("period"), F.floor(-1000 * F.col("best.rank") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
