"""Benchmark decontamination with a BM25 index of the test items and block-max pruning.

The test items are the indexed side and the training texts the queries.  Every text is cut
into passages of ``PASSAGE`` words, each half over its predecessor.  A passage retrieves
every item whose BM25 score for the passage's words is at least ``SCORE`` of what the item
scores for its own words.  Scores are divided by that own goal when the index is built, so
one threshold of 1 holds for all items and the largest contributions of a block of items
bound every item in it (block-max WAND): for all passages of a text at once, the bound of
each block comes from running sums of its terms' block maxima, and blocks below the threshold
are skipped.  In the others the items' exact scores are added up term by term.

Items that pass are verified on word five-grams of the whole text: the last sentence of an
item is its answer, the rest its question (an item of one sentence has only a question).
A text is contaminated by an item if it holds at least ``OVERLAP`` of the question's
five-grams and of the answer's, or of the whole item's and something of either; parts with
fewer than five words count as one n-gram of all their words.  Scripts without blanks have
a word for each letter.

Items come as a table of any size.  They are read in slices of at most ``SLICE_WORDS``
words, so that what is broadcast has a proven bound; each slice is one pass over the
texts.  Benchmarks are far smaller than corpora, and usually fit one slice.

Missing and empty texts and items match nothing.  Repeated rows are reported once.  Items
with equal text each get their matches.  An empty table on either side gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hedonic.llm.common import query, table
from hedonic.session import settle

PASSAGE = 32
SCORE = 0.45
OVERLAP = 0.8
K1, B = 1.2, 0.75
#: Items bounded together.
BLOCK = 16
#: Words of items in one broadcast index.
SLICE_WORDS = 1_000_000
#: Blocks whose bounds are added up together.
BAND = 64
NGRAM = 5

#: What ends a sentence.
SENTENCE_END = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])\s*")
#: Scripts written without blanks, each letter of which is a word (Thai to Khmer, kana, Han).
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(r"[^\W_]+")
LETTER_OR_WORD = re.compile(rf"(?=[{UNSPACED}])[^\W_]|[^\W_{UNSPACED}]+")

MATCHES = (
    "doc_id long, item_id long, score double, passage long, question_overlap double, answer_overlap double, overlap double"
)


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    low = text.lower()
    # Most texts have no such letter, which is seen faster than looked for at every place.
    spaced = low.isascii() or max(low) < UNSPACED[0]
    return (WORD if spaced else LETTER_OR_WORD).findall(low)


def ngrams(words: list[str]) -> set[tuple[str, ...]]:
    if not words:
        return set()
    return {tuple(words[i : i + NGRAM]) for i in range(max(1, len(words) - NGRAM + 1))}


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of an item without its last sentence, and of its last sentence."""
    parts = [w for w in map(words_of, SENTENCE_END.split(text.strip())) if w]
    if len(parts) < 2:
        return (parts[0] if parts else []), []
    return [w for p in parts[:-1] for w in p], parts[-1]


class Index:
    """BM25 contributions of words to items, as shares of each item's goal, and their block maxima."""

    def __init__(self, items: list[tuple[int, str]], share: float = SCORE):
        # Items with like words share blocks, which keeps the blocks' bounds low.
        kept = [(i, words_of(t)) for i, t in items]
        kept = sorted(((i, w) for i, w in kept if w), key=lambda x: (x[1], x[0]))
        self.item_ids = [i for i, _ in kept]
        self.texts = dict(items)
        self.terms: dict[str, int] = {}
        counts = [Counter(w) for _, w in kept]
        for c in counts:
            for w in c:
                self.terms.setdefault(w, len(self.terms))
        n, size = len(kept), len(self.terms)
        self.blocks = -(-n // BLOCK)
        present = np.zeros(size)
        for c in counts:
            present[[self.terms[w] for w in c]] += 1
        idf = np.log1p((n - present + 0.5) / (present + 0.5))
        mean = sum(len(w) for _, w in kept) / max(n, 1)
        lists: list[dict[int, float]] = [{} for _ in range(size)]
        for at, ((_, w), c) in enumerate(zip(kept, counts, strict=True)):
            norm = K1 * (1 - B + B * len(w) / mean)
            own = {self.terms[x]: idf[self.terms[x]] * f * (K1 + 1) / (f + norm) for x, f in c.items()}
            # A passage holds at most so many distinct words: a longer item is not asked for more.
            best = sorted(own.values(), reverse=True)[:PASSAGE]
            goal = share * sum(best)
            for t, v in own.items():
                lists[t][at] = v / goal
        # Block maxima of a band of blocks, with a row for each term that occurs there and one for all others:
        # no more rows than the band's items have words, whatever the vocabulary.
        rows: list[dict[int, int]] = [{} for _ in range(0, self.blocks, BAND)]
        for t, found in enumerate(lists):
            for at in found:
                held = rows[at // (BLOCK * BAND)]
                held.setdefault(t, len(held) + 1)
        self.bands = [(held, np.zeros((len(held) + 1, BAND), dtype=np.float32)) for held in rows]
        # Postings by (term, block): where the block's items start.
        self.postings: list[dict[int, tuple[np.ndarray, np.ndarray]]] = []
        for t, found in enumerate(lists):
            by: dict[int, list[tuple[int, float]]] = {}
            for at, v in found.items():
                by.setdefault(at // BLOCK, []).append((at % BLOCK, v))
            self.postings.append({b: (np.array([a for a, _ in x]), np.array([v for _, v in x])) for b, x in by.items()})
            for b, x in by.items():
                held, maxima = self.bands[b // BAND]
                maxima[held[t], b % BAND] = max(v for _, v in x)

    def retrieve(self, words: list[str]) -> dict[int, tuple[float, int]]:
        """Best score and first word of that passage, for every item some passage retrieves."""
        none = len(self.terms)
        ids = np.fromiter(map(self.terms.get, words, [none] * len(words)), dtype=np.int64, count=len(words))
        starts = np.arange(0, max(len(words) - PASSAGE // 2, 1), PASSAGE // 2)
        ends = np.minimum(starts + PASSAGE, len(words))
        out: dict[int, tuple[float, int]] = {}
        # Passages with too few known words cannot reach any goal; the bounds say so.
        for band, (held, maxima) in enumerate(self.bands if len(ids) else []):
            lo = band * BAND
            at = np.fromiter(map(held.get, ids.tolist(), repeat(0)), dtype=np.int64, count=len(ids))
            # A repeated word counts once in a score and more often in the bound, which only grows.
            half = np.add.reduceat(maxima[at], starts, axis=0)
            bound = half.copy()
            bound[:-1] += half[1:]
            for p, b in np.argwhere(bound >= 1 - 1e-4).tolist():
                found, score = self._scores(ids[starts[p] : ends[p]], lo + b)
                for i, s in zip(found, score, strict=True):
                    item = self.item_ids[i]
                    if s >= 1 and s > out.get(item, (0.0, 0))[0]:
                        out[item] = (s, int(starts[p]))
        return out

    def _scores(self, ids: np.ndarray, block: int) -> tuple[list[int], list[float]]:
        """Scores of the items of one block for the distinct terms of a passage."""
        total = np.zeros(BLOCK)
        for t in set(ids.tolist()) - {len(self.terms)}:
            found = self.postings[t].get(block)
            if found is not None:
                total[found[0]] += found[1]
        good = np.flatnonzero(total >= 1 - 1e-9)
        return (block * BLOCK + good).tolist(), np.maximum(total[good], 1.0).tolist()


class Verifier:
    """Shares of items' question and answer n-grams that a text holds."""

    def __init__(self, items: dict[int, str]):
        self.items, self.known = items, {}

    def parts(self, item: int) -> tuple[set, set, set]:
        if item not in self.known:
            text = self.items[item]
            question, answer = question_and_answer(text)
            self.known[item] = (ngrams(question), ngrams(answer), ngrams(words_of(text)))
        return self.known[item]

    def shares(self, item: int, words: list[str]) -> tuple[float, float | None, float]:
        found = [self._share(part, words) for part in self.parts(item)]
        return found[0], found[1], found[2]

    @staticmethod
    def _share(part: set, words: list[str]) -> float | None:
        if not part:
            return None
        size = len(next(iter(part)))
        have = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        return len(part & have) / len(part)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    overlap: float = OVERLAP,
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """:data:`MATCHES`: every document and item that match, with the best passage's score and place."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = items.where(F.col(item_text).isNotNull() & F.col(item_id).isNotNull())
    known = known.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).cast("string").alias("text")).distinct()
    known = known.withColumn("words", F.size(F.split("text", r"\s+")))
    slices = -(-int(known.agg(F.sum("words")).first()[0] or 0) // slice_words)
    part = F.pmod(F.xxhash64("id", "text"), F.lit(max(slices, 1)))
    found = [spark.createDataFrame([], MATCHES)]
    for k in range(slices):
        rows = known.where(part == k).orderBy("id", "text").collect()
        found.append(_matches(texts, [(r.id, r.text) for r in rows], overlap))
        if slices > 1:
            found[-1] = settle(found[-1])
    return reduce(DataFrame.unionByName, found[1:] or found).distinct()


class _Items:
    """Items as they are broadcast; a worker process makes their index once."""

    def __init__(self, items: list[tuple[int, str]]):
        # An id may come with several texts; positions tell them apart until the rows are made.
        self.numbered, self.names = list(enumerate(t for _, t in items)), [i for i, _ in items]

    @cached_property
    def made(self) -> tuple[Index, Verifier]:
        return Index(self.numbered), Verifier(dict(self.numbered))


def _matches(texts: DataFrame, items: list[tuple[int, str]], overlap: float) -> DataFrame:
    shipped = texts.sparkSession.sparkContext.broadcast(_Items(items))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, (index, verifier) = shipped.value.names, shipped.value.made
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                if not words or not index.blocks:
                    continue
                for item, (score, at) in index.retrieve(words).items():
                    question, answer, whole = verifier.shares(item, words)
                    parts = [s for s in (question, answer) if s is not None]
                    if min(parts) >= overlap or (whole >= overlap and min(parts) > 0):
                        out.append((doc, names[item], score, at, question, answer, whole))
            columns = list(zip(*out, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
            fields = ["doc_id", "item_id", "score", "passage", "question_overlap", "answer_overlap", "overlap"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=fields)

    return texts.mapInArrow(match, MATCHES)


@query("op9_decontamination")
def op9_decontamination(spark, sf_dir):
    """Every pair of a document and a benchmark item whose question and answer it holds."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
