"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the bag of its subwords: the letter n-grams of 1 to 4 characters inside every
word, the word's two ends counting as characters.  Each subword is hashed to one of
``BUCKETS`` embeddings; the embeddings are averaged and a linear layer with a softmax
gives the languages' probabilities.  Embeddings and layer are trained together by
stochastic gradient descent in numpy.

Training reads a bounded sample of labelled rows: by a hash of id and text, ``SAMPLE`` rows of
each language at most are expected, whatever the size of the table; equal rows count once.  Executors turn whole texts
into subword counts; only these (at most ``BUCKETS`` numbers a text) come to the driver.
A fifth of the sample is kept from training to calibrate: a temperature makes the
probabilities of a few subwords drawn from each of these texts honest, and a text is
rejected if its calibrated score is below what all but ``REJECTED`` of these draws reach (with too
few of them: below an even chance), or if it has no letters.  Texts of other languages,
scripts and noise score about as low as ``languages`` allows; one close to a learned
language may pass as that one.

Prediction is a sum of one table row per subword (embedding times layer is folded into
one matrix of buckets by languages), over whole texts and in bounded memory: very long
texts go through in pieces, cut where no n-gram is lost.

Missing texts and texts without letters are ``und`` with score 0.  Rows are judged one by
one, so ties, repeated rows and clashing column names do not matter; an empty table gives
no rows.  Without any labelled row everything is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hedonic.llm.common import query, table, unused

BUCKETS = 1 << 14
DIM = 16
ORDERS = (1, 2, 3, 4)
#: Expected rows of each language to train and calibrate on.
SAMPLE = 700
#: Share of the held-back texts' short draws, rightly told, that may fall below the threshold.  Whole texts score higher.
REJECTED = 0.001
#: Subwords drawn from each held-back text to calibrate on; whole texts are hardly ever in doubt.
THIN = 24
#: Such draws from each of these texts.
DRAWS = 10
#: Characters hashed at a time.
PIECE = 1 << 16
UNKNOWN = "und"

_FOLDED: np.ndarray | None = None


def _folded() -> np.ndarray:
    """Lower case of each character of the basic plane that is a letter, 0 for others."""
    global _FOLDED
    if _FOLDED is None:
        found = np.zeros(1 << 16, dtype=np.uint32)
        for code in range(1 << 16):
            c = chr(code)
            if c.isalpha():
                low = c.lower()
                found[code] = ord(low) if len(low) == 1 else code
        _FOLDED = found
    return _FOLDED


def letters(text: str) -> np.ndarray:
    """Folded characters, 0 standing for everything that is no letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if len(codes) and codes.max() >= 1 << 16:
        low = np.minimum(codes, (1 << 16) - 1)
        beyond = np.array([chr(c).isalpha() for c in codes[codes >= 1 << 16].tolist()])
        out = _folded()[low]
        out[codes >= 1 << 16] = np.where(beyond, codes[codes >= 1 << 16], 0)
        return out
    return _folded()[codes]


def subwords(text: str | None) -> Iterator[np.ndarray]:
    """Bucket numbers of all subwords of a text, piece by piece."""
    if not text:
        return
    most = max(ORDERS)
    for start in range(0, len(text), PIECE):
        # Some characters before and after, so that n-grams over the cut are seen, once.
        before = min(start, 1)
        piece = letters(text[start - before : start + PIECE + most])
        yield _hash(piece, before, min(PIECE, len(text) - start))


def _hash(codes: np.ndarray, before: int, starts: int) -> np.ndarray:
    """N-grams of word characters and word ends that start at one of ``starts`` places."""
    codes = np.concatenate([np.zeros(1 - before, np.uint32), codes, np.zeros(1, np.uint32)])
    word = codes != 0
    if not word.any():
        return np.zeros(0, dtype=np.int64)
    # Place 0 is the character before the first start; a gram may begin at the blank before a word.
    first = 0 if before == 0 else 1
    size = min(starts + 1 - first, len(codes))
    found = []
    value = np.zeros(len(codes), dtype=np.uint32)
    inner = np.ones(len(codes), dtype=bool)
    for order in range(1, max(ORDERS) + 1):
        k = len(codes) - order + 1
        if k <= 0:
            break
        value = value[:k] * np.uint32(0x9E3779B1) + codes[order - 1 :] + np.uint32(order)
        if order > 2:
            inner = inner[:k] & word[order - 2 : order - 2 + k]
        # A gram holds a letter, and blanks only at its ends.
        good = inner[:k] if order > 2 else word[:k] if order == 1 else word[:k] | word[1:]
        if order in ORDERS:
            mixed = value ^ (value >> np.uint32(15))
            mixed = (mixed * np.uint32(0x85EBCA6B)) >> np.uint32(18)
            found.append(mixed[first : first + size][good[first : first + size]])
    return np.concatenate(found).astype(np.int64)


def counts_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and how often each is hit."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for found in subwords(text):
        total += np.bincount(found, minlength=BUCKETS)
    at = np.flatnonzero(total)
    return at, total[at]


@dataclass(frozen=True)
class Model:
    """``weights``: buckets by languages, the embeddings already taken through the layer."""

    languages: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated score, and whether to reject the text."""
        total, n = np.zeros(len(self.languages)), 0
        if self.languages:
            for found in subwords(text):
                total += self.weights[found].sum(axis=0, dtype=np.float64)
                n += len(found)
        if n == 0:
            return UNKNOWN, 0.0, True
        p = _softmax((total / n + self.bias)[None] / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.threshold)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(
    features: list[tuple[np.ndarray, np.ndarray]],
    labels: list[str],
    *,
    epochs: int = 12,
    steps: int = 500,
    rate: float = 30.0,
    batch: int = 64,
    rejected: float = REJECTED,
    seed: int = 0,
) -> Model:
    """Train on subword counts, for some epochs and at least some steps, and calibrate on every fifth row."""
    languages = tuple(sorted(set(labels)))
    rng = np.random.default_rng(seed)
    y = np.array([languages.index(v) for v in labels], dtype=np.int64)
    held = np.zeros(len(y), dtype=bool)
    held[rng.permutation(len(y))[::5]] = len(y) >= 50
    embed = rng.normal(0, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer = np.zeros((DIM, len(languages)), dtype=np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)
    rows, onehot = np.flatnonzero(~held), np.eye(len(languages), dtype=np.float32)[y]
    # Few rows are gone over more often.
    steps = max(steps, epochs * -(-len(rows) // batch))
    order = np.concatenate([rng.permutation(rows) for _ in range(-(-steps * batch // len(rows)))])
    for epoch in range(steps):
        step = rate * (1 - epoch / steps)
        part = order[epoch * batch : (epoch + 1) * batch]
        x = np.zeros((len(part), BUCKETS), dtype=np.float32)
        for row, i in zip(x, part.tolist(), strict=True):
            at, n = features[i]
            row[at] = n / n.sum()
        mean = x @ embed
        off = (_softmax(mean @ layer + bias) - onehot[part]) / len(part)
        back = off @ layer.T
        bias -= 0.02 * step * off.sum(axis=0)
        layer -= 0.05 * step * (mean.T @ off)
        embed -= step * (x.T @ back)
    weights = (embed @ layer).astype(np.float32)
    truth, few = [], []
    for i in np.flatnonzero(held if held.any() else ~held).tolist():
        at, n = features[i]
        draws = rng.choice(at, (DRAWS, THIN), p=n / n.sum())
        few += list(weights[draws].mean(axis=1))
        truth += [y[i]] * DRAWS
    logits, truth = np.array(few) + bias, np.array(truth)
    best, temperature = np.inf, 1.0
    for t in np.geomspace(0.02, 20, 60):
        loss = -np.log(np.maximum(_softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean()
        if loss < best:
            best, temperature = loss, float(t)
    p = _softmax(logits / temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == truth])
    # With few rows the quantile would be the weakest of them all, which says nothing.
    at = int(len(right) * rejected)
    threshold = float(right[at]) if at else 1 / max(len(languages), 1)
    return Model(languages, weights, bias.astype(np.float64), temperature, threshold)


def train(
    labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", sample: int = SAMPLE
) -> Model:
    """A model of the non-null labels of ``labelled``."""
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"))
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    shares = {k: min(1.0, sample / n) for k, n in sizes.items()}
    share = F.coalesce(*[F.when(F.col("label") == k, F.lit(v)) for k, v in sorted(shares.items())])
    # Drawn by id and text, copies once, so that no row without an id and no family of copies comes as a whole.
    drawn = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < share * (1 << 30)).dropDuplicates(["id", "text", "label"])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [counts_of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("label"),
                    pa.array([a for a, _ in got], pa.list_(pa.int32())),
                    pa.array([n for _, n in got], pa.list_(pa.int32())),
                ],
                names=["id", "label", "at", "n"],
            )

    # Collected as Arrow: as rows, every number would be an object in the driver's JVM and in Python.
    found = drawn.mapInArrow(features, "id string, label string, at array<int>, n array<int>").toArrow().combine_chunks()
    found = found.filter(pc.greater(pc.list_value_length(found["at"]), 0))
    sizes = pc.list_value_length(found["at"]).to_numpy()
    at, n = (pc.list_flatten(found[c]).to_numpy() for c in ("at", "n"))
    ends = np.cumsum(sizes)
    rows = pd.DataFrame({"id": found["id"].to_pandas(), "label": found["label"].to_pandas(), "first": at[ends - sizes]})
    rows = rows.sort_values(["id", "label", "first"])
    cuts = [(ends[i] - sizes[i], ends[i]) for i in rows.index]
    return fit([(at[i:j], n[i:j]) for i, j in cuts], rows["label"].tolist())


def identify(docs: DataFrame, model: Model, *, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` (names prefixed by ``prefix``)."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([shipped.value.predict(t) for t in batch], columns=["lang_pred", "score", "rejected"])

    judge = F.pandas_udf(predict, "lang_pred string, score double, rejected boolean")
    found = unused("_judged", docs)
    judged = docs.withColumn(found, judge(F.col(text_col).cast("string")))
    names = [(f"{prefix}{c}", F.col(f"{found}.{c}")) for c in ("lang_pred", "score", "rejected")]
    return judged.withColumns(dict(names)).drop(found)


def held_out(id_col: str = "doc_id"):
    """The third of all documents that nothing is learned from; a row without an id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@query("op3_language")
def op3_language(spark, sf_dir):
    """The language of all documents, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    judged = identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return judged.select("doc_id", "held_out", "lang_pred", "score", "rejected")
