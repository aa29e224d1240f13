"""Runs of periodic words against their definition."""

import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from hedonic.llm import periodic_runs as pr
from tests.llm.conftest import LONG, SF_DIR

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def every_run(words):
    """Maximal stretches of each period, kept where no smaller one fits."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            smaller = any(all(words[k] == words[k + p] for k in range(start, start + length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


letters = st.integers(1, 3).flatmap(lambda k: st.lists(st.sampled_from([b"a", b"b", b"c"][:k]), max_size=40))
repeats = st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=6), st.integers(1, 7)), max_size=5)
texts = st.one_of(letters, repeats.map(lambda parts: [w for words, n in parts for w in words * n]))


@settings(max_examples=400, deadline=None)
@given(st.lists(texts, max_size=5))
def test_runs_of_any_texts(batch):
    assert pr.runs_of(batch) == [every_run(t) for t in batch]


def test_suffix_order_is_that_of_the_suffixes():
    rng = np.random.default_rng(1)
    for _ in range(50):
        words = rng.integers(0, 3, 60)
        ends = np.repeat([20, 50, 60], [20, 30, 10])
        order, classes = pr.suffix_order(words, ends)
        for c in set(classes.tolist()):
            held = [tuple(words[p : ends[p]]) for p in order[classes == c].tolist()]
            assert held == sorted(held) and len({h[:2] for h in held}) == 1 and len(held) > 1
        shared = pr.common_prefixes(words.tolist(), ends, order, classes)
        for i in range(1, len(order)):
            if classes[i] == classes[i - 1]:
                a, b = words[order[i - 1] : ends[order[i - 1]]], words[order[i] : ends[order[i]]]
                n = min(len(a), len(b))
                differ = np.flatnonzero(a[:n] != b[:n])
                assert shared[i] == (differ[0] if len(differ) else n)


def planted(doc, words):
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]


def digests(doc, text):
    words = planted(doc, WORD.findall(text or ""))
    runs = every_run(words) if len(words) < 3000 else pr.runs_of([[w.encode() for w in words]])[0]
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    own = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc, len(runs), *own, *[hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]


def by_all(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def test_query_on_all_documents(spark, tables):
    want = [digests(r.doc_id, r.text) for r in tables("documents").collect()]
    assert sum(w[1] > 0 for w in want) > 5
    assert by_all(map(tuple, pr.op12_periodic_runs(spark, SF_DIR).collect())) == by_all(want)


def test_odd_rows(spark, odd, none, tmp_path):
    """Missing and repeated ids, missing, blank, one-word and very long texts."""
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = {(r.doc_id, r.collapsed): [tuple(x) for x in r.runs] for r in pr.periodic_runs(odd).collect()}
    assert len(got) == len(set(rows))
    assert got[4, "word"] == [(0, len(LONG.split()), 1)]
    assert got[2, ""] == got[3, ""] == got[9, ""] == []
    path = tmp_path / "odd"
    more = [*rows, *[(i, "x y\x1fz w one\v\ftwo " * (i % 5) + "tail" * (i % 2)) for i in range(10, 400)]]
    spark.createDataFrame(more, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    assert by_all(map(tuple, pr.op12_periodic_runs(spark, str(path)).collect())) == by_all([digests(*r) for r in more])
    assert pr.periodic_runs(none).count() == 0


def test_batches_of_few_words(odd, monkeypatch):
    whole = by_all((r.doc_id, str(r.runs)) for r in pr.periodic_runs(odd).collect())
    monkeypatch.setattr(pr, "BATCH_WORDS", 1)
    assert by_all((r.doc_id, str(r.runs)) for r in pr.periodic_runs(odd).collect()) == whole
