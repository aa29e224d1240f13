"""Language, fingerprints, licenses, decontamination and main text, against brute force."""

import hashlib
import html
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hedonic.llm import extract as ex
from hedonic.llm.decontaminate import Index, contamination, ngrams, op9_decontamination, question_and_answer, words_of
from hedonic.llm.fingerprints import as_hex, delete, insert, lanes, likeness, op7_fingerprints
from hedonic.llm.language import PIECE, Model, counts_of, fit, held_out, identify, op3_language, subwords, train
from hedonic.llm.licenses import TEMPLATES, license_matches, op8_licenses
from tests.llm.conftest import SF_DIR


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# --- language


def test_subwords_do_not_depend_on_pieces():
    text = "Größe naïve  x1y 日本 a " * 9000 + "end"
    assert len(text) > 2 * PIECE
    whole = Counter()
    padded = f" {text} ".lower()
    for n in (1, 2, 3, 4):
        whole[n] = sum(
            1 for i in range(len(padded) - n + 1)
            if (g := padded[i : i + n]) and any(c.isalpha() for c in g) and all(c.isalpha() for c in g[1:-1]) and (n > 1 or g.isalpha())
        )
    assert sum(len(x) for x in subwords(text)) == sum(whole.values())


def test_language_query_on_held_out_documents(spark, tables):
    got = op3_language(spark, SF_DIR).toPandas().set_index("doc_id").sort_index()
    docs = tables("documents").toPandas().set_index("doc_id").sort_index()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.index]).all()
    test = got[got["held_out"]]
    assert (test["lang_pred"] == docs["lang"][test.index]).mean() > 0.95
    assert got["score"].between(0, 1).all() and got["rejected"].mean() < 0.02


def test_scores_are_calibrated_and_rejection_spares_good_texts():
    rng = np.random.default_rng(0)
    words = {"aa": ["the", "and", "this"], "bb": ["und", "der", "nicht"]}
    texts = [(" ".join(rng.choice(words[k], 30)), k) for k in ("aa", "bb") for _ in range(100)]
    model = fit([counts_of(t) for t, _ in texts], [k for _, k in texts])
    judged = [model.predict(t) for t, _ in texts]
    assert all(g[0] == k and not g[2] for g, (_, k) in zip(judged, texts))
    assert model.predict("1 2 3") == ("und", 0.0, True) and model.predict(None)[2]
    assert model.predict("zzz qqq")[1] < min(g[1] for g in judged)


def test_unlearned_languages_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = train(docs.where(~held_out()))
    others = [
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью",
        "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    ]
    assert [model.predict(t)[2] for t in others] == [True] * 2
    judged = identify(docs.where(held_out() & F.col("lang").isNotNull()), model)
    assert judged.where("rejected AND lang_pred != 'und'").count() <= 0.005 * judged.count()


def test_training_rows_reach_the_driver_as_arrow(spark, monkeypatch):
    """Numbers collected as rows were objects, some hundreds of megabytes of them."""

    def refuse(*_):
        raise AssertionError("rows collected as objects")

    docs = spark.createDataFrame([(i, "der hund und die katze" if i % 2 else "the dog and the cat", "de" if i % 2 else "en") for i in range(8)], "doc_id long, text string, lang string")
    monkeypatch.setattr(type(docs), "toPandas", refuse)
    assert train(docs, sample=10**9).languages == ("de", "en")


def test_language_of_odd_rows(odd, none):
    model = train(odd)
    got = identify(odd, model, prefix="_")
    assert got.columns == [*odd.columns, "_lang_pred", "_score", "_rejected"]
    rows = got.select("doc_id", "text", "_lang_pred", "_rejected").collect()
    assert len(rows) == odd.count()
    assert all((r._lang_pred == "und") == (not re.search("[a-zA-Z]", r.text or "")) for r in rows)
    assert train(none).languages == () and identify(none, model).count() == 0
    assert identify(odd, Model((), np.zeros((1, 0)), np.zeros(0), 1.0, 0.0)).where("lang_pred <> 'und'").count() == 0


# --- fingerprints


def test_fingerprint_query(spark, tables):
    got = op7_fingerprints(spark, SF_DIR).toPandas().set_index("doc_id")
    docs = tables("documents").toPandas().sort_values("doc_id", ascending=False)
    ids, texts = docs["doc_id"].tolist(), docs["text"].tolist()
    for i, (doc, text) in enumerate(zip(ids, texts)):
        k, after = len(text) // 3, texts[(i + 1) % len(texts)]
        edited = text[: len(text) - k] + after[:k]
        assert got.edited_sha256[doc] == hashlib.sha256(edited.encode()).hexdigest() and got.n_chars[doc] == len(text)
    by_text = dict(zip(ids, texts))
    assert got["fingerprint"].nunique() == len(set(texts))
    assert all(got.loc[[d for d in ids if by_text[d] == t], "fingerprint"].nunique() == 1 for t in set(texts))
    assert (got["near_edited"] > got["near_next"]).mean() >= 0.94
    assert got["near_edited"].mean() > 0.5 and got["near_next"].mean() < 0.1


def test_likeness_is_about_the_cosine_of_paragraph_counts(spark):
    rng = np.random.default_rng(2)
    pairs = [(rng.choice(40, 30).tolist(), rng.choice(60, 30).tolist()) for _ in range(60)]
    join = lambda x: "\n".join(f"paragraph {i}" for i in x)
    df = spark.createDataFrame([(i, join(a), join(b)) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [r[1] for r in df.select("i", likeness(lanes(F.col("a")), lanes(F.col("b")))).orderBy("i").collect()]
    for (a, b), g in zip(pairs, got):
        x, y = np.bincount(a, minlength=60), np.bincount(b, minlength=60)
        assert abs(g - x @ y / np.sqrt(x @ x * (y @ y))) < 0.35
    true = [(np.bincount(a, minlength=60) @ np.bincount(b, minlength=60)) for a, b in pairs]
    assert np.corrcoef(true, got)[0, 1] > 0.6


def test_sums_ignore_order_and_follow_edits(spark):
    a, b = "One here. Two there.\nThree!", "Four? Five\nOne here."
    df = spark.createDataFrame([(a, b, f"{b}\n{a}", "Three!\n\n Two there.   One here.")], "a string, b string, both string, turned string")
    row = df.select(
        as_hex(insert(lanes(F.col("a")), F.col("b"))).alias("inserted"), as_hex(lanes(F.col("both"))).alias("both"),
        as_hex(delete(lanes(F.col("both")), F.col("b"))).alias("deleted"), as_hex(lanes(F.col("a"))).alias("a"),
        as_hex(lanes(F.col("turned"))).alias("turned"), as_hex(lanes(F.col("b"))).alias("b"),
    ).first()
    assert row.inserted == row.both and row.deleted == row.a == row.turned != row.b


def test_fingerprints_of_odd_rows(odd, none):
    rows = odd.select("doc_id", "text", as_hex(lanes(F.col("text"))).alias("f")).collect()
    zero = {r.f for r in rows if not (r.text or "").strip()}
    assert len(zero) == 1 and set(zero.pop()) == {"0"}
    assert len({r.f for r in rows if r.text and r.text.startswith("Repeated")}) == 1
    assert none.select(lanes(F.col("text"))).count() == 0


def test_order_of_rows_with_ties_and_nulls(spark, odd, none):
    from hedonic.llm.fingerprints import with_next

    for size in (2, 4096):
        rows = with_next(odd.select("doc_id", "text"), ["text"], size).collect()
        assert len(rows) == odd.count() and all(r.next is not None for r in rows)
        following = {r.doc_id: r.next.doc_id for r in rows if r.doc_id not in (None, 7)}
        assert following == {9: 8, 8: 7, 6: 4, 4: 3, 3: 2, 2: 1, 1: None}
        assert next(r for r in rows if r.doc_id is None).next.doc_id == 9
    assert with_next(none.select("doc_id", "text"), ["text"]).count() == 0


def test_next_over_many_blocks_and_wide_gaps(spark):
    """Blocks of two ids over gaps of all sizes, ids under zero and at the ends of the type."""
    from hedonic.llm.fingerprints import with_next

    draw = random.Random(7)
    ids = {draw.getrandbits(draw.randrange(1, 63)) * draw.choice((-1, 1)) for _ in range(300)} | {2**63 - 1, -(2**63), 0}
    order = sorted(ids, reverse=True)
    df = spark.createDataFrame([(i, str(i), "kept") for i in ids], "doc_id long, text string, _block string")
    for size in (2, 256):
        rows = with_next(df, ["text"], size).collect()
        assert {r.doc_id: (r.next.doc_id, r.next.text, r._block) for r in rows} == {
            i: (j, str(j), "kept") for i, j in zip(order, [*order[1:], order[0]])
        } and len(rows) == len(ids)
    lost = with_next(spark.createDataFrame([(None, "a")], "doc_id long, text string"), ["text"]).collect()
    assert [r.next.text for r in lost] == ["a"]


def test_native_plans(spark):
    assert no_python(op7_fingerprints(spark, SF_DIR)) and no_python(op8_licenses(spark, SF_DIR))


# --- licenses


def norm(text):
    return " " + re.sub(r"[\W_]+", " ", (text or "").lower()).strip() + " "


def test_license_query(spark, tables):
    got = {(r.doc_id, r.template) for r in op8_licenses(spark, SF_DIR).collect()}
    want = {(r.doc_id, k) for r in tables("documents").collect() for k, t in TEMPLATES.items() if norm(t) in norm(r.text)}
    assert want and got == want


def test_license_containment_and_odd_rows(spark, odd, none):
    long = TEMPLATES["MIT"].split()
    texts = {
        1: " ".join(long), 2: " ".join(w if i % 40 else "x" for i, w in enumerate(long)), 3: " ".join(long[: len(long) // 2]),
        4: "a b c RELEASED under\nthe  mit -- license!! d e", 5: "released under the", 6: "filler words go here " * 3000 + TEMPLATES["MIT-notice"],
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r.doc_id, r.template): r.containment for r in license_matches(df).collect()}
    assert set(got) == {(1, "MIT"), (2, "MIT"), (4, "MIT-notice"), (6, "MIT-notice")}
    assert got[1, "MIT"] == 1.0 and 0.8 <= got[2, "MIT"] < 1.0
    assert license_matches(odd).count() == 0 and license_matches(none).count() == 0
    own = odd.withColumn("text", F.lit(TEMPLATES["GPL-3.0-notice"]))
    assert {r.doc_id for r in license_matches(own).collect()} == {r.doc_id for r in odd.collect()}


#: The license and rights lines that stand in the documents of the driver's tables, as they stand there.
LINES = [
    "All rights reserved.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.",
    "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.",
]


def test_lines_of_the_data_and_short_templates(spark, tables):
    texts = {r.doc_id: r.text for r in tables("documents").collect()}
    holding = {d for d, t in texts.items() if any(norm(line) in norm(t) for line in LINES)}
    assert {r.doc_id for r in license_matches(tables("documents")).collect()} == holding
    filler = [f"w{i}" for i in range(20)]
    placed = [" ".join([*filler[:k], line, *filler[k:n]]) for line in LINES for n in (0, 9, 20) for k in range(n + 1)]
    df = spark.createDataFrame(list(enumerate([*placed, "all rights", "rights reserved all"])), "doc_id long, text string")
    assert {r.doc_id for r in license_matches(df).collect()} == set(range(len(placed)))
    got = license_matches(df, {"one": "w3", "two": "w4 w5", "none": ""}).collect()
    assert {(r.doc_id, r.template) for r in got} == {
        (i, k) for i, t in enumerate(placed) for k, w in (("one", "w3"), ("two", "w4 w5")) if norm(w) in norm(t)
    }


# --- decontamination


def test_decontamination_query(spark, tables):
    items = {r.item_id: (*question_and_answer(r.text), words_of(r.text)) for r in tables("benchmark").collect()}
    want = set()
    for r in tables("documents").collect():
        words = words_of(r.text)
        for item, parts in items.items():
            shares = []
            for part in parts:
                grams = ngrams(part)
                size = min(5, len(part))
                have = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
                shares.append(len(grams & have) / len(grams) if grams else None)
            of = [s for s in shares[:2] if s is not None]
            if min(of) >= 0.8 or (shares[2] >= 0.8 and min(of) > 0):
                want.add((r.doc_id, item))
    got = {(r.doc_id, r.item_id) for r in op9_decontamination(spark, SF_DIR).collect()}
    assert want and got == want


def test_block_bounds_lose_nothing():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary, rng.integers(5, 60)))) for i in range(70)]
    index = Index(items)
    for _ in range(30):
        words = rng.choice(vocabulary, 80).tolist()
        at = rng.integers(0, 40)
        words[at : at + 20] = words_of(items[rng.integers(70)][1])[:20]
        got = index.retrieve(words)
        want = {}
        for p in range(0, max(len(words) - 16, 1), 16):
            ids = np.array([index.terms.get(w, len(index.terms)) for w in words[p : p + 32]])
            for b in range(index.blocks):
                for i, s in zip(*index._scores(ids, b)):
                    want[index.item_ids[i]] = max(s, want.get(index.item_ids[i], 0.0))
        assert {k: v[0] for k, v in got.items()} == want


def test_decontamination_of_edits_and_odd_rows(spark, odd, none):
    item = "What is the largest planet that goes around the sun in our own system of worlds? It is Jupiter, the great gas giant with its red spot."
    words = item.split()
    texts = {1: f"before {item} after", 2: " ".join(words[:12]), 3: item.upper().replace(" ", "\n"), 4: "x " * 500 + item + " y" * 500, 5: " ".join(words[::-1])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, item), (3, None), (4, ""), (None, item)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in contamination(docs, items).collect())
    assert got == [(d, i) for d in (1, 3, 4) for i in (1, 2)]
    assert sorted((r.doc_id, r.item_id) for r in contamination(docs, items, slice_words=10).collect()) == got
    assert contamination(odd, items).count() == 0
    assert contamination(none, items).count() == 0 and contamination(docs, items.where("false")).count() == 0
    only = spark.createDataFrame([(1, item.split("?")[0] + "? Something else follows here, of no use to anyone who asks.")], "doc_id long, text string")
    long = spark.createDataFrame([(9, item.split("? ")[0] + " " + " ".join(f"word{i}" for i in range(40)) + "? Jupiter, the great.")], "item_id long, text string")
    unanswered = spark.createDataFrame([(1, long.first().text.split("?")[0] + "? Nobody knows.")], "doc_id long, text string")
    assert contamination(only, items).count() == 0 and contamination(unanswered, long).count() == 0
    han = "中国最长的河流是哪一条河？它是从西藏流到上海的长江，全长六千多公里。"
    texts = [(1, "前面还有很多别的内容，" + han + "后面也还有一些。"), (2, "前面还有很多别的内容，后面也还有一些。")]
    found = contamination(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(5, han)], "item_id long, text string"))
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, 5)]
    assert question_and_answer("A b? C d. E f.") == (["a", "b", "c", "d"], ["e", "f"])


# --- main text


def test_extract_query(spark, tables):
    got = {r.page_id: (r.text, r.n_chars) for r in ex.op6_extract(spark, SF_DIR).collect()}
    for r in tables("pages").collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        plain = re.sub(r"<(/?)(\w+)[^>]*>", lambda m: "" if m[2] == "b" else " ", inner)
        want = " ".join(html.unescape(plain).split())
        assert got[r.page_id] == (want, len(want))


PAGE = """<html><head><title>T t</title><script>var a = "<p>no</p>";</script></head><body>
<header><h1>Site name</h1><p>Some words of a site that has a slogan to tell everyone about</p></header>
<div class="cookie-notice"><p>We use cookies and more cookies than you can count, please accept them all now</p></div>
<nav><ul><li><a href="/">Home</a></li><li><a href="/a">About us and others</a></li></ul></nav>
<div id="content"><h2>A title</h2><p>First &amp; second&nbsp;part of <b>bold</b>ness,   more words follow here.</p>
<aside><p>Buy this and that and everything else you never needed in your life</p></aside>
<ul><li>One point of the list</li><li>Another point of it</li></ul><!-- <p>hidden</p> -->
<form><p>Your name here please</p><input name="x"></form><p>Last words of the article, three < four.</p></div>
<section class="comments"><p>I do not like this at all and I want everyone to know about it right here</p></section>
<footer>All rights kept by somebody somewhere for a long time to come</footer></body></html>"""


def test_clutter_goes_and_lists_stay():
    for weights in (ex.Weights(), ex.Weights({"li": 2.0, "/li": 2.0, "p": 0.1, "/p": 0.1})):
        assert weights.text(PAGE) == (
            "A title First & second part of boldness, more words follow here. One point of the list Another point of it "
            "Last words of the article, three < four."
        )


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain words", "plain words"), ("<nav>only a menu</nav>", ""), ("a<br>b<i>c</i>d", "a bcd"),
    ("<article><p>open", "open"), ("<div><div class=ad>x y z</div><p>q", "q"), ("<!-- never closed <p>x", ""), ("<script>a b c", ""),
    ("<head><meta x><title>t</title><body><p>words", "words"), ("<form id=f><p>words of a page</p><nav>menu</nav></form>", "words of a page"),
    ("<div class='content has-sidebar'><p>many words of a page</p><div class=sidebar>few</div></div>", "many words of a page"),
    ("<p>own words</p><section class='comments'><article><p>not mine</p></article><article>nor mine, however long it may be</article></section>", "own words"),
    ("<article><p>own words of it</p></article><div class=related><article>another</article></div>", "own words of it"),
    ("<article>a b c d</article><article class=comment>not mine</article>", "a b c d"), ("<p title='a > b' x='>'>q", "q"), ("<p a=' >q", "q"), ("q <b", "q <b"),
    ("<p>&lt;p&gt; &#233;&eacute; &bogus;</p>", "<p> éé &bogus;"), ("<nav><article>in an open menu</article>", "in an open menu"),
])
def test_odd_pages(page, text):
    assert ex.Weights().text(page) == text


@pytest.mark.parametrize("part", ["<a '", "<a ='", "<a =\"'>", "<div>", "</script <", "<!--", "<p title=\"", "</div>", "<!", "<section class=x>"])
def test_broken_pages_take_linear_time(part):
    start = time.process_time()
    ex.Weights().text(part * 40_000 + "x > '")
    ex.counts_of("<article>" + part * 40_000)
    assert time.process_time() - start < 8


def test_extract_of_odd_rows(spark, odd, none):
    pages = odd.select(F.col("doc_id").alias("page_id"), F.col("text").alias("html"), "key", "at")
    weights = ex.fit(pages)
    got = ex.extract(pages, weights)
    assert got.columns == [*pages.columns, "text"]
    assert got.where("text IS NULL").count() == 0 and got.count() == odd.count()
    assert ex.fit(pages.where("false")) == ex.Weights({}, frozenset())
    assert ex.extract(pages.where("false"), weights).count() == 0
