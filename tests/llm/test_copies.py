"""Near copies: components, the n-gram join, line deduplication, and the pipeline against brute force."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hedonic.llm import line_dedup as ld
from hedonic.llm import ngram_join as nj
from hedonic.llm.common import rows_near, rows_outside, rows_without, running_before
from hedonic.llm.components import components
from tests.llm.conftest import SF_DIR


class Forest(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def union(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def brute_links(sets):
    """Pairs of set names with a similarity of at least 0.8."""
    by = defaultdict(list)
    for name, s in sets.items():
        for x in s:
            by[x].append(name)
    met = {(a, b) for names in by.values() for a in names for b in names if a < b}
    return {(a, b) for a, b in met if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}


# --- helpers


@pytest.mark.parametrize("seed", [0, 1])
def test_components_of_random_links_chains_and_hubs(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)]
    links += [(i, i + 1) for i in range(1000, 1080)] + [(2000, i) for i in range(2001, 2100)] + [(5, 5), (7, 8), (8, 7), (7, 8)]
    forest = Forest()
    for a, b in links:
        if a != b:
            forest.union(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: forest.find(x) for x in list(forest)}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_sieves_and_running_sums(spark, odd):
    keys = spark.createDataFrame([(4,), (7,)], "doc_id long")
    near, far = rows_near(odd, keys, "doc_id", 3), rows_outside(odd, keys, "doc_id", 3)
    assert near.count() + far.count() == odd.count() and near.columns == far.columns == odd.columns
    assert near.where("doc_id IN (4, 7)").count() == 3
    assert sorted(r.doc_id or 0 for r in rows_without(odd, keys, "doc_id", 3).collect()) == [0, 1, 2, 3, 6, 8, 9]
    sums = running_before(spark.range(50).withColumn("v", F.col("id") * 2), "id", "v", "s", each=7)
    assert [tuple(r) for r in sums.orderBy("id").collect()] == [(i, i * (i - 1)) for i in range(50)]


# --- n-gram join


def sets_of(rows):
    out = {}
    for doc, text in rows:
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall("[^\x20\x09-\x0D]+", folded)
        k = min(5, len(words))
        out[doc] = frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()
    return out


def brute_components(rows):
    sets = sets_of(rows)
    forest = Forest()
    for doc in sets:
        forest.find(doc)
    for a, b in brute_links({d: s for d, s in sets.items() if s}):
        forest.union(a, b)
    return {d: (len(s), forest.find(d)) for d, s in sets.items()}


def joined(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in nj.ngram_components(df).collect()}


def test_ngram_query(spark, tables):
    rows = [(r.doc_id, r.text) for r in tables("documents").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.op4_ngram_join(spark, SF_DIR).collect()}
    assert got == brute_components(rows)


def family(seed, n, length, edits):
    """Copies of a text with some words replaced: similarities on both sides of the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(length)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_small_sets_large_sets_and_families(spark):
    texts = family(1, 60, 150, 5) + family(2, 25, 40, 2) + [t for s in range(12) for t in family(10 + s, 6, 6 + s, 1)]
    texts += ["", "  \n", "one", "ONE", "one two three", "one two  three", "İ ı É é", texts[0].upper(), texts[3].replace(" ", "\n\t")]
    rows = list(enumerate(texts))
    random.Random(0).shuffle(rows)
    assert joined(spark.createDataFrame(rows, "doc_id long, text string")) == brute_components(rows)


def test_every_boundary_gives_the_same_links(spark, monkeypatch):
    rows = list(enumerate([t for s in range(30) for t in family(s, 4, 5 + s % 16, 1)]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows)
    for boundary in (1, 8, 17):
        monkeypatch.setattr(nj, "choose_boundary", lambda sizes, b=boundary: b)
        assert joined(df) == want


def test_an_id_with_several_texts_links_by_each(spark):
    a, b = family(21, 2, 150, 2), family(22, 2, 12, 0)
    rows = [(5, a[0]), (5, b[0]), (8, a[1]), (9, b[1]), (5, a[0]), (None, a[0]), (2, "alone with these words here and there")]
    got = sorted(((r.doc_id or 0, r.component_id) for r in nj.ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(5, 5)] * 3 + [(8, 5), (9, 5), (0, None), (2, 2)], key=str)


def test_a_family_on_both_sides_of_the_threshold_meets_in_few_pairs(spark, monkeypatch):
    rows = list(enumerate(family(31, 250, 150, 9)))
    want, made, meeting = brute_components(rows), [], nj._meeting

    def counted(open_):
        made.append(meeting(open_).count())
        return meeting(open_)

    monkeypatch.setattr(nj, "_meeting", counted)
    assert joined(spark.createDataFrame(rows, "doc_id long, text string")) == want
    # Copies too far from the leader share keys with all others; their differences tell that they link with none.
    assert made[0] <= 20 * len(rows) < len(rows) ** 2 // 10


def test_boundary_follows_cost():
    assert nj.choose_boundary({10: (5, 10**9)}) > 10
    assert nj.choose_boundary({16: (10**6, 1)}) <= 16
    assert nj.needed(5, 5) == 5 and nj.needed(100, 100) == 89 and nj.needed(4, 5) == 4


def test_ngram_join_of_odd_rows(odd, none):
    rows = nj.ngram_components(odd).collect()
    assert len(rows) == odd.count()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got[7] == got[8] == (3, 7) and got[2] == (0, 2) and got[3] == (0, 3) and got[9] == (0, 9) and got[4] == (1, 4)
    assert got[None][1] is None
    assert nj.ngram_components(none).count() == 0


# --- lines


def fold(line):
    return re.sub(r"\s+", " ", line.lower()).strip()


def full(line):
    """The shingles of eight characters at every character of a folded line."""
    return frozenset(line[i : i + 8] for i in range(max(len(line) - 7, 1)))


def brute_lines(docs):
    """``doc -> text`` after deduplication, None for documents that go."""
    docs = sorted(docs)
    first, keys = {}, defaultdict(list)
    for doc, text in docs:
        for at, line in enumerate(text.split("\n")):
            if fold(line):
                keys[fold(line)].append((doc, at))
    names = {f: i for i, f in enumerate(keys)}
    forest = Forest()
    for i in names.values():
        forest.find(i)
    for a, b in brute_links({i: full(f) for f, i in names.items()}):
        forest.union(a, b)
    for f, places in keys.items():
        c = forest.find(names[f])
        first[c] = min(first.get(c, places[0]), places[0])
    out = {}
    for doc, text in docs:
        lines = text.split("\n")
        kept = [x for at, x in enumerate(lines) if fold(x) not in names or first[forest.find(names[fold(x)])] == (doc, at)]
        out[doc] = "\n".join(kept) if len(kept) == len(lines) or fold("\n".join(kept)) else None
    return {d: t for d, t in out.items() if t is not None}


def test_line_query(spark, tables):
    want = brute_lines([(r.doc_id, r.text) for r in tables("documents").collect()])
    got = {r.doc_id: r.text for r in ld.op5_line_dedup(spark, SF_DIR).collect()}
    # Bands may miss a link just above the threshold; links of equal lines are certain.
    assert sum(got.get(d) != want.get(d) for d in set(got) | set(want)) <= 1


def test_near_lines_chains_and_short_lines(spark):
    words = [f"word{i}" for i in range(60)]
    near = [" ".join([*words[:i], f"new{i}", *words[i + 1 :]]) for i in (3, 20, 40)]
    docs = {
        1: "short line\n" + " ".join(words), 2: near[0] + "\nshort line\nsomething else that is only here",
        3: near[1].upper() + "\n" + near[2].replace(" ", "   "), 4: "short line\nshort line", 5: "日本語" * 40, 6: "日本語" * 40 + "終",
    }
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in ld.dedup_lines(df).collect()}
    assert got == {1: docs[1], 2: "something else that is only here", 5: docs[5], 6: docs[6]}


def test_texts_of_a_repeated_id_keep_their_own_lines(spark):
    rows = [(7, "a line that comes back in places\nsome other line of text"), (7, "very important content that is nowhere else\nsome third line"),
            (7, "a line that comes back in places\nsome other line of text"), (3, "some other line of text"), (9, "some third line\nnew")]
    got = [(r.doc_id, r.text) for r in ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    first = (7, "a line that comes back in places")
    assert sorted(got) == sorted([first, first, (7, "very important content that is nowhere else\nsome third line"), (3, rows[3][1]), (9, "new")])


def test_family_of_lines(spark):
    rng = random.Random(4)
    rows = [(i, line) for i, line in enumerate(family(5, 80, 40, 3) + family(6, 20, 12, 1))]
    rng.shuffle(rows)
    got = {r.doc_id: r.text for r in ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(set(got) ^ set(brute_lines(rows))) <= 1


def test_short_lines_and_scripts_without_blanks(spark):
    han = "".join(chr(0x4E00 + 7 * i) for i in range(120))
    docs = {1: f"Home\n\n{han}\n\nAbout us", 2: f"{han}终\nabout  US\nonly here", 3: f"home\n{han}", 4: "Hone\n\n", 5: "a\nb\na"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in ld.dedup_lines(df).collect()}
    assert got == {1: docs[1], 2: "only here", 4: docs[4], 5: "a\nb"}


def test_links_follow_shingles_at_every_character(spark):
    rng = random.Random(8)
    lines = []
    for _ in range(150):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(8, 19))]
        line = " ".join(words)
        at = rng.randrange(len(line))
        lines += [line, line[:at] + "z" + line[at + 1 :]]
    lines += ["日本語の長い文章です" + "".join(chr(0x4E00 + i) for i in range(60)) + e for e in "😀終"] + ["tiny", "tin"]
    df = spark.createDataFrame(list(enumerate(lines)), "key long, folded string")
    for row in df.select("folded", ld.shingles(F.col("folded")).alias("s")).collect():
        assert frozenset(row.s) == full(row.folded)
    forest = Forest()
    for a, b in brute_links({i: full(f) for i, f in enumerate(lines)}):
        forest.union(a, b)
    want = {i: forest.find(i) for i in list(forest)}
    got = {r.key: r.component for r in ld.line_components(df).collect()}
    # Bands miss a link of similarity 0.8 in one of a hundred cases; they never add one.
    assert len(want) > 150 and got.items() <= want.items() and len(want) - len(got) <= 4


def test_unlike_variants_of_a_line_are_not_compared_in_pairs(spark, monkeypatch):
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    common = "".join(rng.choice(letters) for _ in range(120))
    lines = [common + "".join(rng.choice(letters) for _ in range(50)) for _ in range(60)]
    lines += [lines[0] + "x", lines[7][:-1]]
    asked, compared = [], ld._compared

    def counted(pairs, texts):
        asked.append(pairs.count())
        return compared(pairs, texts)

    monkeypatch.setattr(ld, "_compared", counted)
    df = spark.createDataFrame(list(enumerate(lines)), "key long, folded string")
    got = {r.key: r.component for r in ld.line_components(df).collect()}
    assert got.items() <= {0: 0, 60: 0, 7: 7, 61: 7}.items() and len(got) >= 2
    # Heads meet their bands' lines; of the rest only pairs that could be alike are left.
    assert 0 < asked[0] <= ld.BANDS * len(lines) and asked[1] <= 6


def edited(seed, n, length, edits):
    """Copies of a line of letters with some characters replaced: similarities on both sides of the threshold."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    base = [rng.choice(letters) for _ in range(length)]
    out = []
    for _ in range(n):
        line = list(base)
        for _ in range(rng.randrange(1, edits + 1)):
            line[rng.randrange(length)] = rng.choice(letters)
        out.append("".join(line))
    return out


def test_a_family_of_lines_on_both_sides_of_the_threshold_meets_in_few_pairs(spark, monkeypatch):
    lines = list(dict.fromkeys(edited(3, 200, 300, 9)))
    asked, compared, sieved, near = [], ld._compared, [], ld.rows_near

    def counted(pairs, texts):
        asked.append({tuple(sorted(r)) for r in pairs.select("u", "v").collect()})
        return compared(pairs, texts)

    def seen(df, *rest):
        sieved.append(df.columns)
        return near(df, *rest)

    monkeypatch.setattr(ld, "_compared", counted)
    monkeypatch.setattr(ld, "rows_near", seen)
    got = {r.key: r.component for r in ld.line_components(spark.createDataFrame(list(enumerate(lines)), "key long, folded string")).collect()}
    links = brute_links({i: full(f) for i, f in enumerate(lines)})
    forest = Forest()
    for a, b in links:
        forest.union(a, b)
    assert sum(got.get(i) != forest.find(i) for i in list(forest)) <= 2 and set(got) <= set(forest)
    # After the heads, what sets lines apart from their head tells the pairs that link; few others are read.
    assert len(asked) == 2 and len(asked[1]) > 50 and len(asked[1] - links) <= 0.1 * len(asked[1])
    # Bands have no sieve of all shared ones, which lets more and more strangers through.
    assert not any("band" in columns for columns in sieved)


def test_differences_from_a_head_never_hide_a_link(spark):
    lines = edited(5, 40, 120, 4) + edited(6, 20, 30, 2) + ["日本語の長い文章です" * 3, "日本語の長い文章です" * 2 + "x", "tiny"]
    texts = spark.createDataFrame(list(enumerate(lines)), "key long, folded string")
    for head in (0, 45):
        pairs = spark.range(len(lines)).where(f"id != {head}").select(F.col("id").alias("u"), F.lit(head).cast("long").alias("v"))
        rows = ld.settle(ld._compared(pairs, texts))
        for r in rows.collect():
            a, b = full(lines[r.u]), full(lines[r.v])
            assert (r.common, r.nu, r.nv) == (len(a & b), len(a), len(b)) and len(r.apart) <= len(a ^ b)
        about = rows.select(F.col("u").alias("key"), F.col("nu").alias("n"), "apart")
        both = about.alias("a").join(about.alias("b"), F.expr("a.key < b.key") & ld._may_link("a", "b", ld.LIKE))
        may = {tuple(r) for r in both.select("a.key", "b.key").collect()}
        want = brute_links({i: full(f) for i, f in enumerate(lines) if i != head})
        assert want <= may and len(may) <= len(want) + 5


def test_lines_of_odd_rows_and_native_plan(spark, odd, none):
    docs = odd.drop("key", "at", "line", "node", "label")
    got = ld.dedup_lines(docs)
    assert got.columns == docs.columns
    # Of equal lines under ids 7 and 8 the rows of 7 keep theirs; empty and missing texts stay.
    assert sorted(r.doc_id or 0 for r in got.collect()) == [0, 1, 2, 3, 4, 6, 7, 7, 9]
    assert ld.dedup_lines(odd).columns == odd.columns
    assert ld.dedup_lines(none).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# --- pipeline


def test_pipeline_stages(spark, tables):
    docs = tables("documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.dtypes == docs.dtypes
        before = {r.doc_id: r.text for r in docs.collect()}
        after = {r.doc_id: r.text for r in out.collect()}
        if name == "language":
            assert set(before) - set(after) <= {d for d, t in before.items() if not re.search(r"[^\W\d_]", t)}
        elif name == "line_dedup":
            want = brute_lines(list(before.items()))
            assert sum(after.get(d) != want.get(d) for d in set(after) | set(want)) <= 1
        elif name == "ngram_jaccard":
            assert set(after) == {d for d, (_, c) in brute_components(before.items()).items() if c == d}
        else:
            assert 0 < len(before) - len(after) < 0.2 * len(before)
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert corpus_pipeline.run(spark, SF_DIR).select("doc_id").distinct().count() == docs.count()


def test_pipeline_on_odd_rows(spark, odd, none):
    for df in (odd, none):
        docs = df.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_DIR)
            rows = out.collect()
            if name == "packing":
                assert bool(rows) == (df is odd)
            else:
                assert out.columns == docs.columns
                docs = spark.createDataFrame(rows, docs.schema)
