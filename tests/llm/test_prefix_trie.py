"""The trie of conversations against one built in memory."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hedonic.llm import prefix_trie as pt
from tests.llm.conftest import CLASHING, SF_DIR

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_paths(rows):
    """Turns of each conversation in order; equal numbers by role and digest."""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            held[conv].append(((turn is not None, turn or 0), role, digest, text))
    return {c: [(t[1], t[3]) for t in sorted(turns)] for c, turns in held.items()}


def plain_rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def plain_trie(paths):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node, held in members.items():
        if node:
            children[node[:-1]] += 1
    for node, held in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(held) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, held in members.items():
        sha = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(held), len(node), parent, len(held), children[node], leaves[node], saved[node], sha))
    return sorted(map(str, out))


def found(df):
    return sorted(str(tuple(r)) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def drawn(seed, convs, words=("a", "bb", ""), deep=6, copies=0):
    draw = random.Random(seed)
    rows = [(c, t, draw.choice(["user", "system"]), draw.choice(words)) for c in range(convs) for t in range(draw.randrange(1, deep))]
    return rows + [(c, t, "user", "copied " * t) for c in range(convs, convs + copies) for t in range(4)]


@pytest.mark.parametrize("shard_turns", [7, 60, 10**9])
def test_any_number_of_shards_gives_the_same_trie(spark, monkeypatch, shard_turns):
    """Shared prefixes, and 150 copies that are cut apart and end at one node."""
    monkeypatch.setattr(pt, "IDS_EACH", 3)
    rows = drawn(1, 150, copies=150)
    turns = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = plain_trie(plain_paths(rows))
    paths = pt.paths(turns)
    cuts = pt.splitters(paths.select("conv_id", *pt._packed(F.col("turns"))), shard_turns)
    assert len(cuts) > 20 if shard_turns == 7 else len(cuts) < 30
    assert found(pt.trie(paths, shard_turns=shard_turns)) == want


def test_copies_are_cut_apart(spark):
    rows = pt.paths(spark.createDataFrame(drawn(2, 3, copies=400), SCHEMA)).select("conv_id", *pt._packed(F.col("turns")))
    assert len(pt.splitters(rows, 100)) > 10


def test_splitters_of_long_paths_are_short(spark, monkeypatch):
    monkeypatch.setattr(pt, "SPLITTER_TURNS", 2)
    rows = [(c, t, "user", f"{t} {c if t > 30 else ''}") for c in range(20) for t in range(40)]
    paths = pt.paths(spark.createDataFrame(rows, SCHEMA))
    cuts = pt.splitters(paths.select("conv_id", *pt._packed(F.col("turns"))), 50)
    assert cuts and max(len(p) for p, _ in cuts) <= 2 * pt.WIDTH
    assert found(pt.trie(paths, shard_turns=50)) == plain_trie(plain_paths(rows))


def test_a_small_sample_still_finds_all(spark, monkeypatch):
    monkeypatch.setattr(pt, "SKELETON_BYTES", 2000)
    rows = drawn(3, 200, words=("a", "b", "c", "d"), deep=8)
    assert found(pt.trie(pt.paths(spark.createDataFrame(rows, SCHEMA)), shard_turns=20)) == plain_trie(plain_paths(rows))


def test_rebuilt_conversations(spark):
    """Families with and without a first conversation, some left without any turn."""
    rows = [(c, t, "user", f"{c % 7} {t}") for c in [0, 1, 5, 99, 100, 101, 250, 251, 252, 253, 254, 255, 1003] for t in range(1 + c % 4)]
    want = plain_rebuilt(plain_paths(rows))
    assert any(not turns for turns in want.values())
    got = pt.trie(pt.rebuilt(spark.createDataFrame(rows, SCHEMA)), shard_turns=5)
    assert found(got) == plain_trie(want)


def test_odd_rows(spark):
    """Missing values in any column, repeated rows, equal turn numbers, clashing names, long texts, no rows."""
    rows = [
        (1, None, "user", "first"), (1, 0, None, "x"), (1, 0, "user", None), (1, 0, "user", None), (2, None, "user", "first"),
        (2, 0, "", "x"), (None, 0, "user", "nobody's"), (3, 5, "user", "long " * 50_000), (4, 5, "user", "long " * 50_000),
        (-7, 0, "us", "er"), (-8, 0, "u", "ser"), (9, 1, "a", "tie"), (9, 1, "b", "tie"), (9, 1, "a", "other"),
    ]
    turns = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(0) for c in (*CLASHING, "path", "turns", "digest", "depth")})
    for shard_turns in (2, 1000):
        assert found(pt.trie(pt.paths(turns), shard_turns=shard_turns)) == plain_trie(plain_paths(rows))
    assert pt.trie(pt.paths(turns.where("false"))).count() == 0
    assert pt.trie(pt.rebuilt(turns.where("false"))).count() == 0


def test_query_on_all_conversations(spark, tables):
    rows = [tuple(r) for r in tables("conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(pt.op13_prefix_trie(spark, SF_DIR)) == plain_trie(plain_rebuilt(plain_paths(rows)))
