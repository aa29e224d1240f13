"""Token ids, token files and packing."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hedonic.llm.huffman import Coder, canonical_codes, code_lengths
from hedonic.llm.packing import CAPACITY, op10_packing, pack, pack_group
from hedonic.llm.token_files import op2_token_files, read_tokens, write_tokens
from hedonic.llm.tokens import WordEncoder, word_bpe_path
from tests.llm.conftest import LONG, SF_DIR


@pytest.fixture(scope="module")
def whole():
    """Ids of a text encoded whole, with the end id."""
    of = WordEncoder(word_bpe_path()).tokenizer
    return lambda text: np.array([*of.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


ENCODER = WordEncoder(word_bpe_path(), words=200, parts=300)
ODD_TEXTS = [
    "", " ", "a\tb\n\nc  d", "it's they'll DON'T x's.", "...a!!b?? (c) \"d\" e--f", "3.14 1,000 a1b2c3", "Éaé naïve STRASSE ß ﬁ",
    "é ́x", "<|endoftext|> a<|endoftext|>b <| |>", "日本語 テキスト", "𝔘𝔫𝔦 😀!!", " x　y z", "İstanbul", "a_b-c/d",
]


def test_word_cache_equals_encoding_whole(tables, whole):
    of = WordEncoder(word_bpe_path())
    texts = ODD_TEXTS + [r.text for r in tables("documents").select("text").collect()]
    for text in texts:
        assert np.array_equal(np.frombuffer(of(text), of.dtype), whole(text)[:-1]), text[:80]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.one_of(
    st.sampled_from(["İ!", "(İ)", "Aİ,b", "ß", "ŉ", "ǰ.", "Größe", "it's", "THEY'LL", "''", "x1", "é", "é", "ﬁ", "\u0345", "Ω", "ϒ", "Ӏ", "ԥ", "日本", "<|", "�", "\x1d", "\t"]),
    st.text(max_size=6), st.text(st.characters(max_codepoint=0x52F, categories=["L", "P", "M"]), max_size=8),
), max_size=8), st.sampled_from([" ", "\n", "", " \t"]))
def test_random_texts_equal_encoding_whole(whole, parts, between):
    text = between.join(parts)
    assert np.array_equal(np.frombuffer(ENCODER(text), ENCODER.dtype), whole(text)[:-1])


def test_full_cache_is_emptied(whole):
    of = WordEncoder(word_bpe_path(), words=10, parts=10)
    for text in ("one two three four", "five six seven eight nine ten eleven", "one two, five!"):
        assert np.array_equal(np.frombuffer(of(text), of.dtype), whole(text)[:-1])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=600), st.integers(1, 64))
def test_blocks_round_trip(ids, step):
    coder = Coder(code_lengths(np.bincount(ids, minlength=2) + 1))
    assert coder.decode(coder.encode(np.array(ids, dtype=np.int64), step)).tolist() == ids


def test_checkpoints_of_wide_blocks(monkeypatch):
    from hedonic.llm import huffman

    ids = np.arange(3000) % 50
    coder = Coder(code_lengths(np.bincount(ids)))
    narrow = coder.encode(ids, 16)
    monkeypatch.setattr(huffman, "NARROW", 100)
    wide = coder.encode(ids, 16)
    assert len(wide) > len(narrow) and coder.decode(wide).tolist() == coder.decode(narrow).tolist() == ids.tolist()


def test_codes_are_canonical_limited_and_optimal():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 0, 233])
    for limit in (4, 5, 8, 16):
        lengths = code_lengths(counts, limit).astype(int)
        used = lengths[counts > 0]
        assert lengths.max() <= limit and lengths[12] == 0 and (2.0 ** -used).sum() == 1
        codes = [format(c, f"0{n}b") for c, n in zip(canonical_codes(lengths).tolist(), lengths.tolist()) if n]
        assert not any(a != b and b.startswith(a) for a in codes for b in codes)
    # Without a limit the length is Huffman's: sum of the merged weights.
    heap, total = sorted(counts[counts > 0].tolist()), 0
    while len(heap) > 1:
        a, b, *heap = heap
        total, heap = total + a + b, sorted([*heap, a + b])
    assert (code_lengths(counts, 16).astype(int) * counts).sum() == total
    with pytest.raises(ValueError):
        code_lengths(np.ones(17, dtype=int), 4)


def expected_files(rows, whole):
    start, out = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = whole(text)
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files_query(spark, tables, whole):
    rows = [(r.doc_id, r.text) for r in tables("documents").collect()]
    got = [tuple(r) for r in op2_token_files(spark, SF_DIR).orderBy("start").collect()]
    assert got == expected_files(rows, whole)


def test_token_files_of_odd_rows(spark, odd, none, whole, tmp_path):
    write_tokens(odd, str(tmp_path / "odd"), word_bpe_path(), block_tokens=8, part_tokens=16)
    got = read_tokens(spark, str(tmp_path / "odd")).orderBy("start").collect()
    want = expected_files([(r.doc_id, r.text) for r in odd.collect()], whole)
    assert [tuple(r)[:4] for r in got] == want
    assert [zlib.crc32(bytes(r.ids)) for r in got] == [w[3] for w in want]
    write_tokens(none, str(tmp_path / "none"), word_bpe_path())
    assert read_tokens(spark, str(tmp_path / "none")).count() == 0


def check_packing(pieces, rows, whole):
    """Every id in one piece, sequences gapless and within the capacity."""
    texts = {}
    for doc, text in rows:
        texts.setdefault(doc, []).append(whole(text))
    seen = {}
    for p in pieces:
        seen.setdefault(p.doc_id, []).append(p)
    assert set(seen) == set(texts)
    for doc, found in seen.items():
        copies = texts[doc]
        assert sum(p.length for p in found) == sum(map(len, copies))
        for p in found:
            assert p.doc_tokens == len(copies[0])
            assert zlib.crc32(copies[0][p.start : p.start + p.length].tobytes()) == p.ids_crc32
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for found in sequences.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= CAPACITY
    return len(sequences)


def test_packing_query(spark, tables, whole):
    rows = [(r.doc_id, r.text) for r in tables("documents").collect()]
    pieces = op10_packing(spark, SF_DIR).collect()
    total = sum(len(whole(t)) for _, t in rows)
    assert check_packing(pieces, rows, whole) == -(-total // CAPACITY)


def test_packing_of_odd_rows(odd, none, whole):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    pieces = pack(odd, word_bpe_path(), group_docs=4).collect()
    check_packing(pieces, rows, whole)
    for p in pieces:
        assert zlib.crc32(bytes(p.ids)) == p.ids_crc32
    assert any(p.doc_tokens == 1 for p in pieces) and any(p.doc_tokens > len(LONG) // 5 for p in pieces)
    assert pack(none, word_bpe_path()).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(5, 20))
def test_groups_waste_less_than_a_sequence(lengths, capacity):
    pieces = pack_group(np.array(lengths, dtype=np.int64), capacity)
    used, held = {}, {}
    for doc, start, n, to, at in pieces:
        assert at == used.get(to, 0) and n > 0
        used[to] = at + n
        held.setdefault(doc, []).append((start, n))
    assert all(v <= capacity for v in used.values())
    assert len(used) <= -(-sum(lengths) // capacity)
    for doc, n in enumerate(lengths):
        at = 0
        for start, length in sorted(held[doc]):
            assert start == at
            at += length
        assert at == n


def test_costs_are_balanced():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 400, 3000)
    cost = {}
    for _, _, n, to, _ in pack_group(lengths):
        cost[to] = cost.get(to, 0.0) + n + n * n / CAPACITY
    values = np.array(list(cost.values()))
    assert values.std() / values.mean() < 0.1
