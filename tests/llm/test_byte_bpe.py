"""Byte-level BPE by joining halves, against the library and the plain merge rule."""

import base64
import hashlib
import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from hedonic.llm.byte_bpe import ByteBpe, decode, encode, op11_byte_bpe, rank_file
from tests.llm.conftest import LONG, SF_DIR

PATH, PATTERN = rank_file()
#: What meets at seams: contractions, blanks before words, runs of blanks, classes next to each other.
ALPHABET = ["a", "b", "ll", " ", "  ", "\n", "'s", "'ll", "'", "l", "r", "e", "1", "²", "é", "ͱ", "日", "՘", "ౠ", "😀", "\t", " the", ".", "…",
            " ", " ", "\x1c", "\x85", "̈", "\x00"]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


@pytest.fixture(scope="module")
def encoders():
    return [ByteBpe(PATH, PATTERN, leaf=leaf) for leaf in (1, 2, 5, 512)]


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_every_token_is_reached_by_merges(library):
    """The border rule rests on this: by merges alone, a token's bytes give the token."""
    _, ranks = library

    def merged(raw):
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            rank, at = min((ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 30:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    assert [t for t in ranks if merged(t) != [t]] == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=50).map("".join))
def test_seams_of_any_text(library, encoders, text):
    want = library[0].encode_ordinary(text)
    for of in encoders:
        assert ids(of.encode(text)) == want
        assert of.decode(np.array(want, dtype="<u4")) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_characters(library, encoders, text):
    assert ids(encoders[0].encode(text)) == library[0].encode_ordinary(text)


def test_every_letter_and_number_between_digits(library, encoders):
    every = "".join(chr(c) + "1" for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for at in range(0, len(every), 200_000):
        part = every[at : at + 200_000]
        assert ids(encoders[3].encode(part)) == library[0].encode_ordinary(part)


def test_long_matches(library, encoders):
    draw = random.Random(3)
    texts = ["a" * 5000, "ab" * 3001, " " * 4001, "thequickbrown" * 500, "'l" * 3000, "=-" * 4000, "word " * 3000 + "x" * 3000]
    texts += ["".join(draw.choices("abcde", k=6000)), "".join(chr(draw.randrange(0x4E00, 0x9000)) for _ in range(3000))]
    for text in texts:
        for of in encoders[2:]:
            assert ids(of.encode(text)) == library[0].encode_ordinary(text)


def digests(library, doc, text):
    want = library[0].encode_ordinary(text or "")
    raw = np.array(want, dtype="<u4").tobytes()
    return doc, len(want), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_on_all_documents(spark, tables, library):
    want = [digests(library, r.doc_id, r.text) for r in tables("documents").collect()]
    assert sorted(map(tuple, op11_byte_bpe(spark, SF_DIR).collect())) == sorted(want)


def test_odd_rows_whole_and_in_pieces(odd, none, library):
    """Missing ids, repeated rows, clashing names; a piece of 50 characters cuts most of the texts."""
    rows = odd.select("doc_id", "text").collect()
    want = sorted(digests(library, r.doc_id if r.doc_id is not None else -1, r.text) for r in rows)
    for piece in (50, len(LONG) + 1):
        got = decode(encode(odd, PATH, PATTERN, piece=piece), PATH, PATTERN).collect()
        out = [(-1 if r.doc_id is None else r.doc_id, len(r.ids) // 4, hashlib.sha256(r.ids).hexdigest(), hashlib.sha256(r.decoded).hexdigest()) for r in got]
        assert sorted(out) == want
    assert encode(none, PATH, PATTERN).count() == 0
