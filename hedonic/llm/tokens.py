"""Token ids of texts, with a word cache in front of a public tokenizer."""

from __future__ import annotations

import os
from collections.abc import Iterator
from struct import pack

import numpy as np

#: Characters that end a run of letters without changing its ids.
PUNCTUATION = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""
#: Words, and parts of words, kept per worker process.  Full caches are emptied; results never change.
CACHED_WORDS, CACHED_PARTS = 800_000, 800_000


#: Letters up to here are letters in every version of Unicode that libraries follow.
PLAIN = "\u052f"


def _byte_letters() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = sorted(set(range(256)) - set(kept))
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Known(dict):
    """Ids of words; words that are asked for in vain are noted."""

    def __init__(self):
        super().__init__({"": b""})
        self.missed: list[str] = []

    def __missing__(self, word: str) -> bytes:
        self.missed.append(word)
        return b""


class WordEncoder:
    """Encodes texts with a ``tokenizers`` file, each distinct word once.

    The tokenizer must ignore case, split at blanks and line breaks and between a letter and
    punctuation, and give the parts the same ids wherever they stand, as this pre-tokenized
    BPE does (the tests hold every text of the small tables, and random ones, against encoding
    them whole).  A part of plain letters only is one piece for the model, which then needs
    no splitting; a tokenizer for which that fails on a probe gets whole parts instead.  Ids
    come as little-endian bytes of ``dtype``.
    """

    def __init__(self, path: str, words: int = CACHED_WORDS, parts: int = CACHED_PARTS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.words, self.known = words, _Known()
        self.most, self.parts = parts, {"": b""}
        probe = ["largest", "größe", "éèê", "naïveté", "слово", "λόγος", "x"]
        self.direct = self._pieces(probe) == [self.tokenizer.encode(p, add_special_tokens=False).ids for p in probe]

    def __call__(self, text: str | None) -> bytes:
        words = (text or "").replace("\n", " ").split(" ")
        known = self.known
        found = b"".join(map(known.__getitem__, words))
        if not known.missed:
            return found
        if len(known) + len(known.missed) > self.words:
            known = self.known = _Known()
            known.missed = words
        new = {w: _parts(w) for w in set(known.missed) if w}
        known.missed = []
        parts = self.parts
        apart = {p for pair in new.values() for p in pair if p not in parts}
        if len(parts) + len(apart) > self.most:
            parts = self.parts = {"": b""}
            apart = {p for pair in new.values() for p in pair if p}
        if apart:
            self._add(parts, apart)
        for word, (core, tail) in new.items():
            known[word] = parts[core] + parts[tail]
        return b"".join(map(known.__getitem__, words))

    def _add(self, parts: dict[str, bytes], new: set[str]) -> None:
        plain = [p for p in new if p.isalpha() and max(p) <= PLAIN] if self.direct else []
        if plain:
            normal = self.tokenizer.normalizer.normalize_str(" ".join(plain)).split(" ")
            # Some letters turn into a letter and a mark, which are split.
            good = [(p, n) for p, n in zip(plain, normal, strict=True) if n.isalpha()]
            for (part, _), ids in zip(good, self._tokenized([n for _, n in good])):
                parts[part] = pack(f"<{len(ids)}{'H' if self.dtype.itemsize == 2 else 'I'}", *ids)
            new = new.difference([p for p, _ in good])
        if new:
            rest = list(new)
            parts.update(zip(rest, self._encode(rest), strict=True))

    def _tokenized(self, pieces: list[str]) -> Iterator[list[int]]:
        """Ids of normalized pieces."""
        model, letters = self.model, self.letters
        for p in pieces:
            yield [t.id for t in model.tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(letters))]

    def _pieces(self, parts: list[str]) -> list[list[int]] | None:
        normalizer = self.tokenizer.normalizer
        return list(self._tokenized([normalizer.normalize_str(p) for p in parts])) if normalizer else None

    def _encode(self, parts: list[str]) -> list[bytes]:
        """Ids of each part, from encoding all of them as one text and cutting it at their places."""
        got = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
        first = np.fromiter((at for at, _ in got.offsets), dtype=np.int64, count=len(got.offsets))
        ends = np.cumsum([len(p) + 1 for p in parts])
        cuts = [0, *(self.dtype.itemsize * np.searchsorted(first, ends)).tolist()]
        ids = np.array(got.ids, dtype=self.dtype).tobytes()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


def _parts(word: str) -> tuple[str, str]:
    """A word as letters and the ASCII punctuation after them, which are encoded apart anyway."""
    core = word.rstrip(PUNCTUATION)
    if not core or "<|" in word:  # perhaps a special token
        return word, ""
    if core.isascii():
        return (core.lower(), word[len(core) :]) if core[-1].isalpha() else (word, "")
    # Lower case of some letters ends in a mark, which would join what follows.
    return (core, word[len(core) :]) if core[-1].isalpha() and core.lower()[-1].isalpha() else (word, "")


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker process's encoder of a file, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
