"""Canonical length-limited Huffman codes, and blocks of ids coded with them.

Code lengths come from global counts by package-merge, so no code is longer than the
limit and the total length is the least possible under it.  Codes are canonical: shorter
first, then by id, so the lengths alone describe them.

A block is self-contained apart from the lengths: 4 bytes mark, then as little-endian
unsigned 32-bit numbers the ids held, the ids between checkpoints and the checkpoints'
number, then the checkpoints (the bit at which every ``step``-th id starts), then the
bits, most significant first, padded to a byte.  Only a block that one document fills with
2**32 bits or more has 64-bit checkpoints, under a mark of its own.  Decoding looks ``limit`` bits up in one
table that gives the id and its code's length; it runs from all checkpoints at once.
"""

from __future__ import annotations

import numpy as np

#: Blocks of fewer than NARROW bits have checkpoints of 32 bits; others, marked WIDE, of 64.
MARK, WIDE = b"HFB1", b"HFB8"
NARROW = 1 << 32
LIMIT = 16
STEP = 128


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Length of each id's code (0: the id does not occur), by package-merge."""
    counts = np.asarray(counts, dtype=np.int64)
    ids = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(ids) == 0:
        return lengths
    if len(ids) == 1:
        lengths[ids] = 1
        return lengths
    if len(ids) > 1 << limit:
        raise ValueError(f"{len(ids)} ids cannot have codes of at most {limit} bits")
    order = ids[np.argsort(counts[ids], kind="stable")]
    leaf = counts[order].astype(np.float64)
    # Each level merges the leaves with pairs of the level below.  ``source`` says which
    # leaf an entry is, or -1 - p for the p-th pair of the level below.
    levels, weight = [], leaf
    source = np.arange(len(leaf))
    levels.append(source)
    for _ in range(limit - 1):
        pairs = weight[: len(weight) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaf, pairs])
        origin = np.concatenate([np.arange(len(leaf)), -1 - np.arange(len(pairs))])
        rank = np.argsort(both, kind="stable")
        weight, source = both[rank], origin[rank]
        levels.append(source)
    take, depth = 2 * (len(leaf) - 1), np.zeros(len(leaf), dtype=np.int64)
    for source in reversed(levels):
        chosen = source[:take]
        depth[chosen[chosen >= 0]] += 1
        take = 2 * int((chosen < 0).sum())
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each id, right-aligned."""
    lengths = np.asarray(lengths, dtype=np.int64)
    codes = np.zeros(len(lengths), dtype=np.uint64)
    code = last = 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for i in order[lengths[order] > 0].tolist():
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


class Coder:
    """Encodes and decodes blocks under one table of code lengths."""

    def __init__(self, lengths: np.ndarray, limit: int = LIMIT):
        self.limit = limit
        self.lengths = np.asarray(lengths, dtype=np.int64)
        self.codes = canonical_codes(self.lengths)
        size = 1 << limit
        self.symbol = np.zeros(size, dtype=np.uint32)
        self.width = np.zeros(size, dtype=np.int64)
        used = np.flatnonzero(self.lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        spans = 1 << (limit - self.lengths[order])
        n = int(spans.sum())
        self.symbol[:n] = np.repeat(order, spans)
        self.width[:n] = np.repeat(self.lengths[order], spans)

    def encode(self, ids: np.ndarray, step: int = STEP) -> bytes:
        width = self.lengths[ids]
        if len(ids) and not width.all():
            raise ValueError("an id has no code")
        end = np.cumsum(width)
        start = end - width
        bits = int(end[-1]) if len(ids) else 0
        wide_marks = bits >= NARROW
        marks = start[::step].astype("<u8" if wide_marks else "<u4")
        head = (WIDE if wide_marks else MARK) + np.array([len(ids), step, len(marks)], dtype="<u4").tobytes() + marks.tobytes()
        words = np.zeros((bits >> 5) + 2, dtype=np.uint64)
        if len(ids):
            # A code touches one 32-bit word or two; the parts of a word do not overlap, so a sum joins them.
            word, at = start >> 5, start & 31
            wide = self.codes[ids] << (64 - at - width).astype(np.uint64)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            words[word[first]] += np.add.reduceat(wide >> np.uint64(32), first)
            words[word[first] + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), first)
        return head + words.astype(">u4").tobytes()[: (bits + 7) >> 3]

    def decode(self, block: bytes) -> np.ndarray:
        """All ids of a block."""
        if block[:4] not in (MARK, WIDE):
            raise ValueError("not a block of ids")
        kind = np.dtype("<u4" if block[:4] == MARK else "<u8")
        n, step, k = np.frombuffer(block, dtype="<u4", count=3, offset=4).tolist()
        at = np.frombuffer(block, dtype=kind, count=k, offset=16).astype(np.int64)
        raw = np.frombuffer(block + b"\0" * 8, dtype=np.uint8, offset=16 + kind.itemsize * k).astype(np.uint32)
        # The 32 bits from every byte on, so that one look gives the next code wherever it starts.
        ahead = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        out = np.zeros((step, k), dtype=np.uint32)
        mask, top = (1 << self.limit) - 1, 32 - self.limit
        last = n - (k - 1) * step if k else 0
        for i in range(step if k > 1 else last):
            if i == last:  # the last stretch is shorter
                at = at[:-1]
            seen = (ahead[at >> 3] >> (top - (at & 7)).astype(np.uint32)) & mask
            out[i, : len(at)] = self.symbol[seen]
            at = at + self.width[seen]
        return out.T.reshape(-1)[:n]
