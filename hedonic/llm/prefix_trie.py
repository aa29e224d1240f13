"""Prefix trie of conversations, with a skeleton of splitter paths.

A conversation is a path: its turns in order.  Each distinct sequence of first turns is a
node, whose members are the conversations that start with it.  Paths are kept as the
128-bit digests of their turns (role and text) in a row; texts themselves are not moved.

In lexicographic order of (path, id) a node's members are neighbours.  So the rows are cut
into shards of about ``SHARD_TURNS`` turns at splitters, which a small sample gives.  A node
reaches over a cut only if it is a prefix of that splitter's path: these nodes, the
skeleton, are broadcast.  Each shard, sorted, finishes all its other nodes in one pass that
holds a path and the children on it.  For a skeleton node it writes a partial aggregate,
and these are reduced: a handful of numbers for each, and the ids of conversations that end
there, which a checksum reads in order.  Many equal conversations differ in their ids, so
they spread over shards like any others.

The skeleton is bounded: at most ``SKELETON_BYTES`` of splitter paths, each of at most
``SPLITTER_TURNS`` turns; more would only mean larger shards (any splitters give the same
result).  Its nodes, at most one per splitter and turn, are the only rows that meet the
driver, which adds them up from the leaves to the root.

A missing role or text counts as empty, a missing turn comes first; turns of equal number
follow by role and digest.  Rows without a conversation id belong to none and are left out.
Repeated rows are turns of their own.  A conversation's digests (20 bytes a turn) have to
fit in a row.  An empty table has no trie and gives no rows.  Only the four named columns
are read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hedonic.llm.common import query, table, tasks_for
from hedonic.session import release, settle

#: Turns of a shard.
SHARD_TURNS = 50_000
#: Rows looked at per splitter.
SAMPLE = 32
#: Turns of a splitter, and bytes of all sampled paths.
SPLITTER_TURNS, SKELETON_BYTES = 256, 1 << 24
#: Bytes of a turn's digest.
WIDTH = 16
#: Ids that a partial row of a skeleton node holds.
IDS_EACH = 20_000


def paths(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: an array of ``(digest, n)``, the turns of every conversation in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turn = F.struct("turn", role.alias("role"), digest.alias("digest"), F.length(text).alias("n"))
    rows = turns.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return rows.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["n"].alias("n"))).alias("turns"))


def _packed(turns: Column) -> list[Column]:
    """The digests of a path as one binary value, and its lengths."""
    return [F.unhex(F.array_join(turns["digest"], "")).alias("path"), turns["n"].alias("lengths")]


def splitters(rows: DataFrame, shard_turns: int) -> list[tuple[bytes, int]]:
    """Places (path, id) that cut the ordered rows into about equal numbers of turns."""
    most = F.least(F.length("path"), F.lit(WIDTH * SPLITTER_TURNS))
    n, turns, size = rows.agg(F.count(F.lit(1)), F.sum(F.length("path") / WIDTH + 1), F.sum(most + 8)).first()
    shards = tasks_for(int(turns or 0), shard_turns)
    if shards == 1:
        return []
    share = min(1.0, SAMPLE * shards / n, SKELETON_BYTES / size)
    head = F.substring(F.col("path"), 1, WIDTH * SPLITTER_TURNS)
    picked = rows if share == 1 else rows.sample(share, seed=13)
    # A long path weighs more, as it holds more turns.
    got = sorted((bytes(r[0]), r[1], r[2]) for r in picked.select(head, "conv_id", F.length("path") / WIDTH + 1).collect())
    total, passed, found = sum(w for *_, w in got), 0.0, []
    for path, conv, weight in got:
        passed += weight
        if passed * shards >= (len(found) + 1) * total and len(found) < shards - 1:
            found.append((path, conv))
    return sorted(set(found))


def skeleton(cuts: list[tuple[bytes, int]]) -> dict[bytes, int]:
    """Numbers of all nodes on splitter paths, parents first; the root is 0."""
    nodes = {b""}
    for path, _ in cuts:
        nodes.update(path[:at] for at in range(WIDTH, len(path) + 1, WIDTH))
    return {node: i for i, node in enumerate(sorted(nodes, key=lambda x: (len(x), x)))}


FINISHED = (
    "node int, parent_node int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, shard int, chunk int, n_last long, ends string"
)
FIELDS = [f.split(" ")[0] for f in FINISHED.split(", ")]


class _Open:
    """A node on the path that a shard is walking along."""

    __slots__ = ("children", "chunk", "conv", "depth", "ends", "ids", "last", "leaves", "members", "node", "path", "saved", "waiting")

    def __init__(self, path: bytes, depth: int, last: int, node: int | None):
        self.path, self.depth, self.last, self.node = path, depth, last, node
        self.conv: int | None = None
        self.members = self.children = self.leaves = self.saved = self.chunk = 0
        self.ends, self.ids, self.waiting = hashlib.sha256(), [], []


def walk(rows: Iterator[tuple[int, int, bytes, list[int]]], known: dict[bytes, int]) -> Iterator[tuple]:
    """Finished nodes and partial aggregates of sorted rows ``(shard, conv_id, path, lengths)``."""
    stack: list[_Open] = []
    now = -1
    out: list[tuple] = []

    def flush(top: _Open, last: bool) -> None:
        """A partial row of a skeleton node; numbers come with the last one."""
        numbers = (top.members, top.children, top.leaves, top.saved) if last else (0, 0, 0, 0)
        conv, ends = top.conv, ",".join(map(str, top.ids))
        n, children, leaves, saved = numbers
        out.append((top.node, None, conv, top.depth, None, n, children, leaves, saved, None, now, top.chunk, top.last, ends))
        top.chunk, top.ids = top.chunk + 1, []

    def close() -> None:
        top = stack.pop()
        for record in top.waiting:  # children, whose parent's smallest member is now known
            out.append((None, top.node, *record[:2], top.conv if top.node is None else None, *record[2:], None, None, None, None))
        if top.node is not None:
            flush(top, last=True)
            if stack and (top.conv is not None) and (stack[-1].conv is None or top.conv < stack[-1].conv):
                stack[-1].conv = top.conv
            if stack:
                stack[-1].members += top.members
            return
        leaves = top.leaves if top.children else 1
        saved = top.saved + (top.members - 1) * top.last
        up = stack[-1]
        up.members, up.children, up.leaves, up.saved = up.members + top.members, up.children + 1, up.leaves + leaves, up.saved + saved
        up.conv = top.conv if up.conv is None else min(up.conv, top.conv)
        up.waiting.append((top.conv, top.depth, top.members, top.children, leaves, saved, top.ends.hexdigest()))

    for shard, conv, path, lengths in rows:
        if shard != now:
            while stack:
                close()
            now = shard
            stack.append(_Open(b"", 0, 0, known[b""]))
        while not path.startswith(stack[-1].path):
            close()
        while len(stack[-1].path) < len(path):
            depth = len(stack)
            head = path[: WIDTH * depth]
            stack.append(_Open(head, depth, lengths[depth - 1], known.get(head)))
        top = stack[-1]
        top.members += 1
        top.conv = conv if top.conv is None else min(top.conv, conv)
        if top.node is None:
            top.ends.update(f",{conv}".encode() if top.ids else str(conv).encode())
            top.ids = [conv]
        else:
            top.ids.append(conv)
            if len(top.ids) >= IDS_EACH:
                flush(top, last=False)
        yield from out
        out.clear()
    while stack:
        close()
    yield from out


def _batches(records: Iterator[tuple], kinds: list[pa.DataType], names: list[str], each: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for record in records:
        held.append(record)
        if len(held) == each:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)


_KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}


def trie(rows: DataFrame, *, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of the trie of ``rows`` (``conv_id, turns`` as :func:`paths` gives them)."""
    spark = rows.sparkSession
    rows = settle(rows.select("conv_id", *_packed(F.col("turns"))))
    cuts = splitters(rows, shard_turns)
    known = skeleton(cuts)
    shipped = spark.sparkContext.broadcast((cuts, known))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shipped.value[0]
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)
            shards = pa.array([bisect_right(places, k) for k in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([shards, *batch.columns], names=["shard", *batch.schema.names])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for batch in batches:
                yield from zip(*[batch.column(c).to_pylist() for c in ("shard", "conv_id", "path", "lengths")], strict=True)

        kinds = [_KINDS[f.split(" ")[1]] for f in FINISHED.split(", ")]
        yield from _batches(walk(each(), shipped.value[1]), kinds, FIELDS)

    dealt = rows.mapInArrow(deal, "shard int, conv_id long, path binary, lengths array<int>")
    ordered = dealt.repartition(len(cuts) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
    made = settle(ordered.mapInArrow(finish, FINISHED))
    release(rows)

    partial = made.where(F.col("node").isNotNull())
    reduced = partial.groupBy("node", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("n_last").alias("n_last"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    found = {r.node: r for r in reduced.collect()}
    ends = {r.node: r.ends_sha256 for r in _ends(partial).collect()}
    bones = _roll_up(known, found, ends)

    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    schema = ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in names)
    top = spark.createDataFrame([bones[i][:8] for i in sorted(bones)], schema)
    heads = spark.createDataFrame([(i, bones[i][0]) for i in sorted(bones)], "parent_node int, head long")
    # The skeleton's bound holds for this side as well.
    rest = made.where(F.col("node").isNull()).join(F.broadcast(heads), "parent_node", "left")
    rest = rest.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "head")).select(names)
    return top.union(rest)


def _ends(partial: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of skeleton nodes where conversations end: a stream of ids in order for each."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            node, sha = None, None
            for batch in batches:
                for now, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                    if now != node:
                        if sha:
                            yield node, sha.hexdigest()
                        node, sha = now, hashlib.sha256(ends.encode())
                    else:
                        sha.update(b"," + ends.encode())
            if sha:
                yield node, sha.hexdigest()

        yield from _batches(each(), [pa.int32(), pa.string()], ["node", "ends_sha256"])

    some = partial.where(F.col("ends") != "").select("node", "shard", "chunk", "ends")
    return some.repartition("node").sortWithinPartitions("node", "shard", "chunk").mapInArrow(hashed, "node int, ends_sha256 string")


def _roll_up(known: dict[bytes, int], found: dict, ends: dict[int, str]) -> dict[int, list]:
    """The skeleton's rows, its nodes added to their parents from the leaves up.

    A node that only lies on a splitter's path, without members, is none (splitter paths
    are prefixes of real ones, so this happens in an empty table only).
    """
    none = hashlib.sha256().hexdigest()
    rows: dict[int, list] = {}
    for path, i in known.items():
        r = found.get(i)
        if r is None or not r.n_convs:
            continue
        parent = known[path[:-WIDTH]] if path else None
        rows[i] = [r.conv_id, r.depth, None, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, ends.get(i, none), parent, r.n_last]
    for i in sorted(rows, reverse=True):  # parents have smaller numbers
        row = rows[i]
        row[5] = row[5] if row[4] else 1
        row[6] += (row[3] - 1) * row[9]
        if row[8] is not None:
            up = rows[row[8]]
            row[2] = up[0]
            up[4], up[5], up[6] = up[4] + 1, up[5] + row[5], up[6] + row[6]
    return rows


def rebuilt(turns: DataFrame, family: int = 100, heads: int = 6) -> DataFrame:
    """Paths of conversations whose first turns are those of their family's first conversation."""
    own = settle(paths(turns))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    base = F.col("conv_id") - F.col("conv_id") % family
    first = own.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("first"))
    both = own.withColumn("base", base).withColumn("h", h.cast("int")).join(first, "base", "left")
    # A slice of no turns would need a positive start, so the empty case is said.
    head = F.when(F.col("first").isNull() | (F.col("h") == 0), F.slice("turns", 1, 0)).otherwise(F.slice("first", 1, F.col("h")))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return both.select("conv_id", F.concat(head, rest).alias("turns"))


#: CRC-32 of a conversation's decimal id, bit by bit, as DuckDB has no such function.
_BIT = "list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, {0})"
_CRC = (
    "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), "
    "lambda c, b: " + _BIT.format("xor(c, b)") + "), 4294967295)"
)
SQL = f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)
), steps AS (
  SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, t.pos - c.h + least(c.h, (SELECT count(*) FROM turns b WHERE b.conv_id = c.base)), t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), numbered AS (
  SELECT conv_id, pos, length(text) AS n, md5(length(role) || ':' || role || text) AS turn FROM steps
), prefixes AS (
  SELECT conv_id, pos AS depth, n, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM numbered
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), last AS (
  SELECT conv_id, max(depth) AS d FROM prefixes GROUP BY conv_id
), nodes AS (
  SELECT path, depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
    coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (d = depth), '') AS ends
  FROM prefixes p JOIN last USING (conv_id) GROUP BY path, depth
), kids AS (
  SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), sized AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * n AS saved FROM nodes LEFT JOIN kids USING (path)
), up AS (
  SELECT left(path, 32 * i) AS path, (n_children = 0)::INT AS leaf, saved FROM sized, unnest(range(depth + 1)) AS r(i)
), sums AS (
  SELECT path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM up GROUP BY path
)
SELECT s.conv_id::BIGINT AS conv_id, s.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, s.n_convs::BIGINT AS n_convs,
  s.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(s.ends) AS ends_sha256
FROM sized s JOIN sums USING (path) LEFT JOIN nodes p ON s.depth > 0 AND p.path = left(s.path, 32 * (s.depth - 1))
"""


@query("op13_prefix_trie", SQL)
def op13_prefix_trie(spark, sf_dir):
    """The trie of all conversations, rebuilt on their families' first turns."""
    return trie(rebuilt(table(spark, sf_dir, "conversations")))
