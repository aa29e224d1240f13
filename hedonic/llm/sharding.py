"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Every source block (an input partition) orders its rows at random.  A matrix says exactly
how many rows each block sends to each shard: its row sums are the blocks' sizes, its
column sums the shards' sizes, and its law is the one a uniform shuffle of all rows
gives, the multivariate hypergeometric.  The first rows of a block's random order go to
shard 0, the next to shard 1, and so on; every shard then orders what it got at random.

The matrix is drawn in SQL expressions.  Blocks are halved recursively: a node has its
blocks' sizes and the sizes still to fill in every shard, and draws what its left half
takes, shard by shard.  One draw is by inversion around the most likely value, with
weights from the ratios of neighbouring probabilities, over twelve standard deviations and
more to each side, beyond which weights vanish in double precision.  The root holds one
number per block; rows come in only when their block's line of the matrix is known.

The last order within a shard is made in buckets of the random number that defines it, so
no shard is ever sorted in one task.

Everything random is drawn once into a settled table, so a retried task repeats its rows.
Missing text has size 8; rows without an id, repeated rows and rows with equal text are
dealt like any others; an empty table gives no rows.  Columns of the input are kept, and
the names of added ones may not be among them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hedonic.llm.common import let, query, table, tasks_for, unsigned_crc32
from hedonic.session import cut, settle

#: Rows of a shard that one task orders at a time.
BUCKET_ROWS = 16_384
#: Depth of halving at which the nodes are spread over tasks.
SPREAD_DEPTH = 6


def _long(c: Column) -> Column:
    return c.cast("long")


def hypergeometric(good: Column, total: Column, drawn: Column, u: Column) -> Column:
    """How many of ``good`` among ``total`` are in a uniform sample of ``drawn``; ``u`` is uniform in [0, 1).

    Values are tried in the order mode, mode + 1, ..., then mode - 1, mode - 2, ...
    """
    K, N, n = good.cast("double"), total.cast("double"), drawn.cast("double")
    low, high = F.greatest(F.lit(0.0), n - (N - K)), F.least(n, K)
    mode = F.greatest(low, F.least(high, F.floor((n + 1) * (K + 1) / (N + 2)).cast("double")))
    some = F.greatest(N, F.lit(1.0))
    reach = F.ceil(F.sqrt(n * (K / some) * ((N - K) / some)) * 12 + 40).cast("double")
    known = F.struct(
        K.alias("good"), N.alias("total"), n.alias("drawn"), mode.alias("m"), u.alias("u"),
        F.least(reach, high - mode).alias("up"), F.least(reach, mode - low).alias("down"),
    )

    def ratio(p: Column, i: Column, up: bool) -> Column:
        """p(k + 1) / p(k) at k = m + i, or p(k - 1) / p(k) at k = m - i."""
        K, N, n, m = p["good"], p["total"], p["drawn"], p["m"]
        if up:
            return ((K - m - i) * (n - m - i)) / ((m + i + 1) * (N - K - n + m + i + 1))
        return ((m - i) * (N - K - n + m - i)) / ((K - m + i + 1) * (n - m + i + 1))

    def walk(steps: Column) -> Column:
        """0.0, 1.0, ..., ``steps - 1``."""
        numbers = F.transform(F.sequence(F.lit(0), F.greatest(steps - 1, F.lit(0.0)).cast("int")), lambda i: i.cast("double"))
        return F.filter(numbers, lambda i: i < steps)

    def total_of(p: Column, steps: Column, up: bool) -> Column:
        """Sum of the weights on one side, the mode's weight being 1."""
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
        return F.aggregate(
            walk(steps), start, lambda a, i: let(a["w"] * ratio(p, i, up), lambda w: F.struct(w.alias("w"), (a["sum"] + w).alias("sum"))),
            lambda a: a["sum"],
        )

    def passed(p: Column, steps: Column, goal: Column, up: bool) -> Column:
        """How many steps leave less than ``goal`` behind."""
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("k"))

        def step(a: Column, w: Column) -> Column:
            k = a["k"] + F.when(a["sum"] + w <= goal, 1.0).otherwise(0.0)
            return F.struct(w.alias("w"), (a["sum"] + w).alias("sum"), k.alias("k"))

        return F.aggregate(walk(steps), start, lambda a, i: let(a["w"] * ratio(p, i, up), lambda w: step(a, w)), lambda a: a["k"])

    def draw(p: Column) -> Column:
        sums = F.struct(total_of(p, p["up"], True).alias("up"), total_of(p, p["down"], False).alias("down"))
        return let(sums, lambda s: let(p["u"] * (1 + s["up"] + s["down"]), lambda goal: F.when(goal < 1, p["m"]).when(
            goal < 1 + s["up"], F.least(p["m"] + p["up"], p["m"] + 1 + passed(p, p["up"], goal - 1, True))
        ).otherwise(F.greatest(p["m"] - p["down"], p["m"] - 1 - passed(p, p["down"], goal - 1 - s["up"], False)))))

    certain = F.when((n <= 0) | (K <= 0), F.lit(0.0)).when(n >= N, K).when(K >= N, n)
    return _long(F.coalesce(certain, let(known, draw)))


def communication_matrix(blocks: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """Rows ``block, sent`` (an array by shard) from rows ``block, n``, as a uniform shuffle would send them.

    Shard sizes differ by one at most.
    """
    total = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    root = blocks.agg(F.sort_array(F.collect_list(F.struct("block", _long(F.col("n")).alias("n")))).alias("sizes"))
    root = root.where(F.size("sizes") > 0).withColumn("_n", total)
    full = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: _long(F.floor(F.col("_n") / shards)) + F.when(s < F.col("_n") % shards, 1).otherwise(0)
    )
    nodes = root.select(F.lit(1).cast("long").alias("node"), "sizes", full.alias("fill"))
    count, depth = blocks.count(), 0
    while (1 << depth) < count:
        nodes = _halve(nodes, seed)
        depth += 1
        if depth % SPREAD_DEPTH == 0:  # plans stay short, and the nodes spread over tasks
            nodes = cut(nodes.repartition("node"))
    return nodes.select(F.col("sizes")[0]["block"].alias("block"), F.col("fill").alias("sent"))


def _halve(nodes: DataFrame, seed: int) -> DataFrame:
    """Both halves of every node that has more than one block."""
    many = F.size("sizes") > 1
    left = F.slice("sizes", 1, F.ceil(F.size("sizes") / 2).cast("int"))
    right = F.slice("sizes", F.size(left) + 1, F.size("sizes"))
    rows = F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x["n"])

    def shard(a: Column, s: Column) -> Column:
        """One shard's share of what the left half still takes."""
        u = F.pmod(F.xxhash64(F.lit(seed), F.col("node"), F.size(a["got"])), F.lit(1 << 52)) / float(1 << 52)
        return let(hypergeometric(s, a["pool"], a["left"], u), lambda k: F.struct(
            (a["left"] - k).alias("left"), (a["pool"] - s).alias("pool"), F.concat(a["got"], F.array(k)).alias("got")
        ))

    start = F.struct(
        rows.alias("left"),
        F.aggregate("fill", F.lit(0).cast("long"), lambda a, x: a + x).alias("pool"),
        F.array().cast("array<bigint>").alias("got"),
    )
    drawn = nodes.select("*", F.when(many, F.aggregate("fill", start, shard)["got"]).alias("_got"))
    halves = F.array(
        F.struct((F.col("node") * 2).alias("node"), left.alias("sizes"), F.col("_got").alias("fill")),
        F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("sizes"), F.zip_with("fill", "_got", lambda f, g: f - g).alias("fill")),
    )
    alone = F.array(F.struct((F.col("node") * 2).alias("node"), F.col("sizes"), F.col("fill")))
    return drawn.select(F.explode(F.when(many, halves).otherwise(alone)).alias("x")).select("x.*")


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0 in each shard), uniformly shuffled.

    Shard sizes differ by one at most.  The rows travel as they are, so give columns
    that should not travel a key and join them afterwards.
    """
    columns = df.columns
    # The local order costs no exchange: rows are numbered as their partition stands.
    local = df.withColumn("_first", F.rand(seed)).withColumn("_second", F.rand(seed + 1)).sortWithinPartitions("_first")
    number = F.monotonically_increasing_id()
    local = local.withColumn("_block", F.shiftright(number, 33)).withColumn("_at", number.bitwiseAND((1 << 33) - 1))
    local = settle(local.drop("_first"))

    blocks = local.groupBy(F.col("_block").alias("block")).agg(F.count(F.lit(1)).alias("n"))
    matrix = cut(communication_matrix(blocks, shards, seed))
    upto = F.transform(F.sequence(F.lit(1), F.size("sent")), lambda i: F.aggregate(F.slice("sent", 1, i), F.lit(0).cast("long"), lambda a, x: a + x))
    lines = matrix.select(F.col("block").alias("_block"), upto.alias("_upto"))
    shard = F.size(F.filter("_upto", lambda end: end <= F.col("_at"))).cast("int")
    dealt = local.join(lines, "_block").withColumn("shard", shard)

    buckets = tasks_for(-(-local.count() // shards), bucket_rows)
    dealt = settle(dealt.withColumn("_bucket", F.floor(F.col("_second") * buckets).cast("int")).drop("_upto"))
    sizes = dealt.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy("shard", "_bucket").orderBy("_second", "_block", "_at")
    placed = dealt.withColumn("_inside", F.row_number().over(inside)).join(ahead, ["shard", "_bucket"])
    return placed.select(*columns, "shard", (F.col("_ahead") + F.col("_inside") - 1).cast("long").alias("slot"))


@query("op1_sharding")
def op1_sharding(spark, sf_dir):
    """All documents in 24 shards of equal size, uniformly shuffled."""
    docs = table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    keys = docs.select("doc_id", size.alias("size"), unsigned_crc32("text").alias("text_crc32"))
    return shuffle_into_shards(keys, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
