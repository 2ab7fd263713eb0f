"""K-d tree sharding: weighted medians along the widest metadata dimension.

A row's point is known by one digest row without its text. At each level every node of the
tree is split at once: its widest dimension is found by an aggregate, and the weighted
median of that dimension by narrowing a radix histogram, twelve bits a pass. What reaches
the driver is nothing; split points are tables of a row for each node.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import discard, stash

#: Passes of 12 bits over a 60-bit place: 28 bits of the coordinate, 32 that spread ties.
BITS, PASSES = 12, 4
#: Split points of at most this many nodes are broadcast; beyond, they are joined by shuffle.
MOST_BROADCAST = 20_000
#: Rows of a shard that are numbered by one task, roughly.
ROWS_A_RUN = 500_000

DIMENSIONS = ["size", "doc", "source", "lang"]


def _unit(column: Column, low: Column, high: Column) -> Column:
    return F.when(high > low, (column - low) / (high - low)).otherwise(F.lit(0.0))


def _small(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= MOST_BROADCAST else table


def kd_leaves(points: DataFrame, depth: int, rows: int | None = None) -> DataFrame:
    """``points`` (tie long, weight long, x0.. in [0, 1]) with ``leaf`` in [0, 2**depth).

    rows: how many points there are, if known.
    """
    axes = [c for c in points.columns if c.startswith("x")]
    table = stash(points.withColumn("leaf", F.lit(0).cast("long")), "kd", rows)
    for level in range(depth):
        nodes = 1 << level
        spread = table.groupBy("leaf").agg(*(F.max(a).alias(f"hi_{a}") for a in axes), *(F.min(a).alias(f"lo_{a}") for a in axes), F.sum("weight").alias("total"))
        # the widest axis; of equal ones the first
        widest = F.array_max(F.array(*(F.struct((F.col(f"hi_{a}") - F.col(f"lo_{a}")).alias("w"), F.lit(-i).alias("i")) for i, a in enumerate(axes))))
        plan = stash(spread.select("leaf", "total", (-widest["i"]).alias("axis")), "axes", nodes, light=True)
        coordinate = F.element_at(F.array(*axes), (F.col("axis") + 1).cast("int"))
        place = F.shiftleft((coordinate * float((1 << 28) - 1)).cast("long"), 32) + F.col("tie")
        placed = stash(table.join(_small(plan.select("leaf", "axis"), nodes), "leaf").withColumn("place", place).drop("axis"), "kd", rows)
        discard(table)
        # narrow the bucket that holds the median: (leaf, prefix of its place, weight before it)
        at = plan.select("leaf", "total", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"))
        over = [plan, placed]
        for p in range(PASSES):
            shift = 60 - BITS * (p + 1)
            inside = placed.join(_small(at, nodes), "leaf")
            if p:
                inside = inside.filter(F.shiftright("place", shift + BITS) == F.col("prefix"))
            weights = inside.groupBy("leaf", "total", "before", F.shiftright("place", shift).alias("prefix")).agg(F.sum("weight").alias("w"))
            run = Window.partitionBy("leaf").orderBy("prefix")  # at most 2**BITS rows a node
            up = F.col("before") + F.sum("w").over(run)
            summed = weights.withColumn("up", up).filter(2 * F.col("up") >= F.col("total"))
            least = summed.groupBy("leaf", "total").agg(F.min(F.struct("prefix", "up", "w")).alias("m"))
            new = stash(least.select("leaf", "total", F.col("m.prefix").alias("prefix"), (F.col("m.up") - F.col("m.w")).alias("before")), "medians", nodes, light=True)
            at = new
            over.append(new)
        cut = at.select("leaf", F.col("prefix").alias("cut"))
        right = (F.shiftright("place", 60 - BITS * PASSES) > F.col("cut")).cast("long")
        table = stash(placed.join(_small(cut, nodes), "leaf").withColumn("leaf", 2 * F.col("leaf") + right).drop("cut", "place"), "kd", rows)
        for done in over:
            discard(done)
    return table


def kd_shards(docs: DataFrame, shards: int | None = 16, target_bytes: int | None = None) -> DataFrame:
    """Shards of nearly equal bytes for all rows of ``docs`` (doc_id, text, source, lang).

    A row's weight is the UTF-8 bytes of its text, null counting none, plus one. Its
    dimensions are the logarithm of that size, its doc_id, and the places of its source and
    language among hashes; each is scaled to [0, 1] over the table, nulls at 0. A node of
    the tree is cut at the weighted median of its widest dimension; rows that are equal in
    it are cut by a hash of doc_id and text, so even one source or one size can be cut. The tree
    is as deep as ``shards`` (a power of two) or ``target_bytes`` for a leaf ask.

    Returns doc_id, size, text_crc32, law ('bytes'), shard, slot (gapless from 0 within a
    shard, by doc_id within runs), grown_shard (null). Repeated rows and null doc_ids are
    rows like others; rows equal in all of doc_id and text may end on one side together. An
    empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("weight"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        (F.pmod(F.xxhash64("doc_id", text), F.lit(1 << 32))).alias("tie"),
        *(F.when(F.col(c).isNotNull(), F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(1 << 20)) / float(1 << 20)).otherwise(0.0).alias(f"x{i}") for i, c in ((2, "source"), (3, "lang"))),
    )
    digest = stash(rows, "digest")
    size = F.log(F.col("weight").cast("double"))
    ends = digest.agg(F.min(size).alias("s0"), F.max(size).alias("s1"), F.min("doc_id").cast("double").alias("d0"), F.max("doc_id").cast("double").alias("d1"), F.sum("weight").alias("all"), F.count("*").alias("n"))
    total, count = ends.select("all", "n").first()
    depth = 0
    if target_bytes:
        depth = max(0, math.ceil(math.log2(max(1, (total or 0) / target_bytes))))
    elif shards:
        depth = round(math.log2(shards))
        if 1 << depth != shards:
            raise ValueError("shards must be a power of two")
    points = digest.crossJoin(F.broadcast(ends)).select(
        "doc_id", "weight", "text_crc32", "tie",
        _unit(size, F.col("s0"), F.col("s1")).alias("x0"),
        F.coalesce(_unit(F.col("doc_id").cast("double"), F.col("d0"), F.col("d1")), F.lit(0.0)).alias("x1"),
        "x2", "x3",
    )
    leaves = kd_leaves(points, depth, count)
    discard(digest)
    # slots: runs of a shard are numbered by themselves and moved by the rows before them
    runs = max(8, math.ceil(4 * count / ROWS_A_RUN / (1 << depth)))
    numbered = leaves.withColumn("run", F.pmod(F.xxhash64("tie", "doc_id"), F.lit(runs)))
    sums = numbered.groupBy("leaf", "run").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("leaf").orderBy("run")) - F.col("n")
    starts = sums.select("leaf", "run", before.alias("first"))
    own = F.row_number().over(Window.partitionBy("leaf", "run").orderBy("doc_id", "text_crc32", "weight")) - 1
    return (
        numbered.withColumn("own", own)
        .join(_small(starts, runs << depth), ["leaf", "run"])
        .select(
            "doc_id", F.col("weight").alias("size"), "text_crc32", F.lit("bytes").alias("law"), F.col("leaf").cast("int").alias("shard"),
            (F.col("first") + F.col("own")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
