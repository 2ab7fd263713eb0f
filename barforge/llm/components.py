"""Connected components by alternating large-star and small-star (distributed union-find)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, respread, stash


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is tied to the least node of its neighbourhood."""
    ends = edges.select(F.col("lo").alias("n"), F.col("lo").alias("m")).union(edges.select("hi", "lo"))
    least = ends.groupBy(*respread("n")).agg(F.min("m").alias("m")).select("n", "m")
    return edges.join(least, edges.lo == least.n).select("hi", F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's lesser neighbours, and the node itself, are tied to the least of them."""
    least = edges.select(F.col("hi").alias("n"), "lo").groupBy(*respread("n")).agg(F.min("lo").alias("m")).select("n", "m")
    met = edges.join(least, edges.hi == least.n).select(
        F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")
    )
    return met.select("e.hi", "e.lo").filter("hi > lo").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """(node, root) for every node of ``edges``; root is the least node that it reaches.

    The two star operations alternate until the edges are stars around the roots, which
    takes a number of rounds logarithmic in the size of a component. Edges with a null
    end and loops are ignored; no edges give no rows. Nothing but two numbers a round
    reaches the driver; each round's edges are written to the shared folder, and the last
    ones go when the result is discarded. rows: about how many edges there are, if known.
    """
    proper = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    table = stash(proper.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges", rows, light=True)
    before = _signature(table)
    while before[0]:
        larger = stash(_large_star(table), "stars", before[0], light=True)
        discard(table)
        table = stash(_small_star(larger), "stars", before[0], light=True)
        discard(larger)
        now = _signature(table)
        if now == before:
            break
        before = now
    out = table.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        table.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )
    out._barforge_path = table._barforge_path  # for discard(), once the result is stored
    return out
