"""Nearest neighbours by vantage-point trees, one for each shard.

A small vantage-point tree, fitted on a bounded sample, cuts space into cells; a cell is one
shard, or several by a hash of vec_id where it is large. Each shard's rows become a tree of
their own, stored as one row. Queries travel in blocks. A block first searches a shard of its
own cell, which bounds the distance of each query's last neighbour; then it goes to those
shards only whose cell may hold something as near, with the queries for which that is so.
Shards and blocks meet by a shuffle: a task reads a tree, then the blocks for it, one by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import broadcast_if_small, discard, stash
from .vectors import common_length, matrix, whole
from .words import freeing

#: Rows and bytes of a shard, at the most and on average; rows of a leaf; queries of a block.
SHARD_ROWS, SHARD_BYTES, LEAF, BLOCK = 4096, 4 << 20, 64, 64
#: The tree of cells: levels at the most, and rows and bytes of the sample that it is fitted on.
LEVELS, SAMPLE_ROWS, SAMPLE_BYTES = 10, 8192, 16 << 20
#: Blocks that one task searches in one shard; more are dealt out to copies of the shard.
MOST_BLOCKS = 256
#: Share by which bounds are lowered against rounding, of the numbers that they are made from.
SLACK = 1e-9
BATCH_BYTES, BATCH_SETTING = 16 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"
NONE = np.iinfo(np.int64).max


def gaps(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distances of all points from all others; squares are added in order of components."""
    total = np.zeros((len(points), len(others)))
    for a, b in zip(points.T, others.T, strict=True):
        apart = a[:, None] - b[None, :]
        total += apart * apart
    return np.sqrt(total)


def _below(bound: np.ndarray, *made_from: np.ndarray) -> np.ndarray:
    return bound - SLACK * sum(np.abs(x) for x in made_from)


@dataclass
class Cells:
    """A vantage-point tree of full depth: node n has children 2n + 1 (within its radius) and 2n + 2."""

    points: np.ndarray
    radii: np.ndarray
    depth: int

    @classmethod
    def fit(cls, sample: np.ndarray, depth: int) -> Cells:
        nodes = (1 << depth) - 1
        points, radii = np.zeros((nodes, sample.shape[1])), np.full(nodes, np.inf)
        own = {0: np.arange(len(sample))}
        for n in range(nodes):
            rows = own.pop(n)
            left = right = rows
            if len(rows):
                points[n] = sample[rows[0]]
                away = gaps(sample[rows], points[n : n + 1])[:, 0]
                radii[n] = np.median(away)
                left, right = rows[away <= radii[n]], rows[away > radii[n]]
            own[2 * n + 1], own[2 * n + 2] = left, right
        return cls(points, radii, depth)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """The cell of each vector."""
        node = np.zeros(len(vectors), np.int64)
        for _ in range(self.depth):
            total = np.zeros(len(vectors))
            for a, b in zip(vectors.T, self.points[node].T, strict=True):
                total += (a - b) ** 2
            node = 2 * node + 1 + (np.sqrt(total) > self.radii[node])
        return node - (len(self.points))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and cell a distance that no vector of the cell falls below."""
        least = np.zeros((len(queries), 1))
        for level in range(self.depth):
            first = (1 << level) - 1
            nodes = slice(first, 2 * first + 1)
            away, radius = gaps(queries, self.points[nodes]), self.radii[nodes][None, :]
            known = np.where(np.isinf(radius), 0.0, radius)  # nothing lies beyond no radius
            inner = np.where(np.isinf(radius), 0.0, _below(away - known, away, known))
            outer = np.where(np.isinf(radius), np.inf, _below(known - away, away, known))
            least = np.maximum(np.repeat(least, 2, axis=1), np.stack([inner, outer], axis=2).reshape(len(queries), -1))
        return least


class ShardTree:
    """A vantage-point tree over the rows of one shard, cut by rank, so that copies are no trouble."""

    FIELDS = (("ids", np.int64), ("vectors", np.float64), ("points", np.float64), ("reach", np.float64), ("children", np.int64), ("ends", np.int64))

    def __init__(self, width: int, **arrays: np.ndarray) -> None:
        self.width = width
        self.ids, self.vectors, self.points, self.reach, self.children, self.ends = (arrays[n] for n, _ in self.FIELDS)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> ShardTree:
        points, reach, children, order, ends = [], [], [], [], [0]

        def leaf(rows: np.ndarray) -> int:
            order.extend(rows.tolist())
            ends.append(len(order))
            return -(len(ends) - 1)

        def node(rows: np.ndarray) -> int:
            if len(rows) <= LEAF:
                return leaf(rows)
            n = len(points)
            point = vectors[rows[0]]
            points.append(point), reach.append(None), children.append(None)
            away = gaps(vectors[rows], point[None, :])[:, 0]
            halves = np.array_split(np.argsort(away, kind="stable"), 2)
            reach[n] = [(away[h].min(), away[h].max()) for h in halves]
            children[n] = [node(rows[h]) for h in halves]
            return n

        node(np.arange(len(ids)))
        width = vectors.shape[1]
        return cls(
            width, ids=ids[order], vectors=np.ascontiguousarray(vectors[order]), points=np.array(points).reshape(-1, width), reach=np.array(reach).reshape(-1, 2, 2),
            children=np.array(children, np.int64).reshape(-1, 2), ends=np.array(ends, np.int64),
        )

    def packed(self) -> list[bytes]:
        return [np.ascontiguousarray(getattr(self, n)).tobytes() for n, _ in self.FIELDS]

    @classmethod
    def unpacked(cls, width: int, blobs: list[bytes]) -> ShardTree:
        flat = {n: np.frombuffer(b, kind) for (n, kind), b in zip(cls.FIELDS, blobs, strict=True)}
        shapes = {"vectors": (-1, width), "points": (-1, width), "reach": (-1, 2, 2), "children": (-1, 2)}
        return cls(width, **{n: a.reshape(shapes.get(n, -1)) for n, a in flat.items()})

    def _leaves(self, queries: np.ndarray, limit: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, leaf, bound) of the leaves that triangle inequalities leave, level by level."""
        if not len(self.points):
            return np.arange(len(queries)), np.ones(len(queries), np.int64), np.zeros(len(queries))
        query, at, bound = np.arange(len(queries)), np.zeros(len(queries), np.int64), np.zeros(len(queries))
        out = []
        while len(query):
            grown = []
            for n in np.unique(at):
                here = at == n
                q, b = query[here], bound[here]
                away = gaps(queries[q], self.points[n : n + 1])[:, 0]
                for (low, high), child in zip(self.reach[n], self.children[n], strict=True):
                    least = np.maximum(b, np.maximum(_below(low - away, low, away), _below(away - high, high, away)))
                    stays = least * factor <= limit[q]
                    grown.append((q[stays], np.full(stays.sum(), child), least[stays]))
            query, at, bound = (np.concatenate(x) for x in zip(*grown, strict=True))
            ends = at < 0
            out.append((query[ends], -at[ends], bound[ends]))
            query, at, bound = query[~ends], at[~ends], bound[~ends]
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def search(self, own: np.ndarray, queries: np.ndarray, limit: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, distances, comparisons): the k nearest to each query within ``limit``, not of its own id.

        Leaves are visited by their bounds, one of each query first, then two more, then
        four: each step tightens what the next may prune. A leaf is left out if its bound
        times ``factor`` exceeds the distance of the last neighbour; at 1 that loses nothing.
        """
        ids, best, limit = np.full((len(own), k), NONE), np.full((len(own), k), np.inf), limit.copy()
        query, leaf, bound = self._leaves(queries, limit, factor)
        order = np.lexsort((bound, query))
        query, leaf, bound = query[order], leaf[order], bound[order]
        turn = np.arange(len(query)) - np.searchsorted(query, query)
        compared, first, step = 0, 0, 1
        while first <= turn.max(initial=-1):
            now = (turn >= first) & (turn < first + step) & (bound * factor <= limit[query])
            for n in np.unique(leaf[now]):
                q = query[now & (leaf == n)]
                rows = slice(self.ends[n - 1], self.ends[n])
                away, names = gaps(queries[q], self.vectors[rows]), np.broadcast_to(self.ids[rows], (len(q), self.ends[n] - self.ends[n - 1]))
                compared += away.size
                away = np.where((names == own[q, None]) | (away > limit[q, None]), np.inf, away)
                both, named = np.concatenate([best[q], away], axis=1), np.concatenate([ids[q], np.where(np.isinf(away), NONE, names)], axis=1)
                kept = np.lexsort((named, both), axis=1)[:, :k]
                best[q], ids[q] = np.take_along_axis(both, kept, 1), np.take_along_axis(named, kept, 1)
                limit[q] = np.minimum(limit[q], best[q, k - 1])
            first, step = first + step, 2 * step
        return ids, best, compared


TREE = ", ".join(f"{n} binary" for n, _ in ShardTree.FIELDS)
#: A block: its home cell and number, the shard that it has searched (-1: none), its queries.
BLOCKS = "cell int, block int, home int, query_ids binary, twins binary, queries binary, limits binary, found binary, scores binary"
FLAT = "query_id long, twin long, vec_id long, score double"


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    names, types = zip(*(x.split() for x in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], names=list(names))


def _routed(cells: Cells, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = cells.of(matrix(batch["vector"], width)) if len(batch) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["vector"], pa.array(cell.astype(np.int32))], names=["vec_id", "vector", "cell"])

    return run


def _grown(width: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        tree = ShardTree.build(rows["vec_id"].to_numpy(), matrix(rows["vector"].combine_chunks(), width))
        return pa.Table.from_batches([_batch(f"shard int, {TREE}", [(key[0].as_py(), *tree.packed())])])

    return run


def _blocked(width: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        own, vectors = rows["vec_id"].to_numpy(), matrix(rows["vector"].combine_chunks(), width)
        limits = np.full(len(own), np.inf)
        row = (key[0].as_py(), key[1].as_py(), -1, own.tobytes(), rows["twin"].to_numpy().tobytes(), vectors.tobytes(), limits.tobytes(), b"", b"")
        return pa.Table.from_batches([_batch(BLOCKS, [row])])

    return run


def _searched(width: int, k: int, factor: float):
    """Blocks with what the tree ahead of them holds for their queries."""
    fields = [n for n, _ in ShardTree.FIELDS]
    names = [x.split()[0] for x in BLOCKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, at = None, None
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                shard, kind = row["shard"][0].as_py(), row["kind"][0].as_py()
                if kind == 0:
                    tree, at = ShardTree.unpacked(width, [row[n][0].as_py() for n in fields]), shard
                    continue
                cell, block, _, ids, twins, queries, limits, _, _ = (row[n][0].as_py() for n in names)
                own, limit = np.frombuffer(ids, np.int64), np.frombuffer(limits, np.float64)
                if at == shard:
                    found, scores, _ = tree.search(own, np.frombuffer(queries).reshape(-1, width), limit, k, factor)
                else:  # a shard that no row was hashed to
                    found, scores = np.full((len(own), k), NONE), np.full((len(own), k), np.inf)
                limit = np.minimum(limit, scores[:, k - 1])
                yield _batch(BLOCKS, [(cell, block, shard, ids, twins, queries, limit.tobytes(), found.tobytes(), scores.tobytes())])

    return run


def _spread(cells: Cells, width: int, first: np.ndarray, shards: np.ndarray, factor: float):
    """A block for each other shard that may hold something for some of its queries, with those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, twins = np.frombuffer(row["query_ids"], np.int64), np.frombuffer(row["twins"], np.int64)
                queries, limit = np.frombuffer(row["queries"]).reshape(-1, width), np.frombuffer(row["limits"])
                may = cells.bounds(queries) * factor <= limit[:, None]
                rows, held = [], 0
                for cell in np.flatnonzero(may.any(axis=0) & (shards > 0)):
                    q = may[:, cell]
                    part = own[q].tobytes(), twins[q].tobytes(), queries[q].tobytes(), limit[q].tobytes(), b"", b""
                    for shard in range(int(first[cell]), int(first[cell] + shards[cell])):
                        if shard != row["home"]:
                            rows.append((shard, row["cell"], row["block"], row["home"], *part))
                            held += len(part[2])
                            if held > BATCH_BYTES:
                                yield _batch(f"shard int, {BLOCKS}", rows)
                                rows, held = [], 0
                yield _batch(f"shard int, {BLOCKS}", rows)

    return run


def _flat(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["query_ids", "twins", "found", "scores"]).to_pylist():
                found, scores = np.frombuffer(row["found"], np.int64), np.frombuffer(row["scores"])
                there = found != NONE
                own, twins = (np.repeat(np.frombuffer(row[n], np.int64), k)[there] for n in ("query_ids", "twins"))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (own, twins, found[there], scores[there])], names=["query_id", "twin", "vec_id", "score"])

    return run


def _met(index: DataFrame, blocks: DataFrame) -> DataFrame:
    """Trees and the blocks that want them, each tree ahead of its blocks in one partition."""
    counts = stash(blocks.groupBy("shard").agg(F.ceil(F.count("*") / MOST_BLOCKS).cast("int").alias("copies")), "wanted")
    groups = counts.agg(F.sum("copies")).first()[0] or 1
    small = broadcast_if_small(counts, F.lit(16))
    wanted = counts if small is None else small
    trees = index.join(wanted, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).withColumn("kind", F.lit(0)).drop("copies")
    asked = blocks.join(wanted, "shard").withColumn("part", F.pmod(F.xxhash64("cell", "block"), F.col("copies")).cast("int")).withColumn("kind", F.lit(1)).drop("copies")
    both = trees.unionByName(asked, allowMissingColumns=True)
    return both.repartition(int(min(groups, 20_000)), "shard", "part").sortWithinPartitions("shard", "part", "kind")


def nearest(embeddings: DataFrame, every: int = 100, k: int = 10, factor: float = 1.0) -> DataFrame:
    """The ``k`` nearest other vectors of each whose vec_id is divisible by ``every``.

    embeddings: vec_id, embedding; other columns are ignored. Vectors that are null, zero or
    hold null or non-finite components, those without vec_id, and those of another length
    than the most frequent one take no part. Rows with the query's vec_id are its own; rows
    equal in vec_id and vector are one, and a vec_id with several vectors is as many queries.
    Of copies of one vector only the k + 1 smallest vec_ids can be among answers, and only
    those are indexed. Fewer candidates than k give fewer rows, no vectors none. Results are
    exact with ``factor`` 1; a greater one prunes more, and may miss neighbours.

    Returns query_id, rank (from 1), vec_id, score (the distance), ties to the smaller vec_id.
    """
    spark: SparkSession = embeddings.sparkSession
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))  # trees are long rows
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & whole(F.col("vector")) & F.exists("vector", lambda x: x != 0))
    width, count = common_length(rows, "vector")
    if not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("vector") == width)
    shard_rows = max(LEAF, min(SHARD_ROWS, SHARD_BYTES // (8 * width)))
    depth = min(LEVELS, max(0, math.ceil(math.log2(count / shard_rows))))
    taken = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * width)))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(taken).select("vector").toPandas()["vector"]
    distinct = np.unique(np.stack(sample.to_list()), axis=0)
    # mixed: vantage points are the first of their nodes
    cells = Cells.fit(np.random.default_rng(0).permutation(distinct), depth)
    # copies: no more than k + 1 of a vector, cut ahead of the shuffle as well as after it
    copies = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.distinct().withColumn("_n", F.row_number().over(copies)).filter(F.col("_n") <= k + 1).drop("_n")
    placed = "vec_id long, vector array<double>, cell int"
    routed = stash(few.mapInArrow(freeing(_routed(cells, width)), placed), "routed")
    own = rows.filter(F.col("vec_id") % every == 0).distinct()
    asking = stash(own.mapInArrow(freeing(_routed(cells, width)), placed), "asking")
    sizes, asked = ({r["cell"]: r["count"] for r in t.groupBy("cell").count().collect()} for t in (routed, asking))  # no more than 2 ** LEVELS
    shards = np.array([-(-sizes.get(c, 0) // shard_rows) for c in range(1 << depth)])
    first = np.concatenate([[0], np.cumsum(shards)[:-1]])
    plan = F.broadcast(spark.createDataFrame([(c, int(first[c]), int(max(1, shards[c])), max(1, -(-asked.get(c, 0) // BLOCK))) for c in range(1 << depth)], "cell int, first int, shards int, blocks int"))
    shard = (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("shards"))).cast("int")
    grown = routed.join(plan, "cell").select(shard.alias("shard"), "vec_id", "vector").groupBy("shard").applyInArrow(_grown(width), f"shard int, {TREE}")
    index = stash(grown, "index")
    discard(routed)
    twin = F.xxhash64("vector")
    block = F.pmod(F.xxhash64("vec_id", twin), F.col("blocks")).cast("int")
    blocks = asking.join(plan, "cell").select("cell", block.alias("block"), "vec_id", twin.alias("twin"), "vector").groupBy("cell", "block").applyInArrow(_blocked(width), BLOCKS)
    at_home = stash(blocks.join(plan, "cell").withColumn("shard", (F.col("first") + F.pmod("block", "shards")).cast("int")).drop("first", "shards", "blocks"), "blocks")
    discard(asking)
    seeded = stash(_met(index, at_home).mapInArrow(freeing(_searched(width, k, factor)), BLOCKS), "seeded")
    discard(at_home)
    wide = stash(seeded.mapInArrow(freeing(_spread(cells, width, first, shards, factor)), f"shard int, {BLOCKS}"), "spread")
    found = _met(index, wide).mapInArrow(freeing(_searched(width, k, factor)), BLOCKS)
    flat = stash(seeded.unionByName(found).mapInArrow(freeing(_flat(k)), FLAT), "found")
    for done in (index, seeded, wide):
        discard(done)
    rank = F.row_number().over(Window.partitionBy("query_id", "twin").orderBy("score", "vec_id"))
    return flat.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

