"""Vector code compression: integer product codes, entries found by vantage-point trees.

Components become integers, so sums over any number of tasks are exact and every run makes
the same codebooks. The nearest entry is found for each part position in a vantage-point tree
over its entries, by branch and bound: radii are rounded outwards, a branch is visited while
its bound is not above the best, and distances are compared as integers. A round is one pass
over the integers, of which each task hands on one row for each entry that it has met.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import broadcast_if_small, discard, stash
from .vectors import common_length, matrix, whole
from .words import freeing

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: How far square roots in doubles are moved outwards, as a share.
SLACK = 1e-12
#: Entries of a node that are compared one by one.
LEAF = 3


class EntryTree:
    """A vantage-point tree over the entries of one codebook (integers, a row for each)."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.root = self._node(np.arange(len(entries)))

    def _node(self, own: np.ndarray):
        """(vantage entry, children), each child with the least and greatest distance of its entries."""
        if len(own) <= LEAF:
            return own, ()
        gaps = np.sqrt(((self.entries[own] - self.entries[own[0]]) ** 2).sum(axis=1).astype(np.float64))
        order = 1 + np.argsort(gaps[1:], kind="stable")  # cut by rank, so that equal entries make no endless branch
        halves = np.array_split(order, 2)
        return own[:1], tuple((gaps[h].min() * (1 - SLACK), gaps[h].max() * (1 + SLACK), self._node(own[h])) for h in halves)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each point's nearest entry, ties to the lower index."""
        best = np.full(len(points), np.iinfo(np.int64).max)
        entry = np.full(len(points), len(self.entries))
        self._visit(self.root, np.arange(len(points)), points, best, entry)
        return entry, best

    def _visit(self, node, rows: np.ndarray, points: np.ndarray, best: np.ndarray, entry: np.ndarray) -> None:
        own, children = node
        for e in own.tolist():
            apart = points[rows] - self.entries[e]
            gap = np.einsum("ij,ij->i", apart, apart)
            wins = (gap < best[rows]) | ((gap == best[rows]) & (e < entry[rows]))
            best[rows[wins]], entry[rows[wins]] = gap[wins], e
        if not children:
            return
        away = np.sqrt(gap.astype(np.float64))  # from the one vantage entry
        bounds = [np.maximum(low - away * (1 + SLACK), away * (1 - SLACK) - high) for low, high, _ in children]
        near = bounds[0] <= bounds[1]
        for first, mine in ((0, near), (1, ~near)):
            for k in (first, 1 - first):
                # not strict: an entry that is as near may have a lower index
                go = mine & (bounds[k] <= np.sqrt(best[rows].astype(np.float64)) * (1 + SLACK))
                if go.any():
                    self._visit(children[k][2], rows[go], points, best, entry)


def assign(vectors: np.ndarray, trees: list[EntryTree]) -> tuple[np.ndarray, np.ndarray]:
    """(entries, squared distances), a column for each part."""
    found = [tree.nearest(part) for tree, part in zip(trees, np.split(vectors, len(trees), axis=1), strict=True)]
    return np.stack([e for e, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _sums(width: int, books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [EntryTree(b) for b in books]
        parts, entries, step = books.shape
        counts, totals = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, step), np.int64)
        for batch in batches:
            vectors = matrix(batch["ints"], width).astype(np.int64)
            for p, column in enumerate(assign(vectors, trees)[0].T):
                counts[p] += np.bincount(column, minlength=entries)
                np.add.at(totals[p], column, vectors[:, p * step : (p + 1) * step])
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e]), pa.array(list(totals[p, e]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    return run


def codebooks(ints: DataFrame, width: int, first: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) after ``rounds`` of assigning and averaging, from ``first`` on.

    ints: ints, arrays of ``width`` integers. Averages are rounded down; entries that are
    nearest to nothing stay. What reaches the driver is a row for each entry.
    """
    books = first.copy()
    step = books.shape[2]
    for _ in range(rounds):
        sums = ints.select("ints").mapInArrow(freeing(_sums(width, books)), "part int, entry int, n long, sums array<long>")
        whole_sums = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.get("sums", F.lit(i))) for i in range(step))).alias("sums"))
        for row in whole_sums.collect():
            books[row["part"], row["entry"]] = [s // row["n"] for s in row["sums"]]
    return books


def _codes(width: int, books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [EntryTree(b) for b in books]
        for batch in batches:
            entries, gaps = assign(matrix(batch["ints"], width).astype(np.int64), trees)
            codes = [row.astype(np.uint8).tobytes().hex() for row in entries]
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], pa.array(codes, pa.string()), pa.array(gaps.sum(axis=1))], names=["vec_id", "label", "code", "error"])

    return run


def vector_codes(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Codes of all vectors (vec_id, embedding, label) by codebooks that they make themselves.

    Vectors that are null, or hold null or non-finite components, take no part; nor do those
    of another length than the most frequent one, which ``parts`` has to divide, and empty
    ones. The first codebooks are parts of the vectors of the smallest vec_ids, nulls last,
    ties by components; of fewer vectors than ``entries`` there are fewer. Repeated rows count
    as often as they occur. Components so large that a squared distance might not fit 63 bits
    raise an error. Other columns are ignored; without vectors there are no rows.

    Returns vec_id, code (two hex digits for each part), error (squared distances summed),
    label_error (errors summed over equal labels, nulls together), codebooks_sha256.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("vector")).filter(whole(F.col("vector")) & (F.size("vector") > 0))
    width, _ = common_length(rows, "vector")
    if width % parts:
        raise ValueError(f"vectors of {width} components have no {parts} equal parts")
    most = math.isqrt((1 << 58) // max(1, width // parts)) if width else 1
    most = min(most, (1 << 31) - 1)
    scaled = F.transform("vector", lambda x: F.when(F.abs(x) * SCALE < most, F.floor(x * SCALE).cast("int")).otherwise(F.raise_error(F.lit("a component is too large"))))
    ints = stash(rows.filter(F.size("vector") == width).select("vec_id", F.col("label").cast("string").alias("label"), scaled.alias("ints")), "ints")
    head = ints.select("vec_id", "ints").orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()
    kind = embeddings.schema["label"].dataType
    if not head:
        return embeddings.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    first = np.array([r["ints"] for r in head], np.int64).reshape(len(head), parts, -1).transpose(1, 0, 2)
    books = codebooks(ints, width, first, rounds)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = stash(ints.mapInArrow(freeing(_codes(width, books)), "vec_id long, label string, code string, error long"), "codes")
    discard(ints)
    labels = stash(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "labels")
    small = broadcast_if_small(labels, F.coalesce(F.length("_label"), F.lit(0)) + 16)
    out = coded.join(labels if small is None else small, F.col("label").eqNullSafe(F.col("_label")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"), F.col("label").cast(kind).alias("label"))
