"""Vector best-fit packing of tokenized documents into sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stash
from .tokens import encoder
from .words import freeing, slices

CAPACITY = 4096
#: Pieces that one task packs together. A group ends with hardly more than one open sequence
#: when small pieces are among so many, so larger groups would gain next to nothing.
GROUP = 16_384
#: Weights of the residual tokens, documents and attention cost in a residual's norm.
WEIGHTS = (1.0, 0.01, 0.01)

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of each document: its ids and ``end_id``, cut only if longer than ``capacity``."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = encoder(path)
        for whole in batches:
            for low, high in slices(whole["text"], 2 << 20):
                batch = whole.slice(low, high - low)
                rows = []
                for doc, ids in zip(batch["doc_id"].to_pylist(), table.encode(batch["text"]), strict=True):
                    n = len(ids) + 1
                    if n <= capacity:
                        rows.append((doc, 0, 0, n, zlib.crc32(end, zlib.crc32(ids.astype("<u4", copy=False).data))))
                        continue
                    raw = ids.astype("<u4", copy=False).tobytes() + end
                    for k, at in enumerate(range(0, n, capacity)):
                        rows.append((doc, k, at, min(capacity, n - at), zlib.crc32(raw[4 * at : 4 * (at + capacity)])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(freeing(cut), PIECES)


def best_fit(lengths: np.ndarray, capacity: int, most_docs: int, most_attention: int, weights: tuple = WEIGHTS) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, longest first, each into the open bin it fits best.

    A bin's residual is a vector: tokens, documents and attention cost (the sum of squared
    lengths) that it still takes, as shares of the capacities. Of the bins that can take the
    piece under every one of the three, the one whose residual is then shortest in the
    weighted norm gets it; of equal ones the oldest. A piece that no bin takes opens one.
    """
    order = np.argsort(-lengths, kind="stable")
    full = np.array([1.0, 1.0, 1.0])
    w = np.array(weights)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room = np.zeros((256, 3))
    used, ids, n_open, made = np.zeros(256, np.int64), np.zeros(256, np.int64), 0, 0
    least = int(lengths.min()) if len(lengths) else 0
    for i in order.tolist():
        length = int(lengths[i])
        need = np.array([length / capacity, 1 / most_docs, length * length / most_attention])
        left = room[:n_open] - need
        fits = np.flatnonzero((left > -1e-12).all(axis=1))
        if len(fits):
            k = int(fits[np.argmin((left[fits] ** 2) @ w)])
        else:
            if n_open == len(room):
                room, used, ids = (np.concatenate((x, np.zeros_like(x))) for x in (room, used, ids))
            k, n_open = n_open, n_open + 1
            room[k], used[k], ids[k], made = full, 0, made, made + 1
        bins[i], offsets[i] = ids[k], used[k]
        room[k] -= need
        used[k] += length
        if capacity - used[k] < least:  # closed: nothing fits any more
            n_open -= 1
            room[k], used[k], ids[k] = room[n_open], used[n_open], ids[n_open]
    return bins, offsets


def pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY, most_docs: int | None = None, most_attention: int | None = None) -> DataFrame:
    """Every token of every document in as few sequences of at most ``capacity`` as it can.

    docs: doc_id, text; other columns are ignored; a null text is empty and packs as its end
    id. Sequences also hold at most ``most_docs`` pieces and ``most_attention`` squared
    lengths; the defaults are what full sequences of any pieces stay within, so by default
    only tokens bind, which gives the fewest sequences. Pieces of full length are sequences
    by themselves; the others are dealt out at random to groups of about GROUP pieces, which
    are packed one by one in memory. Repeated rows are packed as often
    as they occur; an empty table gives no rows.

    Returns a row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    most_docs, most_attention = most_docs or capacity, most_attention or capacity * capacity
    if most_attention < capacity * capacity:
        raise ValueError("a piece of full length must fit into a sequence")
    cut = stash(pieces(docs, path, end_id, capacity), "pieces")
    part = cut.filter(F.col("length") < capacity)
    groups = max(1, -(-part.count() // GROUP))

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = best_fit(frame["length"].to_numpy(), capacity, most_docs, most_attention)
        frame["sequence_id"] = bins * groups + frame["place"]
        frame["offset"] = offsets
        return frame.drop(columns="place")

    out = "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    small = (
        # hashed, as row numbers begin at a multiple of 2**33 in each partition
        part.withColumn("place", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
        .groupBy("place")
        .applyInPandas(packed, f"{PIECES}, sequence_id long, offset long")
    )
    whole = cut.filter(F.col("length") >= capacity).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return small.select(*out).union(whole.select(*out))
