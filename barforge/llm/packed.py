"""Records of fixed size dealt out by key as blobs: one row of a shuffle holds many of them.

A shuffle row for each record costs more than the record. Here a task sorts its records by
bucket, a hash of their key, and writes one blob for each bucket and some 8 MB of records;
Spark deals out the blobs, and a task reads whole buckets one by one. All records of a key
are in one bucket. What a task holds at once is a bucket, so a hot key has to be thinned out
before it is dealt (``flush`` does that for each blob); the number of buckets follows
``spark.sql.shuffle.partitions``, which is set by the size of the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .words import mixed

#: Buckets for each shuffle partition; a bucket is the most that a task holds at once.
SHARE = 4
#: Bytes of records that wait for each other in a task.
HELD_BYTES = 8 << 20
FIELDS = "bucket int, blob binary"
#: Parts in which blobs that are on disk are dealt out one after the other, so that no more than
#: one part is there twice, as blobs and in the shuffle; shuffle partitions that each asks for.
PASSES, PASS_PARTITIONS = 4, 12


def bucket_count(spark: SparkSession) -> int:
    return max(1024, SHARE * int(spark.conf.get("spark.sql.shuffle.partitions")))


def passes(spark: SparkSession) -> int:
    return max(1, min(PASSES, int(spark.conf.get("spark.sql.shuffle.partitions")) // PASS_PARTITIONS))


def blobs(records: np.ndarray, key: str, buckets: int) -> list[pa.Array]:
    """The columns bucket and blob of structured ``records``."""
    owner = (mixed(records[key].astype(np.uint64, copy=False)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(owner, kind="stable")
    records, owner = records[order], owner[order]
    begins = np.flatnonzero(np.concatenate((np.ones(min(1, len(owner)), bool), owner[1:] != owner[:-1])))
    ends = np.append(begins, len(owner))[1:] * records.dtype.itemsize
    borders = pa.array(np.concatenate(([0], ends)), pa.int32())
    return [pa.array(owner[begins]), pa.Array.from_buffers(pa.binary(), len(begins), [None, borders.buffers()[1], pa.py_buffer(records.tobytes())])]


class Packer:
    """Collects records and gives them out as (bucket, blob) columns, some HELD_BYTES at once."""

    def __init__(self, key: str, buckets: int, flush: Callable[[np.ndarray], np.ndarray] | None = None) -> None:
        self.key, self.buckets, self.flush = key, buckets, flush or (lambda records: records)
        self.parts: list[np.ndarray] = []
        self.held = 0

    def add(self, records: np.ndarray) -> bool:
        """Whether it is time to give them out."""
        self.parts.append(records)
        self.held += records.nbytes
        return self.held >= HELD_BYTES

    def out(self) -> list[pa.Array] | None:
        if not self.held:
            return None
        records = np.concatenate(self.parts)
        self.parts, self.held = [], 0
        return blobs(self.flush(records), self.key, self.buckets)


def dealt(packed: DataFrame) -> DataFrame:
    """Blobs (bucket, blob) with each bucket's together and after each other."""
    return packed.select("bucket", "blob").repartition("bucket").sortWithinPartitions("bucket")


def whole_buckets(batches: Iterator[pa.RecordBatch], dtype: np.dtype, thin: Callable[[np.ndarray], np.ndarray] | None = None) -> Iterator[np.ndarray]:
    """The records of each bucket of a task in turn.

    thin: makes fewer of a bucket's records as they come in, whenever they are twice as many
    as it left the last time and at least HELD_BYTES.
    """
    known, parts, held, least = None, [], 0, HELD_BYTES
    for batch in batches:
        column = batch.column(1)
        column = column.cast(pa.binary()) if pa.types.is_large_binary(column.type) else column
        for bucket, blob in zip(batch.column(0).to_pylist(), column, strict=True):
            if bucket != known and parts:
                yield np.concatenate(parts)
                parts, held, least = [], 0, HELD_BYTES
            known = bucket
            parts.append(np.frombuffer(blob.as_buffer(), dtype))
            held += parts[-1].nbytes
            if thin and held >= least:
                parts = [thin(np.concatenate(parts))]
                held = parts[0].nbytes
                least = max(HELD_BYTES, 2 * held)
    if parts:
        yield np.concatenate(parts)
