"""Token ids in sorted-string-table shards.

A shard file holds documents in ascending key order:

    block*  index  bloom  footer

* key: 1 byte (0: null doc_id, 1: else) and doc_id as 8 big-endian bytes with the sign bit
  flipped, so that bytes sort as numbers do.
* block: zstd of entries [shared u8 | rest u8 | value length u32 | rest of key | value], keys
  prefix-compressed against the one before; value: the ids as little-endian u16 or u32. In
  front stand length u32 and crc32 u32 of the compressed bytes.
* index: for each block first key (9 bytes) and offset u64; searched by bisection.
* bloom: bits of all keys, HASHES bits of xxhash64 with different seeds for each key.
* footer: fixed size, little-endian: see FOOTER.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import fresh_path, stash
from .tokens import encoder
from .words import freeing, slices

MAGIC = b"BFSST001"
#: offsets of index and bloom, their lengths, blocks, documents, ids, bytes an id, magic
FOOTER = struct.Struct("<QQQQQQQQ8s")
ENTRY = struct.Struct("<BBI")
HEAD = struct.Struct("<II")
BLOCK_BYTES = 256 << 10
BITS_A_KEY, HASHES = 10, 7

#: Ranges that documents are dealt out by, at the most: at 100 TB they hold five GB each.
MOST_RANGES = 20_000

MANIFEST = "path string, shard long, first binary, docs long, ids long, bytes long"


def key_of(doc_id: int | None) -> bytes:
    return bytes(9) if doc_id is None else b"\x01" + ((doc_id + (1 << 63)) & ((1 << 64) - 1)).to_bytes(8, "big")


def doc_of(key: bytes) -> int | None:
    return int.from_bytes(key[1:], "big") - (1 << 63) if key[0] else None


def _places(key: bytes, bits: int) -> list[int]:
    return [xxhash.xxh64_intdigest(key, seed) % bits for seed in range(HASHES)]


def _opened(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class ShardWriter:
    """Entries must come in ascending key order; repeated keys are allowed."""

    def __init__(self, path: str, width: int = 2) -> None:
        self.system, self.place = _opened(path)
        self.system.create_dir(self.place.rpartition("/")[0], recursive=True)
        self.out, self.width, self.offset = self.system.open_output_stream(self.place), width, 0
        self.block, self.last, self.index, self.keys, self.ids, self.size = [], b"", [], [], 0, 0
        self.press = zstandard.ZstdCompressor(level=1)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        key = key_of(doc_id)
        if not self.block:
            self.index.append((key, self.offset))
            self.last = b""
        shared = next((i for i, (x, y) in enumerate(zip(key, self.last, strict=False)) if x != y), min(len(key), len(self.last)))
        value = ids.astype("<u2" if self.width == 2 else "<u4").tobytes()
        self.block += (ENTRY.pack(shared, len(key) - shared, len(value)), key[shared:], value)
        self.last, self.size, self.ids = key, self.size + len(value) + 16, self.ids + len(ids)
        self.keys.append(key)
        if self.size >= BLOCK_BYTES:
            self._flush()

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.offset += len(data)

    def _flush(self) -> None:
        if self.block:
            data = self.press.compress(b"".join(self.block))
            self._write(HEAD.pack(len(data), zlib.crc32(data)) + data)
            self.block, self.size = [], 0

    def close(self) -> None:
        self._flush()
        at_index = self.offset
        self._write(b"".join(k + struct.pack("<Q", o) for k, o in self.index))
        at_bloom, bits = self.offset, max(64, -(-len(self.keys) * BITS_A_KEY // 8) * 8)
        bloom = np.zeros(bits, np.uint8)
        for key in self.keys:
            bloom[_places(key, bits)] = 1
        self._write(np.packbits(bloom).tobytes())
        self._write(FOOTER.pack(at_index, at_bloom, at_bloom - at_index, self.offset - at_bloom, len(self.index), len(self.keys), self.ids, self.width, MAGIC))
        self.out.close()


class ShardReader:
    def __init__(self, path: str) -> None:
        system, place = _opened(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        foot = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if foot[-1] != MAGIC:
            raise ValueError(f"{path} is no shard")
        self.at_index, self.at_bloom, n_index, n_bloom, _, self.docs, self.ids, self.width, _ = foot
        index = self.file.read_at(n_index, self.at_index)
        self.first = [index[i : i + 9] for i in range(0, n_index, 17)]
        self.offsets = [struct.unpack_from("<Q", index, i + 9)[0] for i in range(0, n_index, 17)]
        self.bloom = self.file.read_at(n_bloom, self.at_bloom)

    def __enter__(self) -> ShardReader:
        return self

    def __exit__(self, *_: object) -> None:
        self.file.close()

    def block(self, k: int) -> Iterator[tuple[bytes, np.ndarray]]:
        end = self.offsets[k + 1] if k + 1 < len(self.offsets) else self.at_index
        raw = self.file.read_at(end - self.offsets[k], self.offsets[k])
        length, crc = HEAD.unpack_from(raw)
        packed = raw[HEAD.size : HEAD.size + length]
        if zlib.crc32(packed) != crc:
            raise ValueError("a block is damaged")
        data, at, key = zstandard.ZstdDecompressor().decompress(packed), 0, b""
        while at < len(data):
            shared, rest, n = ENTRY.unpack_from(data, at)
            at += ENTRY.size
            key = key[:shared] + data[at : at + rest]
            at += rest
            yield key, np.frombuffer(data, "<u2" if self.width == 2 else "<u4", n // self.width, at)
            at += n

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for k in range(len(self.offsets)):
            for key, ids in self.block(k):
                yield doc_of(key), ids

    def get(self, doc_id: int | None) -> np.ndarray | None:
        """The ids of one document: Bloom filter, bisection of the block index, one or two blocks."""
        key = key_of(doc_id)
        bits = len(self.bloom) * 8
        if not all(self.bloom[p >> 3] >> (7 - (p & 7)) & 1 for p in _places(key, bits)):
            return None
        k = max(0, bisect_right(self.first, key) - 1)
        while k > 0 and self.first[k] == key:  # a repeated key may begin in the block before
            k -= 1
        for j in range(k, len(self.first)):
            if j > k and self.first[j] > key:
                return None
            for found, ids in self.block(j):
                if found == key:
                    return ids
        return None


def write_shards(docs: DataFrame, path: str, end_id: int = 0, shard_bytes: int = 32 << 20) -> DataFrame:
    """Encode whole texts and write them as shards in doc_id order; returns the manifest.

    Rows are dealt out by ranges of doc_id, and of a hash of the text where a doc_id repeats, of
    about ``shard_bytes`` of text but no more than MOST_RANGES, as the bounds of ranges are known
    to the driver and every task. A task streams its sorted rows and begins another shard
    whenever one has met twice ``shard_bytes``. A task that runs again writes other files; the
    manifest, itself a written table, names those that count.
    """
    spark = docs.sparkSession
    folder = fresh_path(spark, "shards")
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, min(MOST_RANGES, -(-total // shard_bytes)))
    end = np.array([end_id], np.uint32)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, out, first, shard = encoder(path), None, None, TaskContext.get().partitionId() << 20
        width, held, name = 2 if table.tokenizer.get_vocab_size() <= 1 << 16 else 4, 0, ""

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([shard], pa.int64()), pa.array([first], pa.binary()), pa.array([len(out.keys)], pa.int64()), pa.array([out.ids], pa.int64()), pa.array([out.offset], pa.int64())],
                names=[c.split()[0] for c in MANIFEST.split(", ")],
            )

        for whole in batches:
            for low, high in slices(whole["text"], 2 << 20):
                batch = whole.slice(low, high - low)
                sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_pylist()
                for doc, size, ids in zip(batch["doc_id"].to_pylist(), sizes, table.encode(batch["text"]), strict=True):
                    if out is not None and held >= 2 * shard_bytes:
                        yield closed()
                        out, shard = None, shard + 1
                    if out is None:
                        name = f"{folder}/{shard:012d}-{uuid.uuid4().hex}.sst"
                        out, first, held = ShardWriter(name, width), key_of(doc), 0
                    out.add(doc, np.concatenate((ids, end)))
                    held += size
        if out is not None:
            yield closed()

    order = F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return stash(ranged.mapInArrow(freeing(written), MANIFEST), "manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of ``manifest``."""
    # a row for each file, whose number is that of shard_bytes pieces of the corpus
    before = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.withColumn("base", before.cast("long"))
    files = files.repartition(F.col("shard"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

        for batch in batches:
            for path, at in zip(batch["path"].to_pylist(), batch["base"].to_pylist(), strict=True):
                rows = []
                with ShardReader(path) as shard:
                    for doc, ids in shard:
                        rows.append((doc, at, len(ids), zlib.crc32(ids.astype("<u4").data)))
                        at += len(ids)
                        if len(rows) == 10_000:
                            yield made(rows)
                            rows = []
                if rows:
                    yield made(rows)

    return files.select("path", "base").mapInArrow(freeing(read), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_shards(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Write every whole text's ids and the end id to shards, and read the shards back.

    docs: doc_id, text; other columns are ignored. Null and empty texts have the end id
    alone. A null doc_id stands before all others; rows that repeat a doc_id follow each
    other. An empty table gives no files and no rows. Returns a row for each input row.
    """
    return read_shards(write_shards(docs, path, end_id))
