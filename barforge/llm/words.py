"""Vectorised word and shingle hashing over Arrow batches.

Words are maximal runs outside ``[\\x20\\x09-\\x0D]`` of the text with A-Z lower-cased.
Everything is flat: one array of word hashes for a batch, with the offsets of its texts.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

MIX_1, MIX_2, ODD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
#: Bytes that are no white space.
SOLID = np.array([x != 0x20 and not 0x09 <= x <= 0x0D for x in range(256)])
#: Elements hashed at once, so that one block of minima is found in the processor's cache.
BLOCK = 1 << 15


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def mixed_32(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 32-bit values (the finisher of MurmurHash3)."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def freeing(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` on a task's batches, after which its worker gives back the memory it does not use.

    Workers are kept for later tasks; what their allocators hold would add to those of the
    stages that follow, which may need none of it.
    """

    @functools.wraps(work)  # plans show its name
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return run


def slices(texts: pa.Array, most_bytes: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most_bytes`` of text each; a longer text is a range by itself."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most_bytes:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def word_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All lower-cased words of ``texts``, flat, and the offsets of each text's words."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, offsets = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not real.all():
        before = np.concatenate(([0], np.cumsum(real)))
        flat, offsets = flat.filter(pa.array(real)), before[offsets]
    return flat, offsets


def word_counts(texts: pa.Array) -> np.ndarray:
    """Words of each text: bytes that are no white space and follow white space or the text's start."""
    borders = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[borders[0] : borders[-1]]
    borders = borders - borders[0]
    solid = SOLID[raw]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = borders[:-1][np.diff(borders) > 0]
    begins[inner] = solid[inner]
    return np.diff(np.concatenate(([0], np.cumsum(begins)))[borders])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat, offsets = word_lists(texts)
    coded = flat.dictionary_encode()
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(coded.dictionary))
    return (table[coded.indices.to_numpy(zero_copy_only=False)] if len(flat) else np.zeros(0, np.uint64)), offsets


def shingles(hashes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``width``-word window of every text, flat, and the texts' offsets.

    A text with fewer words has one shingle, its whole sequence; one without words none.
    """
    counts = np.diff(offsets)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out = np.concatenate(([0], np.cumsum(made)))
    total = int(out[-1])
    if not total:
        return np.zeros(0, np.uint64), out
    text = np.repeat(np.arange(len(counts)), made)
    first = offsets[text] + (np.arange(total) - out[text])
    last = np.minimum(first + width, offsets[text + 1])
    acc = np.zeros(total, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            at = first + j
            inside = at < last
            acc = np.where(inside, mixed((acc + ODD) ^ hashes[np.minimum(at, len(hashes) - 1)]), acc)
    return acc, out


def distinct_counts(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros(len(offsets) - 1, np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        if b - a == 1:
            out[i] = 1
        elif b > a:
            part = np.sort(values[a:b])
            out[i] = 1 + np.count_nonzero(part[1:] != part[:-1])
    return out


class MinHash:
    """``bands * rows`` universal hash minima: x -> a * x + b modulo 2**32 over mixed shingles."""

    def __init__(self, bands: int, rows: int, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint64).astype(np.uint32)

    def minima(self, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row of minima for each text; texts without shingles get the largest value."""
        full = np.flatnonzero(np.diff(offsets))
        out = np.full((len(offsets) - 1, len(self.a)), np.uint32(0xFFFFFFFF), np.uint32)
        out[full] = self.span_minima(values, offsets[full], offsets[full + 1])
        return out

    def span_minima(self, values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Minima of values[begin:end], none empty, in rising order; what lies between is passed over."""
        n = len(begin)
        out = np.empty((n, len(self.a)), np.uint32)
        if not n:
            return out
        apart = bool((begin[1:] != end[:-1]).any())
        buffer = np.empty(max(2 * BLOCK, int((end - begin).max())), np.uint32)
        i = 0
        while i < n:
            k = max(i + 1, int(np.searchsorted(begin, begin[i] + BLOCK)))
            low, high = int(begin[i]), int(end[k - 1])
            if high - low > len(buffer):
                buffer = np.empty(high - low, np.uint32)
            x, hashed = values[low:high], buffer[: high - low]
            if x.dtype == np.uint64:
                x = (x >> np.uint64(32)).astype(np.uint32)
            borders = begin[i:k] - low
            if apart:
                borders = np.column_stack((borders, end[i:k] - low)).reshape(-1)[:-1]
            for j in range(len(self.a)):
                np.multiply(x, self.a[j], out=hashed)
                np.add(hashed, self.b[j], out=hashed)
                least = np.minimum.reduceat(hashed, borders)
                out[i:k, j] = least[::2] if apart else least
            i = k
        return out

    def sketch(self, minima: np.ndarray) -> np.ndarray:
        """64 bits of each row: four of each of 16 minima, of different bands as far as there are."""
        chosen = minima.reshape(len(minima), self.bands, self.rows).transpose(0, 2, 1).reshape(len(minima), self.bands * self.rows)[:, :16]
        return ((chosen & np.uint32(15)).astype(np.uint64) << (np.arange(chosen.shape[1], dtype=np.uint64) * np.uint64(4))).sum(axis=1, dtype=np.uint64).astype(np.int64)

    def keys(self, minima: np.ndarray) -> np.ndarray:
        """A 64-bit key for each text and band; its lowest four bits are the band's number."""
        n = len(minima)
        wide = minima.astype(np.uint64).reshape(n, self.bands, self.rows)
        acc = np.broadcast_to(mixed(np.arange(1, self.bands + 1, dtype=np.uint64) * ODD), (n, self.bands)).copy()
        with np.errstate(over="ignore"):
            for r in range(self.rows):
                acc = mixed((acc + ODD) ^ wide[:, :, r])
        return (acc & ~np.uint64(15)) | (np.arange(self.bands, dtype=np.uint64) & np.uint64(15))
