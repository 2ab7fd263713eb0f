"""Exact similarity classes from locality-sensitive buckets, without all pairs of a group.

``sign`` writes a row for each occurrence of a text (a document, a line) and, packed, one
record (key, text, sketch) for each band of each text that is new in its slice.
``similarity_classes`` then finds the connected components of the graph that links two texts
of a group whose Jaccard similarity, on full sets, reaches the threshold and whose signatures
agree in a whole band (``allowed``). Groups are texts joined by common buckets; the pairs of a
bucket are never written down, only each member with one other.

One rule holds for pairs of a group, whatever its size: the limits below decide how its pairs
are found, not which are. A group of at most MOST_NODES texts and MOST_SHINGLES shingles is
settled by one task in memory, by counts of common shingles. In a larger bucket's group let H
be its frequent shingles, those in more than RARE members. A pair x, y at the threshold t either

(a) shares a shingle that is not in H, so it is met there among at most RARE members; or
(b) has x & y inside H, so |x & y| <= min(|x & H|, |y & H|), and with
    |x & y| >= t / (1 + t) (|x| + |y|) this bounds |y| by room(x) = (1 + t) / t |x & H| - |x|
    and |x| by room(y): such pairs are met by size.

Groups are larger mostly because chance collisions chain them together. So each of their
buckets, texts whose signatures agree in one band, is settled by itself first, in blocks of
which two are in memory at once where the limits ask for it; only the texts of buckets beyond
LARGER times the limits go the way described above, which writes down every shingle.

Beforehand each member is verified against the member that has most of H; of (a) and (b)
only pairs whose ends are in different components by then are verified. A large group of
edited copies of one text is nearly settled by the first step, whatever its size.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .packed import FIELDS, Packer, bucket_count, dealt, passes, whole_buckets
from .shared import discard, respread, sieved, stash, stash_apart
from .words import MinHash, freeing, slices

#: texts -> (flat shingle hashes, offsets)
Shingler = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
#: slice of rows -> (place of each text's row in the slice, the text's place in that row, the texts)
Cutter = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, pa.Array]]
#: distinct texts -> (shingles of each, minima of those that have any)
Signer = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
#: (low, high) -> 0-1 rows of the nodes from low to high against all from low on
Rows = Callable[[int, int], np.ndarray]

MOST_NODES, MOST_SHINGLES, RARE = 8192, 1 << 22, 64
#: Times these limits that a bucket may have which one task settles, two blocks at a time.
LARGER = 4
#: Columns of a 0-1 matrix, and pairs, that are in memory at once.
COLUMNS, PAIRS = 1024, 1 << 21
#: Texts of small groups that are cut into shingles at once.
SHINGLED = 1024

#: A row for each occurrence of a text; in other rows only the first two columns, blobs of
#: records in BAND, or, in bucket LINKS, of pairs of short ids.
SIGNED = f"{FIELDS}, doc_id long, place int, id binary, h long, n_shingles long, sig binary"
NAMES = [c.split()[0] for c in SIGNED.split(", ")]
BAND = np.dtype([("key", "<u8"), ("h", "<i8"), ("sketch", "<u8")])
LINKS = -1
#: Links that a task holds before it writes them.
HELD_LINKS = 1 << 20


def components_in_memory(n: int, linked: Rows, step: int = 512) -> np.ndarray:
    """For each of ``n`` nodes the first of its component; only ``step`` rows are in memory at a time."""
    root = np.arange(n)
    for low in range(0, n, step):
        rows = linked(low, min(n, low + step))
        rows[np.arange(len(rows)), np.arange(len(rows))] = True
        several = np.flatnonzero(rows.sum(axis=1) > 1)
        for i in several.tolist():
            met = np.unique(root[low:][rows[i]])
            if len(met) > 1:
                into = np.arange(n)
                into[met] = met[0]
                root = into[root]
    return root


def roots_in_memory(sets: list[np.ndarray], num: int, den: int, may: Rows | None = None) -> np.ndarray:
    """For each set the first set of its component, by exact counts of common elements.

    may: which pairs count; all, if it is not given. Elements that more than a tenth of the sets have are counted as products of 0-1 matrices,
    the rarer ones by their pairs, whichever is less work.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), size)
    _, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    dense = counts > max(8, n // 10)
    column = np.cumsum(dense) - 1
    often = dense[place]
    often_owner, often_column = owner[often], column[place[often]]
    total = int(dense.sum())
    rarely = ~often & (counts[place] > 1)
    owner, place = owner[rarely], place[rarely]
    begins = np.flatnonzero(np.concatenate((np.ones(min(1, len(place)), bool), place[1:] != place[:-1])))
    lengths = np.diff(np.append(begins, len(place)))
    begin, length = np.repeat(begins, lengths), np.repeat(lengths, lengths)  # of each entry's element

    def linked(low: int, high: int) -> np.ndarray:
        met = np.zeros((high - low, n - low), np.float32)  # whole numbers, exact below 2**24
        for first in range(0, total, COLUMNS):
            a, b = np.searchsorted(often_column, (first, first + COLUMNS))
            block = np.zeros((n - low, min(COLUMNS, total - first)), np.float32)
            own = often_owner[a:b] >= low
            block[often_owner[a:b][own] - low, often_column[a:b][own] - first] = 1
            met += block[: high - low] @ block.T
        entries = np.flatnonzero((owner >= low) & (owner < high))
        flat = met.reshape(-1)
        while len(entries):
            upto = np.cumsum(length[entries])
            k = max(1, int(np.searchsorted(upto, PAIRS)))
            own, entries = entries[:k], entries[k:]
            x = np.repeat(owner[own] - low, length[own])
            y = owner[np.repeat(begin[own] - (upto[:k] - length[own]), length[own]) + np.arange(len(x))] - low
            real = y >= 0
            flat += np.bincount(x[real] * (n - low) + y[real], minlength=len(flat)).astype(np.float32)
        either = size[low:high, None] + size[None, low:]
        found = (met > 0) & ((den + num) * met.astype(np.int64) >= num * either)
        return found if may is None else found & may(low, high)

    return components_in_memory(n, linked, max(16, min(512, (1 << 21) // n)))


def roots_by_blocks(texts: pa.ChunkedArray, shingler: Shingler, num: int, den: int, rule: Callable[[np.ndarray], Rows] | None = None) -> np.ndarray:
    """What roots_in_memory says of the sets of ``texts``, of which no more than the limits allow are in memory at once.

    rule: texts, by their places -> which of their pairs count.

    Each pair of blocks of half the limits is settled, unless its texts are one component by then.
    """
    n = len(texts)
    counts = np.concatenate([np.diff(shingler(texts.slice(at, SHINGLED))[1]) for at in range(0, n, SHINGLED)])
    blocks, start, held = [], 0, 0
    for i, count in enumerate(counts.tolist()):
        if i > start and (i - start >= MOST_NODES // 2 or held + count > MOST_SHINGLES // 2):
            blocks.append(np.arange(start, i))
            start, held = i, 0
        held += count
    blocks.append(np.arange(start, n))
    root = np.arange(n)
    for a, b in itertools.combinations(blocks, 2) if len(blocks) > 1 else [(blocks[0], blocks[0][:0])]:
        own = np.concatenate((a, b))
        if (root[own] == root[own[0]]).all():
            continue
        values, offsets = shingler(texts.take(pa.array(own)))
        sets = [np.unique(values[x:y]) for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
        met = own[roots_in_memory(sets, num, den, rule and rule(own))]
        for i, j in zip(own.tolist(), met.tolist(), strict=True):
            if root[i] != root[j]:
                root[root == max(root[i], root[j])] = min(root[i], root[j])
    return root


def least_agreement(width: int, t: float) -> int:
    """In how many places the signatures of linked texts agree, at the least.

    A linked pair falls six standard deviations short of its expectation less than once in
    some hundred million, and only when it is near the threshold.
    """
    return max(1, math.ceil(t * width - 6 * (t * (1 - t) * width) ** 0.5))


def allowed(sigs: np.ndarray, rows: int, least: int) -> Rows:
    """Which pairs of signatures agree in a whole band of ``rows`` places, and in at least ``least`` places in all.

    This is asked of two signatures alone, so it does not matter what others they stand with.
    """
    n, width = sigs.shape
    bands = np.ascontiguousarray(sigs).reshape(n, width // rows, rows)
    codes = [np.unique(np.ascontiguousarray(bands[:, i]).view(f"V{rows}"), return_inverse=True)[1].reshape(-1).astype(np.int32) for i in range(width // rows)]

    def met(low: int, high: int) -> np.ndarray:
        banded = np.zeros((high - low, n - low), bool)
        for code in codes:
            banded |= code[low:high, None] == code[None, low:]
        if np.count_nonzero(banded) * 8 > banded.size:
            agree = np.zeros(banded.shape, np.uint8 if width < 256 else np.uint16)
            for column in sigs.T:
                agree += column[low:high, None] == column[None, low:]
            return banded & (agree >= least)
        x, y = np.nonzero(banded)
        for at in range(0, len(x), PAIRS // width):
            i, j = x[at : at + PAIRS // width], y[at : at + PAIRS // width]
            banded[i, j] = np.count_nonzero(sigs[low + i] == sigs[low + j], axis=1) >= least
        return banded

    return met


def roots_by_signature(sigs: np.ndarray, rows: int, least: int) -> np.ndarray:
    """For each signature the first of those joined by pairs that are allowed."""
    return components_in_memory(len(sigs), allowed(sigs, rows, least), max(16, min(512, (1 << 23) // len(sigs))))


#: Sketches of linked texts agree in fewer of their 16 places less than twice in 100,000 times
#: at a similarity of 0.8, and less than once in a million at 0.85.
AGREE = 6
#: Rows of one bucket that are compared by sketch; in a longer stretch all go to its first row.
STRETCH = 2048


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether two sketches agree in at least AGREE of their 16 places of four bits."""
    x = a ^ b
    x = (x | (x >> np.uint64(1)) | (x >> np.uint64(2)) | (x >> np.uint64(3))) & np.uint64(0x1111111111111111)
    return 16 - np.bitwise_count(x) >= AGREE


def spanned(linked: np.ndarray) -> np.ndarray:
    """For each row of symmetric 0-1 matrices the first row of its component."""
    n = linked.shape[-1]
    root = np.broadcast_to(np.arange(n, dtype=np.int32), linked.shape[:-1]).copy()
    while True:
        new = np.minimum(root, np.where(linked, root[..., None, :], np.int32(n)).min(axis=-1))
        new = np.take_along_axis(new, new.astype(np.intp), axis=-1)
        if (new == root).all():
            return root
        root = new


def stars(key: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """For rows sorted by key the first row that each is joined to by agreement with others of its key."""
    root = np.arange(len(key))
    begins = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1])))
    lengths = np.diff(np.append(begins, len(key)))
    for n in np.unique(lengths[lengths > 1]).tolist():
        own = begins[lengths == n]
        if n > STRETCH:
            for i in own.tolist():
                root[i : i + n] = i
            continue
        step = max(1, (1 << 20) // (n * n))
        for at in range(0, len(own), step):
            rows = own[at : at + step, None] + np.arange(n)
            x = sketch[rows]
            root[rows] = own[at : at + step, None] + spanned(agreeing(x[:, :, None], x[:, None, :]))
    return root


def meet(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(links, records left): pairs of short ids that share a key and agree, and one of each such set.

    A pair of equal ids says that the text occurs again. Of the records that are tied to
    another only that one is left, so a hot key shrinks to what does not agree.
    """
    order = np.argsort(records["key"])
    key = records["key"][order]
    same = key[1:] == key[:-1]
    several = np.zeros(len(key), bool)
    several[1:] |= same
    several[:-1] |= same
    lone, rows = order[~several], records[order[several]]
    rows = rows[np.lexsort((rows["h"], rows["key"]))]
    again = np.zeros(len(rows), bool)
    again[1:] = (rows["key"][1:] == rows["key"][:-1]) & (rows["h"][1:] == rows["h"][:-1])
    loops = rows["h"][again & (rows["key"] & np.uint64(15) == 0)]  # the first band's will do
    rows = rows[~again]
    root = stars(rows["key"], rows["sketch"])
    tied = root != np.arange(len(root))
    links = np.stack((rows["h"][tied], rows["h"][root[tied]]), axis=1)
    return np.concatenate((links, np.stack((loops, loops), axis=1))), np.concatenate((records[lone], rows[~tied]))


def unique_links(parts: list[np.ndarray]) -> np.ndarray:
    links = np.concatenate(parts) if parts else np.zeros((0, 2), np.int64)
    return np.unique(links.view([("a", "<i8"), ("b", "<i8")])).view(np.int64).reshape(-1, 2)


def sign(docs: DataFrame, cut: Cutter, signer: Signer, family: MinHash, label: str, most_bytes: int = 2 << 20) -> tuple[DataFrame, list[DataFrame]]:
    """SIGNED rows of the texts that ``cut`` finds in each row's ``text``, written to the shared folder.

    The occurrences and the blobs are tables of their own, as the blobs, most of the bytes, go
    first; those in as many parts as they are dealt out in turn, each of whole buckets.
    """
    buckets = bucket_count(docs.sparkSession)

    def occurrences(doc: pa.Array, texts: pa.Array) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
        row, place, found = cut(texts)
        coded = found.dictionary_encode()
        distinct, code = coded.dictionary, coded.indices
        known = distinct.cast(pa.binary()).to_pylist()
        ids = pa.array([hashlib.md5(x, usedforsecurity=False).digest() for x in known], pa.binary())
        h = np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in known), np.uint64, len(known)).astype(np.int64)  # as F.xxhash64
        counts, minima = signer(distinct)
        width = family.bands * family.rows
        sig = np.zeros((len(known), width), np.uint8)
        sig[counts > 0] = minima & 0xFF
        sig = pa.Array.from_buffers(pa.binary(width), len(known), [None, pa.py_buffer(sig.tobytes())]).cast(pa.binary())
        columns = [doc.take(pa.array(row)), pa.array(place, pa.int32()), *(x.take(code) for x in (ids, pa.array(h), pa.array(counts), sig))]
        n = len(found)
        out = pa.RecordBatch.from_arrays([pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), *columns], names=NAMES)
        records = np.empty((len(minima), family.bands), BAND)
        records["key"], records["h"], records["sketch"] = family.keys(minima), h[counts > 0, None], family.sketch(minima).view(np.uint64)[:, None]
        again = h[(np.bincount(code.to_numpy(), minlength=len(known)) > 1) & (counts > 0)]
        return out, records.reshape(-1), np.stack((again, again), axis=1)

    def blob_rows(bucket: pa.Array, blob: pa.Array) -> pa.RecordBatch:
        rest = (pa.nulls(len(bucket), t) for t in (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary()))
        return pa.RecordBatch.from_arrays([bucket, blob, *rest], names=NAMES)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: list[np.ndarray] = []

        def thinned(records: np.ndarray) -> np.ndarray:
            found, left = meet(records)
            links.append(found)
            return left

        packer = Packer("key", buckets, thinned)

        def given_out() -> Iterator[pa.RecordBatch]:
            if out := packer.out():
                yield blob_rows(*out)
                yield blob_rows(pa.array([LINKS], pa.int32()), pa.array([unique_links(links).tobytes()], pa.binary()))
                links.clear()

        for whole in batches:
            for low, high in slices(whole["text"], most_bytes):
                batch = whole.slice(low, high - low)
                rows, records, again = occurrences(batch["doc_id"], batch["text"])
                yield rows
                links.append(again)
                if packer.add(records):
                    yield from given_out()
        yield from given_out()

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text").filter(F.col("text").isNotNull())
    signed, *blobs = stash_apart(rows.mapInArrow(freeing(made), SIGNED), label, "bucket", passes(docs.sparkSession))
    return signed, blobs


def bucket_links(blobs: DataFrame) -> DataFrame:
    """(a, b): short ids that share a bucket and agree by sketch, or are joined by such that do.

    Of the texts of a key those that agree are joined, which keeps chance collisions from
    chaining groups together; where more than STRETCH that do not agree share a key, all are
    joined to the first. Texts that agree are reduced to one for each task before they are
    dealt out, and again whenever a bucket grows, so that a hot key does not gather. A pair
    (a, a) is a text that occurs more than once.
    """

    def out(links: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def thinned(records: np.ndarray) -> np.ndarray:
            found, left = meet(records)
            held.append(found)
            return left

        for records in whole_buckets(batches, BAND, thinned):
            thinned(records)
            if sum(map(len, held)) > HELD_LINKS:
                yield out(unique_links(held))
                held.clear()
        yield out(unique_links(held))

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                yield out(np.frombuffer(blob, np.int64).reshape(-1, 2))

    met = dealt(blobs.filter(f"bucket <> {LINKS}")).mapInArrow(freeing(linked), "a long, b long")
    early = blobs.filter(f"bucket = {LINKS}").select("blob").mapInArrow(freeing(unpacked), "a long, b long")
    return met.union(early)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by g, in tables that hold all rows of each of their groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        g = batch["g"].to_numpy()
        if not len(g):
            continue
        last = int(np.searchsorted(g, g[-1]))
        if held and (last or held[-1]["g"][-1].as_py() != g[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        elif last:
            yield pa.Table.from_batches([batch.slice(0, last)])
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def roots_of_groups(table: pa.Table, shingler: Shingler, num: int, den: int, rows: int = 1) -> np.ndarray:
    """For each row of whole groups the first row of its component: by signatures in bands of ``rows``, then by full sets.

    A pair is linked if its signatures allow it and its full sets are similar enough.
    """
    n = table.num_rows
    sigs = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint8).reshape(n, -1)
    width, least = sigs.shape[1], least_agreement(sigs.shape[1], num / den)
    g = table["g"].to_numpy()
    begins = np.flatnonzero(np.concatenate((np.ones(min(1, n), bool), g[1:] != g[:-1])))
    lengths = np.diff(np.append(begins, n))
    near = np.arange(n)
    for size in np.unique(lengths[lengths > 1]).tolist():
        own = begins[lengths == size]
        if size > 16:
            for i in own.tolist():
                near[i : i + size] = i + roots_by_signature(sigs[i : i + size], rows, least)
            continue
        for at in range(0, len(own), 1024):
            members = own[at : at + 1024, None] + np.arange(size)
            x = sigs[members]
            same = x[:, :, None] == x[:, None]
            banded = same.reshape(*same.shape[:-1], width // rows, rows).all(axis=-1).any(axis=-1)
            near[members] = own[at : at + 1024, None] + spanned(banded & (same.sum(axis=-1) >= least))
    root = np.arange(n)
    order = np.argsort(near, kind="stable")
    parts = [x for x in np.split(order, np.flatnonzero(np.diff(near[order])) + 1) if len(x) > 1]
    length = pc.binary_length(table["text"]).to_numpy()
    large = [len(x) > MOST_NODES or len(x) > 2 and length[x].sum() > MOST_SHINGLES for x in parts]
    for x in (x for x, more in zip(parts, large, strict=True) if more):
        own = sigs[x]
        root[x] = x[roots_by_blocks(table["text"].take(pa.array(x)), shingler, num, den, lambda places, own=own: allowed(own[places], rows, least))]
    parts = [x for x, more in zip(parts, large, strict=True) if not more]
    while parts:
        # as many components as SHINGLED texts are in, at least one
        k = max(1, int(np.searchsorted(np.cumsum([len(x) for x in parts]), SHINGLED)))
        now, parts = parts[:k], parts[k:]
        values, offsets = shingler(table["text"].take(pa.array(np.concatenate(now))))
        sets = [np.unique(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        done = 0
        for x in now:
            own = sets[done : done + len(x)]
            done += len(x)
            if len(x) == 2:
                met = len(np.intersect1d(*own, assume_unique=True))
                if met and den * met >= num * (len(own[0]) + len(own[1]) - met):
                    root[x] = x[0]
            else:
                root[x] = x[roots_in_memory(own, num, den, allowed(sigs[x], rows, least))]
    return root


def similarity_classes(signed: DataFrame, blobs: list[DataFrame], texts: DataFrame, shingler: Shingler, band: int, num: int, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """Texts that occur again or share a bucket, and the components that they are in.

    signed, blobs: what ``sign`` returned; the blobs are discarded, each part before the next
    one goes through the shuffle. texts: (h, text), all the
    texts again, equal ones too. band: minima of a band of what signed them.
    Linked: ``den * |x & y| >= num * |x | y|`` on the sets that ``shingler`` makes, with at
    least one element in common, and signatures that allow it. Returns two stashed tables: the occurrences (doc_id, place,
    id, ...) of these texts, and for each text (id) n, the occurrences of all texts of its
    component, repeated rows included, with first_doc and first_place, those of the least
    doc_id, nulls last, then least place. Texts without shingles and those alone in their
    buckets have no rows. An empty table gives none.
    """
    occurrences = signed.count()
    found = []
    for part in blobs:
        found.append(stash(bucket_links(part), "links", occurrences // len(blobs)))
        discard(part)
    links = functools.reduce(DataFrame.union, found)
    size = links.count()  # texts in groups are twice as many at most
    joined = components(links, "a", "b", size)
    # a component's root is its least node, so a text that only occurs again can be its own
    again = links.filter("a = b").select(F.col("a").alias("h"), F.col("a").alias("g"))
    groups = stash(joined.select(F.col("node").alias("h"), F.col("root").alias("g")).union(again).groupBy("h").agg(F.min("g").alias("g")), "groups", size, light=True)
    for table in (joined, *found):
        discard(table)
    rows = signed.filter("n_shingles > 0").select("doc_id", "place", "id", "h", "n_shingles", "sig")
    met = stash(sieved(rows, groups, "h").join(groups, "h"), "met", occurrences)
    discard(groups)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place")).alias("first")
    same = (F.min(c).alias(c) for c in ("g", "h", "n_shingles", "sig"))
    known = stash(met.groupBy("id").agg(F.count("*").alias("n"), first, *same), "known", size, light=True)
    sums = known.groupBy(*respread("g")).agg(F.count("*").alias("_n"), F.sum("n_shingles").alias("_m"))
    sums = sums.filter("_n > 1").select("g", F.expr(f"_n <= {MOST_NODES} and _m <= {MOST_SHINGLES}").alias("small"))
    wanted = stash(known.join(sums, "g").select("g", "id", "h", "n_shingles", "sig", "small"), "wanted", size, light=True)
    # a hot text is reduced to one for each task before the shuffle
    own = sieved(texts, wanted, "h").select(F.unhex(F.md5("text")).alias("id"), "text").groupBy("id").agg(F.first("text").alias("text"))
    found = stash(wanted.drop("h").join(own, "id"), "texts", size)
    discard(wanted)

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            ids, root = table["id"], roots_of_groups(table, shingler, num, den, band)
            joined = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(joined)).combine_chunks(), ids.take(pa.array(root[joined])).combine_chunks()], names=["node", "root"])

    def tied(rows: DataFrame) -> DataFrame:
        """The groups of a task are settled many at once."""
        rows = rows.select("g", "id", "sig", "text").repartition("g").sortWithinPartitions("g", "id")
        return rows.mapInArrow(freeing(settled), "node binary, root binary")

    classes = tied(found.filter("small"))
    large = found.filter("not small")
    if not large.isEmpty():
        classes = classes.union(_by_bucket(large, band, tied, shingler, num, den))
    rooted = stash(known.join(classes, F.col("id") == F.col("node"), "left").select("id", "n", "first", F.coalesce("root", "id").alias("root")), "roots", size)
    discard(found)
    discard(known)
    whole = rooted.groupBy(*respread("root")).agg(F.sum("n").alias("n"), F.min("first").alias("least")).select("root", "n", "least")
    named = rooted.select("id", "root").join(whole, "root").select("id", "n", F.col("least.doc_id").alias("first_doc"), F.col("least.place").alias("first_place"))
    named = stash(named, "named", size, light=True)
    discard(rooted)
    return met, named


def _by_bucket(texts: DataFrame, band: int, tied: Callable[[DataFrame], DataFrame], shingler: Shingler, num: int, den: int) -> DataFrame:
    """(node, root) of groups that one task does not hold, by their buckets; see the module's text.

    Buckets are of signatures, not of texts: those that agree in one band, in one group.
    """
    own = F.transform(
        F.sequence(F.lit(0), F.expr(f"cast(length(sig) div {band} as int)") - 1),
        lambda i: F.xxhash64("g", i, F.substring("sig", i * band + 1, F.lit(band))),
    )
    placed = stash(texts.select(F.explode(own).alias("g"), "id", "n_shingles"), "placed")
    sums = placed.groupBy(*respread("g")).agg(F.count("*").alias("_n"), F.sum("n_shingles").alias("_m")).filter("_n > 1")
    sums = sums.select("g", F.expr(f"_n <= {LARGER * MOST_NODES} and _m <= {LARGER * MOST_SHINGLES}").alias("small"))
    shared = stash(placed.join(sums, "g").select("g", "id", "small"), "shared")
    discard(placed)
    edges = ties = stash(tied(shared.filter("small").join(texts.select("id", "sig", "text"), "id")), "ties")
    hot = shared.filter("not small").select("id").distinct()
    if not hot.isEmpty():
        edges = edges.union(_large(texts.join(hot, "id"), band, shingler, num, den).filter("node <> root").select("node", "root"))
    joined = components(edges, "node", "root")
    classes = stash(joined.filter("node <> root"), "classes")
    for table in (shared, ties, joined):
        discard(table)
    return classes


def _large(texts: DataFrame, band: int, shingler: Shingler, num: int, den: int) -> DataFrame:
    """(node, root) of the texts of buckets that one task does not hold; see the module's text."""

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                values, offsets = shingler(batch["text"])
                sets = [np.unique(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                borders = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
                flat = np.concatenate(sets).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch["g"], batch["id"], batch["sig"], pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(flat))], names=["g", "id", "sig", "items"])

    members = stash(texts.select("g", "id", "sig", "text").mapInArrow(freeing(shingled), "g long, id binary, sig binary, items array<long>"), "members")
    items = members.select("g", "id", F.explode("items").alias("s"))
    often = items.groupBy(*respread("g", "s")).agg(F.count("*").alias("n")).filter("n > 1").select("g", "s", "n")
    often = stash(often, "often")
    inside = items.join(often.filter(F.col("n") > RARE), ["g", "s"]).groupBy("g", "id").agg(F.count("*").alias("inside"))
    counts = members.select("g", "id", F.size("items").cast("long").alias("size"))
    counts = stash(counts.join(inside, ["g", "id"], "left").withColumn("inside", F.coalesce("inside", F.lit(0))), "counts")
    found = edges = None

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch["items_a"], batch["items_b"]
            sigs = [np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(batch.num_rows, -1, band) for c in ("sig_a", "sig_b")] if batch.num_rows else []
            keep = []
            for i in range(batch.num_rows):
                same = sigs[0][i] == sigs[1][i]
                if not same.all(axis=1).any() or np.count_nonzero(same) < least_agreement(same.size, num / den):
                    keep.append(False)
                    continue
                p, q = x[i].values.to_numpy(), y[i].values.to_numpy()
                met = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(met > 0 and den * met >= num * (len(p) + len(q) - met))
            yield pa.RecordBatch.from_arrays([batch["a"].filter(pa.array(keep)), batch["b"].filter(pa.array(keep))], names=["a", "b"])

    def grown(pairs: DataFrame) -> None:
        nonlocal found, edges
        left, right = (members.select(F.col("id").alias(f"id_{e}"), F.col("sig").alias(f"sig_{e}"), F.col("items").alias(f"items_{e}")) for e in "ab")
        rows = pairs.join(left, F.col("a") == F.col("id_a")).join(right, F.col("b") == F.col("id_b")).select("a", "b", "sig_a", "sig_b", "items_a", "items_b")
        more = stash(rows.mapInArrow(freeing(verify), "a binary, b binary"), "links")
        if more.isEmpty():
            return
        edges = more if edges is None else edges.union(more)
        found = stash(components(edges), "classes")

    def placed(rows: DataFrame) -> DataFrame:
        if found is None:
            return rows.withColumn("comp", F.col("id"))
        own = found.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        return rows.join(own, F.col("id") == F.col("_node"), "left").withColumn("comp", F.coalesce("_root", "id")).drop("_node", "_root")

    # each member against the one that has most of the frequent shingles, and the next most
    top = counts.groupBy(*respread("g")).agg(F.max(F.struct("inside", F.col("size") * -1, "id")).alias("m")).select("g", F.col("m.id").alias("b"))
    grown(counts.join(top, "g").filter("id <> b").select(F.col("id").alias("a"), "b"))

    # (b) by size: common shingles that are all frequent
    room = F.floor(F.col("inside") * (den + num) / F.lit(float(num)) + 1e-9).cast("long") - F.col("size")
    sized = stash(placed(counts.withColumn("room", room).filter(F.col("room") * den >= F.col("size") * num)), "sized")
    several = sized.groupBy(*respread("g")).agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).filter("c1 <> c2").select("g")
    sized = stash(sized.join(several, "g"), "sized")
    scale = lambda c: F.floor(F.log(c.cast("double")) / float(np.log(1.02))).cast("long")
    low = F.greatest(F.ceil(F.col("size") * num / F.lit(float(den)) - 1e-9).cast("long"), F.lit(1).cast("long"))
    high = F.least("room", "size")
    x = sized.filter(high >= low).select("g", F.col("id").alias("a"), F.col("comp").alias("ca"), F.col("size").alias("sa"), F.col("room").alias("ra"), F.explode(F.sequence(scale(low), scale(high))).alias("bin"))
    y = sized.select("g", F.col("id").alias("b"), F.col("comp").alias("cb"), F.col("size").alias("sb"), F.col("room").alias("rb"), scale(F.col("size")).alias("bin"))
    met = x.join(y, ["g", "bin"]).filter("ca <> cb and sb <= ra and sa <= rb and sb <= sa and a <> b")
    grown(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    # (a) by shingles that at most RARE members have; with these a pair has m + min(inside) in
    # common at most, which dismisses most pairs before their sets are looked at
    own = counts.select(F.col("id").alias("_id"), "size", "inside")
    rare = placed(items.join(often.filter(F.col("n") <= RARE), ["g", "s"]).select("g", "s", "id"))
    several = rare.groupBy(*respread("g", "s")).agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).filter("c1 <> c2").select("g", "s")
    rare = rare.join(several, ["g", "s"]).join(own, F.col("id") == F.col("_id")).drop("_id")
    rare = stash(rare, "rare")
    x, y = (rare.select("g", "s", F.col("id").alias(i), F.col("comp").alias(f"c{i}"), F.struct("size", "inside").alias(f"n{i}")) for i in "ab")
    met = x.join(y, ["g", "s"]).filter("a < b and ca <> cb").groupBy("a", "b").agg(F.count("*").alias("m"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    grown(met.filter(f"(m + least(na.inside, nb.inside)) * {den + num} >= {num} * (na.size + nb.size)").select("a", "b"))
    for table in (members, often, counts, sized, rare):
        discard(table)
    return placed(texts.select("id")).select(F.col("id").alias("node"), F.col("comp").alias("root"))
