"""Benchmark items in documents: CGK embedding, bit-sampling LSH, exact edit distance.

The CGK random walk reads a string with one pointer: at step j it writes the character under
the pointer and moves on if a random function of j and that character says so. Strings at
small edit distance walk into step again, so their embeddings differ in few places, and
samples of places agree with good odds. Walks must begin together: a window begins at eight
bytes of the text that are an anchor of an item, and reads as far as the item reaches from
there, forward for anchors in the item's first half, else backward, so that every window has
at least half the item's size. An edit loses the anchors it touches; an item has several.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import ODD, freeing, slices

#: An item's anchors: the ANCHORS runs of GRAM bytes that are least likely by the benchmark's own
#: letters, begun at least APART bytes from each other. Items too short for three such runs have
#: shorter ones. Target: of passages of 15 words or more with edits scattered over characters, at
#: least 95 in a hundred are found right up to MOST_EDITS, 98 in a hundred up to three quarters.
ANCHORS, GRAM, APART = 24, 8, 3
#: A window of a passage agrees in some band with good odds at each anchor that is left; of
#: windows that only share the anchor one in some eight does, and is mostly dismissed by pieces.
WALKS, BANDS, SAMPLED = 4, 32, 4
#: Steps of a walk before its random functions are used again.
STEPS = 1024
#: Share of an item's characters that may be edited.
MOST_EDITS = 0.2
#: Text of the items that one pass over the documents looks for.
BLOCK_BYTES = 4 << 20
#: Anchors met that wait for each other, and windows walked at once, those of like reach together.
HELD, WINDOWS = 1 << 15, 2048
#: Reach up to which windows are laid out in memory; longer ones are walked in the text itself, and
#: of what the walks write so many steps are held at once.
LAID_OUT, STEPS_HELD = 2048, 1024
#: Bytes of stretches that are compared with their items at once.
GRID = 1 << 21
EDGES = string.punctuation + string.whitespace + "«»“”„‘’…–—¿¡"


def streams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts, lower-cased and without outer punctuation, each after a space.

    One run of UTF-8 bytes, and where each text begins in it, with the end behind.
    """
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = split.offsets.to_numpy().astype(np.int64)
    coded = split.flatten().dictionary_encode()
    words = pc.utf8_trim(pc.utf8_lower(coded.dictionary), characters=EDGES)
    words = pc.if_else(pc.equal(words, ""), "", pc.binary_join_element_wise("", words, " "))
    whole = words.take(coded.indices)
    if not len(whole):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    borders = np.frombuffer(whole.buffers()[1], np.int32)[whole.offset : whole.offset + len(whole) + 1].astype(np.int64)
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[borders[0] : borders[-1]]
    return data, (borders - borders[0])[offsets - offsets[0]]


def plain(text: str | None) -> str:
    """A text's words as they are compared."""
    return streams(pa.array([text], pa.string()))[0].tobytes().decode()[1:]


def infix_distance(pattern: str, text: str) -> int:
    """Least edit distance between ``pattern`` and any substring of ``text`` (bit-parallel)."""
    m = len(pattern)
    if not m:
        return 0
    at: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        at[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, m
    for c in text:
        eq = at.get(c, 0)
        x = eq | down
        d0 = ((((eq & up) + up) ^ up) | x) & full
        right, left = (down | ~(d0 | up)) & full, up & d0
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        right, left = (right << 1) & full, (left << 1) & full
        up, down = (left | ~(d0 | right)) & full, right & d0
        best = min(best, score)
    return best


def least_distances(patterns: list[str], texts: list[str]) -> np.ndarray:
    """A lower bound of ``infix_distance`` for each pattern and text, many at once.

    A pattern is cut into pieces of up to 64 characters, whose own least distances add up to
    no more than the whole's. Characters count as equal if their lowest bytes are.
    """
    cut = [[p[i : i + 64] for i in range(0, len(p), 64)] for p in patterns]
    owner = np.repeat(np.arange(len(cut)), [len(x) for x in cut])
    pieces = [x for own in cut for x in own]
    codes = [np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) & 255 for x in texts]
    grid = np.zeros((max(map(len, codes), default=0), len(texts)), np.uint8)
    for i, c in enumerate(codes):
        grid[: len(c), i] = c
    known = {x: i for i, x in enumerate(dict.fromkeys(pieces))}
    at = np.zeros((len(known), 256), np.uint64)
    for x, i in known.items():
        c = np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) & 255
        np.bitwise_or.at(at[i], c, np.uint64(1) << np.arange(len(c), dtype=np.uint64))
    flat, row = at.reshape(-1), np.array([known[x] for x in pieces], np.intp) * 256
    score = np.array([len(x) for x in pieces], np.int64)
    top, one = (score - 1).astype(np.uint64), np.uint64(1)
    up, down, best = np.full(len(pieces), 0xFFFFFFFFFFFFFFFF, np.uint64), np.zeros(len(pieces), np.uint64), score.copy()
    for symbols in grid:
        eq = flat[row + symbols[owner]]
        d0 = (((eq & up) + up) ^ up) | eq | down
        right, left = down | ~(d0 | up), up & d0
        score += ((right >> top) & one).astype(np.int64) - ((left >> top) & one).astype(np.int64)
        np.minimum(best, score, out=best)
        right, left = right << one, left << one
        up, down = left | ~(d0 | right), right & d0
    return np.bincount(owner, best, len(patterns)).astype(np.int64)


def gram_sizes(length: int) -> int:
    """Bytes of the anchors of an item of so many bytes."""
    return GRAM if length >= 3 * GRAM else GRAM // 2 if length >= 3 * GRAM // 2 else 2


def likelihoods(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By counts of all bytes, the logarithm of how likely each two are, and each after the two before it."""
    if len(data) < 3:
        return np.zeros(len(data)), np.zeros(len(data))
    three = (data[:-2].astype(np.int64) << 16) | (data[1:-1].astype(np.int64) << 8) | data[2:]
    _, of_three, n = np.unique(three, return_inverse=True, return_counts=True)
    _, of_two, m = np.unique(three >> 8, return_inverse=True, return_counts=True)
    return np.append(np.log(m[of_two] / len(three)), (0.0, 0.0)), np.append((0.0, 0.0), np.log(n[of_three] / m[of_two]))


class Grams:
    """Runs of ``size`` bytes, each with the anchors that it stands for."""

    def __init__(self, size: int, grams: np.ndarray, targets: np.ndarray) -> None:
        order = np.argsort(grams, kind="stable")
        self.size, self.targets = size, targets[order]
        self.known, self.first = np.unique(grams[order], return_index=True)
        self.end = np.append(self.first[1:], len(grams))
        self.bits = np.uint64(64 - min(24, 8 + max(8, int(len(self.known)).bit_length())))
        self.table = np.zeros(1 << (64 - int(self.bits)), bool)
        self.table[self.slots(self.known)] = True

    def slots(self, grams: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (grams * ODD) >> self.bits

    def hits(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``data``, anchor) wherever the bytes of an anchor stand."""
        raw, places, anchors = data.tobytes(), [], []
        for j in range(min(self.size, max(0, len(data) - self.size + 1))):
            grams = np.frombuffer(raw, f"<u{self.size}", (len(raw) - j) // self.size, j).astype(np.uint64, copy=False)
            at = np.flatnonzero(self.table[self.slots(grams)])
            k = np.minimum(np.searchsorted(self.known, grams[at]), len(self.known) - 1)
            real = self.known[k] == grams[at]
            at, k = at[real], k[real]
            n = self.end[k] - self.first[k]
            places.append(np.repeat(at * self.size + j, n))
            begins = np.cumsum(n) - n
            anchors.append(self.targets[np.repeat(self.first[k] - begins, n) + np.arange(n.sum())])
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(places), np.concatenate(anchors)


class Items:
    """The anchors of a block of items."""

    def __init__(self, items: list[tuple[int | None, str | None]], most_edits: float = MOST_EDITS, seed: int = 5) -> None:
        self.most_edits = most_edits
        self.data, self.begin = streams(pa.array([t for _, t in items], pa.string()))
        self.ids = [i for i, _ in items]
        self.texts = [self.data[a:b].tobytes().decode()[1:] for a, b in zip(self.begin[:-1], self.begin[1:], strict=True)]
        two, after = likelihoods(self.data)
        upto = np.concatenate(([0.0], np.cumsum(after)))
        item, offset, sizes, grams = [], [], [], []
        for k, (a, b) in enumerate(zip(self.begin[:-1].tolist(), self.begin[1:].tolist(), strict=True)):
            size = gram_sizes(b - a)
            likely = two[a : b - size + 1] + upto[a + size : b + 1] - upto[a + 2 : b - size + 3]
            barred = bytearray(b - a + 2 * APART)
            chosen = 0
            for o in np.argsort(likely, kind="stable").tolist():
                if not barred[o] and chosen < ANCHORS:
                    # from o - APART + 1 to o + APART - 1; what would be before the start is at the end
                    for x in range(1 - APART, APART):
                        barred[o + x] = 1
                    chosen += 1
                    item.append(k)
                    offset.append(o)
                    sizes.append(size)
                    grams.append(int.from_bytes(self.data[a + o : a + o + size].tobytes(), "little"))
        self.item, self.offset, self.size = (np.array(x, np.int64) for x in (item, offset, sizes))
        grams = np.array(grams, np.uint64)
        self.grams = [Grams(n, grams[self.size == n], np.flatnonzero(self.size == n)) for n in np.unique(self.size).tolist()]
        length = np.diff(self.begin)[self.item]
        self.backward = 2 * self.offset >= length
        self.reach = np.where(self.backward, self.offset + self.size, length - self.offset)
        rng = np.random.default_rng(seed)
        self.moves = rng.integers(0, 2, (WALKS, STEPS, 256), dtype=np.uint8)
        self.moves[:, :, 0] = 0  # a walk stays at its window's end
        self.shares = rng.random((WALKS, BANDS, SAMPLED))

    def windows(self, data: np.ndarray, place: np.ndarray, target: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The bytes that walks from anchors at ``place`` read, a row each, zero beyond the text or the item."""
        width = 1 + int(self.reach[target].max())
        back = self.backward[target]
        start = np.where(back, place + self.size[target] - 1, place)
        at = start[:, None] + np.where(back, -1, 1)[:, None] * np.arange(width)
        inside = (np.arange(width) < self.reach[target, None]) & (at >= low[:, None]) & (at < high[:, None])
        return np.where(inside, data[np.where(inside, at, 0)], 0)

    def sampled(self, windows: np.ndarray, target: np.ndarray) -> np.ndarray:
        """What the walks of each window have at the places that its anchor's bands sample."""
        n, width = windows.shape
        flat, row = windows.reshape(-1), np.arange(n)
        steps = 2 * int(self.reach[target].max())
        # a walk of 2 L steps passes a window of L characters on average
        places = (self.shares[None] * (2 * self.reach[target])[:, None, None, None]).astype(np.int32)
        out = np.empty((n, WALKS, BANDS, SAMPLED), np.uint8)
        written = np.empty((steps, n), np.uint8)
        for walk in range(WALKS):
            at = row * width
            for j in range(steps):
                c = flat.take(at, out=written[j])
                at += self.moves[walk, j % STEPS].take(c)
            out[:, walk] = written[places[:, walk], row[:, None, None]]
        return out

    def walked(self, data: np.ndarray, place: np.ndarray, target: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """As ``sampled`` of ``windows``, for windows of any reach: nothing of a window's size is held."""
        n, row = len(place), np.arange(len(place))
        back, reach = self.backward[target], self.reach[target]
        start = np.where(back, place + self.size[target] - 1, place)
        ahead = np.where(back, -1, 1)
        most = np.minimum(reach, np.where(back, start - low + 1, high - start))
        text, stop = np.append(data, np.uint8(0)), len(data)
        places = (self.shares[None] * (2 * reach)[:, None, None, None]).astype(np.int32)
        out = np.empty((n, WALKS, BANDS, SAMPLED), np.uint8)
        moves, walk = self.moves.reshape(-1), (np.arange(WALKS) * STEPS * 256)[:, None]
        gone = np.zeros((WALKS, n), np.int64)
        written = np.empty((STEPS_HELD, WALKS, n), np.uint8)
        steps = 2 * int(reach.max())
        for first in range(0, steps, STEPS_HELD):
            held = min(STEPS_HELD, steps - first)
            for j in range(held):
                c = text.take(np.where(gone < most, start + ahead * gone, stop), out=written[j])
                gone += moves.take(walk + (((first + j) % STEPS) * 256 + c.astype(np.int64)))
            now = np.nonzero((places >= first) & (places < first + held))
            out[now] = written[places[now] - first, now[1], row[now[0]]]
        return out

    def marks(self, data: np.ndarray, place: np.ndarray, target: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """What the walks of windows from anchors at ``place`` have where their bands sample."""
        if self.reach[target].max() > LAID_OUT:
            return self.walked(data, place, target, low, high)
        return self.sampled(self.windows(data, place, target, low, high), target)

    def candidates(self, data: np.ndarray, place: np.ndarray, target: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which windows agree with their item's own in all sampled places of some band."""
        out = np.zeros(len(place), bool)
        order = np.lexsort((target, self.reach[target]))
        for at in range(0, len(order), WINDOWS):
            own = order[at : at + WINDOWS]
            distinct, known = np.unique(target[own], return_inverse=True)
            items = self.item[distinct]
            there = self.begin[items] + self.offset[distinct]
            want = self.marks(self.data, there, distinct, self.begin[items], self.begin[items + 1])
            found = self.marks(data, place[own], target[own], low[own], high[own])
            out[own] = (found == want[known]).all(axis=3).any(axis=(1, 2))
        return out

    def stretches(self, place: np.ndarray, target: np.ndarray, low: np.ndarray, high: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, begin, end) of what may hold the item; overlapping ones as one."""
        item = self.item[target]
        length = self.begin[item + 1] - self.begin[item]
        slack = (self.most_edits * length).astype(np.int64) + GRAM
        begin = np.maximum(low, place - self.offset[target] - slack)
        end = np.minimum(high, place - self.offset[target] + length + slack)
        order = np.lexsort((begin, item, owner))
        last: list[int] | None = None
        for d, k, a, b in zip(*(x[order].tolist() for x in (owner, item, begin, end)), strict=True):
            if last and last[:2] == [d, k] and a < last[3]:
                last[3] = max(last[3], b)
                continue
            if last:
                yield tuple(last)
            last = [d, k, a, b]
        if last:
            yield tuple(last)

    def verified(self, data: np.ndarray, found: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, int, int]]:
        """(text, item, distance) of those stretches that hold their item."""
        rest = []
        for d, k, a, b in found:
            if data[a:b].tobytes().find(self.texts[k].encode()) >= 0:
                yield d, k, 0
            else:
                rest.append((d, k, a, b))
        found = sorted(rest, key=lambda x: x[3] - x[2])
        while found:
            # the longest is as long as the shortest and a quarter more, and all together not above GRID
            longest = 5 * (found[0][3] - found[0][2]) // 4 + 64
            n = sum(1 for x in found[: max(1, GRID // longest)] if x[3] - x[2] <= longest)
            part, found = found[:n], found[n:]
            texts = [data[a:b].tobytes().decode("utf-8", "ignore") for _, _, a, b in part]
            least = least_distances([self.texts[k] for _, k, _, _ in part], texts)
            for (d, k, _, _), text, n in zip(part, texts, least.tolist(), strict=True):
                most = self.most_edits * len(self.texts[k])
                if n <= most and (exact := infix_distance(self.texts[k], text)) <= most:
                    yield d, k, exact

    def scan(self, texts: pa.Array) -> list[dict[int, int]]:
        """For each text, place of an item in the block -> least distance of the items found in it."""
        out: list[dict[int, int]] = [{} for _ in range(len(texts))]
        data, begin = streams(texts)
        for grams in self.grams:
            place, target = grams.hits(data)
            owner = np.searchsorted(begin, place, side="right") - 1
            low, high = begin[owner], begin[owner + 1]
            whole = place + grams.size <= high
            place, target, owner, low, high = (x[whole] for x in (place, target, owner, low, high))
            order = np.argsort(owner, kind="stable")
            place, target, owner, low, high = (x[order] for x in (place, target, owner, low, high))
            for at in range(0, len(place), HELD):
                own = slice(at, at + HELD)
                chosen = at + np.flatnonzero(self.candidates(data, place[own], target[own], low[own], high[own]))
                found = list(self.stretches(place[chosen], target[chosen], low[chosen], high[chosen], owner[chosen]))
                for d, k, n in self.verified(data, found):
                    out[d][k] = min(n, out[d].get(k, n))
        return out


def blocks(benchmark: DataFrame, most_edits: float) -> Iterator[Items]:
    """The benchmark in blocks of about BLOCK_BYTES, each small enough for every task."""
    items = benchmark.selectExpr("cast(item_id as long) item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    for k in range(n):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield Items(sorted(((r.item_id, r.text) for r in own.distinct().collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")), most_edits)


def leaks(docs: DataFrame, benchmark: DataFrame, most_edits: float = MOST_EDITS) -> DataFrame:
    """Benchmark items that documents contain, exactly or with a few edits.

    docs: doc_id, text; benchmark: item_id, text; other columns are ignored. Case, outer
    punctuation of words and the kind of white space do not count. An item is contained if
    some stretch of the text is within ``most_edits`` times its length of edits.

    Returns a row for each input row and item found: doc_id, item_id, distance. Null and
    empty texts and items without words give none; an item with a null item_id gives rows
    with a null item_id, and items with the same id but different texts a row each; an item
    that is repeated counts once, rows of docs that are repeated give repeated rows; empty
    tables give no rows.
    """
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    out = None
    for block in blocks(benchmark, most_edits):

        def scanned(batches: Iterator[pa.RecordBatch], block: Items = block) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for low, high in slices(whole["text"]):
                    batch = whole.slice(low, high - low)
                    found = [(doc, block.ids[k], n) for doc, items in zip(batch["doc_id"].to_pylist(), block.scan(batch["text"]), strict=True) for k, n in sorted(items.items())]
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), pa.int32()), strict=True)], names=["doc_id", "item_id", "distance"])

        more = rows.mapInArrow(freeing(scanned), "doc_id long, item_id long, distance int")
        out = more if out is None else out.union(more)
    if out is None:
        return rows.selectExpr("doc_id", "cast(0 as long) item_id", "cast(0 as int) distance").limit(0)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, most_edits: float = MOST_EDITS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that contain no benchmark item."""
    for block in blocks(benchmark, most_edits):

        def kept(batches: Iterator[pa.RecordBatch], block: Items = block) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for low, high in slices(whole["text"]):
                    batch = whole.slice(low, high - low)
                    yield batch.filter(pa.array([not x for x in block.scan(batch["text"])], pa.bool_()))

        docs = docs.mapInArrow(freeing(kept), docs.schema)
    return docs
