"""Passages that repeat word for word, wherever they begin in a text and however it is wrapped.

A passage is repeated if each of its stretches of ``least`` words is. Such a stretch shares
the least of its fingerprints (hashes of half as many words) with every other occurrence, so
fingerprints that are the least of some stretch find all of them (winnowing); about one word
in thirteen has one. Only around fingerprints that occur again are the stretches themselves
compared. No pairs are made: each occurrence of a stretch is placed on the first one. What
is frequent within one task's records is placed there, on the first of the task, and only
that one is dealt out; its own place then leads on to the first of all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packed import FIELDS, Packer, bucket_count, dealt, whole_buckets
from .shared import discard, sieved, stash
from .words import freeing, mixed, slices, word_hashes

BASE, OTHER = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
PRINT = np.dtype([("f", "<u8"), ("h", "<i8"), ("p", "<i4")])
#: A stretch by two hashes, its text, the place of its first word and the line of that.
STRETCH = np.dtype([("w", "<u8"), ("c", "<u4"), ("t", "<i8"), ("s", "<i4"), ("line", "<i4")])
#: A stretch with the text and place of the occurrence that it is placed on.
PLACED = np.dtype([("t", "<i8"), ("s", "<i4"), ("line", "<i4"), ("ft", "<i8"), ("fs", "<i4")])
#: Equal stretches among a task's records, beyond which one of them stands for all.
FREQUENT = 64


class Worded:
    """The words of a batch of texts, with a hash for any run of them."""

    def __init__(self, texts: pa.Array) -> None:
        split = pc.split_pattern(pc.fill_null(texts, ""), "\n")
        borders = split.offsets.to_numpy().astype(np.int64)
        borders -= borders[0]
        self.hashes, self.lines = word_hashes(split.flatten())
        #: Words before each text, and before each line; the text's first line.
        self.texts, self.first_line = self.lines[borders], borders[:-1]
        self.sums, self.back = self.prefixes(BASE)

    def prefixes(self, base: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.hashes)
        with np.errstate(over="ignore"):
            back = np.cumprod(np.full(n + 1, pow(base, -1, 1 << 64), np.uint64))
            powers = np.cumprod(np.full(n, base, np.uint64))
            return np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.hashes * powers, dtype=np.uint64))), back

    def runs(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[end] - self.sums[begin]) * self.back[begin])

    def line_of(self, word: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lines, word, side="right") - 1


def extreme(x: np.ndarray, width: int, f: np.ufunc) -> np.ndarray:
    """``f`` (minimum or maximum) of every ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        x, have = f(x[: len(x) - have], x[have:]), 2 * have
    return f(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def fingerprints(words: Worded, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, place) of the fingerprints that are the least of some ``least`` words."""
    size = least // 2
    span = least - size + 1  # fingerprints in a stretch
    n = int(words.texts[-1])
    if n < least:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(n - size + 1)
    value = words.runs(at, at + size)
    owner = np.repeat(np.arange(len(words.texts) - 1), np.diff(words.texts))
    smallest = extreme(value, span, np.minimum)
    begin = np.arange(len(smallest))
    smallest[begin + least > words.texts[owner[begin] + 1]] = 0  # goes on in the next text
    edge = np.zeros(span - 1, np.uint64)
    chosen = np.flatnonzero(extreme(np.concatenate((edge, smallest, edge)), span, np.maximum) == value)
    return value[chosen], owner[chosen], chosen - words.texts[owner[chosen]]


def stretches(words: Worded, places: list[np.ndarray], numbers: np.ndarray, least: int) -> np.ndarray:
    """STRETCH records of the stretches around fingerprints of each text."""
    reach = least - least // 2
    n = int(words.texts[-1])
    change = np.zeros(n + 1, np.int64)
    for t, p in enumerate(places):
        low, high = words.texts[t], words.texts[t + 1] - least
        np.add.at(change, np.maximum(low + p - reach, low), 1)
        np.add.at(change, np.minimum(low + p, high) + 1, -1)
    begin = np.flatnonzero(np.cumsum(change)[:n] > 0)
    owner = np.searchsorted(words.texts, begin, side="right") - 1
    out = np.empty(len(begin), STRETCH)
    out["w"] = words.runs(begin, begin + least)
    sums, back = words.prefixes(OTHER)
    with np.errstate(over="ignore"):
        out["c"] = mixed((sums[begin + least] - sums[begin]) * back[begin]) >> np.uint64(32)
    out["t"], out["s"] = numbers[owner], begin - words.texts[owner]
    out["line"] = words.line_of(begin) - words.first_line[owner]
    return out


def begins_of(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows begin to differ from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def repeated_prints(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(records whose hash has another place, one record of each hash)."""
    records = records[np.argsort(records["f"])]
    begins = begins_of(records["f"])
    lengths = np.diff(np.append(begins, len(records)))
    several = np.repeat(lengths > 1, lengths)
    rows = records[several]
    rows = rows[np.lexsort((rows["p"], rows["h"], rows["f"]))]
    rows = rows[begins_of(rows["f"], rows["h"], rows["p"])]  # copies of a text have the same places
    first = begins_of(rows["f"])
    lengths = np.diff(np.append(first, len(rows)))
    return rows[np.repeat(lengths > 1, lengths)], np.concatenate((records[~several], rows[first]))


def placed(records: np.ndarray, least: int, frequent: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(PLACED records of the stretches that occur again, STRETCH records not disposed of).

    With ``frequent``, only stretches that occur more often are placed, and the first of them
    stays on for others to be placed on. Overlapping itself is no repetition.
    """
    records = records[np.argsort(records["w"])]
    begins = begins_of(records["w"])
    lengths = np.diff(np.append(begins, len(records)))
    several = np.repeat(lengths > max(frequent, 1), lengths)
    rows = records[several]
    rows = rows[np.lexsort((rows["s"], rows["t"], rows["c"], rows["w"]))]
    begins = begins_of(rows["w"], rows["c"])
    ends = np.append(begins, len(rows))[1:]
    lengths = ends - begins
    apart = (rows["t"][begins] != rows["t"][ends - 1]) | (rows["s"][ends - 1] - rows["s"][begins] >= least)
    rest = np.concatenate((records[~several], rows[begins], rows[~np.repeat(apart, lengths)])) if frequent else records[:0]
    begins, lengths, rows = begins[apart], lengths[apart], rows[np.repeat(apart, lengths)]
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.empty(len(rows), PLACED)
    for c in ("t", "s", "line"):
        out[c] = rows[c]
    out["ft"], out["fs"] = rows["t"][first], rows["s"][first]
    return out, rest


def joined(records: np.ndarray, least: int) -> pa.RecordBatch:
    """Passages of PLACED records: neighbours that are placed on neighbours."""
    records = records[np.lexsort((records["fs"], records["ft"], records["s"], records["t"]))]
    records = records[begins_of(records["t"], records["s"])]  # placed by a task and by all: on the first
    t, s, ft, fs = (records[c] for c in ("t", "s", "ft", "fs"))
    on = (t[1:] == t[:-1]) & (s[1:] == s[:-1] + 1) & (ft[1:] == ft[:-1]) & (fs[1:] == fs[:-1] + 1)
    at = np.flatnonzero(np.concatenate((np.ones(min(1, len(t)), bool), ~on)))
    words = np.diff(np.append(at, len(t))) + least - 1
    columns = [t[at], s[at], records["line"][at], ft[at], fs[at], words.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in columns], names=["t", "s", "line", "ft", "fs", "words"])


def repeated_passages(docs: DataFrame, least: int) -> DataFrame:
    """Passages of ``least`` words or more that occur more than once, without regard to lines.

    Columns: doc_id, paragraph (the line in which it begins), word (its first word among the
    text's), words (how many), component_doc, component_word (the first occurrence, by doc_id
    and place, nulls last), kept. A passage ends where its first occurrence no longer goes on
    alike; what repeats only by overlapping itself is none. A text that several rows have is
    a passage as a whole in each of them, and other passages are then reported of the first.
    """
    buckets = bucket_count(docs.sparkSession)
    # texts are known by hashes; copies of a text are looked at once
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text").filter("text is not null")

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again: list[np.ndarray] = []

        def thinned(records: np.ndarray) -> np.ndarray:
            found, left = repeated_prints(records)
            again.append(found)
            return left

        packer = Packer("f", buckets, thinned)

        def given_out() -> Iterator[pa.RecordBatch]:
            if out := packer.out():
                yield pa.RecordBatch.from_arrays(out, names=["bucket", "blob"])
                yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([np.concatenate(again).tobytes()], pa.binary())], names=["bucket", "blob"])
                again.clear()

        for whole in batches:
            for low, high in slices(whole["text"], 2 << 20):
                batch = whole.slice(low, high - low)
                f, text, p = fingerprints(Worded(batch["text"]), least)
                records = np.empty(len(f), PRINT)
                records["f"], records["h"], records["p"] = f, batch["h"].to_numpy()[text], p
                if packer.add(records):
                    yield from given_out()
        yield from given_out()

    prints = stash(own.select("h", "text").mapInArrow(freeing(printed), FIELDS), "prints")

    def listed(records: np.ndarray) -> pa.RecordBatch:
        """(text, places) of prints."""
        records = records[np.lexsort((records["p"], records["h"]))]
        begins = begins_of(records["h"])
        places = pa.ListArray.from_arrays(pa.array(np.append(begins, len(records)), pa.int32()), pa.array(np.ascontiguousarray(records["p"])))
        return pa.RecordBatch.from_arrays([pa.array(records["h"][begins]), places], names=["h", "places"])

    def met_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def thinned(records: np.ndarray) -> np.ndarray:
            again, left = repeated_prints(records)
            held.append(again)
            return left

        for records in whole_buckets(batches, PRINT, thinned):
            thinned(records)
            if sum(x.nbytes for x in held) > 1 << 24:
                yield listed(np.concatenate(held))
                held.clear()
        if held:
            yield listed(np.concatenate(held))

    def early_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                yield listed(np.frombuffer(blob, PRINT))

    lists = dealt(prints.filter("bucket >= 0")).mapInArrow(freeing(met_prints), "h long, places array<int>")
    lists = lists.union(prints.filter("bucket < 0").select("blob").mapInArrow(freeing(early_prints), "h long, places array<int>"))
    picked = lists.groupBy("h").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"))
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("one")
    known = own.groupBy("h").agg(one, F.count("*").alias("n"))
    known = known.join(picked, "h", "left").filter("n > 1 or places is not null").select(F.col("one.none").alias("none"), F.col("one.doc_id").alias("first"), "h", "n", "places")
    # t numbers the texts in the order of their first documents
    chosen = stash(known.orderBy("none", "first", "h").select(F.monotonically_increasing_id().alias("t"), "first", "h", "n", "places"), "numbered", docs.count())
    discard(prints)
    size = 50 * chosen.count()  # stretches, roughly
    texts = sieved(own, chosen, "h").groupBy("h").agg(F.first("text").alias("text"))
    texts = stash(chosen.select("t", "h", "places", "n").join(texts, "h"), "texts", size)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        early = Packer("t", buckets)

        def thinned(records: np.ndarray) -> np.ndarray:
            found, left = placed(records, least, FREQUENT)
            early.add(found)
            return left

        packer = Packer("w", buckets, thinned)

        def given_out() -> Iterator[pa.RecordBatch]:
            for kind, own in (("w", packer), ("t", early)):
                if out := own.out():
                    yield pa.RecordBatch.from_arrays([*out, pa.array([kind] * len(out[0]))], names=["bucket", "blob", "kind"])

        for whole in batches:
            for low, high in slices(whole["text"], 2 << 20):
                batch = whole.slice(low, high - low)
                places = [x.values.to_numpy().astype(np.int64) for x in batch["places"]]
                if packer.add(stretches(Worded(batch["text"]), places, batch["t"].to_numpy(), least)):
                    yield from given_out()
        yield from given_out()

    found = stash(texts.filter("places is not null").select("t", "places", "text").mapInArrow(freeing(compared), f"{FIELDS}, kind string"), "stretches", size)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer("t", buckets)
        for records in whole_buckets(batches, STRETCH):
            if packer.add(placed(records, least)[0]):
                yield pa.RecordBatch.from_arrays(packer.out(), names=["bucket", "blob"])
        if out := packer.out():
            yield pa.RecordBatch.from_arrays(out, names=["bucket", "blob"])

    rows = stash(dealt(found.filter("kind = 'w'")).mapInArrow(freeing(met), FIELDS), "placed", size)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for records in whole_buckets(batches, PLACED):
            yield joined(records, least)

    passages = rows.union(found.filter("kind = 't'").select("bucket", "blob"))
    passages = stash(dealt(passages).mapInArrow(freeing(runs), "t long, s int, line int, ft long, fs int, words int"), "passages", size)
    discard(found)
    discard(rows)
    # what a task placed on the first of its own goes on to where that one is placed
    led = passages.filter("t <> ft or s <> fs").select(F.col("t").alias("_t"), F.col("s").alias("_s"), F.col("words").alias("_words"), F.col("ft").alias("_ft"), F.col("fs").alias("_fs"))
    inside = (F.col("ft") == F.col("_t")) & F.col("fs").between(F.col("_s"), F.col("_s") + F.col("_words") - least)
    final = passages.join(led, inside, "left").select("t", "s", "line", "words", F.coalesce("_ft", "ft").alias("ft"), F.expr("coalesce(_fs + fs - _s, fs)").alias("fs"))
    firsts = chosen.select(F.col("t").alias("ft"), F.col("first").alias("component_doc"))
    named = final.join(chosen.select("t", F.col("first").alias("doc_id")), "t").join(firsts, "ft")
    named = named.select("doc_id", F.col("line").alias("paragraph"), F.col("s").alias("word"), "words", "component_doc", F.col("fs").alias("component_word"), ((F.col("t") == F.col("ft")) & (F.col("s") == F.col("fs"))).alias("kept"))
    words = F.size(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    copied = texts.filter("n > 1").select("h", words.alias("words")).filter(F.col("words") >= least).join(chosen.select("h", F.col("first").alias("component_doc")), "h")
    zero = F.lit(0)
    copies = own.select("doc_id", "h").join(copied, "h").select("doc_id", zero.alias("paragraph"), zero.alias("word"), "words", "component_doc", zero.alias("component_word"), F.col("doc_id").eqNullSafe(F.col("component_doc")).alias("kept"))
    return named.union(copies)
