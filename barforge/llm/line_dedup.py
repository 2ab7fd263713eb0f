"""Lines that repeat, exactly or nearly, by MinHash over character shingles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linking import Signer, sign, similarity_classes
from .shared import broadcast_if_small, discard, parted, stash, with_keys
from .substring_dedup import all_lines, lines_of, repeated_parts
from .words import BLOCK, ODD, MinHash, mixed, mixed_32

#: Characters a shingle: as many as tell lines apart that only share common words.
WIDTH = 8
#: 8 bands of 3 minima: a pair at similarity 0.8 is missed by all bands 3 times in a thousand,
#: one at 0.9 3 times in a hundred thousand.
BANDS, ROWS = 8, 3


def window_hashes(lines: pa.Array, kind: type = np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of every ``WIDTH`` characters of all lines in a row, begin, length of each line).

    kind: np.uint64, or np.uint32, which is quicker and does for minima.
    """
    borders = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset : lines.offset + len(lines) + 1].astype(np.int64)
    raw = memoryview(lines.buffers()[2] or b"")[borders[0] : borders[-1]]
    # characters are code points; WIDTH of padding so that a window may reach beyond
    text = str(raw, "utf-8", "surrogatepass") + "\0" * WIDTH
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(c) - WIDTH == len(raw):
        ends = borders[1:] - borders[0]
    else:
        starts = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
        ends = starts[borders[1:] - borders[0]]
    out = np.empty(len(c) - WIDTH + 1, kind)
    one, finish = (ODD, mixed) if kind is np.uint64 else (ODD.astype(np.uint32), mixed_32)
    with np.errstate(over="ignore"):
        for at in range(0, len(out), BLOCK):
            x = c[at : at + BLOCK + WIDTH - 1].astype(kind, copy=False)
            two = x[:-1] * one + x[1:]
            four = two[:-2] * (one * one) + two[2:]
            out[at : at + BLOCK] = finish(four[:-4] * (one * one * one * one) + four[4:])
    return out, np.concatenate((np.zeros(min(1, len(ends)), np.int64), ends[:-1])), np.diff(ends, prepend=0)


def short_hash(line: str) -> np.uint64:
    """What stands for the whole of a line of fewer than ``WIDTH`` characters."""
    value = np.uint64(len(line))
    with np.errstate(over="ignore"):
        for c in line:
            value = mixed((value + ODD) ^ np.uint64(ord(c)))
    return value


def char_shingles(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``WIDTH`` characters of every line, flat, and the lines' offsets.

    A line with fewer characters has one shingle, the whole line; an empty line none.
    """
    lines = lines.combine_chunks() if isinstance(lines, pa.ChunkedArray) else lines
    windows, begin, length = window_hashes(lines)
    made = np.where(length >= WIDTH, length - WIDTH + 1, np.minimum(length, 1))
    out = np.concatenate(([0], np.cumsum(made)))
    values = windows[np.repeat(begin - out[:-1], made) + np.arange(out[-1])]
    for i in np.flatnonzero((length > 0) & (length < WIDTH)).tolist():
        values[out[i]] = short_hash(lines[i].as_py())
    return values, out


def line_signer(family: MinHash) -> Signer:
    """Signs lines, none empty, by their character shingles."""

    def signed(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        windows, begin, length = window_hashes(lines, np.uint32)
        minima = np.empty((len(lines), family.bands * family.rows), np.uint32)
        whole = length >= WIDTH
        minima[whole] = family.span_minima(windows, begin[whole], begin[whole] + length[whole] - WIDTH + 1)
        short = np.flatnonzero(~whole)
        hashes = np.array([short_hash(lines[i].as_py()) for i in short.tolist()], np.uint64)
        minima[short] = family.span_minima(hashes, np.arange(len(short)), np.arange(1, len(short) + 1))
        return np.maximum(length - WIDTH + 1, 1), minima

    return signed


def line_dedup(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """Lines that occur more than once, exactly or nearly, over all documents.

    docs: doc_id, text; other columns are ignored. A line is what stands between newlines
    and is not blank. Two are linked if the Jaccard similarity of their sets of 8-character
    shingles is at least num / den, after banding and exact verification on the whole lines;
    a component's first occurrence, by doc_id and place, is kept.

    Returns a row for each occurrence in a component with several: doc_id, line (place among
    the text's lines, blank ones counted, from 0), component_doc, component_line (the kept
    occurrence), occurrences, kept. Null and empty texts have no lines; a null doc_id stands
    after all others; a row that repeats with its doc_id repeats its lines, of which the kept
    ones are then marked in each copy. An empty table gives no rows.
    """
    return _repeated_lines(docs, num, den)[0]


def _repeated_lines(docs: DataFrame, num: int, den: int) -> tuple[DataFrame, list[DataFrame]]:
    """(line_dedup's rows, the stashed tables that they are made from)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    family = MinHash(BANDS, ROWS, seed=9)
    signer = line_signer(family)
    signed, blobs = sign(docs, lines_of(1), signer, family, "lines")
    met, named = similarity_classes(signed, blobs, all_lines(docs), char_shingles, family.rows, num, den)
    discard(signed)
    found = repeated_parts(met, named)
    found = found.select("doc_id", F.col("place").alias("line"), F.col("first_doc").alias("component_doc"), F.col("first_place").alias("component_line"), F.col("n").alias("occurrences"), "kept")
    return found, [met, named]


def without_repeated_lines(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with all their columns, less the lines that line_dedup does not keep.

    n_chars, where there is such a column, is counted anew for texts that change. A document
    of which no line is left goes; one that had none stays. Rows with a null doc_id, or with
    one that repeats, are documents of their own.
    """
    keyed = with_keys(docs)
    found, made_from = _repeated_lines(keyed.select(F.col("_key").alias("doc_id"), F.col("_row.text").alias("text")), num, den)
    lost = found.filter("not kept").groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_set("line").alias("_gone"))
    lost = stash(lost, "gone", docs.count())
    for table in made_from:
        discard(table)
    if (few := broadcast_if_small(lost, 64 + 4 * F.size("_gone"))) is not None:
        both, same = keyed.join(few, F.col("_key") == F.col("_doc"), "left"), None
    else:  # only rows that may lose a line are shuffled
        maybe, same = parted(keyed.withColumn("_h", F.xxhash64("_key")), lost.withColumn("_h", F.xxhash64("_doc")), "_h")
        both = maybe.join(lost, F.col("_key") == F.col("_doc"), "left")
    # bound by a lambda, the text is split once for a row
    lines = F.array(F.split("_row.text", "\n", -1))
    left = F.element_at(F.transform(lines, lambda ls: F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("_gone")), lambda i: F.get(ls, i))), 1)
    both = both.select("_row", F.col("_gone").isNull().alias("_same"), F.when(F.col("_gone").isNull(), F.col("_row.text")).otherwise(F.array_join(left, "\n")).alias("_text"))
    both = both.filter(F.col("_same") | F.col("_text").rlike(r"[^\x20\x09-\x0D]"))
    changed = {"text": F.col("_text"), "n_chars": F.when(F.col("_same"), F.col("_row.n_chars")).otherwise(F.char_length("_text")) if "n_chars" in docs.columns else None}
    both = both.select(*(changed[c].cast(docs.schema[c].dataType).alias(c) if c in changed else F.col(f"_row.`{c}`") for c in docs.columns))
    return both if same is None else same.select("_row.*").union(both)
