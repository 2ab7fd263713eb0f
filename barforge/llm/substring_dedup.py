"""Paragraphs that repeat, exactly or nearly, by MinHash banding; passages that repeat anywhere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linking import Cutter, sign, similarity_classes
from .near_dedup import word_shingler, word_signer
from .passages import repeated_passages
from .shared import discard
from .words import MinHash, word_counts

#: 12 bands of 3 minima: a pair at similarity 0.8 is missed by all bands twice in ten thousand.
BANDS, ROWS = 12, 3
#: Paragraphs with fewer words are left alone: greetings, headings, notices.
LEAST_WORDS = 30
#: A passage of so many words is found wherever it begins, in lines of any length.
LEAST_PASSAGE = 50


def parts(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The lines of all texts, flat; the row of each and its place among its text's lines."""
    split = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    offsets = split.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    counts = np.diff(offsets)
    row = np.repeat(np.arange(len(counts)), counts)
    return split.flatten(), row, np.arange(offsets[-1]) - np.repeat(offsets[:-1], counts)


def lines_of(least_words: int) -> Cutter:
    """Cuts texts into their lines of at least so many words."""

    def cut(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        lines, row, place = parts(texts)
        if least_words > 1:
            real = word_counts(lines) >= least_words
        else:
            real = pc.not_equal(pc.ascii_trim_whitespace(lines), "").to_numpy(zero_copy_only=False)
        return row[real], place[real], lines.filter(pa.array(real))

    return cut


def all_lines(docs: DataFrame) -> DataFrame:
    """(h, text) of every line of every document."""
    lines = docs.select(F.explode(F.split("text", "\n", -1)).alias("text"))
    return lines.select(F.xxhash64("text").alias("h"), "text")


def repeated_parts(met: DataFrame, named: DataFrame) -> DataFrame:
    """(doc_id, place, first_doc, first_place, n, kept) of each occurrence in a class of several."""
    out = met.select("doc_id", "place", "id").join(named.filter("n > 1"), "id")
    kept = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("place") == F.col("first_place"))
    return out.select("doc_id", "place", "first_doc", "first_place", "n", kept.alias("kept"))


def substring_dedup(docs: DataFrame, num: int = 80, den: int = 100, least_words: int = LEAST_WORDS, least_passage: int = LEAST_PASSAGE) -> DataFrame:
    """Paragraphs that occur more than once, exactly or nearly, and passages, word for word.

    docs: doc_id, text; other columns are ignored. A paragraph is what stands between
    newlines and has at least ``least_words`` words. Two are linked if the Jaccard similarity
    of their 5-word shingle sets is at least num / den, after banding and exact verification;
    a component's first occurrence, by doc_id and place, is kept and the others are to be
    removed.

    Returns a row for each occurrence in a component with several: doc_id, paragraph (place
    among the text's paragraphs, from 0), component_doc, component_paragraph (the kept
    occurrence), occurrences, kept; word, words and component_word are null there. Passages
    of ``least_passage`` words or more have rows of their own (see repeated_passages), with
    the first word's place among the text's words and their number; component_paragraph and
    occurrences are null there. They may begin in the middle of a line or go over several,
    short ones too. Null and empty texts have no paragraphs; a null doc_id stands after all
    others; a row that repeats with its doc_id repeats its paragraphs and passages, of which
    the kept ones are then marked in each copy. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    family = MinHash(BANDS, ROWS, seed=4)
    signer = word_signer(family)
    signed, blobs = sign(docs, lines_of(least_words), signer, family, "paragraphs")
    met, named = similarity_classes(signed, blobs, all_lines(docs), word_shingler, family.rows, num, den)
    discard(signed)
    found = repeated_parts(met, named)
    none = (F.lit(None).cast("int").alias(c) for c in ("word", "words", "component_word"))
    whole = found.select("doc_id", F.col("place").alias("paragraph"), F.col("first_doc").alias("component_doc"), F.col("first_place").alias("component_paragraph"), F.col("n").alias("occurrences"), "kept", *none)
    passages = repeated_passages(docs, least_passage)
    none = F.lit(None).cast("int").alias("component_paragraph"), F.lit(None).cast("long").alias("occurrences")
    return whole.union(passages.select("doc_id", "paragraph", "component_doc", *none, "kept", "word", "words", "component_word"))
