"""MinHash near-duplicate detection over whole documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linking import Signer, sign, similarity_classes
from .shared import discard, parted, stash, with_keys
from .words import MinHash, distinct_counts, shingles, word_hashes

WIDTH = 5
#: 16 bands of 4 minima: a pair at similarity 0.85 is missed by all bands seven times in a
#: million, one at 0.8 twice in ten thousand.
BANDS, ROWS = 16, 4


def word_shingler(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    return shingles(*word_hashes(texts), WIDTH)


def word_signer(family: MinHash) -> Signer:
    """Signs texts by their distinct 5-word shingles."""

    def signed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        values, offsets = word_shingler(texts)
        full = np.diff(offsets) > 0
        return distinct_counts(values, offsets), family.minima(values, offsets)[full]

    return signed


def whole_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    return np.arange(len(texts)), np.zeros(len(texts), np.int32), texts


def near_duplicates(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """Components of documents linked by Jaccard similarity of their 5-word shingle sets.

    docs: doc_id, text; other columns are ignored. Words are what lies between white space
    (0x20, 0x09-0x0D) with A-Z lower-cased; a text of one to four words has its whole
    sequence as its one shingle. Two documents are linked if
    ``den * |intersection| >= num * |union|`` on full sets, after MinHash banding found them
    and their signatures agree well enough.

    Returns a row for each input row: doc_id, n_shingles, component_id (the least doc_id
    reachable over links, itself included), kept (doc_id = component_id). Null, empty and
    blank texts have no shingles and are alone. Nodes are texts, so rows with equal texts
    are linked, and a doc_id repeated with different texts does not link them. A null doc_id
    gets the least non-null doc_id of its component, or null, and is not kept. An empty table
    gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    family = MinHash(BANDS, ROWS)
    signer = word_signer(family)
    signed, blobs = sign(docs, whole_texts, signer, family, "minhash")
    met, named = similarity_classes(signed, blobs, docs.select(F.xxhash64("text").alias("h"), "text"), word_shingler, family.rows, num, den)
    discard(met)
    rows = signed.select("doc_id", "n_shingles", "id").join(named, "id", "left")
    rows = rows.select("doc_id", "n_shingles", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first_doc")).alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def without_near_duplicates(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each component of near_duplicates, with all columns of ``docs``.

    Rows with a null doc_id, or with one that repeats, are documents of their own; of equal
    rows one stays. Texts without words stay, each of them. Rows that the sieve clears do not
    go through a shuffle.
    """
    keyed = with_keys(docs)
    found = near_duplicates(keyed.select(F.col("_key").alias("doc_id"), F.col("_row.text").alias("text")), num, den)
    gone = stash(found.filter("not kept").select(F.col("doc_id").alias("_gone"), F.xxhash64("doc_id").alias("_h")), "gone", docs.count())
    maybe, kept = parted(keyed.withColumn("_h", F.xxhash64("_key")), gone, "_h")
    left = maybe.join(gone.select("_gone"), F.col("_key") == F.col("_gone"), "left_anti")
    return kept.union(left).select("_row.*")
