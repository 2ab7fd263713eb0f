"""Token counts at every prefix by dynamic programming over a text's chunks and within them."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .tokens import encoder
from .words import freeing, slices


class PrefixCounts:
    """Exact token counts of every prefix of one text.

    Stored are the ends of the text's chunks with the counts there, and for each chunk that
    is asked about a table of the counts at its own prefixes, which a dynamic program makes
    once (see PrefixMerges). No prefix is encoded again to answer a question.
    """

    def __init__(self, text: str | None, path: str) -> None:
        self.text, self.path = text or "", path
        counts, _, flat = encoder(path).prefix_counts(pa.array([self.text]))
        self.starts, self.ends, self.counts, at = [], [], [], 0
        for chunk, n in zip(flat.to_pylist(), counts.tolist(), strict=True):
            if chunk:
                at = self.text.index(chunk, at)
                self.starts.append(at)
                at += len(chunk)
                self.ends.append(at)
                self.counts.append(n)

    def _inside(self, k: int) -> list[int]:
        return encoder(self.path).prefix_table(self.text[self.starts[k] : self.ends[k]])

    def count(self, characters: int) -> int:
        """Tokens of the prefix of so many characters."""
        k = bisect_right(self.ends, characters)
        before = self.counts[k - 1] if k else 0
        if k == len(self.ends) or characters <= self.starts[k]:
            return before
        return before + self._inside(k)[characters - self.starts[k]]

    def total(self) -> int:
        return self.counts[-1] if self.counts else 0

    def truncate(self, budget: int) -> str:
        """The longest prefix that has at most ``budget`` tokens."""
        k = bisect_right(self.counts, budget)
        if k == len(self.ends):
            return self.text
        before = self.counts[k - 1] if k else 0
        # within a chunk counts may fall again: the last that is low enough counts
        return self.text[: self.starts[k] + max(i for i, n in enumerate(self._inside(k)) if before + n <= budget)]


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """Counts of each row's whole text (doc_id, text; other columns are ignored).

    Returns a row for each input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit
    (n_tokens > limit), n_words (chunks), words_in_limit (chunks of the longest prefix of
    whole chunks with at most ``limit`` tokens) and chars_over (characters that follow those
    chunks within the limit, of the chunk that it cuts), all read off the counts at the text's
    prefixes. Null and empty texts count nothing. An empty table gives no rows.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = encoder(path)
        for whole in batches:
            for low, high in slices(whole["text"], 2 << 20):
                batch = whole.slice(low, high - low)
                texts = pc.fill_null(batch["text"], "")
                counts, offsets, flat = table.prefix_counts(texts)
                real = np.concatenate(([0], np.cumsum(pc.not_equal(flat, "").to_numpy(zero_copy_only=False))))
                total = np.where(np.diff(offsets) > 0, counts[np.maximum(offsets[1:] - 1, 0)] if len(counts) else 0, 0)
                # counts rise within a text: how many of its prefixes are within the limit
                within = np.concatenate(([0], np.cumsum(counts <= limit)))
                cut = offsets[:-1] + within[offsets[1:]] - within[offsets[:-1]]
                over = np.zeros(len(batch), np.int64)
                for i in np.flatnonzero(cut < offsets[1:]).tolist():
                    before = int(counts[cut[i] - 1]) if cut[i] > offsets[i] else 0
                    inside = table.prefix_table(flat[int(cut[i])].as_py())
                    over[i] = max(j for j, n in enumerate(inside) if before + n <= limit)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pc.cast(pc.binary_length(texts), pa.int64()), pa.array(total, pa.int64()), pa.array(total > limit), pa.array(real[offsets[1:]] - real[offsets[:-1]], pa.int64()), pa.array(real[cut] - real[offsets[:-1]], pa.int64()), pa.array(over)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_words", "words_in_limit", "chars_over"],
                )

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return rows.mapInArrow(freeing(counted), "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_words long, words_in_limit long, chars_over long")
