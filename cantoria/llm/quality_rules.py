"""Quality rules: fixed rules, then a hashed n-gram log-likelihood ratio between trusted and raw text.

Byte n-grams hash into a fixed number of bins. The trusted documents and the
whole corpus give one multinomial each, smoothed by one count a bin. A
document's score is the mean over its n-grams of log p(trusted) / p(raw); it is
kept where the score reaches the threshold, which is the same for every
document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import text_of
from .docstats import Counts
from .textbytes import slices, text_buffer

BITS = 16
GRAM = 3
#: log(1 / 2): on average, the n-grams of a rejected text are less than half as likely in trusted text.
THRESHOLD = -0.693147


def bins(data: np.ndarray, n: int = GRAM, bits: int = BITS) -> np.ndarray:
    """The bin of the n-gram that starts at each byte, n - 1 fewer than bytes."""
    size = max(0, len(data) - n + 1)
    code = np.zeros(size, np.uint64)
    for j in range(n):
        code = (code * np.uint64(0x100000001B3)) ^ data[j : j + size].astype(np.uint64)
    return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int32)


def inside(offsets: np.ndarray, size: int, n: int = GRAM) -> np.ndarray:
    """Does the n-gram at each place end in the row where it starts?"""
    ok = np.ones(size, bool)
    for back in range(1, n):
        at = offsets[1:-1] - back
        ok[at[(at >= 0) & (at < size)]] = False
    return ok


class QualityRules:
    """Base rules and likelihood ratio over documents (doc_id, text).

    trusted: (doc_id, trusted boolean); a document is trusted if any of its
    rows there says so. Without trusted documents there is no ratio to tell by
    and the base rules alone decide. Null texts count as empty and fail them.
    Repeated rows are judged alike.
    """

    def __init__(self, docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD):
        self.docs, self.threshold = docs, threshold
        self.plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        self.trusted = trusted.filter("trusted").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("trusted", F.lit(True))

    def ratios(self) -> np.ndarray | None:
        """log p(trusted) / p(raw) of each bin."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            raw, good = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
            for batch in batches:
                for piece in slices(batch, "text"):
                    data, offsets = text_buffer(text_of(piece))
                    b = bins(data)
                    ok = inside(offsets, len(b))
                    raw += np.bincount(b[ok], minlength=1 << BITS)
                    mine = np.repeat(piece.column("trusted").to_numpy(zero_copy_only=False), np.diff(offsets))[: len(b)]
                    good += np.bincount(b[ok & mine], minlength=1 << BITS)
            there = np.flatnonzero(raw)
            yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(raw[there]), pa.array(good[there])], ["bin", "raw", "good"])

        # always the same join: it would be a broadcast on small tables only, and grow by leaps; rows without an id take no part in it
        named = self.plain.filter("doc_id is not null").join(self.trusted.hint("merge"), "doc_id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
        marked = named.unionByName(self.plain.filter("doc_id is null").select("text", F.lit(False).alias("trusted")))
        summed = marked.mapInArrow(count, "bin int, raw long, good long").groupBy("bin").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).toArrow()  # a row for each bin
        raw, good = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
        at = summed.column("bin").to_numpy()
        raw[at], good[at] = summed.column("raw").to_numpy(), summed.column("good").to_numpy()
        if not good.sum():
            return None
        return np.log((good + 1) / (good.sum() + len(good))) - np.log((raw + 1) / (raw.sum() + len(raw)))

    def _judge(self):
        ratios, threshold = self.plain.sparkSession.sparkContext.broadcast(self.ratios()), self.threshold

        def judge(piece) -> list[np.ndarray]:
            llr, c = ratios.value, Counts(piece)
            b = bins(c.data)
            ok = inside(c.offsets, len(b))
            each, one = np.zeros(len(c.data)), np.zeros(len(c.data))
            if llr is not None:
                each[: len(b)] = np.where(ok, llr[b], 0)
            one[: len(b)] = ok
            score = np.round(c.per_row(each) / np.maximum(c.per_row(one), 1), 9)
            failed = (c.n_words < 50) | (100 * c.n_repeat_words > 50 * c.n_words)
            kept = ~failed & ((score >= threshold) | (llr is None))
            return [c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words, failed, kept, score]

        return judge

    def judged(self) -> DataFrame:
        """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score."""
        judge, names = self._judge(), ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch, "text"):
                    yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *map(pa.array, judge(piece))], names)

        return self.plain.mapInArrow(rows, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double")

    def kept(self) -> DataFrame:
        """The documents that are kept, with all their columns."""
        judge = self._judge()

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch, "text"):
                    yield piece.filter(pa.array(judge(piece)[-2]))

        return self.docs.mapInArrow(rows, self.docs.schema)
