"""Quality classifier: random Fourier features, ridge regression by normal equations, isotonic calibration.

Statistics of a whole document, standardised over the training rows, pass
through random Fourier features of a Gaussian kernel. Each partition sums its
part of the normal equations, by fold; a fold's rows are scored by the ridge of
the other folds, and these scores, summed in a fixed number of bins, are made
monotone by pooling adjacent violators. Interpolation of what the ridge of all
folds says gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .docstats import Counts
from .textbytes import slices

FEATURES = 256
CALIBRATION_BINS = 1024
#: Training rows fall into folds by their statistics, so that copies of a text share one.
FOLDS = 4
#: Sums travel as whole multiples of 2**-20: their total doesn't depend on the order in which they meet.
GRAIN = float(1 << 20)
STATISTICS = ("log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "bang_share", "digit_share", "log_line", "distinct_share", "long_word_share", "stop_share", "high_byte_share", "space_share")


def statistics(batch) -> np.ndarray:
    """One row of STATISTICS for each text; an empty text has zeros."""
    c = Counts(batch)
    n, bytes_ = len(c.n_words), np.maximum(np.diff(c.offsets), 1)
    words, chars = np.maximum(c.n_words, 1), np.maximum(c.n_chars, 1)
    order = np.lexsort((c.word, c.row))
    new = np.ones(len(order), bool)
    new[1:] = (c.word[order][1:] != c.word[order][:-1]) | (c.row[order][1:] != c.row[order][:-1])
    distinct = np.bincount(c.row[order][new], minlength=n)
    share = lambda mask: c.per_row(mask.astype(np.int64)) / bytes_
    d = c.data
    by_word = lambda mask: np.bincount(c.row[mask], minlength=n) / words
    return np.column_stack([
        np.log1p(c.n_words), c.word_chars / words, c.n_symbols / words, c.n_dup_lines / np.maximum(c.n_lines, 1), c.n_repeat_words / words,
        share((d >= 65) & (d <= 90)), c.per_row((d == 33).astype(np.int64)) / words, share((d >= 48) & (d <= 57)), np.log1p(c.n_words / np.maximum(c.n_lines, 1)), distinct / words,
        by_word(c.chars > 12), by_word(c.chars <= 3), share(d >= 128), 1 - c.word_chars / chars,
    ]).astype(np.float64)


def pooled(weights: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The non-decreasing means closest to sums / weights (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for w, s in zip(weights.tolist(), sums.tolist(), strict=True):
        blocks.append([w, s, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w2, s2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w2, blocks[-1][1] + s2, blocks[-1][2] + n2]
    return np.concatenate([np.full(n, s / w) for w, s, n in blocks]) if blocks else np.zeros(0)


def lifted(x: np.ndarray, mean: np.ndarray, spread: np.ndarray, weights: np.ndarray, phases: np.ndarray) -> np.ndarray:
    """A constant and the random Fourier features of each row."""
    z = np.clip((x - mean) / spread, -6, 6)
    return np.column_stack((np.ones(len(z)), np.cos(z @ weights + phases) * (2 / weights.shape[1]) ** 0.5))


class QualityClassifier:
    """Fits on labels (doc_id, quality), scores documents (doc_id, text).

    Rows whose crc32(doc_id) mod 3 is 1 are held out of everything that is
    fitted. Null and empty texts are scored by their zero statistics. Without
    labelled rows, or with one label only, every score is that label's share
    (one half without any). Several labels of one document all count, null ones
    don't.
    """

    def __init__(self, docs: DataFrame, labels: DataFrame, ridge: float = 1.0, seed: int = 11):
        rng = np.random.RandomState(seed)
        d = len(STATISTICS)
        self.weights, self.phases = rng.normal(0, (1.0 / d) ** 0.5, (d, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES)
        self.ridge = ridge
        plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

        def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch, "text"):
                    x = statistics(piece)
                    yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))], ["doc_id", "x"])

        self.described = checkpointed(plain.mapInArrow(describe, "doc_id long, x array<double>"))
        held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
        self.scored = self.described.withColumn("held_out", F.coalesce(held, F.lit(False)))
        known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y")).filter("y is not null")
        self.training = checkpointed(self.scored.filter(~F.col("held_out")).join(known, "doc_id").select("x", "y", F.pmod(F.xxhash64("x"), F.lit(FOLDS)).cast("int").alias("fold")))

    def fit(self):
        """(mean, spread, coefficients, knots, levels); None with fewer than two labels."""
        stats = self.training.agg(F.count("*"), F.avg("y"), *(f(F.col("x")[i]) for i in range(len(STATISTICS)) for f in (F.avg, F.stddev_pop))).first()
        if not stats[0] or stats[1] in (0.0, 1.0):
            return 0.5 if not stats[0] else float(stats[1])
        mean, spread = np.array(stats[2::2]), np.array(stats[3::2])
        spread = np.where(spread > 1e-9, spread, 1.0)
        wave, width = (self.weights, self.phases), FEATURES + 2

        upper = np.triu_indices(width)

        def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((FOLDS, width, width))
            for batch in batches:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, len(mean)))
                a = np.column_stack((lifted(x, mean, spread, *wave), batch.column(1).to_numpy()))
                fold = batch.column(2).to_numpy()
                for f in range(FOLDS):
                    total[f] += a[fold == f].T @ a[fold == f]
            part = np.rint(total[:, *upper] * GRAIN).astype(np.int64)
            fold, at = np.nonzero(part)
            yield pa.RecordBatch.from_arrays([pa.array(fold, pa.int32()), pa.array(at, pa.int32()), pa.array(part[fold, at])], ["fold", "at", "part"])

        summed = self.training.mapInArrow(gram, "fold int, at int, part long").groupBy("fold", "at").agg(F.sum("part").alias("part")).toArrow()  # FOLDS * FEATURES ** 2 / 2 rows or so
        total = np.zeros((FOLDS, width, width))
        at = summed.column("at").to_numpy()
        total[summed.column("fold").to_numpy(), upper[0][at], upper[1][at]] = summed.column("part").to_numpy() / GRAIN
        total += np.triu(total, 1).transpose(0, 2, 1)
        penalty = self.ridge * np.eye(width - 1)
        penalty[0, 0] = 1e-9  # the constant is free; the grain keeps a fold of no rows solvable
        solved = lambda t: np.linalg.solve(t[:-1, :-1] + penalty, t[:-1, -1])
        beta, without = solved(total.sum(0)), np.array([solved(total.sum(0) - total[f]) for f in range(FOLDS)])

        def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    s = (lifted(batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1), mean, spread, *wave) * without[batch.column(2).to_numpy()]).sum(1)
                    at = np.clip((s + 0.5) / 2 * CALIBRATION_BINS, 0, CALIBRATION_BINS - 1).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(1)], ["bin", "y"])

        binned = sorted(self.training.mapInArrow(raw, "bin int, y double").groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("y")).collect())
        level = pooled(np.array([r["n"] for r in binned], float), np.array([r["y"] for r in binned], float))
        knots = (np.array([r["bin"] for r in binned]) + 0.5) / CALIBRATION_BINS * 2 - 0.5
        return mean, spread, beta, knots, level

    def scores(self) -> DataFrame:
        """doc_id, held_out, score, predicted."""
        model, wave = self.fit(), (self.weights, self.phases)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if isinstance(model, float):
                    s = np.full(batch.num_rows, model)
                elif batch.num_rows:
                    mean, spread, beta, knots, level = model
                    s = np.interp(lifted(batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1), mean, spread, *wave) @ beta, knots, level)
                else:
                    s = np.zeros(0)
                s = np.clip(np.round(s, 9), 0, 1)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

        return self.scored.select("doc_id", "x", "held_out").mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
