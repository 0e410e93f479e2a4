"""Hard negatives by product quantisation with stored residual norms.

Vectors are cut into parts, each part is coded by its nearest centroid, and the
norm of what the centroid leaves is stored with the code. For an anchor, table
lookups give the score of the coded vector; the true score lies within the sum
of the anchor's part norms times the stored norms of it. These bounds are
rigorous, so that rows outside a window, or below the best that are certainly
in it, are put aside unread, and whole-number scores of the rest decide.

Anchors go to the tasks in blocks of a fixed size. For each block, the tasks
first give each anchor's positives among their rows, then, for each positive's
window of scores, the best rows of other labels; a task gives at most a few
rows for each anchor, and those are ranked over all tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder
from .chunks import NO_ID

#: Rows that the centroids are fitted on, at most.
SAMPLE = 8192
CENTROIDS = 64
PART = 4
ROUNDS = 8
#: Rows scored at once, and components of the anchors in a block.
ROWS = 4096
BLOCK_COMPONENTS = 1 << 19
#: Components beyond this count as this, so that scores fit 64 bits.
LARGEST = 1 << 27


def centroids(sample: np.ndarray, count: int, rounds: int, seed: int) -> np.ndarray:
    """(parts, count, width of a part): k-means of each part of the sample's rows (rows, parts, width)."""
    rng = np.random.RandomState(seed)
    out = np.zeros((sample.shape[1], count, sample.shape[2]))
    for p in range(sample.shape[1]):
        x = sample[:, p]
        c = x[rng.choice(len(x), count, replace=len(x) < count)].copy() if len(x) else out[p]
        for _ in range(rounds if len(x) else 0):
            near = ((c**2).sum(1) - 2 * (x @ c.T)).argmin(1)
            n = np.bincount(near, minlength=count)
            sums = np.stack([np.bincount(near, x[:, j], count) for j in range(x.shape[1])], 1)
            c[n > 0] = sums[n > 0] / n[n > 0, None]
        out[p] = c
    return out


def coded(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, residual norms), each (parts, rows), of rows of whole numbers."""
    parts, _, width = books.shape
    x = x.reshape(len(x), parts, width).astype(np.float64)
    codes, norms = np.zeros((parts, len(x)), np.uint8), np.zeros((parts, len(x)))
    for p, c in enumerate(books):
        codes[p] = ((c**2).sum(1) - 2 * (x[:, p] @ c.T)).argmin(1)
        norms[p] = np.sqrt(((x[:, p] - c[codes[p]]) ** 2).sum(1))
    return codes, norms


def bounds(anchors: np.ndarray, books: np.ndarray, codes: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper), each (anchors, rows): every score lies within."""
    parts, _, width = books.shape
    q = anchors.reshape(len(anchors), parts, width).astype(np.float64)
    score, scale = np.zeros((len(q), codes.shape[1])), np.zeros((len(q), 1))
    for p, c in enumerate(books):
        table = q[:, p] @ c.T
        score += table[:, codes[p]]
        scale += np.abs(table).max(1, keepdims=True)
    part = np.sqrt((q**2).sum(2))
    slack = part @ norms
    slack += 1e-9 * (slack + scale) + 1e-6  # what rounding may add
    return score - slack, score + slack


def best(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the `top` highest scores, equal ones by smaller id."""
    at = np.arange(len(scores))
    if len(at) > top:
        at = at[scores >= np.partition(scores, -top)[-top]]
    return at[np.lexsort((ids[at], -scores[at]))[:top]]


class HardNegatives:
    """Mines embeddings (vec_id, embedding, label).

    Rows with a null label or vector, or a null or non-finite component, take
    no part. Components become floor(256 * x), within 2**27 either way; a
    vector shorter than the longest counts as zero beyond its end. Where vec_id is
    divisible by `shift_each`, the label counts as the next one of ten. Anchors
    are the distinct rows whose vec_id is divisible by `anchor_each`; a row
    without a vec_id is none, but may be a positive or negative, and its id
    counts as the least of equal scores. Other rows are those with another vec_id; rows that share one
    are rows of their own. An anchor without positives, or a positive whose window is
    empty, has no rows. The centroids are fitted on at most `sample` rows,
    those whose ids and labels have the least hashes; what they are decides how many rows are
    put aside, never what comes out.
    """

    def __init__(self, rows: DataFrame, positives: int = 5, negatives: int = 5, least_percent: int = 80, most_percent: int = 100, anchor_each: int = 100, shift_each: int = 7, sample: int = SAMPLE, block: int = BLOCK_COMPONENTS, seed: int = 3):
        self.spark, self.positives, self.negatives = rows.sparkSession, positives, negatives
        self.least, self.most, self.block, self.anchor_each = least_percent, most_percent, block, anchor_each
        label = F.when(F.col("vec_id") % shift_each == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
        fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
        plain = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label"))
        plain = plain.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine).withColumn("label", label)
        self.width = -(-(plain.agg(F.max(F.size("embedding"))).first()[0] or 0) // PART) * PART or PART
        whole = F.transform("embedding", lambda v: F.floor(F.greatest(F.least(256 * v, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int"))
        self.folder = f"{shared_folder(self.spark)}/negatives-{uuid.uuid4().hex}"
        whole = plain.select("vec_id", "label", whole.alias("x"))
        first = whole.withColumn("by", F.xxhash64("vec_id", "label")).orderBy("by").limit(sample).select("x").toArrow()
        books = centroids(_matrix(first.column("x").combine_chunks(), self.width).reshape(first.num_rows, self.width // PART, PART).astype(np.float64), CENTROIDS, ROUNDS, seed)
        self.books, width = books, self.width

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    piece = batch.slice(at, ROWS)
                    codes, norms = coded(_matrix(piece.column("x"), width), books)
                    yield pa.RecordBatch.from_arrays([*piece.columns, pa.array([c.tobytes() for c in codes.T], pa.binary()), _lists(norms.T, pa.float64())], ["vec_id", "label", "x", "codes", "norms"])

        whole.mapInArrow(encode, "vec_id long, label long, x array<int>, codes binary, norms array<double>").write.parquet(f"{self.folder}/index")
        self.index = self.spark.read.parquet(f"{self.folder}/index")

    def mined(self) -> DataFrame:
        """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
        asked = self.index.filter(F.col("vec_id") % self.anchor_each == 0).select("vec_id", "label", "x").distinct()
        blocks = max(1, -(-asked.count() * self.width // self.block))
        found = []
        for b in range(blocks):
            anchors = asked.filter(F.pmod(F.xxhash64("vec_id", "label", "x"), F.lit(blocks)) == b).toArrow()  # bounded by `block` or so
            if anchors.num_rows:
                found.append(f"{self.folder}/found-{b}")
                self._of(anchors).write.parquet(found[-1])
        schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return self.spark.read.schema(schema).parquet(*found) if found else self.spark.createDataFrame([], schema)

    def _of(self, anchors: pa.Table) -> DataFrame:
        ids, labels, x = anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy(), _matrix(anchors.column("x").combine_chunks(), self.width)
        books, width, top, least, most, each = self.books, self.width, self.positives, self.least, self.most, self.negatives

        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for vec, label, rows, lower, upper in _scored(batches, x, books, width):
                out = []
                for a in range(len(ids)):
                    own = np.flatnonzero((label == labels[a]) & (vec != ids[a]))
                    if len(own) > top:
                        own = own[upper[a, own] >= np.partition(lower[a, own], -top)[-top]]
                    exact = rows[own] @ x[a]
                    keep = best(exact, vec[own], top)
                    out.append((np.full(len(keep), a), vec[own[keep]], exact[keep]))
                yield _batch(out, ["anchor", "vec_id", "score"])

        order = (F.desc("score"), F.asc_nulls_first("vec_id"))
        near = self.index.mapInArrow(nearest, "anchor long, vec_id long, score long").withColumn("at", F.row_number().over(Window.partitionBy("anchor").orderBy(*order))).filter(F.col("at") <= top).toArrow()  # `positives` rows for each anchor
        anchor, positive, score = (near.column(c).fill_null(NO_ID).to_numpy() for c in ("anchor", "vec_id", "score"))
        by = np.argsort(anchor, kind="stable")
        first = np.searchsorted(anchor[by], np.arange(len(ids) + 1))

        def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for vec, label, rows, lower, upper in _scored(batches, x, books, width):
                out = []
                for a in range(len(ids)):
                    windows = by[first[a] : first[a + 1]]
                    if not len(windows):
                        continue
                    other = np.flatnonzero((label != labels[a]) & (upper[a] * 100 >= least * score[windows].min()))
                    low, high = lower[a, other] * 100, upper[a, other] * 100
                    exact, known = np.zeros(len(other), np.int64), np.zeros(len(other), bool)
                    for w in windows.tolist():
                        least_score, most_score = least * int(score[w]), most * int(score[w])
                        may = (high >= least_score) & (low <= most_score)
                        sure = low[(low >= least_score) & (high <= most_score)]
                        if len(sure) > each:
                            may &= high >= np.partition(sure, -each)[-each]
                        at = np.flatnonzero(may)
                        new = at[~known[at]]
                        exact[new], known[new] = rows[other[new]] @ x[a], True
                        at = at[(100 * exact[at] >= least_score) & (100 * exact[at] <= most_score)]
                        at = at[best(exact[at], vec[other[at]], each)]
                        out.append((np.full(len(at), w), vec[other[at]], exact[at]))
                yield _batch(out, ["window", "vec_id", "score"])

        ranked = self.index.mapInArrow(within, "window long, vec_id long, score long").withColumn("rank", F.row_number().over(Window.partitionBy("window").orderBy(*order))).filter(F.col("rank") <= each)

        def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                w = batch.column("window").to_numpy()
                known = positive[w] != NO_ID
                yield pa.RecordBatch.from_arrays([pa.array(ids[anchor[w]]), pa.array(positive[w], mask=~known), batch.column("rank"), batch.column("vec_id"), pa.array(score[w]), batch.column("score")], ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

        return ranked.select("window", "rank", "vec_id", "score").mapInArrow(named, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def _scored(batches: Iterator[pa.RecordBatch], anchors: np.ndarray, books: np.ndarray, width: int) -> Iterator[tuple]:
    """(ids, labels, whole vectors, lower and upper bounds for each anchor) of some rows at a time."""
    rows = max(64, min(ROWS, (1 << 21) // max(1, len(anchors))))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            piece = batch.slice(at, rows)
            codes = np.frombuffer(b"".join(piece.column("codes").to_pylist()), np.uint8).reshape(piece.num_rows, -1).T
            norms = piece.column("norms").flatten().to_numpy().reshape(piece.num_rows, -1).T
            yield piece.column("vec_id").fill_null(NO_ID).to_numpy(), piece.column("label").to_numpy(), _matrix(piece.column("x"), width), *bounds(anchors, books, codes, norms)


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of whole numbers, with zeros behind those that are shorter."""
    n = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(n), width), np.int64)
    flat = lists.flatten().to_numpy()
    if (n == width).all():
        return flat.reshape(len(n), width).astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def _lists(values: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1]), pa.int32()), pa.array(np.ascontiguousarray(values).ravel(), kind))


def _batch(out: list[tuple], names: list[str]) -> pa.RecordBatch:
    key, vec, score = (np.concatenate([np.zeros(0, np.int64), *(o[i] for o in out)]).astype(np.int64) for i in range(3))
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(vec, mask=vec == NO_ID), pa.array(score)], names)


#: The same rows, for tables whose ids are unique.
ORACLE_SQL = """
with whole as (select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label, list_transform(embedding, lambda v: floor(256 * v::double)::bigint) as x
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0),
scores as (select a.vec_id as anchor_id, a.label as anchor_label, b.vec_id, b.label, list_inner_product(a.x::double[], b.x::double[])::bigint as score from whole a join whole b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (select anchor_id, vec_id as positive_id, score as positive_score from scores where label = anchor_label qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::int as rank, vec_id as negative_id, positive_score, score as negative_score
from positives join scores using (anchor_id) where label <> anchor_label and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score qualify rank <= 5
"""
