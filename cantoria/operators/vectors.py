"""Similarity, neighbour graphs and clustering of embeddings.

Pairwise work over a table runs against a stated query set, in blocks, or
inside one recording (a few thousand segments), never over all pairs of a table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Vectors and scores that a task holds at a time when it looks for neighbours.
VECTORS, SCORES = 1024, 1 << 20


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column, eps: float = 3.5e-4) -> Column:
    """Cosine similarity; eps stands in for a norm of zero."""
    return dot(a, b) / (F.greatest(norm(a), F.lit(eps)) * F.greatest(norm(b), F.lit(eps)))


def scaled_min_max(df: DataFrame, column: str) -> DataFrame:
    """(x - min) / (max - min) over the whole table."""
    ends = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return df.crossJoin(F.broadcast(ends)).withColumn(column, F.coalesce(F.try_divide(F.col(column) - F.col("lo"), F.col("hi") - F.col("lo")), F.lit(0.0))).drop("lo", "hi")  # one row


def normalized(df: DataFrame, column: str, by_std: bool = False, eps: float = 1e-10) -> DataFrame:
    """Mean of the table subtracted, optionally over the population deviation, then unit length."""
    each = df.select(F.posexplode(column).alias("i", "x"))
    stats = each.groupBy("i").agg(F.avg("x").alias("mu"), F.stddev_pop("x").alias("sd")).agg(F.array_sort(F.collect_list(F.struct("i", "mu", "sd"))).alias("stats"))  # one row, as many entries as dimensions
    centred = F.zip_with(column, "stats", lambda x, s: (x.cast("double") - s["mu"]) / ((s["sd"] + eps) if by_std else F.lit(1.0)))
    out = df.crossJoin(F.broadcast(stats)).withColumn("_c", centred).drop("stats")
    return out.withColumn(column, F.transform("_c", lambda x: x / (norm(F.col("_c")) + eps))).drop("_c")


def nearest(scores: np.ndarray, names: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest scores of each row and their names, of equal scores the least names."""
    k = min(k, scores.shape[1])
    at = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    least = np.take_along_axis(scores, at, 1).min(1)
    for r in np.flatnonzero((scores >= least[:, None]).sum(1) > k).tolist():
        tied = np.flatnonzero(scores[r] >= least[r])
        at[r] = tied[np.lexsort((names[r, tied], -scores[r, tied]))[:k]]
    return np.take_along_axis(scores, at, 1), np.take_along_axis(names, at, 1)


def neighbours(queries: DataFrame, vectors: DataFrame, key: str, column: str, k: int, block: int = 4096) -> DataFrame:
    """(query, key, similarity, place): the k nearest of all vectors to each query, by cosine.

    Queries go to every task in blocks of a fixed size; each task keeps its
    best k for each query, and those are merged. A task's memory follows the
    block and VECTORS, not the table.
    """
    kind = vectors.schema[key].dataType.simpleString()
    spark, rows, out = vectors.sparkSession, [], None

    def against(chunk: list) -> DataFrame:
        sent = spark.sparkContext.broadcast(([r[0] for r in chunk], np.array([r[1] for r in chunk], np.float64)))

        def best(parts):
            ids, q = sent.value
            q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 3.5e-4)
            own, top_s, top_i = np.array(ids), None, None
            for pdf in parts:
                # so many rows and queries at a time as SCORES allows
                for a in range(0, len(pdf), VECTORS):
                    rows = pdf.iloc[a : a + VECTORS]
                    v = np.array(rows[column].tolist(), np.float64)
                    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 3.5e-4)
                    names = np.array(rows[key].tolist())
                    near_s, near_i = (np.empty((len(ids), min(k, len(rows))), t) for t in (float, names.dtype))
                    for b in range(0, len(ids), SCORES // VECTORS):
                        z = min(b + SCORES // VECTORS, len(ids))
                        s = np.round(q[b:z] @ v.T, 12)  # equal vectors have equal scores, wherever they stand
                        s[own[b:z, None] == names] = -np.inf
                        near_s[b:z], near_i[b:z] = nearest(s, np.broadcast_to(names, s.shape), k)
                    top_s, top_i = (near_s, near_i) if top_s is None else nearest(np.hstack((top_s, near_s)), np.hstack((top_i, near_i)), k)
            if top_s is None:
                return
            for a in range(0, len(ids), VECTORS):
                found = [(ids[r], top_i[r, c].item(), float(top_s[r, c])) for r in range(a, min(a + VECTORS, len(ids))) for c in range(top_s.shape[1]) if np.isfinite(top_s[r, c])]
                yield pd.DataFrame(found, columns=["query", key, "similarity"])

        return vectors.select(key, column).mapInPandas(best, f"query {kind}, {key} {kind}, similarity double")

    for r in queries.select(key, column).toLocalIterator():
        rows.append((r[0], list(r[1])))
        if len(rows) == block:
            out, rows = against(rows) if out is None else out.unionByName(against(rows)), []
    if rows or out is None:
        part = against(rows) if rows else vectors.limit(0).select(F.col(key).alias("query"), key, F.lit(0.0).alias("similarity"))
        out = part if out is None else out.unionByName(part)
    ranked = out.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("similarity")).alias("s"), F.col(key).alias("k")))), 1, k).alias("top"))
    return ranked.select("query", F.posexplode("top").alias("place", "t")).select("query", F.col("t.k").alias(key), (-F.col("t.s")).alias("similarity"), "place")


def symmetric_graph(edges: DataFrame, a: str = "query", b: str = "key", weight: str = "similarity", binary: bool = True) -> DataFrame:
    """0.5 * (A + A^T) of a directed neighbour graph: (a, b, w), a < b."""
    w = F.lit(1.0) if binary else F.col(weight)
    return edges.filter(F.col(a) != F.col(b)).groupBy(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).agg((F.sum(w) / 2).alias("w"))


def laplacian(edges: DataFrame) -> DataFrame:
    """(i, j, l) of D - A without the diagonal of A; D is the row sum of absolute weights."""
    both = edges.select(F.col("a").alias("i"), F.col("b").alias("j"), "w").unionByName(edges.select(F.col("b").alias("i"), F.col("a").alias("j"), "w")).filter("i != j")
    return both.select("i", "j", (-F.col("w")).alias("l")).unionByName(both.groupBy("i").agg(F.sum(F.abs("w")).alias("l")).select("i", F.col("i").alias("j"), "l"))


# one recording


def affinity(vectors: np.ndarray) -> np.ndarray:
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 3.5e-4)
    a = unit @ unit.T
    np.fill_diagonal(a, 1.0)
    low, high = a.min(), a.max()
    return (a - low) / (high - low) if high > low else np.ones_like(a)


def neighbour_graph(a: np.ndarray, p: int) -> np.ndarray:
    """The p nearest of each row, symmetrised."""
    at = np.argsort(-a, axis=1, kind="stable")[:, :p]
    g = np.zeros_like(a)
    np.put_along_axis(g, at, 1.0, 1)
    return 0.5 * (g + g.T)


def largest_component(a: np.ndarray, start: int) -> np.ndarray:
    reached = np.zeros(len(a), bool)
    edge = np.array([start])
    while len(edge):
        reached[edge] = True
        edge = np.flatnonzero((a[edge] > 0).any(0) & ~reached)
    return reached


def eigen_gaps(a: np.ndarray, most: int) -> tuple[int, np.ndarray]:
    """(number of clusters, sorted eigenvalues of the Laplacian)."""
    b = a - np.diag(np.diag(a))
    values = np.linalg.eigvalsh(np.diag(np.abs(b).sum(1)) - b)
    gaps = np.diff(values[: most + 1])
    return (int(np.argmax(gaps)) + 1 if len(gaps) else 1), values


def k_means(x: np.ndarray, k: int, rounds: int = 15, seed: int = 0) -> np.ndarray:
    rng = np.random.RandomState(seed)
    centres = [x[rng.randint(len(x))]]
    for _ in range(1, k):
        d = np.min([((x - c) ** 2).sum(1) for c in centres], axis=0)
        centres.append(x[rng.choice(len(x), p=d / d.sum())] if d.sum() > 0 else x[rng.randint(len(x))])
    centres = np.array(centres)
    for _ in range(rounds):
        label = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[label == j].mean(0) if (label == j).any() else centres[j] for j in range(k)])
        if np.allclose(new, centres, atol=1e-3):
            break
        centres = new
    return label


def clustered(vectors: np.ndarray, most: int = 8, k: int | None = None, max_share: float = 0.25, seed: int = 0) -> np.ndarray:
    """Spectral clustering: the neighbour count by least ratio of p to the largest eigenvalue gap, or the next one whose graph is connected; the cluster count by that gap."""
    n = len(vectors)
    if n < 3:
        return np.zeros(n, int)
    a = affinity(vectors)
    best = None
    for p in range(2, max(3, int(n * max_share)) + 1, max(1, int(n * max_share) // 30)):
        count, values = eigen_gaps(neighbour_graph(a, p), min(most, n - 1))
        gap = np.diff(values[: most + 1]).max() / max(values[-1], 1e-10)
        score = p / n / max(gap, 1e-10)
        if best is None or score < best[0]:
            best = (score, p, count)
    _, p, count = best
    g = neighbour_graph(a, p)
    while p < n - 1 and not largest_component(g, 0).all():
        p += 1
        g = neighbour_graph(a, p)
    count = k or count
    _, vecs = np.linalg.eigh(np.diag(np.abs(g - np.diag(np.diag(g))).sum(1)) - (g - np.diag(np.diag(g))))
    return k_means(vecs[:, :count], count, seed=seed)


def speaker_clusters(segments: DataFrame, key: str, order: str, column: str, most: int = 8, window: int | None = None) -> DataFrame:
    """(key, order, cluster) of each recording's embeddings, by the matrix of all its segments.

    With a `window`, which is another method with another result, a recording
    of more segments is clustered piece by piece, and the pieces' cluster
    centres are clustered once more: for recordings whose matrix doesn't fit a task.
    """
    kinds = {c: segments.schema[c].dataType.simpleString() for c in (key, order)}

    def label(k, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        x = np.array(pdf[column].tolist(), float)
        size = window or max(1, len(x))
        pieces = [clustered(x[i : i + size], most) for i in range(0, len(x), size)]
        if len(pieces) == 1:
            out = pieces[0]
        else:
            centres, owner = [], []
            for n, p in enumerate(pieces):
                for c in np.unique(p):
                    centres.append(x[n * size : (n + 1) * size][p == c].mean(0))
                    owner.append((n, c))
            merged = dict(zip(owner, clustered(np.array(centres), most), strict=True))
            out = np.concatenate([[merged[(n, c)] for c in p] for n, p in enumerate(pieces)])
        _, dense = np.unique(out, return_inverse=True)
        return pd.DataFrame({key: k[0], order: pdf[order], "cluster": dense})

    return segments.groupBy(key).applyInPandas(label, f"{key} {kinds[key]}, {order} {kinds[order]}, cluster int")


def nearest_scale_segments(base: np.ndarray, scales: list[np.ndarray]) -> np.ndarray:
    """For every base segment (start, end) the index of the segment with the nearest centre in each scale."""
    centre = base.mean(1)
    return np.array([np.abs(s.mean(1)[None] - centre[:, None]).argmin(1) for s in scales])


def multiscale_affinity(weights: list[float], vectors: list[np.ndarray], mapping: np.ndarray) -> np.ndarray:
    """Weighted sum of the scales' affinities at the base resolution."""
    return sum(w * affinity(v)[np.ix_(m, m)] for w, v, m in zip(weights, vectors, mapping, strict=True))
