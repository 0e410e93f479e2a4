"""Queries over embeddings: neighbours of a query set, graphs, clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import vectors as V
from .registered import query, table

NEIGHBOURS = """WITH q AS (SELECT vec_id AS q, CAST(embedding AS DOUBLE[]) AS a FROM embeddings WHERE vec_id % 50 = 0), s AS (SELECT q, vec_id, list_cosine_similarity(a, CAST(embedding AS DOUBLE[])) AS s FROM q, embeddings WHERE vec_id <> q),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, vec_id) - 1 AS place FROM s)"""


def _neighbours(spark, sf_dir, k):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return V.neighbours(e.filter("vec_id % 50 = 0"), e, "vec_id", "embedding", k)


@query(NEIGHBOURS + " SELECT q AS query, vec_id, round(s, 6) AS similarity, CAST(place AS INTEGER) AS place FROM r WHERE place < 10")
def nearest_vectors(spark, sf_dir):
    """The ten nearest of all vectors to every fiftieth, by cosine."""
    return _neighbours(spark, sf_dir, 10).withColumn("similarity", F.round("similarity", 6))


@query(NEIGHBOURS + " SELECT least(q, vec_id) AS a, greatest(q, vec_id) AS b, count(*) / 2.0 AS w FROM r WHERE place < 5 GROUP BY 1, 2")
def neighbour_graph(spark, sf_dir):
    return V.symmetric_graph(_neighbours(spark, sf_dir, 5), "query", "vec_id")


@query("SELECT label, count(*) AS n, round(avg(sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x)))), 5) AS mean_norm FROM embeddings GROUP BY label")
def vector_norms(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg(V.norm(F.col("embedding"))), 5).alias("mean_norm"))


@query()
def speaker_clusters(spark, sf_dir):
    """Embeddings in recordings of a hundred, clustered spectrally."""
    e = table(spark, sf_dir, "embeddings").withColumn("recording", F.floor(F.col("vec_id") / 100))
    return V.speaker_clusters(e, "recording", "vec_id", "embedding")
