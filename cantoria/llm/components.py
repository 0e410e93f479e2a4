"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed


#: Edges up to which a round is one task's work: dealing out so few costs more than the round itself.
FEW = 200_000
#: Edges of one node up to which its rows may stand in one task.
HOT = 1_000_000
#: Nodes beyond that are at most this many, since the bound grows with the edges: they can be sent to every task.
MOST_HOT = 10_000


def _starred(edges: DataFrame, large: bool, count: int) -> DataFrame:
    """One star operation over edges (u, v), u > v.

    Minima come from an aggregate and go back by a join, so no neighbourhood is
    ever gathered; those of nodes with very many edges go back by a broadcast
    of bounded size, so their edges stay where they are.
    """
    together = (lambda df: df.coalesce(1)) if count <= FEW else (lambda df: df)
    both = together(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m"))
    bound = max(HOT, 2 * count // MOST_HOT)
    if 2 * count > bound:
        hot = both.join(F.broadcast(least.filter(F.col("n") > bound).select("u", F.col("m").alias("hot"))), "u", "left")
        linked = hot.filter("hot is not null").select("u", "v", F.col("hot").alias("m"))
        linked = linked.unionByName(hot.filter("hot is null").select("u", "v").join(least.filter(F.col("n") <= bound).select("u", "m"), "u"))
    else:
        linked = both.join(least, "u")
    moved = linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")) if large else linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = together(moved.unionByName(least.select("u", F.col("m").alias("v"))))
    return moved.filter(F.col("u") > F.col("v")).distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Has every node one edge to a smaller one, or only edges from larger ones? Then those it leads to are the components' least nodes."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up")))).alias("e")).select("e.*")
    return not ends.groupBy("x").agg(F.sum("up").alias("ups"), F.min("up").alias("least")).filter("ups > 1 or (ups = 1 and least = 0)").limit(1).count()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node in an edge (u, v); component is the least node reachable.

    Self-links, repeated and reversed links and nulls add nothing. Rounds go
    on until the edges are stars, which they come to in about the square of the logarithm of
    the nodes. Each round is checkpointed, so a lost executor costs one round at most.
    """
    clean = edges.select("u", "v").filter("u is not null and v is not null and u != v")
    now = checkpointed(clean.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        count = now.count()
        if count <= FEW:
            now = now.coalesce(1)
        if _is_forest_of_stars(now):
            break
        now = checkpointed(_starred(_starred(now, True, count), False, count))
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
