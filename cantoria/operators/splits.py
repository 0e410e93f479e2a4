"""Splits of a corpus that keep a floor of rare rows, whole entities at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hex digits of an entity's md5 that make a cell: the running sums of 4096 cells stand in one place, an entity's rank within its cell does not.
CELL = 3


def _counted(df: DataFrame, tail: Column, split: str, *by: str) -> DataFrame:
    return df.withColumn("_tail", F.coalesce(tail, F.lit(False)).cast("long")).groupBy(*by, split).agg(F.count("*").alias("n"), F.sum("_tail").alias("t"))


def moved_entities(df: DataFrame, entity: str, tail: Column, split: str = "split", source: str = "train", target: str = "val", least_ratio: float = 0.7, most_moved: float = 0.02) -> DataFrame:
    """(entity) that go from `source` to `target`, so that the target's share of tail rows comes to least_ratio times the source's.

    Entities go whole, in order of their md5, as long as the floor isn't met
    and at most `most_moved` of the source's rows (one at least) have gone. Only
    entities that stand in the source alone and bring the target nearer to the
    floor are moved. Rows without an entity stay where they are.
    """
    totals = {r[split]: r for r in _counted(df, tail, split).filter(F.col(split).isin(source, target)).collect()}  # two rows
    names = df.select(F.col(entity).alias("entity"))
    if len(totals) < 2:
        return names.limit(0)
    a, b = totals[source], totals[target]
    required = least_ratio * a.t / a.n
    budget = max(1, int(a.n * most_moved))
    if b.t >= required * b.n:
        return names.limit(0)
    groups = _counted(df.filter(F.col(entity).isNotNull()), tail, split, entity)
    alone = groups.groupBy(F.col(entity).alias("entity")).agg(F.count("*").alias("splits"), F.max(split).alias("of"), F.sum("n").alias("n"), F.sum("t").alias("t"))
    key = F.md5(F.col("entity").cast("string"))
    able = alone.filter((F.col("splits") == 1) & (F.col("of") == source) & (F.col("t") > required * F.col("n"))).select("entity", "n", "t", key.alias("key"), F.substring(key, 1, CELL).alias("cell"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as cells
    cells = able.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).select("cell", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("n", "t")))
    inside = Window.partitionBy("cell").orderBy("key", "entity").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = able.join(F.broadcast(cells), "cell").select("entity", "n", "t", *((F.col(f"{c}_before") + F.sum(c).over(inside)).alias(f"{c}_upto") for c in ("n", "t")))
    gone_n, gone_t = F.col("n_upto") - F.col("n"), F.col("t_upto") - F.col("t")
    return ranked.filter((F.col("n_upto") <= budget) & (b.t + gone_t < required * (b.n + gone_n))).select("entity")


def with_floor(df: DataFrame, entity: str, tail: Column, split: str = "split", source: str = "train", target: str = "val", **how) -> DataFrame:
    """The rows with the splits that `moved_entities` gives them."""
    moved = moved_entities(df, entity, tail, split, source, target, **how).withColumnsRenamed({"entity": "_entity"}).withColumn("_moved", F.lit(True))
    joined = df.join(moved, F.col(entity) == F.col("_entity"), "left")
    return joined.withColumn(split, F.when(F.col("_moved"), target).otherwise(F.col(split))).drop("_entity", "_moved")


def floor_report(before: DataFrame, after: DataFrame, tail: Column, split: str = "split", source: str = "train", target: str = "val", least_ratio: float = 0.7) -> dict:
    """What was required, what is reached, how many tail rows of the target are missing, and how many rows went."""
    was, now = ({r[split]: r for r in _counted(df, tail, split).collect() if r[split] in (source, target)} for df in (before, after))
    if source not in was or target not in was:
        return {"required": 0.0, "reached": 0.0, "missing": 0, "moved": 0}
    required = least_ratio * was[source].t / was[source].n
    n, t = now[target].n, now[target].t
    return {"required": required, "reached": t / n, "missing": max(0, -int((t - required * n) // 1)), "moved": n - was[target].n}


def test_only(df: DataFrame, split: str = "split") -> DataFrame:
    """All rows in the split `test`: a corpus that nothing is trained on, so that no entity stands in two splits."""
    return df.withColumn(split, F.lit("test"))
