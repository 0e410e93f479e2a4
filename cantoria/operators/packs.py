"""Packs of token sequences filled and taken apart, and rows sorted for a run and put back in their old order.

A pack's rows meet by its number, so nothing larger than a pack is ever in one
place; sorted rows get their global place from the sizes of sorted partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed


def label_mask(ids: Column, mask: Column | None = None, answer_start: Column | None = None) -> Column:
    """The loss mask of a sequence, moved by one to stand with the labels: of a mask, or of all from the place before the answer's start on."""
    if (mask is None) == (answer_start is None):
        raise ValueError("a mask or an answer's start is needed, not both")
    if mask is not None:
        return F.when(F.size(mask) > 0, F.concat(F.slice(mask, 2, F.greatest(F.size(mask) - 1, F.lit(0))), F.array(F.lit(False)))).otherwise(F.array().cast("array<boolean>"))
    return F.transform(ids, lambda _, i: i >= answer_start - 1)


def filled(packs: DataFrame, rows: DataFrame, key: str, ids: str = "input_ids", mask: str = "loss_mask") -> DataFrame:
    """packs (key, slot, pack, start) and rows (key, ids, mask) -> (slot, pack, input_ids, loss_mask, seq_start_id, keys).

    Sequences stand in a pack in order of start; empty ones take no room but
    keep a start. A null sequence counts as empty, a null mask as all false.
    """
    whole = F.coalesce(F.col(ids), F.array().cast(rows.schema[ids].dataType))
    told = F.coalesce(F.col(mask), F.transform(whole, lambda _: F.lit(False)))
    each = packs.select(key, "slot", "pack", "start").join(rows.select(key, whole.alias("_ids"), told.alias("_mask")), key)
    piece = F.array_sort(F.collect_list(F.struct("start", F.col(key).alias("key"), F.col("_ids").alias("ids"), F.col("_mask").alias("mask"))))
    packed = each.groupBy("slot", "pack").agg(piece.alias("p"))
    part = lambda c: F.transform("p", lambda x: x[c])
    return packed.select("slot", "pack", F.flatten(part("ids")).alias("input_ids"), F.flatten(part("mask")).alias("loss_mask"), part("start").alias("seq_start_id"), part("key").alias("keys"))


def unfilled(packs: DataFrame, key: str) -> DataFrame:
    """`filled` packs -> (key, input_ids, loss_mask), as the rows were."""
    starts, n = F.col("seq_start_id"), F.size("input_ids")
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(n.cast("long")))
    each = packs.select("input_ids", "loss_mask", F.explode(F.arrays_zip(F.col("keys").alias("k"), starts.alias("a"), ends.alias("z"))).alias("s"))
    cut = lambda c: F.slice(c, (F.col("s.a") + 1).cast("int"), (F.col("s.z") - F.col("s.a")).cast("int")).alias(c)
    return each.select(F.col("s.k").alias(key), cut("input_ids"), cut("loss_mask"))


def pack_figures(packs: DataFrame, capacity: int) -> DataFrame:
    """One row: packs, sequences a pack, the most in one, filled percent, least and most filled, longest sequence."""
    starts, n = F.col("seq_start_id"), F.size("input_ids")
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(n.cast("long")))
    longest = F.array_max(F.zip_with(starts, ends, lambda a, z: z - a))
    return packs.select(F.size(starts).alias("k"), n.alias("n"), longest.alias("longest")).agg(
        F.count("*").alias("packs"), F.round(F.avg("k"), 2).alias("packing_factor"), F.max("k").alias("max_samples_per_bin"), F.round(100 * F.avg(F.col("n") / capacity), 2).alias("packing_efficiency"), F.min("n").alias("min_packed_seqlen"), F.max("longest").alias("dataset_max_seqlen"),
    )


def placed(df: DataFrame, *order: Column | str, name: str = "order") -> DataFrame:
    """The rows with their place in a global order, 0, 1, ...: a sort by ranges, and the sizes of the ranges before."""
    numbered = checkpointed(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = {r.p: r.n for r in numbered.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}  # a row for each partition
    before, total = [], 0
    for p in sorted(sizes):
        before.append((p, total))
        total += sizes[p]
    offsets = df.sparkSession.createDataFrame(before, "_part long, _before long")
    within = F.col("_id") - F.shiftleft(part, 33)
    return numbered.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + within).drop("_id", "_part", "_before")


def presorted(df: DataFrame, place: str, duration: str = "duration") -> DataFrame:
    """Rows with `order`, the place they take in a run: longest first, equal ones as they were; as they were altogether if a duration is missing. `place`: a row's number, from 0 on."""
    if "order" in df.columns or df.filter(F.col(duration).isNull()).limit(1).count():
        return df.withColumn("order", F.col(place).cast("long"))
    return placed(df, F.desc(duration), F.col(place))


def restored(outputs: DataFrame, sorted_rows: DataFrame, place: str) -> DataFrame:
    """What a run gave for (order, ...) with the old `place` of each."""
    return outputs.join(sorted_rows.select("order", place), "order").drop("order")
