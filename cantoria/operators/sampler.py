"""Training batches from a spec: filters, windows, a measure of length, buckets, batches within a budget, a global order to resume in.

A spec is compiled to DataFrame steps. Rows of a bucket are dealt into slots and
shuffled by md5, so a retried task, another run and SQL deal alike; a slot's
rows pass a task as a stream that keeps one batch's length and number. Batches
get a step in a global shuffled order, and a run that stopped after some steps
goes on from there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import filters as X
from .batching import equal_mass_bounds, smallest_bucket, smallest_bucket_2d

#: Rows of a slot, about, where the spec names no number of slots.
SLOT_ROWS = 200_000
#: Hex digits of a batch's hash that make a cell of the global order.
CELL = 3


@dataclass(frozen=True)
class Constraint:
    """How rows are measured, bucketed and batched; sizes: rows a batch by bucket, else `most` rows and `budget` of rows times the longest measure."""

    measure: str  # duration, tokens or both
    bounds: tuple | None = None
    sizes: tuple[int, ...] | None = None
    most: int | None = None
    budget: float | None = None
    quadratic: float | None = None
    strict: bool = True
    ratio: float | None = None


def sampling_constraint(spec: dict) -> Constraint:
    """The constraint that a spec asks for; bucket settings turn bucketing on, and some batch size must be set."""
    many, bounds, sizes = bool(spec.get("use_multimodal_sampling")), spec.get("bucket_duration_bins"), spec.get("bucket_batch_size")
    bounds = tuple(tuple(b) if isinstance(b, (list, tuple)) else b for b in bounds) if bounds is not None else None
    two = bounds is not None and isinstance(bounds[0], tuple)
    if sizes is not None:
        if bounds is None:
            raise ValueError("bucket_batch_size needs bucket_duration_bins")
        if len(sizes) != len(bounds):
            raise ValueError("a batch size for each bucket")
        ratio = spec.get("max_tpt" if many else "max_tps")
        return Constraint("both" if two else "tokens" if many else "duration", bounds, tuple(sizes), strict=spec.get("bucketing_2d_strict_mode", True), ratio=ratio if isinstance(ratio, (int, float)) else None)
    budget = spec.get("batch_tokens") if many else spec.get("batch_duration")
    if spec.get("batch_size") is None and budget is None:
        raise ValueError("batch_size, batch_tokens with multimodal sampling, batch_duration without, or bucket_duration_bins with bucket_batch_size must be set")
    bounds = bounds if spec.get("use_bucketing") or bounds is not None else None
    return Constraint("both" if two else "tokens" if many else "duration", bounds, None, spec.get("batch_size"), budget, spec.get("quadratic_factor" if many else "quadratic_duration"))


def measured(df: DataFrame, spec: dict) -> DataFrame:
    """Adds `duration_` and `tokens_`, the lengths that batches go by: with multimodal sampling audio counts as tokens of token_equivalent_duration seconds each, with measure_total_length beside the text's, else instead of it."""
    duration = F.coalesce(F.col(spec.get("duration", "duration")), F.lit(0.0)).cast("double") if spec.get("duration", "duration") in df.columns else F.lit(0.0)
    text = F.coalesce(F.col(spec.get("tokens", "n_tokens")), F.lit(0)).cast("double") if spec.get("tokens", "n_tokens") in df.columns else F.lit(0.0)
    audio = F.ceil(duration / spec["token_equivalent_duration"]).cast("double") if spec.get("use_multimodal_sampling") and spec.get("token_equivalent_duration") else F.lit(0.0)
    total = audio + text if spec.get("measure_total_length", True) else F.when(duration > 0, audio).otherwise(text)
    return df.withColumns({"duration_": duration, "tokens_": total})


def windowed(df: DataFrame, spec: dict) -> DataFrame:
    """Rows cut to truncate_duration from their start, or into windows of cut_into_windows_duration, each a row with an offset; duration and offset follow."""
    d, o = spec.get("duration", "duration"), spec.get("offset", "offset")
    df = df if o in df.columns else df.withColumn(o, F.lit(0.0))
    if most := spec.get("truncate_duration"):
        df = df.withColumn(d, F.least(F.col(d).cast("double"), F.lit(float(most))))
    if size := spec.get("cut_into_windows_duration"):
        hop = float(spec.get("cut_into_windows_hop") or size)
        n = F.greatest(F.ceil((F.col(d) - size) / hop), F.lit(0)) + 1
        cut = df.withColumn("_i", F.explode(F.sequence(F.lit(0), n.cast("int") - 1)))
        cut = cut.withColumns({o: F.col(o) + F.col("_i") * hop, d: F.least(F.lit(float(size)), F.col(d) - F.col("_i") * hop)})
        df = cut.filter(F.col(d) > 0).drop("_i")
    return df


def filtered(df: DataFrame, spec: dict) -> DataFrame:
    """The filters that a spec sets, each as filters.py has it: a row without the field passes."""
    d = spec.get("duration", "duration")
    if "min_duration" in spec or "max_duration" in spec:
        df = X.by_duration(df, spec.get("min_duration", -1), spec.get("max_duration", float("inf")), d)
    tokens = spec.get("tokens", "n_tokens")
    if tokens in df.columns and ("min_tokens" in spec or "max_tokens" in spec):
        low, high = spec.get("min_tokens"), spec.get("max_tokens")
        inside = F.lit(True) if low is None else F.col(tokens) >= low
        df = df.filter(F.coalesce(inside if high is None else inside & (F.col(tokens) <= high), F.lit(True)))
    if tokens in df.columns and ("min_tps" in spec or "max_tps" in spec) and not isinstance(spec.get("max_tps"), (list, tuple)):
        rate = F.try_divide(F.col(tokens), F.col(d))
        df = df.filter(F.coalesce((rate >= spec.get("min_tps", float("-inf"))) & (rate <= spec.get("max_tps", float("inf"))), F.lit(True)))
    if "keep" in spec and "validation_status" in df.columns:
        df = df.filter(F.coalesce(F.col("validation_status") == spec["keep"], F.lit(True)))
    for name, column, above in (("max_cer", "cer", False), ("min_context_speaker_similarity", "context_speaker_similarity", True)):
        if name in spec and column in df.columns:
            fits = F.col(column) >= spec[name] if above else F.col(column) <= spec[name]
            df = df.filter(F.coalesce(fits, F.lit(True)))
    return df


def _md5(*parts) -> Column:
    return F.md5(F.concat_ws(":", *(p if isinstance(p, Column) else F.lit(str(p)) for p in parts)))


def _bucket(c: Constraint) -> Column:
    if c.bounds is None:
        return F.lit(0)
    if c.measure == "both":
        return smallest_bucket_2d(F.col("duration_"), F.col("tokens_"), list(c.bounds), c.strict, c.ratio)
    return smallest_bucket(F.col(f"{c.measure}_"), list(c.bounds))


def batches(df: DataFrame, spec: dict) -> DataFrame:
    """The rows with bucket, slot and batch (numbered from 0 in each slot of each bucket) and the measures duration_ and tokens_.

    Rows that no bucket holds go. A row longer than the budget has a batch of
    its own. spec["key"] names the column that tells rows apart; equal keys
    are dealt alike. Without bucket_duration_bins, use_bucketing makes
    num_buckets of equal mass. A null measure counts as zero.
    """
    c, key, seed = sampling_constraint(spec), spec.get("key", "id"), spec.get("seed", 0)
    rows = measured(filtered(windowed(df, spec), spec), spec)
    if spec.get("use_bucketing") and c.bounds is None:
        column = f"{c.measure}_"
        c = Constraint(c.measure, (*equal_mass_bounds(rows, column, spec.get("num_buckets", 8)), float("inf")), c.sizes, c.most, c.budget, c.quadratic)
    rows = rows.withColumn("bucket", _bucket(c)).filter("bucket is not null")
    slots = spec.get("slots") or max(1, -(-rows.count() // SLOT_ROWS))
    order = _md5(F.col(key).cast("string"), *([F.col(spec.get("offset", "offset")).cast("string")] if spec.get("cut_into_windows_duration") else []), seed)
    dealt = rows.withColumn("_order", order).withColumn("slot", (F.conv(F.substring("_order", 1, 7), 16, 10).cast("long") % slots).cast("int"))
    if c.sizes is not None:
        size = F.element_at(F.array(*map(F.lit, c.sizes)), F.col("bucket") + 1)
        w = Window.partitionBy("bucket", "slot").orderBy("_order", key)
        return dealt.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size)).drop("_order")
    dealt = dealt.withColumn("_length", F.col("tokens_" if c.measure == "tokens" else "duration_"))
    most, budget, quadratic = c.most or float("inf"), c.budget or float("inf"), c.quadratic

    def fold(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, batch, n, longest = None, 0, 0, 0.0
        for part in parts:
            out = []
            for bucket, slot, x in zip(*(part.column(k).to_pylist() for k in ("bucket", "slot", "_length")), strict=True):
                x = x + x * x / quadratic if quadratic else x
                if (bucket, slot) != at:
                    at, batch, n, longest = (bucket, slot), 0, 0, 0.0
                elif n and (n + 1 > most or (n + 1) * max(longest, x) > budget):
                    batch, n, longest = batch + 1, 0, 0.0
                n, longest = n + 1, max(longest, x)
                out.append(batch)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.int64())], [*part.schema.names, "batch"])

    schema = dealt.withColumn("batch", F.lit(0).cast("long")).schema
    return dealt.repartition("bucket", "slot").sortWithinPartitions("bucket", "slot", "_order", key).mapInArrow(fold, schema).drop("_order", "_length")


def stepped(batched: DataFrame, seed: int = 0) -> DataFrame:
    """Adds `step`, each batch's place in one shuffled order of all: its rank within a cell of hashes, behind the cells before."""
    one = batched.select("bucket", "slot", "batch").distinct().withColumn("_h", _md5(*(F.col(c).cast("string") for c in ("bucket", "slot", "batch")), seed)).withColumn("_cell", F.substring("_h", 1, CELL))
    cells = one.groupBy("_cell").agg(F.count("*").alias("n")).select("_cell", F.coalesce(F.sum("n").over(Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # 4096 rows at most
    ranked = one.join(F.broadcast(cells), "_cell").withColumn("step", F.col("_before") + F.row_number().over(Window.partitionBy("_cell").orderBy("_h", "bucket", "slot", "batch")) - 1)
    return batched.join(ranked.select("bucket", "slot", "batch", "step"), ["bucket", "slot", "batch"])


def sampled(df: DataFrame, spec: dict, done: int = 0) -> DataFrame:
    """Rows with their batch and step, from step `done` on: what a run that took so many steps has left."""
    return stepped(batches(df, spec), spec.get("seed", 0)).filter(F.col("step") >= done)
