"""Buckets, batches, packing, sampling and mixing.

Random choices are made by hashing a key with a seed, so that a run can be
repeated and a lost task makes the same choice again.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# buckets


def smallest_bucket(length: Column, bounds: list[float]) -> Column:
    """Index of the first bound >= length; null beyond the last."""
    out = F
    for i, b in enumerate(bounds):
        out = out.when(length <= b, F.lit(i))
    return out


def smallest_bucket_2d(first: Column, second: Column, bounds: list[tuple[float, float]], strict: bool = True, max_ratio: float | None = None) -> Column:
    """Index of the first fitting (first, second) bound; strict: only among the bounds of the smallest fitting first dimension."""
    fits = F
    starts = sorted({a for a, _ in bounds})
    for i, (a, b) in enumerate(bounds):
        ok = (first <= a) & (second <= b)
        if strict:
            below = [s for s in starts if s < a]
            ok = ok & (first > below[-1] if below else F.lit(True))
        fits = fits.when(ok, F.lit(i))
    return fits if max_ratio is None else F.when(second / first <= max_ratio, fits)


def linear_bounds(least: float, most: float, n: int) -> list[float]:
    """n - 1 inner bounds of n equally wide buckets."""
    return [least + (most - least) * i / n for i in range(1, n)]


def equal_mass_bounds(df: DataFrame, column: str, n: int) -> list[float]:
    """Bounds that cut the sum of a column into n equal parts, from sums of each distinct value; equal bounds merge."""
    sums = df.filter(F.col(column) > 0).groupBy(column).agg(F.sum(column).alias("mass"))
    # cumulative mass by range: sorted partitions, then the few partition totals
    total = sums.agg(F.sum("mass")).first()[0]
    if not total:
        return []
    w = Window.orderBy(column).rowsBetween(Window.unboundedPreceding, 0)
    part = Window.partitionBy("p").orderBy(column).rowsBetween(Window.unboundedPreceding, 0)
    ranged = sums.repartitionByRange(F.col(column)).withColumn("p", F.spark_partition_id())
    before = ranged.groupBy("p").agg(F.sum("mass").alias("m"), F.min(column).alias(column)).withColumn("base", F.sum("m").over(w) - F.col("m")).select("p", "base")
    running = ranged.join(F.broadcast(before), "p").withColumn("upto", F.col("base") + F.sum("mass").over(part))  # as many rows as partitions
    cut = F.least(F.ceil(F.col("upto") * n / total), F.lit(n)).cast("int")
    found = running.groupBy(cut.alias("part")).agg(F.max(column).alias("bound")).filter(F.col("part") < n).orderBy("part").collect()  # n - 1 rows
    return sorted({r["bound"] for r in found})


def not_outlying(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """Rows whose z-score (population deviation) is at most the threshold; only high values are outliers."""
    stats = df.agg(F.avg(column).alias("mu"), F.stddev_pop(column).alias("sd"))
    return df.crossJoin(F.broadcast(stats)).filter((F.col("sd") == 0) | F.col("sd").isNull() | ((F.col(column) - F.col("mu")) / F.col("sd") <= threshold)).drop("mu", "sd")  # one row


def duration_token_bounds(df: DataFrame, n: int, n_inner: int, max_rate: float | None = None, threshold: float | None = None, duration: str = "duration", tokens: str = "n_tokens") -> list[tuple[float, int]]:
    """Equal-mass duration bounds, each with equal-mass token bounds inside, token-rate outliers dropped first."""
    rated = df.withColumn("rate", F.try_divide(tokens, duration))
    if max_rate is not None:
        rated = rated.filter(F.col("rate") <= max_rate)
    if threshold is not None:
        rated = not_outlying(rated, "rate", threshold)
    outer = [*equal_mass_bounds(rated, duration, n), rated.agg(F.max(duration)).first()[0]]
    out, low = [], 0.0
    for bound in outer:
        inside = rated.filter((F.col(duration) > low) & (F.col(duration) <= bound))
        most = inside.agg(F.max(tokens)).first()[0]
        if most is not None:
            out += [(bound, t) for t in [*equal_mass_bounds(inside, tokens, n_inner), most]]
        low = bound
    return list(dict.fromkeys(out))


def quantized(bins: list[int], two_powers: bool = False) -> list[int]:
    """Bins rounded up to powers of two, or to sums of two; repeated ones merge in order."""
    out = []
    for b in bins:
        p = 1 << max(0, math.ceil(math.log2(max(1, b))))
        if two_powers and p > b:
            half = p >> 1
            p = next((half + (1 << k) for k in range(max(0, half.bit_length())) if half + (1 << k) >= b), p)
        out.append(p)
    return list(dict.fromkeys(out))


def token_length(duration: Column, text_tokens: Column, token_seconds: float) -> Column:
    """Length of a row of audio and text in tokens."""
    return F.ceil(F.coalesce(duration, F.lit(0)) / token_seconds) + F.coalesce(text_tokens, F.lit(0))


# batches


#: Rows of a slot, about, and the fewest slots, where no number of slots is asked for.
SLOT_ROWS, FEWEST_SLOTS = 50_000, 16


def _slots(df: DataFrame, slots: int | None) -> int:
    """As many slots as the rows ask for, so that one doesn't grow with the table."""
    return slots or max(FEWEST_SLOTS, math.ceil(df.count() / SLOT_ROWS))


def fixed_size_batches(df: DataFrame, bucket: str, sizes: dict[int, int], order: str, seed: int = 0) -> DataFrame:
    """A batch number for each row: rows of one bucket, shuffled by hash, cut by the bucket's batch size.

    A bucket is first dealt into slots by hash, so no bucket stands in one task; each slot makes its own batches.
    """
    size = F.coalesce(F.create_map(*(F.lit(x) for kv in sizes.items() for x in kv))[F.col(bucket)], F.lit(1))
    slots = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    slotted = df.withColumn("slot", F.pmod(F.xxhash64(order, F.lit(seed)), F.lit(slots)))
    w = Window.partitionBy(bucket, "slot").orderBy(F.xxhash64(F.col(order), F.lit(seed + 1)), order)
    return slotted.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size))


def budget_batches(df: DataFrame, length: str, budget: float, order: str, quadratic: float | None = None, slots: int | None = None) -> DataFrame:
    """(slot, batch) for each row so that rows times the longest length keep within a budget.

    The fold depends on order, so each slot of the hash-dealt rows is folded
    alone, as a stream. quadratic: length beyond which cost grows with its square.
    """
    dealt = df.withColumn("slot", F.pmod(F.xxhash64(order), F.lit(_slots(df, slots))).cast("int"))
    kinds = {c: t for c, t in dealt.dtypes}
    schema = ", ".join(f"`{c}` {t}" for c, t in kinds.items()) + ", batch long"

    def fold(parts):
        slot, batch, n, longest = None, 0, 0, 0.0
        for pdf in parts:
            out = []
            for s, x in zip(pdf["slot"], pdf[length].astype(float), strict=True):
                x = x + x * x / quadratic if quadratic else x
                if s != slot:
                    slot, batch, n, longest = s, 0, 0, 0.0
                if n and (n + 1) * max(longest, x) > budget:
                    batch, n, longest = batch + 1, 0, 0.0
                n, longest = n + 1, max(longest, x)
                out.append(batch)
            yield pdf.assign(batch=out)

    return dealt.repartition("slot").sortWithinPartitions("slot", length, order).mapInPandas(fold, schema)


def length_buckets(df: DataFrame, length: str, bounds: list[float]) -> DataFrame:
    """Rows in buckets (lo, hi]; rows in none go."""
    out = F
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        out = out.when((F.col(length) > a) & (F.col(length) <= b), F.lit(i))
    return df.withColumn("bucket", out).filter("bucket is not null")


def semi_sorted(df: DataFrame, duration: str, key: str, factor: float = 0.1, seed: int = 0) -> DataFrame:
    """A sort key: the duration plus uniform noise of +-(max - min) * factor / 2."""
    ends = df.agg(F.min(duration).alias("lo"), F.max(duration).alias("hi"))
    noise = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30) - 0.5
    return df.crossJoin(F.broadcast(ends)).withColumn("sort_key", F.col(duration) + noise * (F.col("hi") - F.col("lo")) * factor).drop("lo", "hi")  # one row


def bucket_batch_sizes(size: int | list[int], buckets: int) -> list[int]:
    """Bucket i of n gets (n - i) * size rows a batch, or the listed sizes."""
    if isinstance(size, list):
        if len(size) != buckets:
            raise ValueError("a size for each bucket")
        return size
    return [(buckets - i) * size for i in range(buckets)]


# packing


def first_fit(lengths: list[int], capacity: int, descending: bool = False) -> list[list[int]]:
    """Bins of lengths; each length goes to the first bin with room, found in a tree over the bins' free space. One longer than the capacity has a bin of its own."""
    todo = sorted(lengths, reverse=True) if descending else lengths
    size = 1 << max(1, (len(todo) - 1).bit_length() if todo else 1)
    free, bins = [capacity] * (2 * size), []
    for x in todo:
        at = size + len(bins) if x > capacity else 1
        while at < size:
            at = 2 * at if free[2 * at] >= x else 2 * at + 1
        if at - size == len(bins):
            bins.append([])
        bins[at - size].append(x)
        free[at] -= x
        while at > 1:
            at //= 2
            free[at] = max(free[2 * at], free[2 * at + 1])
    return bins


def packed(df: DataFrame, key: str, length: str, capacity: int, slots: int | None = None, descending: bool = True) -> DataFrame:
    """(key, slot, pack, start): first-fit packing of each slot of the hash-dealt rows.

    Every row comes back: one longer than capacity has a pack of its own, and
    one without a length counts as empty and goes to the first pack with room
    for nothing, which may be full.
    """
    kind = df.schema[key].dataType.simpleString()

    def fit(k, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([length, key], ascending=[not descending, True]) if descending else pdf.sort_values(key)
        used: list[int] = []
        rows = []
        size = 1 << max(1, (len(pdf) - 1).bit_length())
        free = [capacity] * (2 * size)
        for ident, x in zip(pdf[key], pdf[length], strict=True):
            at = size + len(used) if x > capacity else 1
            while at < size:
                at = 2 * at if free[2 * at] >= x else 2 * at + 1
            pack = at - size
            if pack == len(used):
                used.append(0)
            rows.append((ident, k[0], pack, used[pack]))
            used[pack] += int(x)
            free[at] -= x
            while at > 1:
                at //= 2
                free[at] = max(free[2 * at], free[2 * at + 1])
        return pd.DataFrame(rows, columns=[key, "slot", "pack", "start"])

    dealt = df.select(key, F.greatest(F.col(length), F.lit(0)).alias(length), F.pmod(F.xxhash64(key), F.lit(_slots(df, slots))).cast("int").alias("slot"))
    return dealt.groupBy("slot").applyInPandas(fit, f"{key} {kind}, slot int, pack int, start long")


def length_histogram(df: DataFrame, length: str, most: int) -> DataFrame:
    return df.groupBy(F.least(F.col(length), F.lit(most)).alias("length")).agg(F.count("*").alias("n"))


def packing_efficiency(packs: DataFrame, df: DataFrame, key: str, length: str, capacity: int) -> DataFrame:
    """packs, sequences per pack, and the filled share."""
    return packs.join(df.select(key, length), key).agg(F.count_distinct("slot", "pack").alias("packs"), F.count("*").alias("n"), F.sum(length).alias("tokens")).select("packs", (F.col("n") / F.col("packs")).alias("factor"), (F.col("tokens") / (F.col("packs") * capacity)).alias("efficiency"))


# shards and ranks


def sharded(df: DataFrame, key: str, shards: int, seed: int = 0) -> DataFrame:
    """Rows in equal shards after a shuffle by hash; the remainder is dropped, as fixed shard sizes ask.

    Places come from ranks within hash cells and the cells' totals: no task sees all rows.
    """
    h = F.xxhash64(F.col(key), F.lit(seed))
    ranges = max(shards, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cell = F.pmod(h, F.lit(ranges)).cast("int")
    placed = df.withColumn("h", h).withColumn("cell", cell)
    counts = placed.groupBy("cell").agg(F.count("*").alias("n"))
    base = counts.withColumn("base", F.sum("n").over(Window.orderBy("cell")) - F.col("n")).select("cell", "base")  # as many rows as cells
    total = counts.agg(F.sum("n").alias("total"))
    w = Window.partitionBy("cell").orderBy("h", key)
    ranked = placed.withColumn("r", F.row_number().over(w) - 1).join(F.broadcast(base), "cell").crossJoin(F.broadcast(total))
    each = F.floor(F.col("total") / shards)
    return ranked.withColumn("shard_id", F.floor((F.col("base") + F.col("r")) / each).cast("int")).filter(F.col("shard_id") < shards).drop("h", "cell", "r", "base", "total")


def shards_chosen(spec: str, n: int) -> list[int]:
    """"all", "k" or "a:b" with the end left out."""
    if spec == "all":
        return list(range(n))
    if re.fullmatch(r"\d+", spec):
        return [int(spec)]
    a, b = re.fullmatch(r"(\d*):(\d*)", spec).groups()
    return list(range(int(a or 0), int(b or n)))


def expanded(path: str) -> list[str]:
    """a__OP_0..3_CL_.tar, a_{0..3}.tar and the like -> every path; zero padding stays."""
    text = re.sub(r"_OP_|[(\[<]", "{", path)
    text = re.sub(r"_CL_|[)\]>]", "}", text)
    m = re.search(r"\{(\d+)\.\.(\d+)\}", text)
    if not m:
        alternatives = re.search(r"\{([^{}]+,[^{}]*)\}", text)
        if alternatives:
            return [p for x in alternatives[1].split(",") for p in expanded(text[: alternatives.start()] + x + text[alternatives.end() :])]
        return [text]
    width = len(m[1]) if m[1].startswith("0") and len(m[1]) > 1 else 0
    return [p for i in range(int(m[1]), int(m[2]) + 1) for p in expanded(text[: m.start()] + str(i).zfill(width) + text[m.end() :])]


def of_rank(files: list[str], rank: int, world: int, strategy: str = "scatter") -> list[str]:
    """scatter: each rank has floor(n / world) files and the remainder is left; replicate: all."""
    if strategy == "replicate":
        return files
    each = len(files) // world
    return files[rank * each : (rank + 1) * each]


def rank_rows(df: DataFrame, place: str, node: int, nodes: int, gpu: int, gpus: int) -> DataFrame:
    """Rows by modulo: first of the node, then of the device."""
    return df.filter((F.col(place) % nodes == node) & (F.floor(F.col(place) / nodes) % gpus == gpu))


# mixing


def tempered(weights: list[float], temperature: float) -> list[float]:
    """w**t / sum(w**t); all weights must be above zero."""
    if any(w <= 0 for w in weights):
        raise ValueError("weights must be above zero")
    powers = [w**temperature for w in weights]
    return [p / sum(powers) for p in powers]


def mixture(config: list[dict], temperatures: list[float] | float = 1.0, inherited: dict | None = None, level: int = 0) -> list[dict]:
    """A nested mixture flattened to sources with weights that sum to one.

    An entry is a source or a group with `input_cfg`; it inherits what it
    doesn't set. A group's weight is the sum of its children's where it has
    none. Either all entries of a level have weights or none.
    """
    t = temperatures if isinstance(temperatures, (int, float)) else temperatures[level]
    has = ["weight" in c or _weight(c) is not None for c in config]
    if any(has) and not all(has):
        raise ValueError("all entries of a level have weights, or none")
    weights = tempered([_weight(c) for c in config], t) if all(has) else [1 / len(config)] * len(config)
    out = []
    for c, w in zip(config, weights, strict=True):
        attrs = (inherited or {}) | {k: v for k, v in c.items() if k not in ("input_cfg", "weight")}
        if "input_cfg" in c:
            out += [s | {"weight": s["weight"] * w} for s in mixture(c["input_cfg"], temperatures, attrs, level + 1)]
        else:
            out.append(attrs | {"weight": w})
    return out


def _weight(c: dict) -> float | None:
    if "weight" in c:
        return float(c["weight"])
    inner = [_weight(x) for x in c.get("input_cfg", [])]
    return sum(inner) if inner and all(x is not None for x in inner) else None


def levels(config: list[dict]) -> int:
    return 1 + max((levels(c["input_cfg"]) for c in config if "input_cfg" in c), default=0)


def standard_temperatures(t: float | list[float], depth: int) -> list[float]:
    if isinstance(t, (int, float)):
        return [float(t)] * depth
    if len(t) != depth:
        raise ValueError(f"{len(t)} temperatures for {depth} levels")
    return [float(x) for x in t]


def interleaved(sources: list[DataFrame], weights: list[float], key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows (up to rounding) drawn from the sources by weight; a source that is too small repeats its rows.

    How often each row comes is its floor share, plus one for those whose hash
    is below the remainder: expected counts are exact and no row is ordered globally.
    """
    out = None
    for i, (df, w) in enumerate(zip(sources, tempered(weights, 1.0), strict=True)):
        size = df.count()
        if not size:
            continue
        share = n * w / size
        u = F.pmod(F.xxhash64(F.col(key), F.lit(seed), F.lit(i)), F.lit(1 << 30)) / float(1 << 30)
        times = F.lit(int(share)) + (u < share - int(share)).cast("int")
        part = df.withColumn("source_index", F.lit(i)).withColumn("copy", F.explode(F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>"))))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.withColumn("place", F.xxhash64(F.col(key), F.col("copy"), F.lit(seed + 1)))


def round_robin(sources: list[DataFrame], order: str) -> DataFrame:
    """Sources in turn until each has ended: `turn` is the row's place in its source, rows sort by (turn, source_index)."""
    out = None
    for i, df in enumerate(sources):
        ranged = df.repartitionByRange(F.col(order)).withColumn("p", F.spark_partition_id())
        base = ranged.groupBy("p").agg(F.count("*").alias("n")).withColumn("base", F.sum("n").over(Window.orderBy("p")) - F.col("n")).select("p", "base")
        part = ranged.join(F.broadcast(base), "p").withColumn("turn", F.col("base") + F.row_number().over(Window.partitionBy("p").orderBy(order)) - 1).drop("p", "base").withColumn("source_index", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def code_switched(df: DataFrame, language: str, key: str, duration: str, least: float, most: float, seed: int = 0, slots: int | None = None) -> DataFrame:
    """Composite samples of utterances of several languages: (sample, place, key), least to most seconds each.

    Each slot of the hash-dealt rows takes its languages in turn; a sample that stays too short is dropped.
    """
    kind = df.schema[key].dataType.simpleString()

    def compose(k, pdf: pd.DataFrame) -> pd.DataFrame:
        queues = {g: deque(zip(q[key], q[duration], strict=True)) for g, q in pdf.sort_values(["h", key]).groupby(language)}
        rows, sample, now, total = [], 0, [], 0.0
        while any(queues.values()):
            for g in sorted(queues):
                if not queues[g]:
                    continue
                ident, d = queues[g].popleft()
                if total + d > most:
                    if total >= least:
                        rows += [(f"{k[0]}-{sample}", i, x) for i, x in enumerate(now)]
                        sample += 1
                    now, total = [], 0.0
                if d <= most:
                    now.append(ident)
                    total += d
        if total >= least:
            rows += [(f"{k[0]}-{sample}", i, x) for i, x in enumerate(now)]
        return pd.DataFrame(rows, columns=["sample", "place", key])

    dealt = df.select(key, language, duration, F.xxhash64(F.col(key), F.lit(seed)).alias("h")).withColumn("slot", F.pmod("h", F.lit(_slots(df, slots))))
    return dealt.groupBy("slot").applyInPandas(compose, f"sample string, place int, {key} {kind}")


# sampling


def sampled_exactly(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly n rows by least hash; with repeats where there are fewer."""
    have = df.count()
    chosen = df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n % have if have and n > have else n)
    if have and n > have:
        whole = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(n // have)))).drop("copy")
        return whole.unionByName(chosen) if n % have else whole
    return chosen


def weighted_draws(df: DataFrame, weight: str, key: str, draws: int, seed: int = 0) -> DataFrame:
    """Draws with replacement by weight, spread as in `interleaved`: each row comes its expected number of times, rounded by hash."""
    total = df.agg(F.sum(weight)).first()[0] or 1
    share = F.col(weight) * draws / F.lit(float(total))
    u = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    times = (F.floor(share) + (u < share - F.floor(share)).cast("int")).cast("int")
    return df.withColumn("times", times).filter("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times")


def permuted(i: Column, n: int, seed: int = 0, rounds: int = 4) -> Column:
    """A Feistel permutation of 0..n-1 applied to each index, without state; values that fall outside walk on until inside."""
    half = max(1, math.ceil(math.log2(max(2, n)) / 2))
    mask = (1 << half) - 1

    def once(x: Column) -> Column:
        left, right = F.shiftright(x, half), x.bitwiseAND(mask)
        for r in range(rounds):
            left, right = right, left.bitwiseXOR(F.xxhash64(right, F.lit(seed), F.lit(r)).bitwiseAND(mask))
        return F.shiftleft(left, half).bitwiseOR(right)

    # the domain is at most four times n: a few walks bring all but a vanishing part back, the loop is unrolled over an array
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(64)), once(i.cast("long")), lambda x, _: F.when(x < n, x).otherwise(once(x)))
    return walk


def split_by_entity(df: DataFrame, entities: Column, ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), names: tuple[str, str, str] = ("train", "val", "test")) -> DataFrame:
    """A split for each row from the md5 of its entities (array<string>): every entity has one split, rows whose entities differ are `conflict`, rows of none go by themselves to train."""
    from ..functions.text import stable_hash_mod

    a, b = round(ratios[0] * 10000), round((ratios[0] + ratios[1]) * 10000)
    put = lambda e: F.when(stable_hash_mod(e, 10000) < a, names[0]).when(stable_hash_mod(e, 10000) < b, names[1]).otherwise(names[2])
    splits = F.array_distinct(F.transform(entities, put))
    return df.withColumn("split", F.when(F.size(splits) == 0, names[0]).when(F.size(splits) == 1, splits[0]).otherwise("conflict"))


def split_randomly(df: DataFrame, key: str, fractions: dict[str, float], seed: int = 42) -> DataFrame:
    """A named split for each row by hash; fractions sum to at most one, the rest is `train`."""
    u = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    out, upto = F, 0.0
    for name, f in fractions.items():
        upto += f
        out = out.when(u < upto, name)
    return df.withColumn("split", out.otherwise("train"))


def trimmed(df: DataFrame, group: list[str], target: int, *order) -> DataFrame:
    """The `target` first rows of each group in an order; a window the planner turns into a per-partition limit first."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= target).drop("r")


# preferences


def pareto_fronts(items: DataFrame, group: str, key: str, cer: str = "cer", similarity: str = "similarity") -> DataFrame:
    """(group, key, front, place): non-dominated sorting of each group, low error and high similarity first."""
    kinds = {c: items.schema[c].dataType.simpleString() for c in (group, key)}

    def rank(k, pdf: pd.DataFrame) -> pd.DataFrame:
        left = sorted(zip(pdf[cer], -pdf[similarity], pdf[key], strict=True))
        rows, front = [], 0
        while left:
            best, rest = float("inf"), []
            seen = None
            for c, s, ident in left:
                if s < best or (c, s) == seen:
                    best, seen = min(best, s), (c, s)
                    rows.append((k[0], ident, front, len(rows)))
                else:
                    rest.append((c, s, ident))
            left, front = rest, front + 1
        return pd.DataFrame(rows, columns=[group, key, "front", "place"])

    return items.groupBy(group).applyInPandas(rank, f"{group} {kinds[group]}, {key} {kinds[key]}, front int, place int")


def bucket_index(x: float, bounds: list[float]) -> int | None:
    """Index of the first bound >= x."""
    i = bisect_left(bounds, x)
    return i if i < len(bounds) else None
