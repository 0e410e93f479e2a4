"""No-score zones: stretches of a recording that an evaluation leaves out.

Everything here is a sweep over typed events: windows over one shuffle by
recording, in order of time. Times become doubles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import union

#: What stands for a zone that nothing ends.
NEVER = float("inf")


def _any_of(kind: Column, subtype: Column, excluded: dict[str, set[str]]) -> Column:
    return reduce(lambda a, b: a | b, (((kind == k) & subtype.isin(*sorted(v))) for k, v in sorted(excluded.items()) if v), F.lit(False))


def exclusion_zones(tokens: DataFrame, keys: list[str], excluded: dict[str, set[str]], extend: float = 0.0) -> DataFrame:
    """(keys, kind, subtype, start, end) -> zones (keys, start, end) that hold the excluded kinds and subtypes.

    A zone stretches up to `extend` to either side, but not over an anchor: the
    begin or end of a LEXEME that isn't itself excluded, or of a SPEAKER turn,
    one at the zone's own edge included. Where a lexeme goes on over an edge,
    that edge stays. Excluded lexemes are no zones and no anchors. A zone that
    neither an anchor nor another zone follows has no end (infinity). Tokens
    without length or with a null time count for nothing; overlapping and touching zones are one.
    """
    named = tokens.select(*keys, "kind", F.coalesce("subtype", F.lit("")).alias("subtype"), F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end")).filter("end > start")
    gone = F.coalesce(_any_of(F.col("kind"), F.col("subtype"), excluded), F.lit(False))
    role = F.when(F.col("kind") == "LEXEME", F.when(~gone, "lexeme")).when(F.col("kind") == "SPEAKER", "turn").when(gone, "zone")
    roles = union(named.withColumn("role", role).filter("role is not null").select(*keys, "role", "start", "end"), [*keys, "role"])
    # each edge an event; lexemes' begins also know their ends
    edge = lambda at, other, first: F.struct(F.col(at).alias("at"), F.col(other).alias("other"), F.lit(first).alias("begins"))
    events = roles.select(*keys, "role", F.inline(F.array(edge("start", "end", True), edge("end", "start", False))))
    turns = named.filter("kind = 'SPEAKER'")  # turns that overlap or touch have edges inside their union
    inner = turns.select(*keys, F.lit("turn").alias("role"), F.inline(F.array(edge("start", "end", True), edge("end", "start", False))))
    events = events.filter("role <> 'turn'").unionByName(inner)
    upto = Window.partitionBy(*keys).orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    onward = Window.partitionBy(*keys).orderBy("at").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    later = Window.partitionBy(*keys, "role", "begins").orderBy("at").rowsBetween(1, Window.unboundedFollowing)
    anchor = F.when(F.col("role") != "zone", F.col("at"))
    seen = events.select(
        "*",
        F.max(anchor).over(upto).alias("before"),
        F.min(anchor).over(onward).alias("after"),
        F.max(F.when((F.col("role") == "lexeme") & F.col("begins"), F.col("other"))).over(upto).alias("spoken"),
        F.max("at").over(later).alias("next"),
    ).filter("role = 'zone'")
    spoken = F.coalesce(F.col("spoken") >= F.col("at"), F.lit(False))
    to = F.when(spoken, F.col("at")).when(F.col("begins"), F.greatest(F.coalesce("before", F.lit(0.0)), F.col("at") - extend)).otherwise(
        F.coalesce(F.least("after", F.when(F.col("after").isNotNull() | F.col("next").isNotNull(), F.col("at") + extend)), F.lit(NEVER))
    )
    zone = F.when(F.col("begins"), F.col("at")).otherwise(F.col("other"))
    ends = seen.select(*keys, zone.alias("zone"), "begins", to.alias("to")).groupBy(*keys, "zone").agg(F.max(F.when(F.col("begins"), F.col("to"))).alias("start"), F.max(F.when(~F.col("begins"), F.col("to"))).alias("end"))
    return union(ends.drop("zone"), keys)


def overlapped_speech(turns: DataFrame, keys: list[str]) -> DataFrame:
    """Zones in which two or more turns (keys, start, end) go on at once."""
    return _swept(turns.filter("end > start").select(*keys, "start", "end", F.lit("n").alias("what")), keys, ["n"], F.col("n") > 1)


def collar_zones(turns: DataFrame, keys: list[str], collar: float) -> DataFrame:
    """Zones of +-collar around each edge of the turns."""
    around = F.array(*(F.struct((F.col(c) - collar).alias("start"), (F.col(c) + collar).alias("end")) for c in ("start", "end")))
    return union(turns.filter("end > start").select(*keys, F.inline(around)), keys)


def regions_without(regions: DataFrame, zones: DataFrame, keys: list[str]) -> DataFrame:
    """What the zones leave of the regions, as maximal stretches; a recording of which nothing is left keeps its regions."""
    both = [df.filter("end > start").select(*keys, F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"), F.lit(what).alias("what")) for df, what in ((regions, "r"), (zones, "z"))]
    left = (F.col("r") > 0) & (F.col("z") == 0)
    return _swept(both[0].unionByName(both[1]), keys, ["r", "z"], left, F.col("r") > 0)


def _swept(spans: DataFrame, keys: list[str], kinds: list[str], wanted: Column, otherwise: Column | None = None) -> DataFrame:
    """Stretches between edges where `wanted` holds for the numbers of spans of each kind; `otherwise` counts for a recording that has none."""
    step = lambda at, n: F.struct(F.col(at).alias("at"), F.lit(n).alias("n"))
    edges = spans.select(*keys, "what", F.inline(F.array(step("start", 1), step("end", -1))))
    steps = edges.groupBy(*keys, "at").agg(*(F.sum(F.when(F.col("what") == k, F.col("n")).otherwise(0)).alias(k) for k in kinds))
    w = Window.partitionBy(*keys).orderBy("at")
    counted = steps.select(*keys, "at", F.lead("at").over(w).alias("to"), *(F.sum(k).over(w).alias(k) for k in kinds)).filter("to is not null")
    kept = counted.withColumn("in", wanted)
    if otherwise is not None:
        kept = kept.withColumn("in", F.col("in") | (~F.max("in").over(Window.partitionBy(*keys)) & otherwise))
    return union(kept.filter("in").select(*keys, F.col("at").alias("start"), F.col("to").alias("end")), keys)
