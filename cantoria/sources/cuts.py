"""Cuts: stretches of recordings with their supervisions, and sharded corpora whose fields stand in files of their own.

A sharded corpus has a file of cuts for each shard and, for every further
field, a file of lines or an archive for the same shard, in the same order. The
n-th cut takes the n-th value: places come with the rows as they are read by
ranges, and fields meet on (shard, place), so nothing is sorted over the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ranges
from .manifests import _paths, source
from .sinks import write_archives

SUPERVISIONS = "array<struct<id:string,recording_id:string,start:double,duration:double,channel:int,text:string,language:string,speaker:string,custom:map<string,string>>>"
CUT = f"id string, start double, duration double, channel int, recording_id string, supervisions {SUPERVISIONS}, custom map<string,string>"
_RAW = f"id string, start double, duration double, channel int, recording struct<id:string>, recording_id string, supervisions {SUPERVISIONS}, custom map<string,string>"


def _cut(line: Column) -> Column:
    return F.from_json(line, _RAW)


def _columns(r: str = "r") -> list[Column]:
    named = {"recording_id": F.coalesce(F.col(f"{r}.recording_id"), F.col(f"{r}.recording.id")), "start": F.coalesce(F.col(f"{r}.start"), F.lit(0.0)), "supervisions": F.coalesce(F.col(f"{r}.supervisions"), F.array().cast(SUPERVISIONS))}
    return [named.get(c, F.col(f"{r}.{c}")).alias(c) for c in ("id", "start", "duration", "channel", "recording_id", "supervisions", "custom")]


@source("cuts")
def cuts(spark: SparkSession, cuts_path, **_) -> DataFrame:
    """JSONL of cuts, compressed or not: CUT. Blank lines go; a cut without supervisions has an empty list, one without a start begins at 0."""
    rows = spark.read.text(_paths(cuts_path)).filter(F.trim("value") != "")
    return rows.select(_cut(F.col("value")).alias("r")).select(*_columns())


def cut_line(df: DataFrame) -> Column:
    """A cut as a line of JSON; fields that are null are left out."""
    return F.to_json(F.struct(*(F.col(c) for c in ("id", "start", "duration", "channel", "recording_id", "supervisions", "custom"))))


def supervised(cuts_: DataFrame) -> DataFrame:
    """A row for each supervision: cut, its place in it, absolute begin and end, text, language, speaker; cuts without any have none."""
    each = cuts_.select(F.col("id").alias("cut_id"), F.col("start").alias("cut_start"), F.posexplode("supervisions").alias("place", "s"))
    begin = F.col("cut_start") + F.col("s.start")
    return each.select("cut_id", "place", begin.alias("start"), (begin + F.col("s.duration")).alias("end"), "s.text", "s.language", "s.speaker")


def _shard(path: Column) -> Column:
    number = F.regexp_extract(path, r"shard=(\d+)/", 1)
    return F.when(number != "", number).otherwise(F.regexp_extract(path, r"(\d+)\.[^/]*$", 1)).cast("long")


def write_shards(df: DataFrame, folder: str, shard: str, order: str, lines: dict[str, Column], archives: dict[str, tuple[Column, Column]] | None = None) -> dict[str, str]:
    """Writes each field of `lines` (name -> line of text) and of `archives` (name -> member name, bytes) as files of each shard, which in order of path have its rows in the same order; returns name -> paths.

    A task has a range of shards and places, so no shard passes one task. Line feeds in a line would break it: JSON has none.
    """
    out = {}
    for name, line in lines.items():
        to = f"{folder}/{name}"
        df.select(F.col(shard).alias("shard"), F.col(order).alias("_order"), line.alias("value")).repartitionByRange("shard", "_order").sortWithinPartitions("shard", "_order").select("shard", "value").write.partitionBy("shard").text(to)
        out[name] = f"{to}/shard=*/part-*"
    for name, (member, data) in (archives or {}).items():
        rows = df.select(F.col(shard).alias("shard_id"), F.col(order).alias("_order"), member.alias("member"), data.alias("data"))
        write_archives(rows, f"{folder}/{name}", order="_order").count()
        out[name] = f"{folder}/{name}/*.tar"
    return out


@source("shar")
def shar(spark: SparkSession, fields: dict, **_) -> DataFrame:
    """Cuts (the field `cuts`) with a column for each further field: a line's text, or the name and bytes of an archive's member.

    A shard may have several files of a field, in order of path. Of archives whose cuts have two members, data and then JSON, the JSON is a column of its own (`<field>_json`).
    Every shard must have as many values of each field as it has cuts; the
    error names field and shard.
    """
    if "cuts" not in fields:
        raise ValueError("a sharded corpus needs a field of cuts")
    parts = {}
    for name, paths in fields.items():
        listed = _paths(paths)
        if all(p.endswith(".tar") for p in listed):
            m = ranges.within_shards(ranges.members(spark, listed), ranges.members(spark, listed, values=False), _shard(F.col("file")), "member")
            stem = F.regexp_extract("name", r"^(.*?)(?:\.[^.]*)?$", 1)
            numbered = m.select(_shard(F.col("file")).alias("shard"), "member", stem.alias("stem"), "name", "value")
            pairs = numbered.groupBy("shard", "stem").agg(F.min("member").alias("first"), F.min_by(F.struct("name", "value"), "member").alias("data"), F.max(F.when(F.col("name").endswith(".json"), F.decode("value", "UTF-8"))).alias("json"), F.count("*").alias("n"))
            # a cut's members follow each other, so its place is what its first one's comes to
            placed = pairs.select("shard", F.floor(F.col("first") / F.col("n")).alias("place"), F.col("data.value").alias(name), F.col("data.name").alias(f"{name}_name"), F.when(F.col("n") > 1, F.col("json")).alias(f"{name}_json"))
        else:
            placed = ranges.within_shards(ranges.lines(spark, listed), ranges.places(spark, listed), _shard(F.col("file")), "line").select(_shard(F.col("file")).alias("shard"), F.col("line").alias("place"), F.decode("value", "UTF-8").alias(name))
        parts[name] = placed
    counts = None
    for name, placed in parts.items():
        one = placed.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("place").alias("places"), F.max("place").alias("last")).withColumn("field", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    found = {(r.field, r.shard): r for r in counts.collect()}  # a row for each field and shard
    shards = sorted({s for f, s in found if f == "cuts"})
    wrong = [f"{f} in shard {s} ({found[f, s].n if (f, s) in found else 0} values, {found['cuts', s].n} cuts)" for f in parts for s in shards if (f, s) not in found or found[f, s].n != found["cuts", s].n or found[f, s].places != found[f, s].n or found[f, s].last != found[f, s].n - 1]
    wrong += [f"{f} in shard {s} (no cuts)" for f, s in sorted(found) if s not in shards]
    if wrong:
        raise ValueError("fields don't fit the cuts: " + ", ".join(wrong))
    out = parts.pop("cuts").select("shard", "place", _cut(F.col("cuts")).alias("r")).select("shard", "place", *_columns())
    for placed in parts.values():
        out = out.join(placed, ["shard", "place"])
    return out.drop("place")
