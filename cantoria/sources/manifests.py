"""Readers of manifests, text, tables, segment files and sharded archives.

Every reader returns a lazy DataFrame over Spark's own sources. A source type
is a function registered by name; `read(spec)` dispatches on it.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batching import expanded, mixture
from ..operators.conversations import around_placeholder
from ..operators.filters import without_skipped
from . import ranges

SOURCES: dict[str, Callable[..., DataFrame]] = {}


def source(name: str):
    """Registers a reader (spark, **options) -> DataFrame under a name."""

    def register(f):
        SOURCES[name] = f
        return f

    return register


def known_sources() -> list[str]:
    return sorted(SOURCES)


def read(spark: SparkSession, spec: dict) -> DataFrame:
    """A source by its `type`, or a nested mixture under `input_cfg`, with tags as constant columns and `weight` as a column.

    Without a type: manifest_filepath reads a JSONL manifest.
    """
    if "input_cfg" in spec:
        out = None
        for entry in mixture(spec["input_cfg"], spec.get("reweight_temperature", 1.0)):
            part = read(spark, {k: v for k, v in entry.items() if k != "weight"}).withColumn("weight", F.lit(entry["weight"]))
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out
    spec = dict(spec)
    tags = spec.pop("tags", {})
    kind = spec.pop("type", "manifest" if "manifest_filepath" in spec else None)
    if kind not in SOURCES:
        raise ValueError(f"no source {kind}; there are {known_sources()}")
    return SOURCES[kind](spark, **spec).withColumns({k: F.lit(v) for k, v in tags.items()})


def _paths(paths) -> list[str]:
    listed = [paths] if isinstance(paths, str) else list(paths)
    return [p for x in listed for p in expanded(x[0] if isinstance(x, (list, tuple)) else x)]


#: Names under which manifests give one field, in order of preference.
ALIASES = {
    "audio_file": ("audio_filename", "audio_filepath", "context"),
    "video_file": ("video_filename", "video_filepath"),
    "rttm_file": ("rttm_filename", "rttm_filepath"),
    "feature_file": ("feature_filename", "feature_filepath", "feature_file"),
    "text": ("text", "normalized_text", "answer"),
    "offset": ("offset",),
    "duration": ("duration",),
    "lang": ("lang", "language", "source_lang"),
    "speaker": ("speaker", "speaker_id"),
    "sample_rate": ("sampling_rate", "sample_rate", "orig_sample_rate"),
}


def aliased(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Fields collected from their aliases; a missing text is empty, a missing offset 0."""
    fill = {"text": "", "offset": 0.0} | (defaults or {})
    cols = {}
    for name, names in ALIASES.items():
        there = [F.col(n) for n in names if n in df.columns]
        if there or name in fill:
            cols[name] = F.coalesce(*there, *([F.lit(fill[name])] if name in fill else []))
    return df.withColumns(cols)


def full_path(path: Column, base: str, data_dir: str | None = None, longest: int = 255) -> Column:
    """Relative paths under data_dir, or else the manifest's folder; text too long for a path stays as it is."""
    folder = (data_dir or base).rstrip("/")
    return F.when((F.length(path) > longest) | path.rlike(r"^(?:/|~|[A-Za-z][\w+.-]*:)"), path).otherwise(F.concat(F.lit(folder + "/"), path))


@source("manifest")
def manifest(spark: SparkSession, manifest_filepath, text_field: str = "text", lang_field: str = "lang", schema: str | None = None, **_) -> DataFrame:
    """JSONL manifest: rows of true _skipme and broken lines go, text and language from the named fields."""
    reader = spark.read.option("mode", "DROPMALFORMED")
    df = without_skipped((reader.schema(schema) if schema else reader).json(_paths(manifest_filepath)))
    if text_field != "text" and text_field in df.columns:
        df = df.drop("text").withColumnRenamed(text_field, "text")
    if lang_field != "lang" and lang_field in df.columns:
        df = df.drop("lang").withColumnRenamed(lang_field, "lang")
    return df


def broken_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a JSONL file that aren't JSON objects."""
    return spark.read.text(_paths(path)).filter((F.trim("value") != "") & F.get_json_object("value", "$").isNull())


@source("parquet")
def parquet(spark: SparkSession, manifest_filepath, id_field: str | None = None, audio_field: str = "audio", text_field: str = "text", duration_field: str = "duration", lang_field: str = "lang", **_) -> DataFrame:
    """Parquet manifest; audio may be bytes or struct(bytes, path), an id falls back to file stem and row."""
    df = spark.read.parquet(*_paths(manifest_filepath))
    stem = F.regexp_extract(F.input_file_name(), r"([^/]*?)(?:\.[^./]*)?$", 1)
    df = df.withColumn("id", F.col(id_field).cast("string") if id_field else F.concat_ws("_", stem, F.monotonically_increasing_id().cast("string")))
    if audio_field in df.columns and "bytes" in getattr(df.schema[audio_field].dataType, "names", []):
        df = df.withColumn("audio", F.col(audio_field)["bytes"])
    renames = {text_field: "text", duration_field: "duration", lang_field: "lang", audio_field: "audio"}
    return df.withColumnsRenamed({a: b for a, b in renames.items() if a in df.columns and a != b and b not in df.columns})


@source("text")
def text(spark: SparkSession, paths, language: str | None = None, strip: bool = False, **_) -> DataFrame:
    """A row for each line, with its language; lines keep their content unless told to strip."""
    df = spark.read.text(_paths(paths)).withColumnRenamed("value", "text").withColumn("language", F.lit(language))
    return df.withColumn("text", F.trim("text")) if strip else df


@source("text_jsonl")
def text_jsonl(spark: SparkSession, paths, text_field: str = "text", language: str | None = None, **_) -> DataFrame:
    """JSONL rows that have the text field."""
    return spark.read.json(_paths(paths)).filter(F.col(text_field).isNotNull()).select(F.col(text_field).alias("text"), F.lit(language).alias("language"))


def numbered_lines(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(line, name) of one text file read whole into lines: files aligned by line number must be kept as shards of bounded size."""
    whole = spark.read.text(_paths(path), wholetext=True).select(F.input_file_name().alias("file"), F.regexp_replace("value", r"\n$", "").alias("value"))
    return whole.select("file", F.posexplode(F.split("value", "\n")).alias("line", name))


@source("text_pairs")
def text_pairs(spark: SparkSession, source_paths, target_paths, questions: list[str] | None = None, source_language: str | None = None, target_language: str | None = None, **_) -> DataFrame:
    """Line-aligned source and target files, shard by shard; lines stop at the shorter file, ends are stripped. A question is chosen by hash."""
    out = None
    for i, (a, b) in enumerate(zip(_paths(source_paths), _paths(target_paths), strict=True)):
        left, right = numbered_lines(spark, a, "source").drop("file"), numbered_lines(spark, b, "target").drop("file")
        part = left.join(right, "line").select(F.lit(i).alias("shard"), "line", F.trim("source").alias("source"), F.trim("target").alias("target"))
        out = part if out is None else out.unionByName(part)
    if questions:
        asked = F.array(*map(F.lit, questions))
        out = out.withColumn("question", F.element_at(asked, (F.pmod(F.xxhash64("shard", "line"), F.lit(len(questions))) + 1).cast("int")))
    return out.withColumns({"source_language": F.lit(source_language), "target_language": F.lit(target_language)})


def with_lines(df: DataFrame, place: str, lines: DataFrame, name: str) -> DataFrame:
    """Line i of a file on row i; a row without a line raises."""
    joined = df.join(lines.select(F.col("line").alias(place), F.col(name).alias("_line")), place, "left")
    return joined.withColumn(name, F.coalesce("_line", F.raise_error(F.lit("fewer lines than rows")).cast("string"))).drop("_line")


def with_sampled_line(df: DataFrame, key: str, lines: list[str], name: str, seed: int = 0) -> DataFrame:
    """A line of a short file for each row, chosen by hash."""
    return df.withColumn(name, F.element_at(F.array(*map(F.lit, lines)), (F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(len(lines))) + 1).cast("int")))


@source("chat_jsonl")
def chat_jsonl(spark: SparkSession, paths, **_) -> DataFrame:
    """Chat JSONL: conversations of (value, from), with mask role and system where given."""
    schema = "id string, system string, mask string, dataset string, category string, conversations array<struct<value:string,`from`:string,canonical_form:string,label:string,type:string,duration:double,offset:double>>"
    df = spark.read.schema(schema).json(_paths(paths))
    role = lambda r: F.when(F.lower(r).isin("human", "user"), "user").when(F.lower(r) == "system", "system").otherwise("assistant")
    turns = F.transform("conversations", lambda t: F.struct(role(t["from"]).alias("role"), F.coalesce(t["type"], F.lit("text")).alias("type"), t["value"].alias("value"), t["duration"].alias("duration"), t["offset"].alias("offset")))
    return df.withColumn("turns", turns).drop("conversations")


@source("placeholder_chat")
def placeholder_chat(spark: SparkSession, paths, placeholders: list[str] = ("<sound>", "<speech>", "<audio>"), **_) -> DataFrame:
    """Chat JSONL whose texts mark audio with placeholders, as pieces of text and audio."""
    return around_placeholder(chat_jsonl(spark, paths), list(placeholders))


# segment files


def rttm(spark: SparkSession, paths) -> DataFrame:
    """RTTM lines -> file, channel, start, duration, end, speaker; only SPEAKER lines, blanks of any width."""
    parts = F.split(F.trim("value"), r"\s+")
    df = spark.read.text(_paths(paths)).select(parts.alias("p")).filter(F.col("p")[0] == "SPEAKER")
    return df.select(F.col("p")[1].alias("file"), F.col("p")[2].alias("channel"), F.col("p")[3].cast("double").alias("start"), F.col("p")[4].cast("double").alias("duration"), F.round(F.col("p")[3].cast("double") + F.col("p")[4].cast("double"), 3).alias("end"), F.col("p")[7].alias("speaker"))


def transcripts(spark: SparkSession, paths) -> DataFrame:
    """(session_id, line) of what `sinks.transcripts` wrote."""
    return spark.read.options(sep="\t", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).schema("session_id string, line string").csv(_paths(paths))


def rttm_line(line: Column, digits: int = 3) -> Column:
    """One RTTM line as `start end speaker`."""
    p = F.split(F.trim(line), r"\s+")
    return F.concat_ws(" ", F.round(p[3].cast("double"), digits).cast("string"), F.round(p[3].cast("double") + p[4].cast("double"), digits).cast("string"), p[7])


def uem(spark: SparkSession, paths) -> DataFrame:
    p = F.split(F.trim("value"), r"\s+")
    return spark.read.text(_paths(paths)).filter(F.trim("value") != "").select(p[0].alias("file"), p[1].alias("channel"), p[2].cast("double").alias("start"), p[3].cast("double").alias("end"))


def uem_of(segments: DataFrame) -> DataFrame:
    """The evaluated region where none is given: least start to greatest end of each file and channel."""
    return segments.groupBy("file", "channel").agg(F.min("start").alias("start"), F.max("end").alias("end"))


def seglst(spark: SparkSession, paths, digits: int = 3, lines: bool = False) -> DataFrame:
    """JSON arrays of session_id, speaker, words, start_time, end_time, one a file or, as `sinks.seglst` writes them, one a line; duration follows."""
    df = spark.read.option("multiLine", not lines).schema("session_id string, speaker string, words string, start_time double, end_time double").json(_paths(paths))
    return df.withColumns({c: F.round(c, digits) for c in ("start_time", "end_time")}).withColumn("duration", F.round(F.col("end_time") - F.col("start_time"), digits))


def kaldi(spark: SparkSession, folder: str) -> DataFrame:
    """segments with wav.scp by recording and text by utterance; speaker and gender where the files are there."""
    def pairs(name: str, key: str, value: str) -> DataFrame:
        return spark.read.text(f"{folder}/{name}").select(F.split(F.trim("value"), r"\s+", 2).alias("p")).select(F.col("p")[0].alias(key), F.get("p", F.lit(1)).alias(value))

    p = F.split(F.trim("value"), r"\s+")
    segments = spark.read.text(f"{folder}/segments").select(p[0].alias("utterance"), p[1].alias("recording"), p[2].cast("double").alias("offset"), p[3].cast("double").alias("end"))
    out = segments.join(pairs("wav.scp", "recording", "audio_filepath"), "recording").join(pairs("text", "utterance", "text"), "utterance")
    return out.withColumn("duration", F.round(F.col("end") - F.col("offset"), 3)).drop("end")


def tabular(spark: SparkSession, path: str) -> DataFrame:
    """csv, tsv, json or jsonl as strings, null as empty."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind in ("csv", "tsv"):
        df = spark.read.csv(path, header=True, sep="\t" if kind == "tsv" else ",", multiLine=True, escape='"')
    elif kind in ("json", "jsonl"):
        df = spark.read.json(path, multiLine=kind == "json", primitivesAsString=True)
    else:
        raise ValueError(f"no reader for .{kind}")
    return df.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns))


# archives


def tar_members(spark: SparkSession, paths) -> DataFrame:
    """(shard, file, place, stem, extension, data) of every member of tar shards; a task walks an archive member by member."""
    stem = F.regexp_extract("name", r"^(.*)\.[^.]*$", 1)
    named = ranges.members(spark, _paths(paths))
    return named.select(F.col("file").alias("shard"), F.col("name").alias("file"), F.col("member").cast("int").alias("place"), F.when(stem != "", stem).otherwise(F.col("name")).alias("stem"), F.when(stem != "", F.regexp_extract("name", r"([^.]*)$", 1)).otherwise("").alias("extension"), F.col("value").alias("data"))


def tar_pairs(members: DataFrame) -> DataFrame:
    """Members of one stem, side by side: a JSON text and the other file; a lone member has null for the other."""
    js = F.when(F.col("extension") == "json", F.decode("data", "UTF-8"))
    return members.groupBy("shard", "stem").agg(F.max(js).alias("json"), F.max_by("data", F.when(F.col("extension") != "json", F.col("place"))).alias("data"), F.max(F.when(F.col("extension") != "json", F.col("file"))).alias("file"))


@source("tarred_manifest")
def tarred(spark: SparkSession, manifest_filepath, tarred_audio_filepaths, **options) -> DataFrame:
    """Manifest rows with their members' bytes: joined on shard number and file name, of which `-subN` marks a segment of the same recording.

    The shard numbers of the manifests and the archives must be the same.
    """
    number = lambda path: F.regexp_extract(path, r"(\d+)\.[^./]*$", 1).cast("int")
    rows = manifest(spark, manifest_filepath, **options)
    if "shard_id" not in rows.columns:
        rows = rows.withColumn("shard_id", number(F.input_file_name()))
    base = lambda c: F.regexp_replace(F.regexp_extract(c, r"([^/]*)$", 1), r"-sub\d+(?=\.|$)", "")
    data = tar_members(spark, tarred_audio_filepaths).select(number(F.col("shard")).alias("shard_id"), base(F.col("file")).alias("_name"), "data")
    numbers = {int(re.search(r"(\d+)\.[^./]*$", p)[1]) for p in _paths(tarred_audio_filepaths) if re.search(r"(\d+)\.[^./]*$", p)}
    there = {r[0] for r in rows.select("shard_id").distinct().collect()}  # as many as shards
    if there != numbers:
        raise ValueError(f"manifests have shards {sorted(there)}, archives {sorted(numbers)}")
    return rows.withColumn("_name", base(F.col("audio_filepath"))).join(data, ["shard_id", "_name"]).drop("_name")


def offset_index(spark: SparkSession, paths) -> DataFrame:
    """(file, line, offset, length) in bytes of every line of text files: what random access needs. Lines end with a line feed and nothing else."""
    return ranges.lines(spark, _paths(paths), values=False).drop("value")


def created_manifest(wav: DataFrame, **others: DataFrame) -> DataFrame:
    """Path lists joined by file stem: wav (path), then text, rttm, ctm, uem and so on by name."""
    from ..functions.text import file_stem

    out = wav.select(F.col("path").alias("audio_filepath"), file_stem(F.col("path")).alias("uniq_id"))
    for name, df in others.items():
        out = out.join(df.select(file_stem(F.col("path")).alias("uniq_id"), F.col("path").alias(f"{name}_filepath")), "uniq_id", "left")
    return out


def arpa(spark: SparkSession, path: str) -> DataFrame:
    """(order, log10p, ngram, backoff) of an ARPA file; the order is the number of words."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).filter(F.col("value").rlike(r"^-?\d[^\t]*\t")).select(parts.alias("p"))
    return rows.select(F.size(F.split(F.col("p")[1], " ")).alias("order"), F.col("p")[0].cast("double").alias("log10p"), F.col("p")[1].alias("ngram"), F.get("p", F.lit(2)).cast("double").alias("backoff"))


def arpa_lexicon(spark: SparkSession, path: str, lower: bool = False) -> DataFrame:
    """(word, spelling): the words of a language model with their letters, marks of sentence ends and unknown words left out."""
    words = arpa(spark, path).filter((F.col("order") == 1) & ~F.col("ngram").rlike("^<.*>$")).select(F.lower("ngram").alias("word") if lower else F.col("ngram").alias("word")).distinct()
    return words.select("word", F.array_join(F.filter(F.split("word", ""), lambda c: c != ""), " ").alias("spelling"))
