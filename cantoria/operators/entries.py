"""Entries of training sets as manifests give them: fields by their many names, defaults, contexts, sessions, and sets made as large as asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batching import sampled_exactly

#: Names of one field, in order of preference, and what stands for a missing context or answer.
AUDIO = ("audio_filename", "audio_filepath", "audio_file")
VIDEO = ("video_filename", "video_filepath", "video_file")
RTTM = ("rttm_file", "rttm_filename", "rttm_filepath")
DEFAULT_CONTEXT = "what does this audio mean"
DEFAULT_ANSWER = "na"


def first_of(df: DataFrame, *names: str, kind: str = "string") -> Column:
    """The first of the columns that the table has and the row fills."""
    there = [F.col(n).cast(kind) for n in names if n in df.columns]
    return F.coalesce(*there, F.lit(None).cast(kind)) if there else F.lit(None).cast(kind)


def drawn(key: Column, options: list[str], seed: int = 0) -> Column:
    """One of the options for each key, by md5, so that a retried task draws alike."""
    place = F.conv(F.substring(F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed)))), 1, 7), 16, 10).cast("long") % len(options)
    return F.element_at(F.array(*map(F.lit, options)), place.cast("int") + 1)


def _with_text(df: DataFrame, path: str, texts: DataFrame | None, name: str) -> tuple[DataFrame, Column]:
    """The text of the file that column `path` names, from (path, value)."""
    if texts is None or path not in df.columns:
        return df, F.lit(None).cast("string")
    return df.join(texts.select(F.col("path").alias(path), F.col("value").alias(name)), path, "left"), F.col(name)


def context_rows(df: DataFrame, key: str, contexts: list[str] | None = None, context_key: str = "context", answer_key: str = "answer", texts: DataFrame | None = None, seed: int = 0) -> DataFrame:
    """(key, audio_file, duration, context, answer, offset, speaker, orig_sr, lang) of manifest rows.

    The context is the row's own, that of its context file, one drawn from
    `contexts` (blank ones don't count), its question, or a default; the answer its own, its text, that of
    its text file, or `na`. texts: (path, value) of the files that rows name.
    """
    rows, context_text = _with_text(df, "context_filepath", texts, "_context")
    rows, answer_text = _with_text(rows, "text_filepath", texts, "_answer")
    options = [c.strip() for c in contexts or () if c.strip()]
    context = F.coalesce(first_of(df, context_key), context_text, drawn(F.col(key), options, seed) if options else first_of(df, "question"), F.lit(DEFAULT_CONTEXT))
    answer = F.coalesce(first_of(df, answer_key, "text"), answer_text, F.lit(DEFAULT_ANSWER))
    return rows.select(
        key, first_of(df, *AUDIO).alias("audio_file"), first_of(df, "duration", kind="double").alias("duration"), context.alias("context"), answer.alias("answer"), first_of(df, "offset", kind="double").alias("offset"),
        first_of(df, "speaker").alias("speaker"), first_of(df, "orig_sample_rate", kind="int").alias("orig_sr"), first_of(df, "lang").alias("lang"),
    )


def video_rows(df: DataFrame, key: str, texts: DataFrame | None = None) -> DataFrame:
    """(key, video_file, duration, text, offset, speaker, orig_sr, lang) of manifest rows; rows without a video or a text go."""
    rows, said = _with_text(df, "text_filepath", texts, "_text")
    out = rows.select(key, first_of(df, *VIDEO).alias("video_file"), first_of(df, "duration", kind="double").alias("duration"), F.coalesce(first_of(df, "text"), said).alias("text"), first_of(df, "offset", kind="double").alias("offset"), first_of(df, "speaker").alias("speaker"), first_of(df, "orig_sample_rate", kind="int").alias("orig_sr"), first_of(df, "lang").alias("lang"))
    return out.filter("video_file is not null and text is not null")


def _stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(.)\.[^.]*$", "$1")


def session_rows(df: DataFrame) -> DataFrame:
    """(audio_file, uniq_id, duration, rttm_file, offset) of sessions for diarization: the id is the file's stem unless given, the offset 0, the transcript of speakers may be missing."""
    audio = first_of(df, *AUDIO)
    return df.select(audio.alias("audio_file"), F.coalesce(first_of(df, "uniq_id"), _stem(audio)).alias("uniq_id"), first_of(df, "duration", kind="double").alias("duration"), first_of(df, *RTTM).alias("rttm_file"), F.coalesce(first_of(df, "offset", kind="double"), F.lit(0.0)).alias("offset"))


def broken_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions without a file or a duration, with what they lack; a training set must have none."""
    lacks = F.concat_ws(", ", F.when(F.col("audio_file").isNull(), "audio_file"), F.when(F.col("duration").isNull(), "duration"))
    return sessions.withColumn("lacks", lacks).filter("lacks <> ''")


def session_targets(sessions: DataFrame, turns: DataFrame) -> DataFrame:
    """Sessions with their speakers (array, in order of first appearance), how many, and all pairs of their places: (uniq_id, ..., speakers, targets).

    turns: (uniq_id, start, speaker). A session of one speaker has that one paired with itself; one without any has none.
    """
    first = turns.groupBy("uniq_id", "speaker").agg(F.min("start").alias("at"))
    named = first.groupBy("uniq_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "speaker"))), lambda x: x["speaker"]).alias("speakers"))
    n = F.size("speakers")
    place = F.sequence(F.lit(0), n - 1)
    pairs = F.flatten(F.transform(place, lambda i: F.transform(F.filter(place, lambda j: j > i), lambda j: F.struct(i.alias("a"), j.alias("b")))))
    one = F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b")))
    out = sessions.join(named, "uniq_id", "left").withColumn("speakers", F.coalesce("speakers", F.array().cast("array<string>")))
    return out.withColumn("targets", F.when(n == 0, F.array().cast("array<struct<a:int,b:int>>")).when(n == 1, one).otherwise(pairs))


def resized(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly n rows with `copy`: fewer are the first by key; more are whole copies and, of the last one, rows drawn without repeats."""
    total = df.count()
    if n <= total or not total:
        from .packs import placed

        return placed(df, key, name="_at").filter(F.col("_at") < n).withColumn("copy", F.lit(0)).drop("_at")
    whole, rest = divmod(n, total)
    copies = df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(whole - 1))))
    return copies.unionByName(sampled_exactly(df, key, rest, seed).withColumn("copy", F.lit(whole))) if rest else copies
