"""Entries of manifests: names, defaults, drawn contexts, sessions and their pairs, sets of any size."""

from collections import Counter

from pyspark.sql import functions as F

from cantoria.operators import entries as N


def test_context_rows(spark):
    rows = [(1, "a.wav", None, 1.0, "own", "said", None, None, None), (2, None, "b.wav", None, None, None, "text", "why?", 16000), (3, None, None, 2.0, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "id int, audio_filename string, audio_filepath string, duration double, context string, answer string, text string, question string, orig_sample_rate int")
    plain = {r.id: r for r in N.context_rows(df, "id").collect()}
    assert [(r.audio_file, r.context, r.answer, r.orig_sr) for _, r in sorted(plain.items())] == [("a.wav", "own", "said", None), ("b.wav", "why?", "text", 16000), (None, N.DEFAULT_CONTEXT, "na", None)]
    assert plain[1].lang is None and plain[1].offset is None
    many = spark.range(600).select(F.col("id"))
    counts = Counter(r.context for r in N.context_rows(many, "id", ["x", "", "y ", "z"]).collect())
    assert set(counts) == {"x", "y", "z"} and min(counts.values()) > 150
    files = spark.createDataFrame([("c.txt", "from a file"), ("t.txt", "an answer")], "path string, value string")
    named = spark.createDataFrame([(1, "c.txt", "t.txt"), (2, None, "none.txt")], "id int, context_filepath string, text_filepath string")
    assert [(r.context, r.answer) for r in N.context_rows(named, "id", texts=files).orderBy("id").collect()] == [("from a file", "an answer"), (N.DEFAULT_CONTEXT, "na")]
    other = spark.createDataFrame([(1, "q", "a")], "id int, frage string, antwort string")
    assert N.context_rows(other, "id", context_key="frage", answer_key="antwort").first().context == "q"


def test_video_rows(spark):
    df = spark.createDataFrame([(1, "v.mp4", "hi"), (2, None, "no video"), (3, "w.mp4", None)], "id int, video_filepath string, text string")
    assert [(r.id, r.video_file, r.text) for r in N.video_rows(df, "id").collect()] == [(1, "v.mp4", "hi")]


def test_sessions(spark):
    df = spark.createDataFrame([("x/one.two.wav", 3.0, None, None), ("y.wav", None, "r.rttm", 2.0), (None, 1.0, None, None), (".hidden", 1.0, None, None)], "audio_filepath string, duration double, rttm_filepath string, offset double")
    sessions = N.session_rows(df)
    assert [(r.uniq_id, r.rttm_file, r.offset) for r in sessions.collect()] == [("one.two", None, 0.0), ("y", "r.rttm", 2.0), (None, None, 0.0), (".hidden", None, 0.0)]
    assert sorted((r.uniq_id or "", r.lacks) for r in N.broken_sessions(sessions).collect()) == [("", "audio_file"), ("y", "duration")]
    turns = spark.createDataFrame([("y", 5.0, "b"), ("y", 1.0, "c"), ("y", 2.0, "a"), ("y", 9.0, "c"), ("one.two", 1.0, "s")], "uniq_id string, start double, speaker string")
    found = {r.uniq_id: (r.speakers, [tuple(t) for t in r.targets]) for r in N.session_targets(sessions.filter("uniq_id is not null"), turns).collect()}
    assert found == {"y": (["c", "a", "b"], [(0, 1), (0, 2), (1, 2)]), "one.two": (["s"], [(0, 0)]), ".hidden": ([], [])}


def test_sets_of_any_size(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert sorted((r.k, r["copy"]) for r in N.resized(df, "k", 4).collect()) == [(i, 0) for i in range(4)]
    assert N.resized(df, "k", 10).count() == 10
    more = [r.k for r in N.resized(df, "k", 27, seed=1).collect()]
    assert len(more) == 27 and set(Counter(more).values()) == {2, 3}
    assert Counter(r["copy"] for r in N.resized(df, "k", 30).collect()) == {0: 10, 1: 10, 2: 10}
    assert N.resized(df.filter("k < 0"), "k", 5).count() == 0
