"""Queries over events as timed segments of streams: intervals, sessions, diarization, endpointing.

An event of a user is a segment that starts at its time and lasts its value in
milliseconds times a thousand; times are microseconds since 1970, as integers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as I
from ..operators import joins as J
from ..operators import scoring as S
from ..operators import tuning as T
from ..operators import zones as Z
from ..streaming import online, streams
from .registered import query, table

SEGMENTS = "(SELECT user_id, event_id, event_type, epoch_us(ts) AS start, epoch_us(ts) + CAST(round(value * 1000) AS BIGINT) * 1000000 AS end_ FROM events)"


def segments(spark, sf_dir):
    start = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    return table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", start.alias("start"), (start + F.round(F.col("value") * 1000).cast("long") * 1000000).alias("end"))


ISLANDS = """WITH s AS {s}, m AS (SELECT *, max(end_) OVER (PARTITION BY user_id ORDER BY start, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY start, end_, event_id) AS island FROM m)
SELECT user_id, min(start) AS start, max(end_) AS "end" FROM i GROUP BY user_id, island"""


@query(ISLANDS.format(s=SEGMENTS))
def interval_union(spark, sf_dir):
    return I.union(segments(spark, sf_dir), ["user_id"])


@query(f"WITH s AS {SEGMENTS}, g AS (SELECT user_id, lag(end_) OVER (PARTITION BY user_id ORDER BY start, end_) AS start, start AS \"end\" FROM s) SELECT * FROM g WHERE start < \"end\"")
def interval_gaps(spark, sf_dir):
    return I.gaps(segments(spark, sf_dir), ["user_id"])


@query(f"""WITH s AS {SEGMENTS}, m AS (SELECT *, max(end_) OVER (PARTITION BY user_id ORDER BY start, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s)
SELECT user_id, start, least(reach, end_) AS "end" FROM m WHERE start <= reach""")
def interval_overlaps(spark, sf_dir):
    return I.overlaps(segments(spark, sf_dir), ["user_id"])


@query(f"""WITH s AS {SEGMENTS}, m AS (SELECT *, lag(end_) OVER (PARTITION BY user_id ORDER BY start, end_) AS before FROM s WHERE end_ - start >= 2000000000),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR start - before >= 60000000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY start, end_) AS island FROM m)
SELECT user_id, min(start) AS start, max(end_) AS "end" FROM i GROUP BY user_id, island""")
def speech_cleaned(spark, sf_dir):
    """Segments of less than 2000 s dropped, then gaps of less than 60000 s filled."""
    return I.cleaned(segments(spark, sf_dir), ["user_id"], 2000000000, 60000000000)


@query("""WITH m AS (SELECT user_id, ts, event_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR epoch_us(ts) - epoch_us(before) > 3600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM m)
SELECT user_id, CAST(session AS BIGINT) AS session, min(ts) AS start, max(ts) AS "end", count(*) AS n FROM i GROUP BY user_id, session""")
def sessions(spark, sf_dir):
    return I.sessions(table(spark, sf_dir, "events"), ["user_id"], "ts", 3600)


@query("""WITH f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, CAST(event_type = 'click' AS INTEGER) AS y FROM events),
o AS (SELECT user_id, i, i - row_number() OVER (PARTITION BY user_id ORDER BY i) AS run FROM f WHERE y = 1)
SELECT user_id, min(i) * 10 AS start, max(i) * 10 AS "end" FROM o GROUP BY user_id, run""")
def runs_of_frames(spark, sf_dir):
    """Runs of clicks in a user's events, ten units a frame."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    frames = table(spark, sf_dir, "events").select("user_id", (F.row_number().over(w) - 1).alias("frame_idx"), (F.col("event_type") == "click").cast("int").alias("label"))
    return I.speech_segments(frames, ["user_id"], 10).select("user_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@query("""WITH n AS (SELECT event_id, value, CASE WHEN value <= 1.5 THEN 1 ELSE CAST(ceil((value - 1.5) / 0.75) AS BIGINT) + 1 END AS n FROM events),
p AS (SELECT event_id, CAST(round(i * 0.75, 5) AS DOUBLE) AS start, round(least(1.5, value - i * 0.75), 5) AS duration FROM n, unnest(generate_series(0, n - 1)) AS g(i))
SELECT * FROM p WHERE duration > 0.05""")
def subsegments(spark, sf_dir):
    pieces = I.sliding(F.lit(0.0), F.col("value"), 1.5, 0.75, 0.05)
    return table(spark, sf_dir, "events").select("event_id", F.explode(pieces).alias("p")).select("event_id", "p.*")


@query(f"""WITH s AS {SEGMENTS}, a AS (SELECT * FROM s WHERE event_type = 'error'), b AS (SELECT * FROM s WHERE event_type = 'click')
SELECT a.user_id, a.start AS target_start, a.end_ AS target_end, greatest(a.start, b.start) AS start, least(a.end_, b.end_) AS "end"
FROM a JOIN b ON a.user_id = b.user_id AND a.start < b.end_ AND b.start < a.end_ WHERE a.end_ > a.start AND b.end_ > b.start""")
def overlap_join(spark, sf_dir):
    """Errors with the clicks of the same user that overlap them, clipped to both."""
    s = segments(spark, sf_dir).select("user_id", "start", "end", "event_type")
    return J.clipped(s.filter("event_type = 'error'"), s.filter("event_type = 'click'").drop("event_type"), ["user_id"], 20000000000)


@query("""SELECT l.event_id, l.user_id, r.event_id AS click_id FROM (SELECT * FROM events WHERE event_type = 'error') l
ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'click' GROUP BY user_id, ts) r ON l.user_id = r.user_id AND l.ts >= r.ts""")
def as_of_join(spark, sf_dir):
    """Each error with the user's latest click at or before it."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    clicks = e.filter("event_type = 'click'").groupBy("user_id", "ts").agg(F.max("event_id").alias("click_id"))
    return J.as_of(e.filter("event_type = 'error'"), clicks, ["user_id"], "ts", ["click_id"]).select("event_id", "user_id", "click_id")


@query("""SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY event_type""")
def latency_percentiles(spark, sf_dir):
    out = S.percentiles(table(spark, sf_dir, "events"), "value", (0.5, 0.9, 0.95), "event_type")
    return out.select("event_type", *(F.round(c, 6).alias(c) for c in ("p50", "p90", "p95")))


@query("""SELECT coalesce(event_type, 'default') AS event_type, round(avg(value) FILTER (WHERE value <> 0), 6) AS value_mean, round(stddev_samp(value) FILTER (WHERE value <> 0), 6) AS value_std FROM events GROUP BY ROLLUP (event_type)""")
def feature_stats(spark, sf_dir):
    out = S.feature_stats(table(spark, sf_dir, "events"), ["value"], "event_type")
    return out.select("event_type", *(F.round(c, 6).alias(c) for c in ("value_mean", "value_std")))


@query("""SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def nested_fields(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id", F.get_json_object("props", "$.k").cast("long").alias("k")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("""SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def tumbling_windows(spark, sf_dir):
    out = streams.windowed(table(spark, sf_dir, "events"), "ts", "10 minutes", "1 hour", None, "event_type", n=F.count("*"), total=F.sum("value"))
    return out.select("event_type", F.col("window.start").alias("start"), "n", F.round("total", 4).alias("total"))


@query()
def diarization_error(spark, sf_dir):
    """Users as recordings, event types as speakers; the system hears each segment 20 s late and clicks as views."""
    s = segments(spark, sf_dir).select(F.col("user_id").alias("file"), (F.col("start") / 1e6).alias("start"), (F.col("end") / 1e6).alias("end"), F.col("event_type").alias("speaker"))
    heard = s.withColumn("start", F.col("start") + 20).withColumn("end", F.col("end") + 20).withColumn("speaker", F.when(F.col("speaker") == "click", "view").otherwise(F.col("speaker")))
    return S.diarization(s, heard, "file", collar=0.25)


@query()
def end_of_utterance_matches(spark, sf_dir):
    s = segments(spark, sf_dir).select("user_id", (F.col("start") / 1e6).alias("start"), (F.col("end") / 1e6).alias("end"), "event_type")
    return J.matched_ends(s.filter("event_type = 'click'").drop("event_type"), s.filter("event_type = 'error'").drop("event_type"), ["user_id"], 600.0)


@query("""WITH f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, value / 50 AS p FROM events), d AS (SELECT *, CASE WHEN p > 0.5 THEN 1 WHEN p < 0.3 THEN 0 END AS d FROM f),
s AS (SELECT user_id, i, coalesce(last_value(d IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS on_ FROM d), r AS (SELECT user_id, i, i - row_number() OVER (PARTITION BY user_id ORDER BY i) AS run FROM s WHERE on_ = 1),
g AS (SELECT user_id, greatest(min(i) * 2 - 2, 0) AS a, (max(i) + 1) * 2 + 2 AS z FROM r GROUP BY user_id, run), m AS (SELECT *, max(z) OVER (PARTITION BY user_id ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM g),
n AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY a, z) AS island FROM m)
SELECT user_id, CAST(min(a) AS DOUBLE) AS start, CAST(max(z) AS DOUBLE) AS "end" FROM n GROUP BY user_id, island""")
def speech_by_hysteresis(spark, sf_dir):
    """Frames of two units whose value passes 25, until it falls below 15; a frame more at each end."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    frames = table(spark, sf_dir, "events").select("user_id", (F.row_number().over(w) - 1).alias("frame_idx"), (F.col("value") / 50).alias("p"))
    return I.hysteresis(frames, ["user_id"], 2.0, 0.5, 0.3, 2.0, 2.0)


@query("""WITH w AS (SELECT user_id, event_type AS word, epoch_us(ts) / 1e6 AS a FROM events), m AS (SELECT *, lag(a + 1) OVER (PARTITION BY user_id ORDER BY a) AS before FROM w), s AS (SELECT *, sum(CASE WHEN a - before > 3600 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY a) AS segment FROM m)
SELECT user_id::VARCHAR AS stream_id, segment::BIGINT AS segment, min(a) AS start, max(a) + 1 AS "end", string_agg(word, ' ' ORDER BY a) AS text FROM s GROUP BY user_id, segment""")
def stream_transcripts(spark, sf_dir):
    """Event types as words of a user's stream; a silence of an hour ends a segment. The same fold runs on streams."""
    s = segments(spark, sf_dir)
    last = s.groupBy("user_id").agg(F.max(F.struct("start", "event_id")).alias("m"))
    words = s.join(last, "user_id").select(F.col("user_id").cast("string").alias("stream_id"), (F.col("start") / 1e6).alias("start"), (F.col("start") / 1e6 + 1).alias("end"), F.col("event_type").alias("word"), (F.struct("start", "event_id") == F.col("m")).alias("is_last"))
    return streams.transcribed(words, 3600.0)


def words_of_users(spark, sf_dir):
    """Events as words that their type speaks in a user's session."""
    return segments(spark, sf_dir).select(F.col("user_id").alias("session_id"), F.col("event_type").alias("speaker"), "start", "end", F.concat(F.lit("w"), F.col("event_id").cast("string")).alias("word"))


WORDS = f"(SELECT user_id AS session_id, event_type AS speaker, start, end_, 'w' || event_id AS word FROM {SEGMENTS})"


@query(f"""WITH m AS (SELECT *, lag(speaker) OVER (PARTITION BY session_id ORDER BY start, end_) AS before FROM {WORDS}),
t AS (SELECT *, sum(CASE WHEN before IS NOT DISTINCT FROM speaker THEN 0 ELSE 1 END) OVER (PARTITION BY session_id ORDER BY start, end_) AS turn FROM m)
SELECT session_id, CAST(turn AS BIGINT) AS turn, speaker, min(start) AS start, max(end_) AS "end", string_agg(word, ' ' ORDER BY start, end_, word) AS text FROM t GROUP BY session_id, turn, speaker""")
def speaker_sentences(spark, sf_dir):
    return I.speaker_sentences(words_of_users(spark, sf_dir))


@query(f"""WITH m AS (SELECT *, lag(end_) OVER (PARTITION BY session_id ORDER BY start, end_) AS before FROM {WORDS}),
t AS (SELECT *, sum(CASE WHEN before IS NULL OR start - before >= 7200000000 THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY start, end_) AS segment FROM m)
SELECT session_id, CAST(segment AS BIGINT) AS segment, min(start) AS start, max(end_) AS "end", string_agg(word, ' ' ORDER BY start, end_, word) AS text FROM t GROUP BY session_id, segment""")
def utterances_by_gap(spark, sf_dir):
    return I.utterances_by_gap(words_of_users(spark, sf_dir).drop("speaker"), ["session_id"], 7200000000, ())


@query(f"""SELECT event_id, c AS chunk, greatest(start, c * 10000000000) AS start, least(end_, (c + 1) * 10000000000) AS "end", CASE WHEN c = start // 10000000000 THEN event_type ELSE '' END AS words
FROM {SEGMENTS}, unnest(generate_series(start // 10000000000, end_ // 10000000000)) AS g(c)""")
def chunked_segments(spark, sf_dir):
    """Segments over chunks of ten thousand seconds; the words go with the first piece."""
    s = segments(spark, sf_dir).select("event_id", "start", "end", F.col("event_type").alias("words"))
    return I.chunked_segments(s, 10000000000).select("event_id", "chunk", "start", "end", "words")


@query(f"""WITH m AS (SELECT *, lag(end_) OVER (PARTITION BY user_id ORDER BY start, end_) AS before FROM {SEGMENTS}),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR before < start THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY start, end_) AS island FROM m)
SELECT user_id, min(start) AS start, arg_max(end_, start) AS "end" FROM i GROUP BY user_id, island""")
def merged_neighbours(spark, sf_dir):
    """Segments merged with the one before only, which a longer one further back doesn't change."""
    return I.merged_neighbours(segments(spark, sf_dir), ["user_id"])


def _islands(of: str) -> str:
    """SQL of the unions of (user_id, a, z) spans that overlap or touch."""
    return f"""(SELECT user_id, min(a) AS a, max(z) AS z FROM (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY a, z) AS island
FROM (SELECT *, max(z) OVER (PARTITION BY user_id ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {of})) GROUP BY user_id, island)"""


ZONES = f"""WITH s AS (SELECT user_id, event_type, start::DOUBLE AS a, end_::DOUBLE AS z FROM {SEGMENTS} WHERE end_ > start),
z AS {_islands("(SELECT user_id, a, z FROM s WHERE event_type = 'error')")}, l AS {_islands("(SELECT user_id, a, z FROM s WHERE event_type = 'view')")},
anchors AS (SELECT user_id, unnest([a, z]) AS t FROM (SELECT user_id, a, z FROM s WHERE event_type = 'purchase' UNION ALL SELECT user_id, a, z FROM l)),
edges AS (SELECT z.user_id, z.a, z.z, EXISTS (SELECT 1 FROM l WHERE l.user_id = z.user_id AND l.a <= z.a AND l.z >= z.a) AS spoken_a, EXISTS (SELECT 1 FROM l WHERE l.user_id = z.user_id AND l.a <= z.z AND l.z >= z.z) AS spoken_z,
  (SELECT max(t) FROM anchors x WHERE x.user_id = z.user_id AND t <= z.a) AS before, (SELECT min(t) FROM anchors x WHERE x.user_id = z.user_id AND t >= z.z) AS after, (SELECT max(y.a) FROM z y WHERE y.user_id = z.user_id AND y.a > z.a) AS next FROM z),
stretched AS (SELECT user_id, CASE WHEN spoken_a THEN a ELSE greatest(coalesce(before, 0), a - 3e10) END AS a, CASE WHEN spoken_z THEN z WHEN after IS NOT NULL THEN least(after, z + 3e10) WHEN next IS NOT NULL THEN z + 3e10 ELSE 'infinity'::DOUBLE END AS z FROM edges),
zones AS {_islands("stretched")}"""
#: What a user's time between the first begin and the last end is.
TURNS = "SELECT user_id, min(a) AS a, max(z) AS z FROM s GROUP BY user_id"


def _tokens(spark, sf_dir):
    """Views as lexemes, purchases as turns, errors as what isn't lexical; times in microseconds."""
    kind = F.when(F.col("event_type") == "view", "LEXEME").when(F.col("event_type") == "purchase", "SPEAKER").when(F.col("event_type") == "error", "NON-LEX").otherwise("CLICK")
    return segments(spark, sf_dir).select("user_id", kind.alias("kind"), F.lit("other").alias("subtype"), "start", "end")


def _zones(spark, sf_dir):
    return Z.exclusion_zones(_tokens(spark, sf_dir), ["user_id"], {"NON-LEX": {"other"}, "LEXEME": {"fp"}}, extend=3e10)


@query(ZONES + ' SELECT user_id, a AS start, z AS "end" FROM zones')
def exclusion_zones(spark, sf_dir):
    """Errors stretched by up to 30,000 s, not over a view or the edge of a purchase."""
    return _zones(spark, sf_dir)


def _regions(spark, sf_dir):
    s = segments(spark, sf_dir).filter("end > start")
    return s.groupBy("user_id").agg(F.min("start").alias("start"), F.max("end").alias("end"))


@query(ZONES + f""", e AS (SELECT user_id, t, sum(r) AS r, sum(q) AS q FROM (SELECT user_id, unnest([a, z]) AS t, unnest([1, -1]) AS r, 0 AS q FROM ({TURNS}) UNION ALL SELECT user_id, unnest([a, z]), 0, unnest([1, -1]) FROM zones) GROUP BY user_id, t),
c AS (SELECT user_id, t AS a, lead(t) OVER w AS z, sum(r) OVER w AS r, sum(q) OVER w AS q FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t)),
k AS (SELECT *, max(CASE WHEN r > 0 AND q = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS any_left FROM c WHERE z IS NOT NULL), p AS (SELECT user_id, a, z FROM k WHERE r > 0 AND (q = 0 OR any_left = 0))
SELECT user_id, a AS start, z AS "end" FROM {_islands("p")}""")
def regions_to_score(spark, sf_dir):
    """A user's time without the zones."""
    return Z.regions_without(_regions(spark, sf_dir), _zones(spark, sf_dir), ["user_id"])


@query(f"""WITH s AS (SELECT user_id, start::DOUBLE AS a, end_::DOUBLE AS z FROM {SEGMENTS} WHERE end_ > start AND event_type IN ('purchase', 'click')), e AS (SELECT user_id, t, sum(n) AS n FROM (SELECT user_id, unnest([a, z]) AS t, unnest([1, -1]) AS n FROM s) GROUP BY user_id, t),
p AS (SELECT user_id, a, z FROM (SELECT user_id, t AS a, lead(t) OVER w AS z, sum(n) OVER w AS n FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t)) WHERE n > 1 AND z IS NOT NULL)
SELECT user_id, a AS start, z AS "end" FROM {_islands("p")}""")
def speech_at_once(spark, sf_dir):
    turns = segments(spark, sf_dir).filter("event_type in ('purchase', 'click')")
    return Z.overlapped_speech(turns.select("user_id", F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end")), ["user_id"])


@query()
def diarization_outside_zones(spark, sf_dir):
    """As diarization_error, over each user's time without zones and collars; held against a grid of instants in the tests."""
    seconds = lambda df: df.select(F.col("user_id").alias("file"), (F.col("start") / 1e6).alias("start"), (F.col("end") / 1e6).alias("end"))
    s = segments(spark, sf_dir).select(F.col("user_id").alias("file"), (F.col("start") / 1e6).alias("start"), (F.col("end") / 1e6).alias("end"), F.col("event_type").alias("speaker"))
    heard = s.withColumns({"start": F.col("start") + 20, "end": F.col("end") + 20, "speaker": F.when(F.col("speaker") == "click", "view").otherwise(F.col("speaker"))})
    return S.diarization(s, heard, "file", uem=seconds(Z.regions_without(_regions(spark, sf_dir), _zones(spark, sf_dir), ["user_id"])))


THRESHOLDS = {"onset": [0.6, 0.4], "offset": [0.3, 0.5, 0.4], "pad_onset": [0.0, 1.0], "pad_offset": [2.0], "min_duration_on": [0.0, 3.0], "min_duration_off": [0.0, 3.0], "filter_speech_first": [True, False]}


def _on_grid() -> str:
    """SQL of the same grid: states by frames, runs, pads, unions, both filters and the seconds by edges; frames of a second."""
    islands = lambda src: f"(SELECT k, user_id, min(a) AS a, max(z) AS z FROM (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY k, user_id ORDER BY a, z) AS island FROM (SELECT *, max(z) OVER (PARTITION BY k, user_id ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {src})) GROUP BY k, user_id, island)"
    filled = lambda src: f"(SELECT k, user_id, min(a) AS a, max(z) AS z FROM (SELECT *, sum(CASE WHEN reach IS NULL OR a - reach >= gap THEN 1 ELSE 0 END) OVER (PARTITION BY k, user_id ORDER BY a) AS island FROM (SELECT x.*, lag(z) OVER (PARTITION BY k, user_id ORDER BY a) AS reach, min_duration_off AS gap FROM {src} x JOIN grid USING (k))) GROUP BY k, user_id, island)"
    points = ", ".join(f"({i}, {p['onset']}, {p['offset']}, {p['pad_onset']}, {p['pad_offset']}, {p['min_duration_on']}, {p['min_duration_off']}, {p['filter_speech_first']})" for i, p in enumerate(T.parameter_grid(THRESHOLDS)))
    return f"""WITH grid(k, onset, "offset", pad_onset, pad_offset, min_duration_on, min_duration_off, filter_speech_first) AS (VALUES {points}),
f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, least(value / 100, 1) AS p, event_type FROM events),
d AS (SELECT k, user_id, i, last_value(CASE WHEN p > onset THEN 1 WHEN p < "offset" THEN 0 END IGNORE NULLS) OVER (PARTITION BY k, user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS on_ FROM f, grid WHERE onset >= "offset"),
g AS (SELECT k, user_id, greatest(min(i) - any_value(pad_onset), 0) AS a, max(i) + 1 + any_value(pad_offset) AS z FROM (SELECT *, i - row_number() OVER (PARTITION BY k, user_id ORDER BY i) AS run FROM d WHERE on_ = 1) JOIN grid USING (k) GROUP BY k, user_id, run),
u AS {islands("g")}, first_ AS (SELECT u.* FROM u JOIN grid USING (k) WHERE filter_speech_first AND z - a >= min_duration_on), last_ AS (SELECT u.* FROM u JOIN grid USING (k) WHERE NOT filter_speech_first),
segs AS (SELECT * FROM {filled("first_")} UNION ALL SELECT x.* FROM {filled("last_")} x JOIN grid USING (k) WHERE z - a >= min_duration_on),
ref AS {_islands("(SELECT user_id, i AS a, i + 2 AS z FROM f WHERE event_type IN ('view', 'click'))")}, span AS (SELECT user_id, min(a) AS lo, max(z) AS hi, sum(z - a) AS scored FROM ref GROUP BY user_id),
heard AS (SELECT k, sum(least(z, hi) - greatest(a, lo)) AS heard FROM segs JOIN span USING (user_id) WHERE a < hi AND z > lo GROUP BY k), hit AS (SELECT k, sum(least(s.z, r.z) - greatest(s.a, r.a)) AS hit FROM segs s JOIN ref r ON s.user_id = r.user_id AND s.a < r.z AND r.a < s.z GROUP BY k)
SELECT * EXCLUDE (k, heard, hit), (false_alarm + missed) / scored AS error_rate, false_alarm / scored AS false_alarm_rate, missed / scored AS missed_rate
FROM (SELECT k, onset::DOUBLE AS onset, "offset"::DOUBLE AS "offset", pad_onset::DOUBLE AS pad_onset, pad_offset::DOUBLE AS pad_offset, min_duration_on::DOUBLE AS min_duration_on, min_duration_off::DOUBLE AS min_duration_off, filter_speech_first, coalesce(heard, 0)::DOUBLE AS heard, coalesce(hit, 0)::DOUBLE AS hit, scored::DOUBLE AS scored, (coalesce(heard, 0) - coalesce(hit, 0))::DOUBLE AS false_alarm, (scored - coalesce(hit, 0))::DOUBLE AS missed
FROM grid LEFT JOIN heard USING (k) LEFT JOIN hit USING (k), (SELECT sum(scored) AS scored FROM span) WHERE onset >= "offset")"""


@query(_on_grid())
def thresholds_on_grid(spark, sf_dir):
    """Detection errors of a user's events as frames of a second, for every point of the grid whose onset isn't below the offset."""
    from pyspark.sql import Window

    events = table(spark, sf_dir, "events").select("user_id", "event_type", (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).alias("frame_idx"), F.least(F.col("value") / 100, F.lit(1.0)).alias("p"))
    spoken = events.filter("event_type in ('view', 'click')").select("user_id", F.col("frame_idx").alias("start"), (F.col("frame_idx") + 2).alias("end"))
    return T.detection_grid(events, spoken, "user_id", 1.0, THRESHOLDS).filter("onset >= offset")


@query(f"""WITH s AS (SELECT user_id, start AS a, end_ AS z FROM {SEGMENTS} WHERE end_ > start AND event_type IN ('view', 'error')), u AS (SELECT user_id, a::BIGINT AS a, z::BIGINT AS z FROM {_islands("s")}),
w AS (SELECT user_id, z, unnest(range(CASE WHEN z - a <= 9000000000 THEN 1 ELSE ceil((z - a - 9000000000) / 4000000000)::BIGINT + 1 END)) * 4000000000 + a AS a FROM u)
SELECT user_id::VARCHAR AS stream_id, 'given' AS action, a::BIGINT AS start, least(a + 9000000000, z)::BIGINT AS "end" FROM w WHERE a < z""")
def speech_windows(spark, sf_dir):
    """Windows of 9,000 s every 4,000 s over what the views and errors of a user cover; on a stream the same rows, net of those cut."""
    e = segments(spark, sf_dir).filter("event_type in ('view', 'error')")
    return online.speech_windows(e.select(F.col("user_id").cast("string").alias("stream_id"), F.timestamp_micros("start").alias("start"), F.timestamp_micros("end").alias("end")), 9_000_000_000, 4_000_000_000)


@query()
def online_speakers(spark, sf_dir):
    """Embeddings as segments of ten streams; held against the same steps without Spark in the tests, and against streams."""
    e = table(spark, sf_dir, "embeddings")
    return online.online_speakers(e.select((F.col("vec_id") % 10).cast("string").alias("stream_id"), F.floor(F.col("vec_id") / 10).alias("place"), F.col("embedding").alias("vector"), F.lit(False).alias("is_last")))


@query("""WITH f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, value FROM events), n AS (SELECT user_id, max(i) + 1 AS length FROM f GROUP BY user_id),
g AS (SELECT user_id, i, coalesce(lead(i) OVER (PARTITION BY user_id ORDER BY i), length - 1) - i - 1 AS gap FROM f JOIN n USING (user_id) WHERE value > 60), e AS (SELECT user_id, max(i) + 3 AS utterance_end FROM g WHERE gap > 4 GROUP BY user_id)
SELECT user_id, length::INT AS length, utterance_end::INT AS utterance_end FROM n LEFT JOIN e USING (user_id)""")
def utterance_ends(spark, sf_dir):
    """Events as frames, those above 60 as tokens, the last frame left out: two frames into the last gap of more than four."""
    from pyspark.sql import Window

    f = table(spark, sf_dir, "events").select("user_id", "value", (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).alias("i"))
    times = F.array_sort(F.collect_list(F.when(F.col("value") > 60, F.col("i"))))
    return f.groupBy("user_id").agg(times.alias("times"), F.count("*").cast("int").alias("length")).select("user_id", "length", streams.utterance_end(F.col("times"), F.col("length"), 4, 1).alias("utterance_end"))
