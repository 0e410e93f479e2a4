"""Queries over tables: filters, joins, segments, scores, buckets, records and turns, an operator each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import batching as B
from ..operators import conversations as C
from ..operators import dedup as D
from ..operators import filters as P
from ..operators import intervals as I
from ..operators import joins as J
from ..operators import labels as L
from ..operators import scoring as S
from ..operators import vectors as V
from .registered import query, table
from .segments import SEGMENTS, segments
from .talk import PAIRS, predictions

# filters


@query("SELECT o_orderkey FROM orders WHERE o_custkey % 5 = 0 OR o_orderstatus = 'F'")
def rows_of_status(spark, sf_dir):
    """Rows without a status pass."""
    o = table(spark, sf_dir, "orders").withColumn("status", F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderstatus")))
    return P.by_status(o, "F", "status").select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_discount FROM lineitem WHERE l_returnflag = 'N' OR l_discount <= 0.05")
def errors_at_most(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").withColumn("cer", F.when(F.col("l_returnflag") != "N", F.col("l_discount")))
    return P.at_most(l, "cer", 0.05).select("l_orderkey", "l_linenumber", "l_partkey", "l_discount")


@query("SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '[^ \\t\\n\\r]+')) BETWEEN 50 AND 500")
def tokens_between(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("input_ids", F.regexp_extract_all("text", F.lit("[^ \\t\\n\\r]+"), F.lit(0)))
    return P.by_tokens(docs, 50, 500).select("doc_id")


@query("SELECT p_partkey FROM part WHERE length(p_name) * 1.0 / length(p_type) BETWEEN 1.1 AND 1.7")
def answer_ratios(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("answer_len", F.length("p_name")).withColumn("context_len", F.length("p_type"))
    return P.by_answer_ratio(p, 1.1, 1.7).select("p_partkey")


@query("SELECT event_id FROM events WHERE value > 1 AND value < 20")
def durations_within(spark, sf_dir):
    """Both bounds left out."""
    return P.by_duration_open(table(spark, sf_dir, "events"), 1, 20, "value").select("event_id")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_discount <= 0.06 AND l_tax <= 0.05 AND l_discount / 2 <= 0.02 AND l_tax / 2 <= 0.02 AND l_discount + l_tax <= 0.07 AND l_quantity > 3 AND l_quantity < 40")
def within_quality_bounds(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").withColumns({"cer": F.col("l_discount"), "wer": F.col("l_tax"), "start_cer": F.col("l_discount") / 2, "end_cer": F.col("l_tax") / 2, "len_diff_ratio": F.col("l_discount") + F.col("l_tax"), "duration": F.col("l_quantity")})
    return P.by_quality_bounds(l, 0.06, 0.05, 0.02, 0.07, 3, 40).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT p_partkey FROM part WHERE length(p_name) + length(p_type) <= 17")
def examples_short_enough(spark, sf_dir):
    return P.without_long_examples(table(spark, sf_dir, "part"), 17, "p_name", "p_type").select("p_partkey")


@query("SELECT o_custkey, min(o_orderstatus) AS line FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderkey % 2) = 2 AND min(o_orderstatus) = max(o_orderstatus)")
def agreeing_lines(spark, sf_dir):
    """Customers whose orders have one status in each of two runs."""
    o = table(spark, sf_dir, "orders").select("o_custkey", (F.col("o_orderkey") % 2).alias("run"), F.col("o_orderstatus").alias("line"))
    return P.agreeing_everywhere(o, ["o_custkey"], "run", "line")


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD')")
def without_ignored(spark, sf_dir):
    ignored = table(spark, sf_dir, "customer").filter("c_mktsegment = 'HOUSEHOLD'").select(F.col("c_custkey").alias("o_custkey"))
    return P.without_ids(table(spark, sf_dir, "orders"), ignored, "o_custkey").select("o_orderkey")


# joins


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS text, CASE WHEN p_partkey % 3 = 0 THEN p_name END AS orig_text FROM part")
def texts_with_predictions(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("text"))
    heard = p.filter("p_partkey % 3 = 0").select("p_partkey", F.upper("text").alias("pred_text"))
    return J.with_predictions(p, heard, ["p_partkey"]).select("p_partkey", "text", "orig_text")


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def keys_standing_twice(spark, sf_dir):
    return J.duplicates(table(spark, sf_dir, "orders"), ["o_custkey"])


@query(f"SELECT event_id, start - 1704100000000000 AS start, end_ - 1704100000000000 AS \"end\" FROM {SEGMENTS} WHERE start >= 1704100000000000 AND end_ <= 1705000000000000")
def segments_within(spark, sf_dir):
    s = segments(spark, sf_dir).select("event_id", "start", "end")
    return J.within(s, 1704100000000000, 1705000000000000, rebase=True, tolerance=0)


@query(f"""WITH w AS (SELECT event_id, user_id, start FROM {SEGMENTS} WHERE event_type = 'click'), t AS (SELECT user_id, start, arg_max(event_id, (end_, event_id)) AS turn FROM {SEGMENTS} WHERE event_type = 'error' GROUP BY user_id, start),
f AS (SELECT user_id, arg_min(turn, start) AS turn FROM t GROUP BY user_id)
SELECT w.event_id, CAST(coalesce(t.turn, f.turn) AS VARCHAR) AS speaker FROM w ASOF LEFT JOIN t ON w.user_id = t.user_id AND w.start >= t.start LEFT JOIN f ON w.user_id = f.user_id""")
def words_to_turns(spark, sf_dir):
    """Clicks as words, errors as turns: each word to the last turn begun before it, else the first."""
    s = segments(spark, sf_dir)
    turns = s.filter("event_type = 'error'").select("user_id", "start", "end", F.col("event_id").cast("string").alias("speaker"))
    turns = turns.groupBy("user_id", "start").agg(F.max_by("speaker", F.struct("end", F.col("speaker").cast("long"))).alias("speaker"), F.max("end").alias("end"))
    return J.words_to_turns(s.filter("event_type = 'click'").select("event_id", "user_id", "start", "end"), turns, ["user_id"], offset=0).select("event_id", "speaker")


@query("""WITH l AS (SELECT event_id, user_id, epoch_us(ts) AS t FROM events WHERE event_type = 'error'), r AS (SELECT user_id, epoch_us(ts) AS t, max(event_id) AS id FROM events WHERE event_type = 'click' GROUP BY 1, 2),
b AS (SELECT l.*, r.id AS b, r.t AS bt FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.t >= r.t), a AS (SELECT b.*, r.id AS a, r.t AS later FROM b ASOF LEFT JOIN r ON b.user_id = r.user_id AND b.t <= r.t)
SELECT event_id, CASE WHEN b IS NOT NULL AND (a IS NULL OR t - bt <= later - t) THEN b ELSE a END AS click FROM a""")
def nearest_rows(spark, sf_dir):
    """Each error with the user's nearest click, the earlier one at ties."""
    s = segments(spark, sf_dir)
    clicks = s.filter("event_type = 'click'").groupBy("user_id", "start").agg(F.max("event_id").alias("click"))
    return J.nearest(s.filter("event_type = 'error'").select("event_id", "user_id", "start"), clicks, ["user_id"], "start", "click").select("event_id", "click")


@query("SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN lower(p_type) ELSE p_type END AS entry FROM part")
def lexicon_entries(spark, sf_dir):
    """Types through a lexicon of two words, and one with two entries that stays as it is."""
    lexicon = spark.createDataFrame([("ECONOMY", "economy"), ("PROMO", "promo"), ("STANDARD", "a"), ("STANDARD", "b")], "p_type string, entry string")
    return J.looked_up(table(spark, sf_dir, "part"), lexicon, "p_type", "entry").select("p_partkey", "entry")


# segments


@query(f"""WITH s AS (SELECT user_id, CAST(start - 1704067200000000 AS DOUBLE) AS a, CAST(end_ - 1704067200000000 AS DOUBLE) AS z FROM {SEGMENTS}), b AS (SELECT user_id, coalesce(lag(z) OVER (PARTITION BY user_id ORDER BY a, z), 0.0) AS start, a AS "end" FROM s)
SELECT * FROM b WHERE start < "end" UNION ALL SELECT user_id, max(z), 1e13 FROM s GROUP BY user_id HAVING max(z) < 1e13""")
def silence(spark, sf_dir):
    """The gap before each segment of a user and after the last."""
    s = segments(spark, sf_dir).select("user_id", (F.col("start") - 1704067200000000).cast("double").alias("start"), (F.col("end") - 1704067200000000).cast("double").alias("end"), F.lit(1e13).alias("total"))
    return I.nonspeech(s, ["user_id"], "total").filter("start < end")


@query("""WITH s AS (SELECT event_id % 7 AS k, event_id AS a, event_id + 7 * (event_id % 3) AS z, CASE WHEN event_id % 11 < 6 THEN 'a' ELSE 'b' END AS speaker FROM events),
m AS (SELECT *, CASE WHEN lag(speaker) OVER w = speaker AND lag(z) OVER w = a THEN 0 ELSE 1 END AS new FROM s WINDOW w AS (PARTITION BY k ORDER BY a, z)), r AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY a, z) AS run FROM m)
SELECT k, min(a) AS start, max(z) AS "end", min(speaker) AS speaker FROM r GROUP BY k, run""")
def joined_stamps(spark, sf_dir):
    """Neighbours of one speaker that touch become one segment."""
    e, n = table(spark, sf_dir, "events"), F.col("event_id")
    s = e.select((n % 7).alias("k"), n.alias("start"), (n + 7 * (n % 3)).alias("end"), F.when(n % 11 < 6, "a").otherwise("b").alias("speaker"))
    return I.joined_stamps(s, ["k"])


@query(f"SELECT user_id, start, end_ AS \"end\" FROM {SEGMENTS} WHERE event_type <> 'error'")
def segments_without(spark, sf_dir):
    s = segments(spark, sf_dir)
    return I.without(s.select("user_id", "start", "end"), s.filter("event_type = 'error'").select("user_id", "start", "end"), ["user_id"])


@query(f"SELECT user_id, start, least(end_, last) AS \"end\" FROM (SELECT *, max(end_) FILTER (WHERE event_type = 'click') OVER (PARTITION BY user_id) AS last FROM {SEGMENTS}) WHERE start < last AND event_type <> 'click'")
def reference_so_far(spark, sf_dir):
    """The reference up to the last end of what was heard."""
    s = segments(spark, sf_dir)
    return L.truncated(s.filter("event_type != 'click'").select("user_id", "start", "end"), s.filter("event_type = 'click'").select("user_id", "end"), ["user_id"])


@query("SELECT user_id, f AS frame_idx, round(avg(p), 9) AS p FROM (SELECT user_id, event_id % 50 + i AS f, CASE i WHEN 0 THEN value WHEN 1 THEN value / 2 ELSE value / 4 END AS p FROM events, (SELECT unnest([0, 1, 2]) AS i)) GROUP BY user_id, f")
def smoothed_frames(spark, sf_dir):
    """Overlapping windows of three frames, averaged."""
    windows = table(spark, sf_dir, "events").select("user_id", (F.col("event_id") % 50).alias("start_frame"), F.array(F.col("value"), F.col("value") / 2, F.col("value") / 4).alias("probs"))
    return I.smoothed(windows, ["user_id"]).withColumn("p", F.round("p", 9))


@query("SELECT user_id, round(min(value) + 0.8 * (max(value) - min(value)), 9) AS onset, round(min(value) + 0.3 * (max(value) - min(value)), 9) AS \"offset\" FROM events GROUP BY user_id")
def scaled_thresholds(spark, sf_dir):
    frames = table(spark, sf_dir, "events").withColumn("p", F.col("value"))
    return I.scaled_thresholds(frames, ["user_id"], 0.8, 0.3, "relative").select("user_id", F.round("onset", 9).alias("onset"), F.round("offset", 9).alias("offset"))


@query("SELECT event_type, quantile_disc(value, 0.1) AS p10, quantile_disc(value, 0.99) AS p99 FROM events GROUP BY event_type")
def nearest_ranks(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(I.nearest_rank("value", 10).alias("p10"), I.nearest_rank("value", 99).alias("p99"))


@query("""WITH r AS (SELECT *, event_id - row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS run FROM events) SELECT event_type AS file, min(event_id) AS first, string_agg('w' || event_id, ' ' ORDER BY event_id) AS text, count(*) AS n FROM r GROUP BY event_type, run""")
def stitched_texts(spark, sf_dir):
    """Texts of consecutive rows of one file, joined."""
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("file"), F.col("event_id").alias("place"), F.concat(F.lit("w"), F.col("event_id").cast("string")).alias("text"), F.col("value").alias("start"), F.col("value").alias("end"))
    return I.stitched(e, "file", "place", "text").select("file", "first", "text", F.size("segments").cast("long").alias("n"))


@query("SELECT user_id AS session_id, event_type AS speaker, string_agg('w' || event_id, ' ' ORDER BY ts, event_id) AS text FROM events GROUP BY GROUPING SETS ((user_id, event_type), (user_id))")
def speaker_transcripts(spark, sf_dir):
    """A transcript for each speaker of a session, and one of all."""
    s = segments(spark, sf_dir).select(F.col("user_id").alias("session_id"), F.col("event_type").alias("speaker"), "start", F.col("event_id").alias("end"), F.concat(F.lit("w"), F.col("event_id").cast("string")).alias("word"))
    return I.speaker_transcripts(s)


@query("""WITH t AS (SELECT p_partkey, i, CASE WHEN i % 3 = 1 OR i = 1 THEN 1 ELSE 0 END AS new, c FROM (SELECT p_partkey, unnest(string_split(replace(p_name, ' ', ''), '')) AS c, generate_subscripts(string_split(replace(p_name, ' ', ''), ''), 1) AS i FROM part)),
w AS (SELECT *, sum(new) OVER (PARTITION BY p_partkey ORDER BY i) AS word_id FROM t) SELECT p_partkey, CAST(word_id AS BIGINT) AS word_id, round(min(i) * 0.08, 2) AS start, round((max(i) + 1) * 0.08, 2) AS "end", string_agg(c, '' ORDER BY i) AS word FROM w GROUP BY p_partkey, word_id""")
def words_of_tokens(spark, sf_dir):
    """Letters as tokens, every third one starting a word; frame offsets as seconds."""
    letters = table(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.filter(F.split(F.replace("p_name", F.lit(" "), F.lit("")), ""), lambda c: c != "")).alias("i", "c"))
    tokens = letters.select("p_partkey", F.col("i").alias("place"), (F.col("i") + 1).alias("start"), (F.col("i") + 2).alias("end"), F.when(F.col("i") % 3 == 0, F.concat(F.lit("▁"), "c")).otherwise(F.col("c")).alias("token"))
    return I.in_seconds(I.words_of_tokens(tokens, ["p_partkey"]), 8, 0.01, "start", "end")


@query("""WITH s AS (SELECT l_orderkey AS k, sum(l_quantity) AS silence, sum(l_tax) AS overlap, sum(l_discount) + 1 AS speech, sum(l_quantity) + 100 AS total FROM lineitem GROUP BY 1)
SELECT round(sum(silence) / sum(total), 9) AS silence_mean, round(var_pop(silence / total), 9) AS silence_var, round(sum(overlap) / sum(speech), 9) AS overlap_mean, round(var_pop(overlap / speech), 9) AS overlap_var FROM s""")
def multispeaker_stats(spark, sf_dir):
    s = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("silence"), F.sum("l_tax").alias("overlap"), (F.sum("l_discount") + 1).alias("speech"), (F.sum("l_quantity") + 100).alias("total"))
    return L.multispeaker_stats(s).select(*(F.round(c, 9).alias(c) for c in ("silence_mean", "silence_var", "overlap_mean", "overlap_var")))


@query("SELECT event_id, start, least(\"end\", upto) AS \"end\", upto FROM (SELECT event_id, CAST(event_id % 90 AS DOUBLE) AS start, CAST(event_id % 90 + 25 AS DOUBLE) AS \"end\", CAST(unnest(generate_series(event_id % 90 // 20 + 1, 5)) * 20 AS DOUBLE) AS upto FROM events)")
def seen_by_chunk(spark, sf_dir):
    """Segments as an online score has seen them at each chunk's end."""
    s = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 90).cast("double").alias("start"), (F.col("event_id") % 90 + 25).cast("double").alias("end"))
    return L.chunk_by_chunk(s, ["event_id"], 20, 100)


@query("""WITH f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, CAST(event_type = 'click' AS INTEGER) AS y FROM events)
SELECT user_id, CAST(i // 4 AS BIGINT) AS cell, CAST(CASE WHEN avg(y) >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS on_ FROM f GROUP BY user_id, i // 4""")
def soft_masks(spark, sf_dir):
    """Frame labels by the mean of each stride of four."""
    frames = table(spark, sf_dir, "events").groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", (F.col("event_type") == "click").cast("int").alias("y")))), lambda x: x["y"]).alias("labels"))
    return frames.select("user_id", F.posexplode(L.soft_mask(F.col("labels"), 4)).alias("cell", "on_")).select("user_id", F.col("cell").cast("long").alias("cell"), F.col("on_").cast("long").alias("on_"))


@query("""WITH f AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events), o AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY min(i)) - 1 AS speaker FROM f GROUP BY user_id, event_type)
SELECT user_id, CAST(i AS BIGINT) AS place, CAST(speaker AS BIGINT) AS speaker FROM f JOIN o USING (user_id, event_type)""")
def speakers_by_appearance(spark, sf_dir):
    said = table(spark, sf_dir, "events").groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda x: x["event_type"]).alias("labels"))
    return said.select("user_id", F.posexplode(L.relative_speakers(F.col("labels"))).alias("place", "speaker")).select("user_id", F.col("place").cast("long").alias("place"), F.col("speaker").cast("long").alias("speaker"))


# scores


@query(f"SELECT p_partkey, round(2.0 * len(list_intersect(string_split(text, ' '), string_split(pred_text, ' '))) / (len(string_split(text, ' ')) + len(list_filter(string_split(pred_text, ' '), lambda w: w <> ''))), 9) AS f1 FROM {PAIRS}")
def token_f1(spark, sf_dir):
    """Names have two different words, so that sets do for the SQL."""
    return predictions(spark, sf_dir).select("p_partkey", F.round(S.token_f1(F.array("text"), F.col("pred_text")), 9).alias("f1"))


@query("SELECT p_partkey, CAST(CASE WHEN p_size % 4 IN ((p_partkey + 3) % 4, (p_partkey + 2) % 4) THEN 1 ELSE 0 END AS BIGINT) AS hit FROM part")
def top_two_hits(spark, sf_dir):
    """Scores that fall from the label before the key's, modulo four, downwards."""
    score = lambda j: F.lit(10) - F.pmod(F.col("p_partkey") + 3 - j, F.lit(4))
    return table(spark, sf_dir, "part").select("p_partkey", S.top_k_hits(F.array(*(score(j) for j in range(4))), (F.col("p_size") % 4).cast("int"), 2).cast("long").alias("hit"))


@query("SELECT round(avg(exp(-(p * ln(p) + (1 - p) * ln(1 - p)))), 9) AS perplexity FROM (SELECT (1 + p_size % 9) / 10.0 AS p FROM part)")
def perplexity(spark, sf_dir):
    p = (1 + F.col("p_size") % 9) / 10
    return table(spark, sf_dir, "part").agg(F.round(S.mean_perplexity(F.array(p, 1 - p)), 9).alias("perplexity"))


@query("""WITH c AS (SELECT count(*) FILTER (WHERE p AND t) AS tp, count(*) FILTER (WHERE p AND NOT t) AS fp, count(*) FILTER (WHERE NOT p AND t) AS fn FROM (SELECT unnest([p_size % 3 = 0, p_size % 5 < 2]) AS p, unnest([p_size % 2 = 0, p_size % 5 = 0]) AS t FROM part))
SELECT round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall, round(2 * tp / (2 * tp + fp + fn), 9) AS f1 FROM c""")
def binary_scores(spark, sf_dir):
    n = F.col("p_size")
    df = table(spark, sf_dir, "part").select(F.array((n % 3 == 0).cast("double"), (n % 5 < 2).cast("double")).alias("predicted"), F.array((n % 2 == 0).cast("double"), (n % 5 == 0).cast("double")).alias("target"))
    return S.binary_scores(df, "predicted", "target").select(*(F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")))


@query("SELECT p_partkey, CASE WHEN abs(p_size % 6 - p_size % 4) <= 1 THEN 1.0 ELSE 0.0 END AS share FROM part")
def tokens_within_tolerance(spark, sf_dir):
    """One token of a target, found within one place of it in a prediction or not."""
    at = lambda m: F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: (i == F.col("p_size") % m).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", S.within_tolerance(at(6), at(4), F.lit(1), 1).cast("double").alias("share"))


@query("""SELECT p_partkey, round((greatest(p, 1 - p) * 2 - 1), 9) AS top, round(1 + (p * ln(p) + (1 - p) * ln(1 - p)) / ln(2), 9) AS gibbs, round(1 - (1 - (p * p + (1 - p) * (1 - p))) / (1 - 0.5), 9) AS tsallis, round(1 + ln(p * p + (1 - p) * (1 - p)) / ln(2), 9) AS renyi,
round((p + (1 - p)) / 2, 9) AS mean, round(least(p, 1 - p), 9) AS least, round(p * (1 - p), 9) AS product FROM (SELECT p_partkey, (1 + p_size % 9) / 10.0 AS p FROM part)""")
def confidences(spark, sf_dir):
    """Confidence measures of distributions over two, and aggregates of their values."""
    p = (1 + F.col("p_size") % 9) / 10
    d = table(spark, sf_dir, "part").select("p_partkey", F.array(p, 1 - p).alias("p"))
    x = F.col("p")
    out = {"top": S.confidence(x), "gibbs": S.confidence(x, "gibbs"), "tsallis": S.confidence(x, "tsallis", 2.0), "renyi": S.confidence(x, "renyi", 2.0)}
    out |= {"mean": S.aggregated_confidence(x), "least": S.aggregated_confidence(x, "min"), "product": S.aggregated_confidence(x, "prod")}
    return d.select("p_partkey", *(F.round(v, 9).alias(k) for k, v in out.items()))


@query("""SELECT round(quantile_cont(value, 0.5), 6) AS latency_p50, round(quantile_cont(value, 0.9), 6) AS latency_p90, round(quantile_cont(value, 0.95), 6) AS latency_p95,
round(quantile_cont(early, 0.5), 6) AS early_p50, round(quantile_cont(early, 0.9), 6) AS early_p90, round(quantile_cont(early, 0.95), 6) AS early_p95, round(avg(CASE WHEN early IS NULL THEN 0 ELSE 1 END), 9) AS early_rate, round(avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END), 9) AS miss_rate
FROM (SELECT *, CASE WHEN event_id % 4 = 0 THEN value / 2 END AS early FROM events)""")
def end_of_utterance_summary(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("value").alias("latency"), F.when(F.col("event_id") % 4 == 0, F.col("value") / 2).alias("early_cutoff"), (F.col("event_type") == "error").alias("missed"))
    out = S.end_of_utterance_summary(e)
    return out.select(*(F.round(c, 9 if c.endswith("rate") else 6).alias(c) for c in out.columns))


@query(f"SELECT w AS word, count(*) AS n, round(avg(CASE WHEN list_contains(string_split(pred_text, ' '), w) THEN 1 ELSE 0 END), 9) AS accuracy FROM (SELECT unnest(string_split(text, ' ')) AS w, pred_text FROM {PAIRS}) GROUP BY w")
def word_accuracy(spark, sf_dir):
    return S.word_accuracy(predictions(spark, sf_dir).withColumnRenamed("p_partkey", "row_id")).withColumn("accuracy", F.round("accuracy", 9)).select("word", "n", "accuracy")


@query("""WITH c AS (SELECT l_orderkey AS k, l_quantity AS a, l_discount * 100 AS b, CAST(l_linenumber AS BIGINT) AS e FROM lineitem), r AS (SELECT w, k, arg_max(e, (round(a + w * b, 6), -e)) AS e FROM c, (SELECT unnest([0.0, 0.5, 2.0]) AS w) GROUP BY w, k)
SELECT CAST(w AS DOUBLE) AS weight, CAST(sum(e) AS BIGINT) AS errors FROM r GROUP BY w""")
def searched_weights(spark, sf_dir):
    """Errors of the best candidates under each weight of a second score."""
    c = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_quantity").alias("score"), F.round(F.col("l_discount") * 100, 6).alias("other_score"), F.col("l_linenumber").cast("long").alias("errors"))
    return S.searched_weight(c, "k", [0.0, 0.5, 2.0])


# buckets and batches


@query("SELECT p_partkey, CASE WHEN p_size <= 10 AND length(p_name) <= 9 THEN 0 WHEN p_size <= 10 AND length(p_name) <= 20 THEN 1 WHEN p_size > 10 AND p_size <= 40 AND length(p_name) <= 11 THEN 2 END AS bucket FROM part")
def buckets_in_two_dimensions(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", B.smallest_bucket_2d(F.col("p_size"), F.length("p_name"), [(10, 9), (10, 20), (40, 11)]).alias("bucket"))


@query("SELECT doc_id, CASE WHEN n_chars <= 300 THEN 0 ELSE 1 END AS bucket FROM documents WHERE n_chars > 50 AND n_chars <= 2000")
def length_buckets(spark, sf_dir):
    return B.length_buckets(table(spark, sf_dir, "documents"), "n_chars", [50, 300, 2000]).select("doc_id", "bucket")


@query("SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS turn, CASE lang WHEN 'en' THEN 0 ELSE 1 END AS source_index FROM documents WHERE lang IN ('en', 'de')")
def sources_in_turn(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    out = B.round_robin([d.filter(F.col("lang") == g) for g in ("en", "de")], "doc_id")
    return out.select("doc_id", F.col("turn").cast("long").alias("turn"), "source_index")


@query("SELECT count(*) AS n, count(*) AS places, CAST(0 AS BIGINT) AS least, count(*) - 1 AS most FROM (SELECT o_orderkey FROM orders WHERE o_orderkey < 1000)")
def permuted_range(spark, sf_dir):
    """Every place of a range is taken once."""
    o = table(spark, sf_dir, "orders").filter("o_orderkey < 1000").select(B.permuted(F.col("o_orderkey"), 1000).alias("p"))
    return o.agg(F.count("*").alias("n"), F.count_distinct("p").alias("places"), F.min("p").alias("least"), F.max("p").alias("most"))


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS packed, CAST(sum(n_chars) AS BIGINT) AS chars, true AS fits FROM documents")
def packs_hold_everything(spark, sf_dir):
    """Every document is in one pack, and only documents longer than a pack overfill one."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    packs = B.packed(d, "doc_id", "n_chars", 20000).join(d, "doc_id")
    filled = packs.groupBy("slot", "pack").agg(F.sum("n_chars").alias("chars"), F.count("*").alias("n"))
    return filled.agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.bool_and((F.col("chars") <= 20000) | (F.col("n") == 1)).alias("fits")).select("n", F.lit(packs.select("doc_id").distinct().count()).cast("long").alias("packed"), "chars", "fits")


# records


@query("SELECT min(l_orderkey) AS l_orderkey, l_returnflag, l_linestatus, l_linenumber FROM lineitem GROUP BY l_returnflag, l_linestatus, l_linenumber")
def distinct_rows(spark, sf_dir):
    return D.distinct_rows(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_linenumber"), "l_orderkey")


@query("SELECT p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_name, p_type, p_brand ORDER BY p_partkey) AS r FROM part) WHERE r > 1")
def repeated_rows(spark, sf_dir):
    return D.repeated(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand"), "p_partkey")


@query("""WITH e AS (SELECT DISTINCT p_name, p_type FROM part), l AS (SELECT p_name, p_type FROM part GROUP BY 1, 2 HAVING count(DISTINCT p_size % 3) > 1), w AS (SELECT sum(CASE p_type WHEN 'ECONOMY' THEN 2.0 WHEN 'PROMO' THEN 0.5 ELSE 1.0 END) AS w FROM e)
SELECT round(sum(CASE p_type WHEN 'ECONOMY' THEN 2.0 WHEN 'PROMO' THEN 0.5 ELSE 1.0 END) / (SELECT w FROM w), 9) AS ratio FROM l""")
def weighted_leakage(spark, sf_dir):
    """Names by type that stand in more than one of three splits, weighted by type."""
    p = table(spark, sf_dir, "part").select("p_name", "p_type", (F.col("p_size") % 3).cast("string").alias("split"), F.concat_ws("|", "p_name", "p_type").alias("entity"))
    leaked = D.leakage(p, "entity").join(p.select("entity", "p_type").distinct(), "entity")
    return D.weighted_leakage(leaked, p.select("entity", "p_type").distinct(), "p_type", {"ECONOMY": 2.0, "PROMO": 0.5}).withColumn("ratio", F.round("ratio", 9))


@query("SELECT p_type, count(DISTINCT lower(p_name)) AS entities FROM part GROUP BY p_type")
def entity_coverage(spark, sf_dir):
    return D.entity_coverage(table(spark, sf_dir, "part"), "p_type", T.lower_key(F.upper("p_name")))


@query("SELECT p_partkey, 0 AS place, p_name AS text FROM part UNION ALL SELECT p_partkey, 1, p_type FROM part WHERE p_size % 2 = 0 UNION ALL SELECT p_partkey, 2, p_brand FROM part WHERE p_size % 2 = 0")
def alternatives_flattened(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("text"), F.when(F.col("p_size") % 2 == 0, F.array("p_type", "p_brand")).alias("others"))
    return D.alternatives_flattened(p, "text", "others")


@query("SELECT round(avg(CASE WHEN n >= 18 THEN 1 ELSE 0 END), 9) AS long, round(avg(CASE WHEN n % 5 >= 3 THEN 1 ELSE 0 END), 9) AS entity_heavy, round(avg(CASE WHEN lang = 'de' THEN 1 ELSE 0 END), 9) AS long_tail FROM (SELECT lang, len(regexp_extract_all(text, '[^ \\t\\n\\r]+')) AS n FROM documents)")
def difficulty_shares(spark, sf_dir):
    n = F.size(F.regexp_extract_all("text", F.lit("[^ \\t\\n\\r]+"), F.lit(0)))
    return D.difficulty_shares(table(spark, sf_dir, "documents"), n, n % 5, F.col("lang") == "de").select(*(F.round(c, 9).alias(c) for c in ("long", "entity_heavy", "long_tail")))


# conversations


@query("SELECT conv_id, turn, CASE lower(role) WHEN 'user' THEN 'agent' WHEN 'assistant' THEN 'user' ELSE role END AS role, text FROM conversations")
def swapped_roles(spark, sf_dir):
    out = C.spread(C.swapped_roles(C.gathered(table(spark, sf_dir, "conversations"))))
    return out.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.col("value").alias("text"))


@query("SELECT conv_id, false AS has_audio, true AS has_text, CAST(count(*) AS BIGINT) AS n_turns, 'web' AS domain FROM conversations GROUP BY conv_id")
def flagged_conversations(spark, sf_dir):
    out = C.with_tags(C.flagged(C.gathered(table(spark, sf_dir, "conversations"))), {"domain": "web"})
    return out.select("conv_id", "has_audio", "has_text", F.col("n_turns").cast("long").alias("n_turns"), "domain")


@query("SELECT p_partkey, CAST(ceil(p_size / 8.0) - 1 AS BIGINT) AS context, CAST(ceil(p_retailprice / 800) - 1 AS BIGINT) AS answer FROM part")
def audio_tokens(spark, sf_dir):
    """Tokens of an audio question and an audio answer, by their seconds."""
    turn = lambda role, seconds: F.struct(F.lit(role).alias("role"), F.lit("audio").alias("type"), F.lit("x").alias("value"), seconds.cast("double").alias("duration"), F.lit(0.0).alias("offset"))
    p = table(spark, sf_dir, "part").select("p_partkey", F.array(turn("user", F.col("p_size")), turn("assistant", F.col("p_retailprice") / 100)).alias("turns"))
    return p.select("p_partkey", C.audio_tokens(F.col("turns"), 8.0, "context").cast("long").alias("context"), C.audio_tokens(F.col("turns"), 8.0, "answer").cast("long").alias("answer"))


@query("""WITH s AS (SELECT user_id, event_id + CASE WHEN event_type = 'click' THEN 3 ELSE 0 END AS t, CASE WHEN event_type = 'click' THEN 'agent' ELSE 'user' END AS speaker, event_id FROM events), f AS (SELECT user_id, arg_min(speaker, (t, speaker, event_id)) AS first FROM s GROUP BY user_id)
SELECT user_id, string_agg(event_id, ' ' ORDER BY t, speaker, event_id) AS ids FROM s JOIN f USING (user_id) WHERE first = 'user' GROUP BY user_id""")
def duplex_streams(spark, sf_dir):
    """Segments of agent and user in order, the agent's three units later; streams that the agent starts go."""
    s = table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type") == "click", "agent").otherwise("user").alias("speaker"), F.col("event_id").cast("double").alias("start"), "event_id")
    return C.duplex(s, "user_id", 3.0, True).select("user_id", F.array_join(F.transform("segments", lambda x: x["event_id"].cast("string")), " ").alias("ids"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url ELSE '/base/' || page_id || '.html' END AS path, CASE WHEN page_id % 2 = 0 THEN 'left' ELSE 'right' END AS channel FROM pages")
def resolved_paths(spark, sf_dir):
    path = F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(F.concat(F.col("page_id").cast("string"), F.lit(".html")))
    return table(spark, sf_dir, "pages").select("page_id", C.resolved(path, "/base/").alias("path"), C.channel(F.array(F.lit("left"), F.lit("right")), (F.col("page_id") % 2).cast("int")).alias("channel"))


@query("SELECT p_partkey, 'user: ' || p_name || ' assistant: ' || p_type AS said FROM part")
def question_answer_turns(spark, sf_dir):
    out = C.from_question_answer(table(spark, sf_dir, "part"), "p_name", "p_type")
    return out.select("p_partkey", F.array_join(F.transform("turns", lambda t: F.concat_ws(": ", t["role"], t["value"])), " ").alias("said"))


@query("SELECT doc_id, '<|' || lang || '|>' AS source_lang, CASE WHEN doc_id % 2 = 0 THEN '<|transcribe|>' ELSE '<|translate|>' END AS taskname, CASE doc_id % 3 WHEN 0 THEN '<|pnc|>' WHEN 1 THEN '<|nopnc|>' END AS pnc FROM documents")
def manifest_special_tokens(spark, sf_dir):
    n = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("source_lang"), F.when(n % 2 == 0, "asr").otherwise("ast").alias("taskname"), F.when(n % 3 == 0, "yes").when(n % 3 == 1, "no").alias("pnc"))
    return C.special_tokens(d, ["source_lang"])


@query("SELECT p_partkey, array_to_string(list_concat(string_split(p_name, ' '), string_split(p_type, ' ')), ' ') AS ids, CAST(len(string_split(p_type, ' ')) AS BIGINT) AS n_masked FROM part")
def masked_answers(spark, sf_dir):
    out = table(spark, sf_dir, "part").select("p_partkey", C.masked_ids(F.split("p_name", " "), F.split("p_type", " ")).alias("m"))
    return out.select("p_partkey", F.array_join("m.input_ids", " ").alias("ids"), F.size(F.filter("m.mask", lambda x: x)).cast("long").alias("n_masked"))


# vectors


@query("SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def cosines_of_neighbours(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    following = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(following, "vec_id").select("vec_id", F.round(V.cosine(F.col("embedding"), F.col("other")), 6).alias("similarity"))


@query("SELECT event_id, round((value - (SELECT min(value) FROM events)) / (SELECT max(value) - min(value) FROM events), 9) AS value FROM events")
def scaled_values(spark, sf_dir):
    return V.scaled_min_max(table(spark, sf_dir, "events").select("event_id", "value"), "value").withColumn("value", F.round("value", 9))


# what a table holds


@query("SELECT true AS in_any, false AS in_all UNION ALL SELECT true, true UNION ALL SELECT false, false")
def fields_of_rows(spark, sf_dir):
    """A field of some rows, of all and of none."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.lit(1)).alias("some"), F.lit(None).cast("int").alias("none"))
    return J.field_presence(o, "some").unionByName(J.field_presence(o, "o_orderkey")).unionByName(J.field_presence(o, "none"))


@query("SELECT l_returnflag, count(*) AS examples, round(sum(l_quantity) / 3600.0, 6) AS hours FROM lineitem GROUP BY l_returnflag")
def hours_by_dataset(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").cast("double").alias("duration"))
    return S.rows_and_hours(l, ["l_returnflag"]).withColumn("hours", F.round("hours", 6))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderstatus, o_orderpriority")
def kinds_of_splits(spark, sf_dir):
    return S.kinds_by_split(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query("SELECT p_type, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM part), 0) AS percent FROM part WHERE (SELECT count(DISTINCT p_type) < count(*) / 3.0 FROM part) GROUP BY p_type ORDER BY n DESC, p_type LIMIT 5")
def commonest_answers(spark, sf_dir):
    """A top-5 report."""
    return S.common_answers(table(spark, sf_dir, "part").select("p_type"), "p_type")
