"""Queries that write a table in one of the formats and read it back: what comes out is held against SQL on the table."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import checkpointed
from ..sources import cuts
from ..sources import manifests as M
from ..sources import ranges
from ..sources import sinks as K
from .registered import query, scratch, table
from .segments import SEGMENTS, segments


@query("SELECT doc_id, text, lang FROM documents WHERE doc_id % 10 <> 0")
def manifest_rows(spark, sf_dir):
    """JSONL with other names for text and language; rows marked to be skipped go."""
    to = scratch(spark, "manifest")
    docs = table(spark, sf_dir, "documents")
    K.jsonl(docs.select("doc_id", F.col("text").alias("said"), F.col("lang").alias("tongue"), (F.col("doc_id") % 10 == 0).alias("_skipme")), to)
    return M.read(spark, {"manifest_filepath": to, "text_field": "said", "lang_field": "tongue"}).select("doc_id", "text", "lang")


@query("SELECT item_id, text FROM benchmark")
def ascii_manifest_rows(spark, sf_dir):
    """All but ASCII escaped on the way out, the same text on the way in."""
    to = scratch(spark, "ascii")
    K.jsonl(table(spark, sf_dir, "benchmark"), to, ascii_only=True)
    return M.manifest(spark, to).select("item_id", "text")


@query("SELECT o_orderkey, o_orderpriority AS audio_file, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS text, CAST(0.0 AS DOUBLE) AS \"offset\", o_totalprice AS duration FROM orders")
def aliased_fields(spark, sf_dir):
    to = scratch(spark, "aliased")
    o = table(spark, sf_dir, "orders")
    K.jsonl(o.select("o_orderkey", F.col("o_orderpriority").alias("audio_filepath"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("normalized_text"), F.col("o_totalprice").alias("duration")), to)
    return M.aliased(M.manifest(spark, to)).select("o_orderkey", "audio_file", "text", F.col("offset").cast("double").alias("offset"), "duration")


@query("SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE '/data/set/' || page_id || '.wav' END AS path FROM pages")
def full_paths(spark, sf_dir):
    path = F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.concat(F.col("page_id").cast("string"), F.lit(".wav")))
    return table(spark, sf_dir, "pages").select("page_id", M.full_path(path, "/data/set/").alias("path"))


@query("SELECT CAST(doc_id AS VARCHAR) AS id, text, lang, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes FROM documents")
def parquet_rows(spark, sf_dir):
    """Parquet manifest with audio as struct(bytes, path) and fields under other names."""
    to = scratch(spark, "parquet")
    docs = table(spark, sf_dir, "documents")
    docs.select("doc_id", F.col("text").alias("said"), "lang", F.struct(F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("bytes"), F.lit("x.wav").alias("path")).alias("sound")).write.parquet(to)
    return M.read(spark, {"type": "parquet", "manifest_filepath": to, "id_field": "doc_id", "audio_field": "sound", "text_field": "said"}).select("id", "text", "lang", F.length("audio").cast("long").alias("n_bytes"))


@query("SELECT p_name AS text, 'en' AS language FROM part")
def text_lines(spark, sf_dir):
    to = scratch(spark, "lines")
    table(spark, sf_dir, "part").select(F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("value")).write.text(to)
    return M.read(spark, {"type": "text", "paths": to, "language": "en", "strip": True}).select("text", "language")


@query("SELECT text, 'de' AS language FROM documents WHERE doc_id % 7 <> 0 AND text IS NOT NULL")
def text_jsonl_rows(spark, sf_dir):
    """Rows without the text field go."""
    to = scratch(spark, "texts")
    K.jsonl(table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 7 != 0, F.col("text")).alias("body")), to)
    return M.read(spark, {"type": "text_jsonl", "paths": to, "text_field": "body", "language": "de"})


@query("""SELECT CAST(0 AS BIGINT) AS shard, CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS BIGINT) AS line, p_name AS source, p_type AS target, 'en' AS source_language, 'x' AS target_language FROM part WHERE p_partkey < 1500""")
def text_pair_rows(spark, sf_dir):
    """Two files aligned by line; the longer one's tail goes."""
    p = table(spark, sf_dir, "part")
    a, b = scratch(spark, "source"), scratch(spark, "target")
    p.orderBy("p_partkey").coalesce(1).select("p_name").write.text(a)
    p.filter("p_partkey < 1500").orderBy("p_partkey").coalesce(1).select(F.concat("p_type", F.lit(" ")).alias("value")).write.text(b)
    out = M.text_pairs(spark, a, b, source_language="en", target_language="x")
    return out.withColumn("shard", F.col("shard").cast("long")).withColumn("line", F.col("line").cast("long"))


CHAT = """SELECT CAST(conv_id AS VARCHAR) AS id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS BIGINT) AS place,
CASE lower(role) WHEN 'user' THEN 'user' WHEN 'system' THEN 'system' ELSE 'assistant' END AS role, text AS value FROM conversations"""


def written_chats(spark, sf_dir) -> str:
    to = scratch(spark, "chat")
    rows = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    said = F.transform("t", lambda x: F.struct(x["text"].alias("value"), F.when(x["role"] == "user", "Human").otherwise(x["role"]).alias("from")))
    K.jsonl(table(spark, sf_dir, "conversations").groupBy("conv_id").agg(rows.alias("t")).select(F.col("conv_id").cast("string").alias("id"), said.alias("conversations")), to)
    return to


@query(CHAT)
def chat_jsonl_turns(spark, sf_dir):
    chats = M.read(spark, {"type": "chat_jsonl", "paths": written_chats(spark, sf_dir)})
    return chats.select("id", F.posexplode("turns").alias("place", "t")).select("id", F.col("place").cast("long").alias("place"), "t.role", "t.value")


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, kind AS type, CASE kind WHEN 'audio' THEN '<audio>' WHEN 'text' THEN w END AS value FROM (SELECT p_partkey, p_type, unnest(['text', 'audio', 'text']) AS kind, unnest([p_name, '', p_type]) AS w FROM part WHERE p_partkey % 2 = 0) UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'text', p_name FROM part WHERE p_partkey % 2 = 1")
def placeholder_pieces(spark, sf_dir):
    """Texts cut at the place where audio stands."""
    to = scratch(spark, "placeholder")
    value = F.when(F.col("p_partkey") % 2 == 0, F.concat_ws(" <audio> ", "p_name", "p_type")).otherwise(F.col("p_name"))
    K.jsonl(table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.array(F.struct(value.alias("value"), F.lit("human").alias("from"))).alias("conversations")), to)
    return M.read(spark, {"type": "placeholder_chat", "paths": to}).select("id", "type", "value")


@query("SELECT doc_id, lang, 'web' AS domain, CASE WHEN lang = 'en' THEN 0.75 ELSE 0.25 END AS weight FROM documents WHERE lang IN ('en', 'de')")
def mixture_rows(spark, sf_dir):
    """Two weighted sources under one input configuration, tagged."""
    entries = []
    for lang, weight in (("en", 3.0), ("de", 1.0)):
        to = scratch(spark, f"mixture-{lang}")
        K.jsonl(table(spark, sf_dir, "documents").filter(F.col("lang") == lang).select("doc_id", "lang"), to)
        entries.append({"manifest_filepath": to, "weight": weight, "tags": {"domain": "web"}})
    return M.read(spark, {"input_cfg": entries}).select("doc_id", "lang", "domain", "weight")


#: The first of January 2024 in seconds.
DAY = 1704067200
RTTM = f"(SELECT CAST(user_id AS VARCHAR) AS file, start // 1000000 AS s, (end_ - start) // 1000000 AS d, event_type AS speaker FROM {SEGMENTS})"


def rttm_rows_of(spark, sf_dir):
    s = segments(spark, sf_dir)
    first = F.expr("start div 1000000")
    return s.select(F.col("user_id").cast("string").alias("file"), first.cast("double").alias("start"), (first + F.expr("(`end` - start) div 1000000")).cast("double").alias("end"), F.col("event_type").alias("speaker"))


def written_rttm(spark, sf_dir) -> str:
    to = scratch(spark, "rttm")
    K.rttm(rttm_rows_of(spark, sf_dir), to)
    return to


@query(f"SELECT file, '1' AS channel, CAST(s AS DOUBLE) AS start, CAST(d AS DOUBLE) AS duration, CAST(s + d AS DOUBLE) AS \"end\", speaker FROM {RTTM}")
def rttm_rows(spark, sf_dir):
    return M.rttm(spark, written_rttm(spark, sf_dir)).select("file", "channel", "start", "duration", "end", "speaker")


@query(f"SELECT file, '1' AS channel, CAST(min(s) AS DOUBLE) AS start, CAST(max(s + d) AS DOUBLE) AS \"end\" FROM {RTTM} GROUP BY file")
def uem_of_rttm(spark, sf_dir):
    return M.uem_of(M.rttm(spark, written_rttm(spark, sf_dir)))


@query(f"SELECT file, '1' AS channel, CAST(min(s) AS DOUBLE) AS start, CAST(max(s + d) AS DOUBLE) AS \"end\" FROM {RTTM} GROUP BY file")
def uem_rows(spark, sf_dir):
    to = scratch(spark, "uem")
    M.uem_of(rttm_rows_of(spark, sf_dir).withColumn("channel", F.lit("1"))).select(F.concat_ws("  ", "file", "channel", F.col("start").cast("decimal(20,3)").cast("string"), F.col("end").cast("decimal(20,3)").cast("string")).alias("value")).write.text(to)
    return M.uem(spark, to)


@query(f"SELECT file || ' ' || s || ' ' || d AS key, (s - {DAY}) || '.0 ' || (s + d - {DAY}) || '.0 ' || speaker AS line FROM {RTTM}")
def rttm_lines(spark, sf_dir):
    """RTTM lines as `start end speaker`, times from the first day on."""
    r = rttm_rows_of(spark, sf_dir)
    key = F.concat_ws(" ", "file", F.col("start").cast("long").cast("string"), (F.col("end") - F.col("start")).cast("long").cast("string"))
    return r.select(key.alias("key"), M.rttm_line(K.rttm_text(F.col("file"), F.col("start") - DAY, F.col("end") - DAY, F.col("speaker"))).alias("line"))


@query(f"SELECT file AS session_id, speaker, 'w' || d AS words, CAST(s AS DOUBLE) AS start_time, CAST(s + d AS DOUBLE) AS end_time, CAST(d AS DOUBLE) AS duration FROM {RTTM}")
def seglst_rows(spark, sf_dir):
    to = scratch(spark, "seglst")
    r = rttm_rows_of(spark, sf_dir)
    words = F.concat(F.lit("w"), (F.col("end") - F.col("start")).cast("long").cast("string"))
    K.seglst(r.select(F.col("file").alias("session_id"), "speaker", words.alias("words"), F.col("start").alias("start_time"), F.col("end").alias("end_time")), to)
    return M.seglst(spark, to, lines=True).select("session_id", "speaker", "words", "start_time", "end_time", "duration")


@query(f"SELECT file || ' 1 ' || s || '.00 ' || d || '.00 ' || speaker || ' NA lex NA' AS line FROM {RTTM}")
def ctm_lines(spark, sf_dir):
    to = scratch(spark, "ctm")
    r = rttm_rows_of(spark, sf_dir)
    K.ctm(r.select(F.col("file").alias("source"), F.lit(1).alias("channel"), "start", (F.col("end") - F.col("start")).alias("duration"), F.col("speaker").alias("token")), to)
    return spark.read.text(to).withColumnRenamed("value", "line")


@query(f"SELECT file AS session_id, speaker || ': ' || speaker || ' ' || d AS line FROM {RTTM}")
def transcript_lines(spark, sf_dir):
    to = scratch(spark, "transcripts")
    r = rttm_rows_of(spark, sf_dir).select(F.col("file").alias("session_id"), "speaker", "start", F.concat_ws(" ", "speaker", (F.col("end") - F.col("start")).cast("long").cast("string")).alias("text"))
    K.transcripts(r, to)
    return M.transcripts(spark, to)


TAR = "SELECT CAST(doc_id % 5 AS BIGINT) AS shard, doc_id || '.txt' AS file, md5(coalesce(text, '')) AS digest FROM documents"


def written_shards(spark, sf_dir):
    """Documents in tar files of five shards: (shard, path)."""
    docs = table(spark, sf_dir, "documents").select((F.col("doc_id") % 5).alias("shard_id"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("member"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"))
    return K.write_archives(docs, scratch(spark, "tar"))


@query(TAR)
def tar_rows(spark, sf_dir):
    paths = sorted(r.path for r in written_shards(spark, sf_dir).collect())  # a row for each file of 64 MB
    out = M.tar_members(spark, paths)
    return out.select(F.regexp_extract("shard", r"_(\d+)\.tar$", 1).cast("long").alias("shard"), "file", F.md5("data").alias("digest"))


@query("SELECT doc_id, lang, md5(coalesce(text, '')) AS digest FROM documents")
def tarred_manifest_rows(spark, sf_dir):
    """Manifest rows with the bytes of their members, by shard number and name."""
    to = scratch(spark, "tarred")
    K.jsonl(table(spark, sf_dir, "documents").select("doc_id", "lang", (F.col("doc_id") % 5).cast("int").alias("shard_id"), F.concat(F.lit("any/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("audio_filepath")), to)
    paths = sorted(r.path for r in written_shards(spark, sf_dir).collect())  # a row for each file of 64 MB
    return M.read(spark, {"type": "tarred_manifest", "manifest_filepath": to, "tarred_audio_filepaths": paths}).select("doc_id", "lang", F.md5("data").alias("digest"))


@query("SELECT CAST(item_id AS VARCHAR) AS stem, text AS json, md5(text) AS digest FROM (SELECT item_id, '{\"id\":' || item_id || '}' AS text FROM benchmark)")
def tar_pair_rows(spark, sf_dir):
    """A JSON file and another one of the same stem, side by side."""
    rows = table(spark, sf_dir, "benchmark").select((F.col("item_id") % 2).alias("shard_id"), F.col("item_id").cast("string").alias("stem"), F.concat(F.lit('{"id":'), F.col("item_id").cast("string"), F.lit("}")).alias("text"))
    members = rows.select("shard_id", F.explode(F.array(F.concat("stem", F.lit(".json")), F.concat("stem", F.lit(".wav")))).alias("member"), F.encode("text", "UTF-8").alias("data"))
    paths = sorted(r.path for r in K.write_archives(members, scratch(spark, "pairs")).collect())  # a row for each file
    return M.tar_pairs(M.tar_members(spark, paths)).select("stem", "json", F.md5("data").alias("digest"))


@query("""SELECT l_suppkey % 3 AS shard, CASE WHEN n = 0 THEN 'a_' || k || '.wav' ELSE 'a_' || k || '-sub' || n || '.wav' END AS member, i AS id FROM
(SELECT l_suppkey, l_partkey % 10 AS k, l_orderkey * 100 + l_linenumber * 10 AS i, row_number() OVER (PARTITION BY l_suppkey % 3, l_partkey % 10 ORDER BY l_orderkey * 100 + l_linenumber * 10 + l_extendedprice / 1e9) - 1 AS n FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice) AS r FROM lineitem) WHERE r = 1 AND l_partkey < 500)""")
def member_names(spark, sf_dir):
    """Flat names; repeats of one in its shard are numbered."""
    one = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_extendedprice")
    df = table(spark, sf_dir, "lineitem").withColumn("r", F.row_number().over(one)).filter("r = 1 AND l_partkey < 500")
    df = df.select((F.col("l_suppkey") % 3).alias("shard"), F.concat(F.lit("/a/"), (F.col("l_partkey") % 10).cast("string"), F.lit(".wav")).alias("path"), (F.col("l_orderkey") * 100 + F.col("l_linenumber") * 10).alias("id"))
    return K.numbered_members(df, "shard", "path", "id").select("shard", "member", "id")


@query("""SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS line, CAST(coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset", CAST(n AS BIGINT) AS length
FROM (SELECT doc_id, 1 + octet_length(encode(replace(replace(coalesce(text, ''), chr(10), ' '), chr(13), ' '))) AS n FROM documents)""")
def line_offsets(spark, sf_dir):
    """Where each line of a corpus starts, for random access: files in order, numbered as one."""
    to = scratch(spark, "offsets")
    flat = F.translate(F.coalesce("text", F.lit("")), "\n\r", "  ")
    table(spark, sf_dir, "documents").orderBy("doc_id").select(flat.alias("value")).write.text(to)
    index = M.offset_index(spark, f"{to}/part-*")
    return ranges.as_one(index, ranges.files_of(spark, [f"{to}/part-*"])).select("line", "offset", "length")


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def csv_rows(spark, sf_dir):
    """A table as text columns; null is empty."""
    to = scratch(spark, "table") + ".csv"
    c = table(spark, sf_dir, "customer")
    c.select("c_custkey", "c_name", F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("c_mktsegment")).write.csv(to, header=True)
    return M.tabular(spark, to)


@query(f"SELECT CAST(event_id AS VARCHAR) AS utterance, CAST(user_id AS VARCHAR) AS recording, '/audio/' || user_id || '.wav' AS audio_filepath, event_type || ' ' || event_id AS text, CAST(event_id AS DOUBLE) AS \"offset\", CAST(1.5 AS DOUBLE) AS duration FROM events")
def kaldi_rows(spark, sf_dir):
    """Segments with their recordings' paths and their texts, from a folder of three tables."""
    to = scratch(spark, "kaldi")
    e = table(spark, sf_dir, "events")
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    e.select(F.concat_ws(" ", event, user, F.concat(event, F.lit(".0")), (F.col("event_id") + 1.5).cast("string")).alias("value")).write.text(f"{to}/segments")
    e.select("user_id").distinct().select(F.concat(user, F.lit(" /audio/"), user, F.lit(".wav")).alias("value")).write.text(f"{to}/wav.scp")
    e.select(F.concat_ws(" ", event, "event_type", event).alias("value")).write.text(f"{to}/text")
    return M.kaldi(spark, to).select("utterance", "recording", "audio_filepath", "text", "offset", "duration")


@query("SELECT '/w/' || o_orderkey || '.wav' AS audio_filepath, CAST(o_orderkey AS VARCHAR) AS uniq_id, CASE WHEN o_orderkey % 2 = 0 THEN '/t/' || o_orderkey || '.txt' END AS text_filepath, CASE WHEN o_orderkey % 3 = 0 THEN '/r/' || o_orderkey || '.rttm' END AS rttm_filepath FROM orders")
def manifest_of_paths(spark, sf_dir):
    """Lists of paths joined by the files' stems."""
    o = table(spark, sf_dir, "orders")
    paths = lambda folder, kind, every: o.filter(F.col("o_orderkey") % every == 0).select(F.concat(F.lit(f"/{folder}/"), F.col("o_orderkey").cast("string"), F.lit(f".{kind}")).alias("path"))
    return M.created_manifest(paths("w", "wav", 1), text=paths("t", "txt", 2), rttm=paths("r", "rttm", 3)).select("audio_filepath", "uniq_id", "text_filepath", "rttm_filepath")


@query("SELECT DISTINCT lower(w) AS word, rtrim(regexp_replace(lower(w), '(.)', '\\1 ', 'g')) AS spelling FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part)")
def language_model_lexicon(spark, sf_dir):
    """The words of an ARPA file and their letters; marks such as <s> are no words."""
    to = scratch(spark, "arpa")
    words = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("w")).distinct()
    lines = words.select(F.concat(F.lit("-1.5\t"), "w", F.lit("\t-0.25")).alias("value")).unionByName(spark.createDataFrame([("\\data\\",), ("ngram 1=9",), ("-2.0\t<s>\t-0.5",), ("-0.5\tsmall ring",), ("\\end\\",)], "value string"))
    lines.write.text(to)
    return M.arpa_lexicon(spark, to, lower=True)


@query("SELECT o_orderkey, o_orderkey % 4 AS shard_id, CAST(0 AS BIGINT) AS version FROM orders WHERE o_orderkey < 1000 UNION ALL SELECT o_orderkey, o_orderkey % 2 + 4, 1 FROM orders WHERE o_orderkey BETWEEN 1000 AND 1500")
def appended_shards(spark, sf_dir):
    """New shards come behind the last one of a dataset, under its next version."""
    o = table(spark, sf_dir, "orders")
    base = o.filter("o_orderkey < 1000").select("o_orderkey", (F.col("o_orderkey") % 4).alias("shard_id"))
    new = o.filter("o_orderkey BETWEEN 1000 AND 1500").select("o_orderkey", (F.col("o_orderkey") % 2).alias("shard_id"))
    return K.appended(base, new).withColumn("version", F.col("version").cast("long"))


@query("SELECT o_orderkey, o_totalprice AS duration, upper(o_orderstatus) AS text FROM orders WHERE o_orderkey % 9 = 0")
def rows_kept_elsewhere(spark, sf_dir):
    """The rows that another manifest has, with its own fields."""
    o = table(spark, sf_dir, "orders")
    filtered = o.filter("o_orderkey % 9 = 0").select("o_orderkey", F.upper("o_orderstatus").alias("text"))
    return K.kept_in(o.select("o_orderkey", F.col("o_totalprice").alias("duration")), filtered, "o_orderkey")


@query("""SELECT user_id AS session_id, string_agg('Dialogue: 0,0:' || lpad(CAST(k // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') || '.00,0:' || lpad(CAST((k + 1) // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST((k + 1) % 60 AS VARCHAR), 2, '0') || '.00,Default,,0,0,0,,' || event_type, chr(10) ORDER BY k, event_type) AS events
FROM (SELECT DISTINCT user_id, event_type, event_id % 3000 AS k FROM events) GROUP BY user_id""")
def subtitle_events(spark, sf_dir):
    """Words with times as the events of a subtitle file for each session."""
    words = table(spark, sf_dir, "events").select(F.col("user_id").alias("session_id"), (F.col("event_id") % 3000).cast("double").alias("start"), (F.col("event_id") % 3000 + 1).cast("double").alias("end"), F.col("event_type").alias("word")).distinct()
    return K.subtitles(words).select("session_id", F.substring("text", F.lit(len(K.SUBTITLE_HEAD) + 1), F.length("text")).alias("events"))


@query("SELECT doc_id, md5(coalesce(text, '')) AS digest FROM documents")
def rows_by_permutation(spark, sf_dir):
    """Rows of a JSONL file in the order of a permutation, half of them by one run and the rest by the next: all come, each once."""
    to = scratch(spark, "random")
    table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).write.json(to)
    index = checkpointed(ranges.numbered(ranges.lines(spark, to, values=False), "line"))
    half = index.count() // 2
    both = ranges.epoch(index, 7, 0, half).unionByName(ranges.epoch(index, 7, half))
    row = F.from_json(F.decode("data", "UTF-8"), "doc_id long, text string")
    return both.select(row.alias("r")).select("r.doc_id", F.md5("r.text").alias("digest"))


@query("SELECT doc_id, md5(coalesce(text, '')) AS digest FROM documents WHERE doc_id % 3 = 0")
def members_by_name(spark, sf_dir):
    """Every third document's bytes, read from tar files by the places of its member."""
    index = ranges.members(spark, [r.path for r in written_shards(spark, sf_dir).collect()], values=False).withColumn("doc_id", F.regexp_extract("name", r"^(\d+)", 1).cast("long"))  # a row for each file of 64 MB
    return ranges.bytes_at(index.filter("doc_id % 3 = 0").drop("value")).select("doc_id", F.md5("data").alias("digest"))


@query("""SELECT doc_id::VARCHAR AS id, n_chars / 15.0 AS duration, 2::INT AS n_supervisions, text AS said, lang AS language, upper(lang) AS target, md5(coalesce(text, '')) AS digest, doc_id % 4 AS shard FROM documents""")
def sharded_cuts(spark, sf_dir):
    """Documents as cuts in four shards, with a field of lines and one of archives beside them, zipped by place."""
    docs = table(spark, sf_dir, "documents").withColumn("shard", F.col("doc_id") % 4)
    part = lambda n: F.struct(F.concat_ws("-", "doc_id", F.lit(str(n))).alias("id"), F.lit(None).cast("string").alias("recording_id"), F.lit(float(n)).alias("start"), F.lit(1.0).alias("duration"), F.lit(0).alias("channel"), F.when(F.lit(n == 0), F.col("text")).alias("text"), F.col("lang").alias("language"), F.lit(None).cast("string").alias("speaker"), F.lit(None).cast("map<string,string>").alias("custom"))
    rows = docs.select("shard", "doc_id", "text", "lang", F.col("doc_id").cast("string").alias("id"), F.lit(0.0).alias("start"), (F.col("n_chars") / 15).alias("duration"), F.lit(0).alias("channel"), F.lit("r").alias("recording_id"), F.array(part(0), part(1)).alias("supervisions"), F.lit(None).cast("map<string,string>").alias("custom"))
    paths = cuts.write_shards(rows, scratch(spark, "shar"), "shard", "doc_id", {"cuts": cuts.cut_line(rows), "target": F.upper("lang")}, {"recording": (F.concat("id", F.lit(".txt")), F.encode(F.coalesce("text", F.lit("")), "UTF-8"))})
    back = M.read(spark, {"type": "shar", "fields": {k: sorted(f for f, _ in ranges.files_of(spark, [v])) for k, v in paths.items()}})
    first = F.col("supervisions")[0]
    return back.select("id", "duration", F.size("supervisions").alias("n_supervisions"), first["text"].alias("said"), first["language"].alias("language"), "target", F.md5("recording").alias("digest"), "shard")
