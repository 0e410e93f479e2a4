"""Queries over documents as a manifest: scans, filters, keys, dedup, splits, buckets, mixing weights.

A document stands for an utterance: its text, its language, and a duration of
one second for each 15 characters.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import tokens as K
from ..operators import batching as B
from ..operators import dedup as D
from ..operators import filters as X
from ..operators import scoring as S
from .registered import query, table

KEY = "trim(regexp_replace(regexp_replace(lower(text), '[.,;:''\"]', '', 'g'), '\\s+', ' ', 'g'))"
LOWER = "trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))"
WORDS = "(CASE WHEN trim(coalesce(text, '')) = '' THEN 0 ELSE len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) END)"
HASH = "((((('0x' || substr(md5({x}), 1, 8))::BIGINT % 10000) * 4294967296 + ('0x' || substr(md5({x}), 9, 8))::BIGINT) % 10000 * 4294967296 + ('0x' || substr(md5({x}), 17, 8))::BIGINT) % 10000 * 4294967296 + ('0x' || substr(md5({x}), 25, 8))::BIGINT) % 10000"


def manifest(spark, sf_dir):
    return table(spark, sf_dir, "documents").withColumn("duration", F.col("n_chars") / 15.0)


@query(f"""WITH d AS (SELECT doc_id, lang, text, {KEY} AS k, {WORDS} AS w FROM documents),
f AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id) = 1)
SELECT lang, CASE WHEN w <= 8 THEN 'short' WHEN w >= 18 THEN 'long' ELSE 'medium' END AS bucket, count(*) AS n, round(avg(length(text)), 6) AS avg_chars FROM f GROUP BY ALL""")
def corpus_profile(spark, sf_dir):
    """First document of each normalised text, by language and length bucket."""
    first = D.first_of_each(manifest(spark, sf_dir).select("doc_id", "lang", "text"), T.normalized_key(F.col("text")), "doc_id")
    return first.groupBy("lang", T.length_bucket(F.col("text")).alias("bucket")).agg(F.count("*").alias("n"), F.round(F.avg(F.length("text")), 6).alias("avg_chars"))


@query("SELECT doc_id, n_chars FROM documents WHERE n_chars / 15.0 >= 10 AND n_chars / 15.0 <= 200")
def filter_duration(spark, sf_dir):
    return X.by_duration(manifest(spark, sf_dir), 10, 200).select("doc_id", "n_chars")


@query("SELECT doc_id, n_chars FROM documents WHERE n_chars / 15.0 >= 10 AND n_chars / 15.0 < 200")
def filter_duration_half_open(spark, sf_dir):
    return X.by_duration_half_open(manifest(spark, sf_dir), 10, 200).select("doc_id", "n_chars")


@query("SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR quality >= 1")
def filter_optional_label(spark, sf_dir):
    """Rows without a label pass."""
    df = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return X.at_least(df, "quality", 1).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE {WORDS} / (n_chars / 15.0) BETWEEN 1.5 AND 2.6")
def filter_token_rate(spark, sf_dir):
    """Here all rows are utterances, so those without a duration go."""
    df = manifest(spark, sf_dir).filter(F.col("duration").isNotNull()).withColumn("n_tokens", T.word_count(F.col("text")))
    return X.by_token_rate(df, 1.5, 2.6).select("doc_id")


@query("SELECT doc_id, lang FROM documents WHERE ((lang = 'en' OR lang = 'de') AND source <> 'src1')")
def filter_constraint(spark, sf_dir):
    df = table(spark, sf_dir, "documents")
    return df.filter(X.constraint("(.lang == en or .lang == de) and .source != src1", df.columns)).select("doc_id", "lang")


@query("SELECT doc_id FROM documents WHERE n_chars >= 500 AND contains(lang, 'e')")
def filter_table_language(spark, sf_dir):
    return X.table_filter(table(spark, sf_dir, "documents"), "{n_chars} ge 500 && {lang} contains e").select("doc_id")


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 50 OFFSET 100")
def page_of_table(spark, sf_dir):
    return X.page(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), [F.desc("n_chars"), "doc_id"], 50, 2)


@query("SELECT round(sum(n_chars / 15.0) / 3600, 6) AS total_hours, round(sum(CASE WHEN n_chars / 15.0 >= 5 AND n_chars / 15.0 <= 100 THEN n_chars / 15.0 END) / 3600, 6) AS kept_hours FROM documents")
def hours_kept(spark, sf_dir):
    _, hours = X.by_optional_duration(manifest(spark, sf_dir), 5, 100)
    return hours.select(*(F.round(c, 6).alias(c) for c in hours.columns))


@query(f"""SELECT level, round(sum(c - 1) / sum(c), 9) AS rate FROM (
SELECT 'lower' AS level, count(*) AS c FROM documents GROUP BY {LOWER} UNION ALL
SELECT 'normalized', count(*) FROM documents GROUP BY {KEY} UNION ALL
SELECT 'text', count(*) FROM documents GROUP BY text) GROUP BY level""")
def duplicate_rates(spark, sf_dir):
    df = table(spark, sf_dir, "documents")
    rates = D.duplicate_rates(df, {"text": F.col("text"), "lower": T.lower_key(F.col("text")), "normalized": T.normalized_key(F.col("text"))})
    return rates.select("level", F.round("rate", 9).alias("rate"))


@query(f"SELECT {KEY} AS key, min(doc_id) AS doc_id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def repeated_keys(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(T.normalized_key(F.col("text")).alias("key")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")).filter("n > 1")


@query(f"SELECT split, count(*) AS n FROM (SELECT CASE WHEN h < 8000 THEN 'train' WHEN h < 9000 THEN 'val' ELSE 'test' END AS split FROM (SELECT {HASH.format(x=LOWER)} AS h FROM documents)) GROUP BY split")
def split_by_md5(spark, sf_dir):
    """Train, validation and test by the md5 of an entity: here the lower-cased text."""
    df = B.split_by_entity(table(spark, sf_dir, "documents"), F.array(T.lower_key(F.col("text"))))
    return df.groupBy("split").agg(F.count("*").alias("n"))


@query(f"""WITH s AS (SELECT source, CASE WHEN h < 8000 THEN 'train' WHEN h < 9000 THEN 'val' ELSE 'test' END AS split FROM (SELECT source, {HASH.format(x=LOWER)} AS h FROM documents))
SELECT source, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM s GROUP BY source HAVING count(DISTINCT split) > 1""")
def leaked_sources(spark, sf_dir):
    """Sources whose documents stand in more than one split."""
    df = B.split_by_entity(table(spark, sf_dir, "documents"), F.array(T.lower_key(F.col("text"))))
    return D.leakage(df, "source").select("source", F.array_join("splits", ",").alias("splits"))


@query("SELECT doc_id, least(n_chars, 2000) // 500 AS cell, CASE WHEN n_chars <= 200 THEN 0 WHEN n_chars <= 800 THEN 1 WHEN n_chars <= 3200 THEN 2 WHEN n_chars <= 12800 THEN 3 END AS bucket FROM documents")
def smallest_buckets(spark, sf_dir):
    bucket = B.smallest_bucket(F.col("n_chars"), [200, 800, 3200, 12800])
    return table(spark, sf_dir, "documents").select("doc_id", F.floor(F.least("n_chars", F.lit(2000)) / 500).alias("cell"), bucket.alias("bucket"))


@query("""WITH s AS (SELECT n_chars, sum(n_chars) AS mass FROM documents WHERE n_chars > 0 GROUP BY n_chars),
c AS (SELECT n_chars, sum(mass) OVER (ORDER BY n_chars) AS upto, sum(mass) OVER () AS total FROM s),
p AS (SELECT least(ceil(upto * 8.0 / total), 8) AS part, max(n_chars) AS bound FROM c GROUP BY 1)
SELECT DISTINCT bound FROM p WHERE part < 8""")
def equal_mass_bounds(spark, sf_dir):
    bounds = B.equal_mass_bounds(table(spark, sf_dir, "documents"), "n_chars", 8)
    return spark.createDataFrame([(int(b),) for b in bounds], "bound long")


@query("SELECT doc_id FROM documents, (SELECT avg(n_chars) AS mu, stddev_pop(n_chars) AS sd FROM documents) WHERE (n_chars - mu) / sd <= 2")
def without_outliers(spark, sf_dir):
    return B.not_outlying(table(spark, sf_dir, "documents"), "n_chars", 2).select("doc_id")


@query("SELECT lang, n, round(sqrt(n) / sum(sqrt(n)) OVER (), 9) AS weight FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)")
def temperature_weights(spark, sf_dir):
    """Mixing weights of the languages at temperature 0.5."""
    counts = sorted(map(tuple, table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n")).collect()))
    weights = B.tempered([n for _, n in counts], 0.5)
    return spark.createDataFrame([(g, n, round(w, 9)) for (g, n), w in zip(counts, weights, strict=True)], "lang string, n long, weight double")


@query("SELECT doc_id FROM documents WHERE doc_id % 4 = 1 AND (doc_id // 4) % 2 = 0")
def rows_of_rank(spark, sf_dir):
    return B.rank_rows(table(spark, sf_dir, "documents"), "doc_id", 1, 4, 0, 2).select("doc_id")


@query("SELECT w AS word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[^ \\t\\n\\r]+')) AS w FROM documents) GROUP BY w HAVING count(*) > 100")
def vocabulary(spark, sf_dir):
    return S.vocabulary(table(spark, sf_dir, "documents"), "text").filter("n > 100")


@query("SELECT c AS letter, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) WHERE c <> '' GROUP BY c")
def alphabet(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.explode(K.chars(F.col("text"))).alias("letter")).groupBy("letter").agg(F.count("*").alias("n"))


@query("""WITH t AS (SELECT list_concat(list_concat(['<s>'], regexp_extract_all(text, '[^ \\t\\n\\r]+')), ['</s>']) AS t FROM benchmark),
g AS (SELECT 1 AS n, unnest(t) AS ngram FROM t UNION ALL SELECT 2, unnest(list_transform(generate_series(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1])) FROM t)
SELECT n, ngram, count(*) AS count FROM g GROUP BY n, ngram""")
def ngram_counts(spark, sf_dir):
    return K.ngram_counts(table(spark, sf_dir, "benchmark"), "text", 2)


@query("SELECT lang, source, round(avg(n_chars), 6) AS mean, round(stddev_samp(n_chars), 6) AS sd FROM documents WHERE n_chars <> 0 GROUP BY lang, source")
def length_stats(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter("n_chars != 0").groupBy("lang", "source").agg(F.round(F.avg("n_chars"), 6).alias("mean"), F.round(F.stddev_samp("n_chars"), 6).alias("sd"))


@query("SELECT n_name AS name, row_number() OVER (ORDER BY n_name) - 1 AS index FROM (SELECT DISTINCT n_name FROM nation)")
def dense_index(spark, sf_dir):
    return S.dense_index(table(spark, sf_dir, "nation").withColumnRenamed("n_name", "name"), "name")


@query("SELECT doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS r FROM documents) WHERE r <= 20")
def trimmed_groups(spark, sf_dir):
    return B.trimmed(table(spark, sf_dir, "documents"), ["lang"], 20, F.desc("n_chars"), "doc_id").select("doc_id", "n_chars")


@query("SELECT least(n_chars, 5000) AS length, count(*) AS n FROM documents GROUP BY 1")
def length_histogram(spark, sf_dir):
    return B.length_histogram(table(spark, sf_dir, "documents"), "n_chars", 5000)


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unfinished_rows(spark, sf_dir):
    return D.unfinished(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id").select("doc_id")


@query("SELECT lang AS kind, n AS have, 500 AS want, 500 - n AS missing FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang) WHERE n < 500")
def deficits(spark, sf_dir):
    df = table(spark, sf_dir, "documents").withColumnRenamed("lang", "kind")
    out = D.deficits(df, "kind", {g: 500 for g in ("de", "en", "es", "fr")})
    return out.select("kind", "have", F.col("want").cast("int").alias("want"), "missing")


@query(f"SELECT doc_id, {WORDS} AS words, trim(regexp_replace(regexp_replace(regexp_replace(lower(text), '[\"''‘’“”]', '', 'g'), '[!#$%&()*+,\\-./:;<=>?@\\[\\\\\\]^_`{{|}}~]', ' ', 'g'), '\\s+', ' ', 'g')) AS clean FROM documents")
def cleaned_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.word_count(F.col("text")).alias("words"), T.clean_label(F.col("text"), spell_digits=False).alias("clean"))


@query("SELECT doc_id, regexp_replace(regexp_replace(text, '[!\"#$%&()*+,\\-./:;<=>?@\\[\\\\\\]^_`{|}~]', '', 'g'), '\\s+', ' ', 'g') AS bare FROM documents")
def without_punctuation(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace(T.without_punctuation(F.col("text")), r"\s+", " ").alias("bare"))


@query()
def accepted_records(spark, sf_dir):
    """Capped acceptance in order of doc_id: each text once, each opening word at most five times a source."""
    df = table(spark, sf_dir, "documents").select("doc_id", "source", T.normalized_key(F.col("text")).alias("key"), F.regexp_extract("text", r"^(\S+)", 1).alias("opening"))
    return D.accepted(df, "doc_id", {"opening": 5}, ["key"], ["source"])


@query()
def packed_documents(spark, sf_dir):
    """First-fit packing of documents by words into packs of 2048; longer ones have a pack each."""
    df = table(spark, sf_dir, "documents").select("doc_id", T.word_count(F.col("text")).alias("n_tokens"))
    return B.packed(df, "doc_id", "n_tokens", 2048)


@query()
def budget_batches(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double").alias("length"))
    return B.budget_batches(df, "length", 40000.0, "doc_id")


@query()
def fixed_size_batches(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", B.smallest_bucket(F.col("n_chars"), [200, 800, 3200]).alias("bucket"))
    return B.fixed_size_batches(df, "bucket", {0: 32, 1: 16, 2: 8}, "doc_id")


@query()
def code_switched_samples(spark, sf_dir):
    df = manifest(spark, sf_dir).select("doc_id", "lang", "duration")
    return B.code_switched(df, "lang", "doc_id", "duration", 60, 600)


@query()
def sharded_rows(spark, sf_dir):
    return B.sharded(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 7)


@query()
def mixed_languages(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return B.interleaved([df.filter(F.col("lang") == g) for g in ("en", "de")], [0.3, 0.7], "doc_id", 1000).select("doc_id", "lang", "copy")


@query()
def sentence_chunks(spark, sf_dir):
    chunks = T.chunks_for_inference(F.col("text"), F.col("lang"), {"en": 45, "de": 40})
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunks).alias("place", "chunk"))


@query("SELECT l_orderkey % 8 AS shard, count(*) AS n, round(sum(l_quantity), 2) AS mass, CAST(dense_rank() OVER (ORDER BY count(*) DESC, l_orderkey % 8) AS INTEGER) AS place FROM lineitem GROUP BY 1")
def shard_masses(spark, sf_dir):
    sums = table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % 8).alias("shard")).agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("mass"))
    return sums.withColumn("place", F.dense_rank().over(Window.orderBy(F.desc("n"), "shard")))  # eight rows
