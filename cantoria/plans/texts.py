"""Queries over texts: cleaning, keys, identifiers, tokens and pronunciations, a column function each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import tokens as K
from ..operators import labels as L
from .registered import query, table


def _documents(out):
    def run(spark, sf_dir):
        return table(spark, sf_dir, "documents").select("doc_id", out(F.col("text")).alias("out"))

    return run


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(text, '([.,!?])', ' \\1 ', 'g'), '\\s+', ' ', 'g')) AS out FROM documents")
def punctuation_apart(spark, sf_dir):
    return _documents(T.separated_punctuation)(spark, sf_dir)


@query("SELECT doc_id, regexp_replace(replace(text, ',', ' ,'), '([\\p{L}\\p{N}_])\\s+([.,;!?])', '\\1\\2', 'g') AS out FROM documents")
def punctuation_tightened(spark, sf_dir):
    return _documents(lambda t: T.tightened_punctuation(F.replace(t, F.lit(","), F.lit(" ,"))))(spark, sf_dir)


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^a-z'' ]', '', 'g'), '\\s+', ' ', 'g')) AS out FROM documents")
def latin_letters(spark, sf_dir):
    return _documents(T.only_letters)(spark, sf_dir)


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^\\p{L}\\s\\-]', '', 'g'), '\\s+', ' ', 'g')) AS out FROM documents")
def letters_of_any_script(spark, sf_dir):
    return _documents(lambda t: T.letters_and(t, "-"))(spark, sf_dir)


@query("SELECT doc_id, CASE WHEN b = '' OR regexp_matches(b, '[.!?]$') THEN b ELSE b || '.' END AS out FROM (SELECT doc_id, rtrim(text, ' ') AS b FROM documents)")
def closed_sentences(spark, sf_dir):
    return _documents(T.with_period)(spark, sf_dir)


@query("SELECT doc_id, nfc_normalize(replace(text, '’', '''')) AS out FROM documents")
def composed_texts(spark, sf_dir):
    return _documents(T.composed)(spark, sf_dir)


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(replace(text, '’', '''')), '[​‌‍⁠﻿­]', '', 'g'), '[“”„]', '\"', 'g'), '[‐‑–—]', '-', 'g'), '\\s+', ' ', 'g')) AS out FROM documents")
def plain_graphemes(spark, sf_dir):
    return _documents(T.graphemes_normalized)(spark, sf_dir)


@query("SELECT doc_id, regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g') AS out FROM documents")
def ascii_texts(spark, sf_dir):
    return _documents(T.ascii_folded)(spark, sf_dir)


@query("SELECT doc_id, replace(replace(text, '‘', ''''), '’', '''') AS out FROM documents")
def plain_apostrophes(spark, sf_dir):
    return _documents(T.typographic_apostrophes)(spark, sf_dir)


@query("SELECT p_partkey, p_name || ' x' AS out FROM part")
def without_time_tokens(spark, sf_dir):
    marked = F.concat("p_name", F.lit(" <|"), F.col("p_size").cast("string"), F.lit("|>  x<|0|>"))
    return table(spark, sf_dir, "part").select("p_partkey", T.without_timestamps(marked).alias("out"))


@query("SELECT p_partkey, upper(left(p_name, 1)) || substr(p_name, 2) || '. I ' || p_size || '! ' || 'So' AS out FROM part")
def capitals_put(spark, sf_dir):
    plain = F.concat("p_name", F.lit(". i "), F.col("p_size").cast("string"), F.lit("! so"))
    return table(spark, sf_dir, "part").select("p_partkey", T.auto_capitalized(plain).alias("out"))


@query("SELECT p_partkey, 'at ' || p_size || CASE WHEN m = 0 THEN ' o''clock' WHEN m < 10 THEN ' oh ' || m ELSE ' ' || m END || ' for ' || p_size || ' percent of ' || p_size || ' kilometers at home' AS out FROM (SELECT *, p_partkey % 60 AS m FROM part)")
def spoken_texts(spark, sf_dir):
    n, m = F.col("p_size").cast("string"), F.lpad((F.col("p_partkey") % 60).cast("string"), 2, "0")
    return table(spark, sf_dir, "part").select("p_partkey", T.spoken_forms(F.concat(F.lit("at "), n, F.lit(":"), m, F.lit(" for "), n, F.lit("% of "), n, F.lit("km@home"))).alias("out"))


@query("SELECT p_partkey, p_name IN ('small ring', 'red widget') AS is_backchannel FROM part")
def backchannel_turns(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.initcap("p_name"), F.lit("!")).alias("text"))
    return L.backchannels(df, "text", ["small ring", "red widget"]).select("p_partkey", "is_backchannel")


@query("SELECT p_partkey, replace(p_name, 'ring', 'RING') AS out FROM part")
def words_replaced(spark, sf_dir):
    """A pattern replaced where blanks, punctuation or the ends surround it."""
    return table(spark, sf_dir, "part").select("p_partkey", T.between_punctuation(F.col("p_name"), "ring", "RING").alias("out"))


@query("""WITH l AS (SELECT ['zero','one','two','three','four','five','six','seven','eight','nine','ten','eleven','twelve','thirteen','fourteen','fifteen','sixteen','seventeen','eighteen','nineteen'] AS o, ['','','twenty','thirty','forty','fifty','sixty','seventy','eighty','ninety'] AS t,
['zeroth','first','second','third','fourth','fifth','sixth','seventh','eighth','ninth','tenth','eleventh','twelfth','thirteenth','fourteenth','fifteenth','sixteenth','seventeenth','eighteenth','nineteenth'] AS d),
n AS (SELECT p_partkey AS k, p_partkey // 1000 AS h, p_partkey % 1000 // 100 AS c, p_partkey % 100 AS r, p_size AS s FROM part),
h AS (SELECT *, CASE WHEN h = 0 THEN NULL WHEN h < 20 THEN o[h + 1] ELSE t[h // 10 + 1] || CASE WHEN h % 10 > 0 THEN ' ' || o[h % 10 + 1] ELSE '' END END AS high,
CASE WHEN c > 0 THEN o[c + 1] || ' hundred' END AS mid, CASE WHEN r = 0 THEN NULL WHEN r < 20 THEN o[r + 1] ELSE t[r // 10 + 1] || CASE WHEN r % 10 > 0 THEN ' ' || o[r % 10 + 1] ELSE '' END END AS low,
CASE WHEN s < 20 THEN d[s + 1] WHEN s % 10 = 0 THEN left(t[s // 10 + 1], -1) || 'ieth' ELSE t[s // 10 + 1] || ' ' || d[s % 10 + 1] END AS ordinal FROM n, l)
SELECT k AS p_partkey, CASE WHEN k = 0 THEN 'zero' ELSE concat_ws(' ', high || ' thousand', mid, low) END AS cardinal, ordinal FROM h""")
def number_words(spark, sf_dir):
    """Keys of parts in words and sizes as ordinals."""
    return table(spark, sf_dir, "part").select("p_partkey", T.cardinal_words(F.col("p_partkey"), T.MOST_IN_WORDS).alias("cardinal"), T.ordinal_words(F.col("p_size")).alias("ordinal"))


@query("SELECT page_id, regexp_replace(regexp_extract(url, '([^/]*)$', 1), '\\.[^.]*$', '') AS stem FROM pages")
def file_stems(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.file_stem(F.col("url")).alias("stem"))


@query("SELECT event_id, 'u' || user_id || '-' || event_id * 250 || '-' || (event_id + 6) * 250 AS id, event_id * 250 AS start FROM events")
def stems_with_spans(spark, sf_dir):
    path, at = F.concat(F.lit("/a/b/u"), F.col("user_id").cast("string"), F.lit(".wav")), F.col("event_id") / 4
    return table(spark, sf_dir, "events").select("event_id", T.stem_with_span(path, at, F.lit(1.5)).alias("id"), T.scaled_integer(at).alias("start"))


@query("SELECT p_partkey, regexp_replace(p_name, '^(.*)i', '\\1_I_') AS out FROM part")
def last_replaced(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.replaced_last(F.col("p_name"), "i", "_I_").alias("out"))


@query("SELECT o_orderkey, regexp_replace(format('{:.3f}', o_orderkey / 8.0), '(\\.\\d\\d*?)0+$', '\\1') AS out FROM orders")
def rounded_numbers(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", T.rounded_text(F.col("o_orderkey") / 8).alias("out"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def fields_at_paths(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", T.at_path(F.col("props"), "k").alias("k"))


@query("SELECT round(avg(CASE WHEN p_partkey % 5 < 4 AND p_partkey % 4 = p_size % 4 THEN 1 ELSE 0 END), 9) AS accuracy, count(*) AS n FROM part")
def choice_accuracy(spark, sf_dir):
    """Answers in several forms, one of five without a choice, against keys."""
    letter = lambda n: F.element_at(F.array(*map(F.lit, "ABCD")), (n % 4 + 1).cast("int"))
    said = F.element_at(F.array(F.concat(F.lit("The answer is ("), letter(F.col("p_partkey")), F.lit(")")), F.concat(F.lit("option "), letter(F.col("p_partkey"))), F.concat(letter(F.col("p_partkey")), F.lit(") so")), F.concat(F.lit("I take ("), letter(F.col("p_partkey")), F.lit(")")), F.lit("none of them")), (F.col("p_partkey") % 5 + 1).cast("int"))
    df = table(spark, sf_dir, "part").select(said.alias("response"), F.lower(letter(F.col("p_size"))).alias("key"))
    return L.choice_accuracy(df, "response", "key").withColumn("accuracy", F.round("accuracy", 9))


@query("SELECT item_id, CAST(octet_length(encode(text)) AS BIGINT) AS n, text AS back FROM benchmark")
def byte_tokens(spark, sf_dir):
    """Texts as byte ids behind three special ones, and back."""
    ids = table(spark, sf_dir, "benchmark").withColumn("ids", K.utf8_bytes(F.col("text"), 3))
    return ids.select("item_id", F.size("ids").cast("long").alias("n"), K.from_utf8_bytes(F.col("ids"), 3).alias("back"))


@query("SELECT p_partkey, CAST(length(replace(p_name, ' ', '')) AS BIGINT) AS n, CAST(list_sum(list_transform(string_split(replace(p_name, ' ', ''), ''), lambda c: ascii(c) - 97)) AS BIGINT) AS total FROM part")
def character_tokens(spark, sf_dir):
    """Ids of the letters a to z; blanks aren't among the labels and vanish."""
    ids = table(spark, sf_dir, "part").withColumn("ids", K.character_ids(F.upper("p_name"), [chr(97 + i) for i in range(26)]))
    ids = ids.withColumn("ids", F.filter("ids", lambda i: i >= 0))
    return ids.select("p_partkey", F.size("ids").cast("long").alias("n"), F.aggregate("ids", F.lit(0).cast("long"), lambda s, x: s + x).alias("total"))


@query("SELECT item_id, array_to_string(regexp_extract_all(lower(text), '\\|[^|]*\\||[\\p{L}\\p{N}]+(?:[''’-][\\p{L}\\p{N}]+)*|[^\\s\\p{L}\\p{N}]'), ' ') AS tokens FROM benchmark")
def word_and_mark_tokens(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.array_join(K.words_and_marks(F.col("text")), " ").alias("tokens"))


@query("SELECT doc_id, CAST(len(regexp_extract_all(text, '\\p{Lu}\\p{L}+')) AS BIGINT) AS n FROM documents")
def tokens_by_pattern(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(K.by_pattern(F.col("text"), r"\p{Lu}\p{L}+")).cast("long").alias("n"))


WORDS = ("small", "large", "red", "blue")


@query("SELECT p_partkey, array_to_string(list_filter(string_split(p_name, ' '), lambda w: w IN ('small', 'large', 'red', 'blue')), ' ') AS back FROM part")
def vocabulary_round_trip(spark, sf_dir):
    """Words to ids and back; those not in the vocabulary vanish."""
    table_ = {w: i for i, w in enumerate(WORDS)}
    ids = K.looked_up(K.words(F.col("p_name")), table_, unknown=None)
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(K.pieces_of(ids, table_), " ").alias("back"))


@query("SELECT p_partkey, string_agg(CASE WHEN w = 'small' OR w LIKE 'r%' THEN w ELSE upper(w) END, ' ' ORDER BY i) AS phonemes FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, generate_subscripts(string_split(p_name, ' '), 1) AS i FROM part) GROUP BY p_partkey")
def pronounced_names(spark, sf_dir):
    """Names through a lexicon: `small` has two entries, words with r none; those keep their letters."""
    words = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct().filter("word NOT LIKE 'r%'")
    lexicon = words.select("word", F.upper("word").alias("phonemes")).unionByName(words.filter("word = 'small'").select("word", F.lit("S M").alias("phonemes")))
    if not words.filter("word = 'small'").limit(1).count():
        lexicon = words.select("word", F.upper("word").alias("phonemes"))
    return K.pronounced(table(spark, sf_dir, "part"), "p_name", lexicon, "p_partkey")


@query("SELECT p_partkey, ['həˈ', 'hʌloʊ', 'kæt', 'dɔɡ'][2 + p_size % 3] AS ipa, [2, 1, 1][1 + p_size % 3] AS syllables, ['tʃ aɪ l d', 'k ɔː l', 'b ɪ ɡ'][1 + p_size % 3] AS symbols FROM part")
def phonetic_forms(spark, sf_dir):
    one = lambda xs: F.element_at(F.array(*map(F.lit, xs)), (F.col("p_size") % 3 + 1).cast("int"))
    phones = one(("HH AH0 L OW1", "K AE1 T", "D AO1 G"))
    return table(spark, sf_dir, "part").select("p_partkey", K.arpabet_as_ipa(phones).alias("ipa"), K.syllables(phones).alias("syllables"), F.array_join(K.ipa_symbols(one(("tʃaɪld", "kɔːl", "bɪɡ"))), " ").alias("symbols"))


@query("SELECT doc_id, array_to_string(list_filter(['the', 'and of', 'la', 'der'], lambda p: regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}_])' || p || '($|[^\\p{L}\\p{N}_])')), '|') AS hits FROM documents WHERE lang = 'en'")
def phrases_found(spark, sf_dir):
    """Which phrases stand in a text as whole words."""
    hits = K.phrase_hits(F.lower("text"), ["the", "and of", "la", "der"])
    order = F.filter(F.array(*map(F.lit, ("the", "and of", "la", "der"))), lambda p: F.array_contains(F.transform(hits, F.lower), p))
    return table(spark, sf_dir, "documents").filter("lang = 'en'").select("doc_id", F.array_join(order, "|").alias("hits"))


@query("SELECT doc_id, CAST(len(regexp_extract_all(text, '[^ \\t\\n\\r]+')) + CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 100000 ELSE 200000 END AS BIGINT) AS first FROM documents WHERE lang IN ('en', 'de', 'fr') AND regexp_matches(text, '[^ \\t\\n\\r]')")
def tokens_by_language(spark, sf_dir):
    """One id a text, its number of words, shifted by the sizes of the languages before its own."""
    docs = table(spark, sf_dir, "documents").filter("lang IN ('en', 'de', 'fr') AND text rlike '[^ \\t\\n\\r]'")
    ids = F.array(F.size(F.regexp_extract_all("text", F.lit("[^ \\t\\n\\r]+"), F.lit(0))))
    return docs.select("doc_id", K.aggregated(F.col("lang"), {g: (ids, 100000) for g in ("en", "de", "fr")})[0].cast("long").alias("first"))


@query("SELECT p_partkey, 'dir ' || p_name || ' rd' AS road, 'gate ' || p_name AS poi, 't' || p_size % 3 || '|exit_no=#|road_name=dir ' || p_name || ' rd|verb=turn' AS slots, p_name || ' # miles # exit #' AS numeric FROM part")
def record_keys(spark, sf_dir):
    """Keys under which generated records count as alike: directions, kinds of road and numbers are all one."""
    p, one = table(spark, sf_dir, "part"), lambda *xs: F.element_at(F.array(*map(F.lit, xs)), (F.col("p_size") % len(xs) + 1).cast("int"))
    road = F.concat_ws(" ", one("North", "S.", "east"), F.initcap("p_name"), one("Street", "Rd", "blvd", "Hwy"))
    slots = F.create_map(F.lit("verb"), F.lit(" Turn"), F.lit("road_name"), road, F.lit("exit_no"), F.col("p_size").cast("string"))
    said = F.concat_ws(" ", "p_name", F.col("p_size").cast("string"), F.lit("miles,"), one("third", "2nd", "twelve"), F.lit("exit"), F.col("p_partkey").cast("string"))
    return p.select(
        "p_partkey", T.canonical_entity(road, F.lit("road_name")).alias("road"), T.canonical_entity(F.concat(F.lit("Gate "), F.col("p_size").cast("string"), F.lit(" "), "p_name"), F.lit("poi_name")).alias("poi"),
        T.slot_skeleton_key(F.concat(F.lit("t"), (F.col("p_size") % 3).cast("string")), slots).alias("slots"), T.numeric_skeleton_key(said).alias("numeric"),
    )
