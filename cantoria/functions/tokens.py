"""Tokenisers as column functions: characters, words, patterns, bytes, lexicon and library tokenisers."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PUNCTUATION = ",.!?-:;/\"()[]{}"


def chars(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), ""), lambda c: c != "")


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")


def by_pattern(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def utf8_bytes(text: Column, offset: int = 0) -> Column:
    """array<int>: the bytes of the text, each plus an offset for special ids."""
    hexes = F.hex(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))
    return F.transform(F.filter(F.split(hexes, "(?<=\\G..)"), lambda h: h != ""), lambda h: F.conv(h, 16, 10).cast("int") + offset)


def from_utf8_bytes(ids: Column, offset: int = 0) -> Column:
    """The text of byte ids; broken sequences become U+FFFD."""
    return F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: F.lpad(F.hex((i - offset).cast("long")), 2, "0")), "")), "UTF-8")


def looked_up(tokens: Column, vocabulary: dict[str, int], unknown: int | None = -1, blank: int | None = None) -> Column:
    """Ids of tokens; unknown ones have the unknown id, or vanish where it is None or the blank id."""
    table = F.create_map(*(F.lit(x) for kv in vocabulary.items() for x in kv)) if vocabulary else F.create_map(F.lit(""), F.lit(-1))
    ids = F.transform(tokens, lambda t: F.coalesce(table[t], F.lit(unknown)))
    return F.filter(ids, lambda i: i.isNotNull() & (F.lit(True) if blank is None else i != blank))


def pieces_of(ids: Column, vocabulary: dict[str, int]) -> Column:
    table = F.create_map(*(F.lit(x) for k, v in vocabulary.items() for x in (v, k)))
    return F.filter(F.transform(ids, lambda i: table[i]), lambda p: p.isNotNull())


def character_ids(text: Column, labels: list[str], unknown: int = -1, blank: int = -1, lower: bool = True) -> Column:
    """Ids of characters; labels of several characters match whole words; unknown ones vanish where unknown equals blank."""
    index = {c: i for i, c in enumerate(labels)}
    specials = [x for x in labels if len(x) > 1]
    clean = F.trim(F.lower(text) if lower else text)
    if not specials:
        return looked_up(chars(clean), index, unknown, blank)
    parts = F.split(clean, " ")
    per_word = F.transform(parts, lambda w, i: F.concat(F.when(i > 0, F.array(F.lit(" "))).otherwise(F.array().cast("array<string>")), F.when(w.isin(*specials), F.array(w)).otherwise(F.filter(F.split(w, ""), lambda c: c != ""))))
    return looked_up(F.flatten(per_word), index, unknown, blank)


def padded(tokens: Column, pad: str = " ") -> Column:
    return F.concat(F.array(F.lit(pad)), tokens, F.array(F.lit(pad)))


def _shifted(ids: Column, offset: int) -> Column:
    return F.transform(ids, lambda i: i + offset)


def aggregated(language: Column, ids_by_language: dict[str, tuple[Column, int]]) -> Column:
    """Ids of each language's tokeniser shifted by the sizes of those before it: {language: (ids, size)}."""
    out, offset = F, 0
    for name, (ids, size) in ids_by_language.items():
        out = out.when(language == name, _shifted(ids, offset))
        offset += size
    return out


def integers(text: Column) -> Column:
    return F.transform(words(text), lambda w: w.cast("int"))


#: Symbols of the phonetic alphabet that take two characters or a mark.
IPA_PAIRS = ("t͡ʃ", "d͡ʒ", "tʃ", "dʒ", "aɪ", "aʊ", "eɪ", "oʊ", "ɔɪ", "iː", "uː", "ɑː", "ɔː", "ɜː", "əʊ", "ɪə", "eə", "ʊə")


def ipa_symbols(text: Column, pairs: tuple[str, ...] = IPA_PAIRS) -> Column:
    """Longest match first: known pairs, then single characters with their combining marks."""
    longest = "|".join(re.escape(p) for p in sorted(pairs, key=lambda p: (-len(p), p)))
    return F.regexp_extract_all(text, F.lit(rf"(?:{longest}|\S[̀-ͯ]*)"), F.lit(0))


def words_and_marks(text: Column, lower: bool = True) -> Column:
    """array<string>: words, |kept as they are|, and punctuation between them."""
    clean = F.lower(text) if lower else text
    return F.regexp_extract_all(clean, F.lit(r"\|[^|]*\||[\p{L}\p{N}]+(?:['’-][\p{L}\p{N}]+)*|[^\s\p{L}\p{N}]"), F.lit(0))


def pronounced(df: DataFrame, text: str, lexicon: DataFrame, key: str, ambiguous: bool = True) -> DataFrame:
    """(key, phonemes): words joined with a lexicon (word, phonemes); words of several entries, or none, keep their letters."""
    entries = lexicon.groupBy("word").agg(F.count("*").alias("n"), F.min("phonemes").alias("phonemes"))
    each = df.select(key, F.posexplode(words_and_marks(F.col(text))).alias("i", "word"))
    found = each.join(entries, "word", "left").withColumn("out", F.when((F.col("n") == 1) | (~F.lit(ambiguous) & F.col("n").isNotNull()), F.col("phonemes")).otherwise(F.col("word")))
    return found.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "out"))), lambda x: x["out"]), " ").alias("phonemes"))


#: ARPAbet and the phonetic alphabet.
ARPABET = dict(zip("AA AE AH AO AW AY B CH D DH EH ER EY F G HH IH IY JH K L M N NG OW OY P R S SH T TH UH UW V W Y Z ZH".split(), "ɑ æ ʌ ɔ aʊ aɪ b tʃ d ð ɛ ɝ eɪ f ɡ h ɪ i dʒ k l m n ŋ oʊ ɔɪ p ɹ s ʃ t θ ʊ u v w j z ʒ".split(), strict=True))


def arpabet_as_ipa(phones: Column, joined: bool = True) -> Column:
    """`HH AH0 L OW1` -> IPA; stress digits go, unknown symbols stay."""
    table = F.create_map(*(F.lit(x) for kv in ARPABET.items() for x in kv))
    out = F.transform(F.split(F.trim(phones), r"\s+"), lambda p: F.coalesce(table[F.regexp_replace(p, r"\d", "")], p))
    return F.array_join(out, "" if joined else " ")


def syllables(phones: Column) -> Column:
    """Number of syllables: the vowels of an ARPAbet pronunciation."""
    return F.size(F.filter(F.split(F.trim(phones), r"\s+"), lambda p: p.rlike("^[AEIOU]")))


@lru_cache(maxsize=8)
def _library(kind: str, path: str):
    if kind == "sentencepiece":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: model.encode(texts, num_threads=1)
    if kind == "tokenizers":
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        return lambda texts: [x.ids for x in tok.encode_batch(texts, add_special_tokens=False)]
    raise ValueError(kind)


def library_ids(kind: str, path: str):
    """Arrow UDF text -> ids of a tokeniser file; null gives null."""

    @F.pandas_udf("array<int>")
    def encode(text: pd.Series) -> pd.Series:
        found = _library(kind, path)(text.fillna("").tolist())
        return pd.Series([None if t is None else list(ids) for t, ids in zip(text, found, strict=True)])

    return encode


def _windows(tokens: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1), lambda i: F.array_join(F.slice(tokens, i, n), " "))


def ngram_counts(df: DataFrame, text: str, order: int, prune: int = 0) -> DataFrame:
    """(n, ngram, count) for n up to an order, counts above the pruning bound; sentence ends are <s> and </s>."""
    t = F.concat(F.array(F.lit("<s>")), words(F.col(text)), F.array(F.lit("</s>")))
    base = df.select(t.alias("t"))
    out = None
    for n in range(1, order + 1):
        grams = _windows(F.col("t"), n)
        part = base.select(F.explode(F.when(F.size("t") >= n, grams)).alias("ngram")).groupBy("ngram").agg(F.count("*").alias("count")).filter(F.col("count") > prune).select(F.lit(n).alias("n"), "ngram", "count")
        out = part if out is None else out.unionByName(part)
    return out


def phrase_hits(text: Column, phrases: list[str]) -> Column:
    """array<string>: which phrases stand in the text as whole words, by one pattern."""
    pattern = r"(?<![\p{L}\p{N}])(" + "|".join(re.escape(p) for p in sorted(phrases, key=lambda p: (-len(p), p))) + r")(?![\p{L}\p{N}])"
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
