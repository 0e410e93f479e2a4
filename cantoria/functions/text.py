"""Column functions over text: keys, cleaning, number words, identifiers.

All take and return Columns of string unless said otherwise; null in, null
out. Those that need Unicode tables the JVM functions lack are Arrow UDFs.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

#: English number words.
DIGITS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
TEENS = ("ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen")
TENS = ("", "", "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety")
ORDINALS = {"one": "first", "two": "second", "three": "third", "five": "fifth", "eight": "eighth", "nine": "ninth", "twelve": "twelfth"}
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

#: Texts that are Python objects at a time.
SLICE = 64


def _class_of(chars: str) -> str:
    return "[" + "".join("\\" + c for c in chars) + "]"


# keys


def collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


@F.pandas_udf(StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def nfc(text: Column) -> Column:
    """Composed characters; only texts with characters that may combine leave the JVM."""
    plain = text.cast("string")
    may = plain.rlike(r"[^\x00-\u02FF]")
    return F.when(may, _nfc(F.when(may, plain))).otherwise(plain)


def lower_key(text: Column) -> Column:
    """NFC, lower case, one blank between words."""
    return collapsed(F.lower(nfc(text)))


def normalized_key(text: Column) -> Column:
    """lower_key without . , ; : ' and double quotes."""
    return _without_marks(nfc(text))


def _without_marks(text: Column) -> Column:
    return collapsed(F.regexp_replace(F.lower(text), "[.,;:'\"]", ""))


#: Number words that a skeleton hides.
SPOKEN_NUMBERS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth")


def numeric_skeleton_key(text: Column) -> Column:
    """normalized_key with each number word, ordinal and run of digits as #."""
    marked = F.regexp_replace(normalized_key(text), rf"\b(?:{'|'.join(SPOKEN_NUMBERS)}|\d+(?:st|nd|rd|th))\b", "#")
    return collapsed(F.regexp_replace(marked, r"\d+", "#"))


#: Slots whose values are entities, and those whose values are numbers.
ENTITY_SLOTS = ("road_name", "poi_name", "city_name", "district_name", "route_name", "address_string", "street_name")
NUMERIC_SLOTS = ("distance_phrase", "distance_value", "distance_unit", "exit_no", "ordinal", "address_number")


def slot_skeleton_key(template: Column, slots: Column, entities: tuple[str, ...] = ENTITY_SLOTS, numbers: tuple[str, ...] = NUMERIC_SLOTS) -> Column:
    """Template and its slots (a map) in order of name: entities canonical, numbers as #, other values in small letters without blanks around them."""
    value = lambda p: F.when(p["key"].isin(*entities), _canonical(p["value"], p["key"])).when(p["key"].isin(*numbers), "#").otherwise(F.regexp_replace(F.lower(p["value"]), r"^\s+|\s+$", ""))
    whole = F.from_json(nfc(F.to_json(slots)), "map<string,string>")  # all values at once: a lambda can't call Python
    pairs = F.transform(F.array_sort(F.map_entries(whole)), lambda p: F.concat_ws("=", p["key"], value(p)))
    return F.array_join(F.concat(F.array(template), pairs), "|")


#: Words that stand for a compass direction, and for a kind of road.
DIRECTIONS = ("north", "south", "east", "west", "n", "s", "e", "w", "ne", "nw", "se", "sw")
ROAD_TYPES = ("street", "st", "road", "rd", "avenue", "ave", "boulevard", "blvd", "drive", "dr", "lane", "ln", "highway", "hwy", "court", "ct", "place", "pl", "parkway", "pkwy")


def canonical_entity(name: Column, slot: Column) -> Column:
    """Any direction as dir, any kind of road as rd, a-z and digits alone; digits stay where the slot or the name is a road or route."""
    return _canonical(nfc(name), slot)


def _canonical(name: Column, slot: Column) -> Column:
    key = _without_marks(name)
    folded = F.regexp_replace(F.regexp_replace(key, rf"\b(?:{'|'.join(DIRECTIONS)})\b", " dir "), rf"\b(?:{'|'.join(ROAD_TYPES)})\b", " rd ")
    numbered = slot.isin("road_name", "route_name") | key.rlike(r"^(?:i|us|sr|route|hwy|fm|tx)-?\d")
    return collapsed(F.regexp_replace(F.when(numbered, folded).otherwise(F.regexp_replace(folded, r"\d+", "")), "[^a-z0-9 ]", ""))


def stable_hash_mod(text: Column, modulus: int) -> Column:
    """md5 as an integer, modulo a number below 2**31."""
    out = F.lit(0).cast("long")
    digest = F.md5(text)
    for i in range(4):
        out = (out * F.lit(2**32) + F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")) % modulus
    return out


#: The space and those beyond ASCII.
SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


def word_count(text: Column) -> Column:
    """Words between blanks; null and blank texts have none. Spaces beyond ASCII part no words, but none begins or ends a text."""
    inner = F.btrim(F.regexp_replace(text, r"[ \t\n\f\r]+", " "), F.lit(SPACES))
    return F.when(F.coalesce(text, F.lit("")).rlike(rf"\A[{SPACES}]*\z"), 0).otherwise(F.size(F.split(inner, " "))).cast("long")


def length_bucket(text: Column, short_most: int = 8, long_least: int = 18) -> Column:
    n = word_count(text)
    return F.when(n <= short_most, "short").when(n >= long_least, "long").otherwise("medium")


# cleaning


def digits_as_words(text: Column) -> Column:
    """Every word of digits is spelled digit by digit (zero included)."""
    names = F.array(*map(F.lit, DIGITS))
    spelled = lambda w: F.array_join(F.transform(F.split(w, ""), lambda d: F.element_at(names, d.cast("int") + 1)), " ")
    return F.array_join(F.transform(F.split(text, " "), lambda w: F.when(w.rlike(r"^[0-9]+$"), spelled(w)).otherwise(w)), " ")


def clean_label(text: Column, spell_digits: bool = True) -> Column:
    """Lower case without quotes, other punctuation as blanks, digits as words."""
    out = F.regexp_replace(F.lower(text), "[\"'‘’“”]", "")
    out = collapsed(F.regexp_replace(out, _class_of(ASCII_PUNCTUATION.replace("'", "").replace('"', "")), " "))
    return digits_as_words(out) if spell_digits else out


def without_punctuation(text: Column, keep: str = "'") -> Column:
    return F.regexp_replace(text, _class_of("".join(c for c in ASCII_PUNCTUATION if c not in keep)), "")


def separated_punctuation(text: Column, marks: str = ".,!?") -> Column:
    return collapsed(F.regexp_replace(text, f"({_class_of(marks)})", " $1 "))


def tightened_punctuation(text: Column) -> Column:
    """No blanks between a word and . , ; ! ?"""
    return F.regexp_replace(text, r"([\p{L}\p{N}_])\s+([.,;!?])", "$1$2")


def only_letters(text: Column) -> Column:
    """a-z, apostrophe and blanks of the lower-cased text."""
    return collapsed(F.regexp_replace(F.lower(text), "[^a-z' ]", ""))


def letters_and(text: Column, keep: str = "") -> Column:
    """Lower-cased letters of any script, blanks and the given characters."""
    extra = "".join("\\" + c for c in keep)
    return collapsed(F.regexp_replace(F.lower(text), rf"[^\p{{L}}\s{extra}]", ""))


def auto_capitalized(text: Column) -> Column:
    """Where nothing is upper case: a capital at the start of each sentence, and I for i."""
    sentences = F.split(text, r"(?<=[.!?])\s+")
    put = F.array_join(F.transform(sentences, lambda s: F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, F.lit(2), F.length(s)))), " ")
    return F.when(text == F.lower(text), F.regexp_replace(put, r"\bi\b", "I")).otherwise(text)


def with_period(text: Column) -> Column:
    bare = F.rtrim(text)
    return F.when(bare == "", bare).when(bare.rlike(r"[.!?]$"), bare).otherwise(F.concat(bare, F.lit(".")))


def without_timestamps(text: Column) -> Column:
    """Without <|12|> tokens."""
    return collapsed(F.regexp_replace(text, r"<\|\d+\|>", ""))


def typographic_apostrophes(text: Column) -> Column:
    return F.regexp_replace(text, "[‘’]", "'")


def between_punctuation(text: Column, pattern: str, replacement: str) -> Column:
    """The pattern replaced where blanks, punctuation or the ends surround it."""
    return F.regexp_replace(text, rf"(?<=^|[\s\p{{Punct}}])(?:{pattern})(?=$|[\s\p{{Punct}}])", replacement)


def spoken_forms(text: Column) -> Column:
    """Times, feet and inches, percent, units and @ in words."""
    out = F.regexp_replace(text, r"\b(\d{1,2}):00\b", "$1 o'clock")
    out = F.regexp_replace(out, r"\b(\d{1,2}):0(\d)\b", "$1 oh $2")
    out = F.regexp_replace(out, r"\b(\d{1,2}):(\d{2})\b", "$1 $2")
    out = F.regexp_replace(out, r"\b(\d+)'(\d+)\"", "$1 feet $2 inches")
    for unit, name in (("%", "percent"), ("km", "kilometers"), ("kg", "kilograms"), ("mph", "miles per hour"), ("°F", "degrees fahrenheit"), ("°C", "degrees celsius")):
        out = F.regexp_replace(out, rf"\b(\d+(?:\.\d+)?) ?{unit}(?![A-Za-z])", f"$1 {name}")
    return collapsed(F.regexp_replace(out, "@", " at "))


def is_backchannel(text: Column, phrases: list[str]) -> Column:
    """Is the cleaned text one of the phrases? boolean"""
    return only_letters(text).isin(*phrases)


def _sliced(text: pa.Array, out) -> pa.Array:
    """The rows some at a time, so that a task holds little besides the batch itself."""
    return pa.concat_arrays([pa.array([None if t is None else out(t) for t in text.slice(a, SLICE).to_pylist()], pa.string()) for a in range(0, max(len(text), 1), SLICE)])


@F.arrow_udf(StringType())
def ascii_folded(text: pa.Array) -> pa.Array:
    """NFKD without what isn't ASCII."""
    return _sliced(text, lambda t: unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


@F.arrow_udf(StringType())
def composed(text: pa.Array) -> pa.Array:
    """NFC, with the typographic apostrophe as a plain one."""
    return _sliced(text, lambda t: unicodedata.normalize("NFC", t).replace("’", "'"))


@F.pandas_udf(BooleanType())
def has_unassigned(text: pd.Series) -> pd.Series:
    """Does the text hold a code point that Unicode hasn't assigned?"""
    return text.map(lambda t: None if t is None else any(unicodedata.category(c) == "Cn" for c in t))


#: Fixed value: characters that have no width.
INVISIBLE = "​‌‍⁠﻿­"


def graphemes_normalized(text: Column) -> Column:
    """NFC on one line, without invisible characters, plain quotes and hyphens."""
    out = F.regexp_replace(composed(text), f"[{INVISIBLE}]", "")
    out = F.regexp_replace(F.regexp_replace(out, "[“”„]", '"'), "[‐‑–—]", "-")
    return collapsed(out)


# number words

MOST_IN_WORDS = 10**12 - 1
#: What three digits count, the highest first.
SCALES = [(10**9, " billion"), (10**6, " million"), (1000, " thousand"), (1, "")]


def cardinal_words(n: Column, most: int = 999_999) -> Column:
    """0 to `most`, less than a trillion, in words; null beyond."""
    below_hundred = lambda x: F.when(x < 10, F.element_at(F.array(*map(F.lit, DIGITS)), x + 1)).when(x < 20, F.element_at(F.array(*map(F.lit, TEENS)), x - 9)).otherwise(F.concat_ws(" ", F.element_at(F.array(*map(F.lit, TENS)), F.floor(x / 10).cast("int") + 1), F.when(x % 10 > 0, F.element_at(F.array(*map(F.lit, DIGITS)), x % 10 + 1))))

    def below_thousand(x: Column) -> Column:
        rest = F.when((x % 100 > 0) | (x < 100), below_hundred(x % 100))
        return F.concat_ws(" ", F.when(x >= 100, F.concat(F.element_at(F.array(*map(F.lit, DIGITS)), F.floor(x / 100).cast("int") + 1), F.lit(" hundred"))), rest)

    # three digits at a time, the highest first; what stands alone may be zero
    thousands = F.transform(F.array(*(F.struct(F.floor(n.cast("long") / unit).alias("above"), F.lit(name).alias("name")) for unit, name in SCALES)), lambda s: F.struct((s["above"] % 1000).cast("int").alias("x"), s["above"].alias("above"), s["name"].alias("name")))
    said = F.transform(F.filter(thousands, lambda s: (s["x"] > 0) | ((s["name"] == "") & (s["above"] == 0))), lambda s: F.concat(below_thousand(s["x"]), s["name"]))
    return F.when((n >= 0) & (n <= most), F.array_join(said, " "))


def ordinal_words(n: Column) -> Column:
    """1 to 999 as an ordinal in words; null beyond."""
    words = cardinal_words(n)
    last = F.regexp_extract(words, r"([a-z]+)$", 1)
    table = F.create_map(*(F.lit(x) for pair in ORDINALS.items() for x in pair))
    ordinal = F.coalesce(table[last], F.when(last.endswith("y"), F.concat(F.expr("''"), F.regexp_replace(last, "y$", "ieth"))), F.concat(last, F.lit("th")))
    return F.when((n >= 1) & (n <= 999), F.concat(F.regexp_replace(words, r"[a-z]+$", ""), ordinal))


def _cardinal(n: int) -> str:
    if n < 10:
        return DIGITS[n]
    if n < 20:
        return TEENS[n - 10]
    if n < 100:
        return TENS[n // 10] + (f" {DIGITS[n % 10]}" if n % 10 else "")
    if n < 1000:
        return f"{DIGITS[n // 100]} hundred" + (f" {_cardinal(n % 100)}" if n % 100 else "")
    return f"{_cardinal(n // 1000)} thousand" + (f" {_cardinal(n % 1000)}" if n % 1000 else "")


def _ordinal(n: int) -> str:
    head, _, last = _cardinal(n).rpartition(" ")
    last = ORDINALS.get(last) or (last[:-1] + "ieth" if last.endswith("y") else last + "th")
    return f"{head} {last}".strip()


def _spoken(match: re.Match) -> str:
    text = match[0]
    if match["cents"] is not None or text.startswith("$"):
        dollars, cents = int(match["dollars"].replace(",", "") or 0), int(match["cents"] or 0)
        parts = [f"{_cardinal(dollars)} dollar{'s' * (dollars != 1)}"] * (dollars > 0 or not cents) + [f"{_cardinal(cents)} cent{'s' * (cents != 1)}"] * (cents > 0)
        return ", ".join(parts)
    digits = text.replace(",", "")
    if digits[-2:] in ("st", "nd", "rd", "th"):
        return _ordinal(int(digits[:-2])) if 0 < int(digits[:-2]) < 1_000_000 else text
    whole, dot, part = digits.partition(".")
    if int(whole) >= 1_000_000:
        return text
    return _cardinal(int(whole)) + (" point " + " ".join(DIGITS[int(d)] for d in part) if dot else "")


_NUMBER = re.compile(r"\$(?P<dollars>\d[\d,]*)(?:\.(?P<cents>\d{2}))?(?!\d)|\b\d+(?:,\d{3})*(?:st|nd|rd|th)\b|\b\d+(?:,\d{3})*(?:\.\d+)?\b")


@F.pandas_udf(StringType())
def numbers_in_words(text: pd.Series) -> pd.Series:
    """Dollars and cents, ordinals, decimals, grouped and plain integers below a million in words."""
    return text.map(lambda t: None if t is None else _NUMBER.sub(_spoken, t))


# sentences and chunks


def sentences(text: Column, abbreviations: tuple[str, ...] = ("Mr", "Mrs", "Ms", "Dr", "Prof", "St")) -> Column:
    """array<string>: cut after . ! ? and blanks, but not after a title."""
    guard = "".join(rf"(?<!\b{a}\.)" for a in abbreviations)
    return F.filter(F.transform(F.split(text, rf"(?<=[.!?]){guard}\s+"), F.trim), lambda s: s != "")


def chunks_for_inference(text: Column, language: Column, thresholds: dict[str, int]) -> Column:
    """array<string>: the whole text below its language's threshold of words (characters for zh), else sentences; 'en' is the default."""
    limit = F.coalesce(F.create_map(*(F.lit(x) for pair in thresholds.items() for x in pair))[language], F.lit(thresholds["en"]))
    count = F.when(language == "zh", F.length(F.regexp_replace(text, r"\s", ""))).otherwise(word_count(text))
    return F.when(count < limit, F.array(F.trim(text))).otherwise(sentences(text))


# identifiers and small conversions


def replaced_last(text: Column, old: str, new: str) -> Column:
    at = F.length(text) - F.instr(F.reverse(text), old[::-1]) - len(old) + 2
    return F.when(F.instr(text, old) == 0, text).otherwise(F.concat(F.substring(text, F.lit(1), at - 1), F.lit(new), F.substring(text, at + len(old), F.length(text))))


def file_stem(path: Column) -> Column:
    """The last part of a path without its extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[^.]*$", "")


def stem_with_span(path: Column, offset: Column, duration: Column, decimals: int = 3) -> Column:
    """file_stem and the span's start and end in units of 10**-decimals, joined by hyphens."""
    unit = 10**decimals
    return F.concat_ws("-", file_stem(path), F.round(offset * unit).cast("long").cast("string"), F.round((offset + duration) * unit).cast("long").cast("string"))


def scaled_integer(x: Column, decimals: int = 3) -> Column:
    return F.round(x * 10**decimals).cast("long")


def rounded_text(x: Column, most: int = 3, least: int = 1) -> Column:
    """A number rounded to `most` places, with at least `least` shown."""
    text = F.format_string(f"%.{most}f", F.round(x.cast("double"), most))
    return F.regexp_replace(text, rf"(\.\d{{{least}}}\d*?)0+$", "$1")


def at_path(json: Column, path: str) -> Column:
    """A dotted path in JSON text."""
    return F.get_json_object(json, "$." + path)


#: Fixed value: how an answer to a multiple-choice question is looked for, in this order.
ANSWER_PATTERNS = (r"(?i)answer\s*(?:is|:)\s*\(?([A-D])\b", r"(?i)option\s*\(?([A-D])\b", r"^\s*\(?([A-D])[).:]", r"\(([A-D])\)", r"\b([A-D])\b")


def extracted_answer(response: Column) -> Column:
    """A to D, or null if no pattern finds one."""
    found = [F.upper(F.regexp_extract(response, p, 1)) for p in ANSWER_PATTERNS]
    return F.coalesce(*(F.when(x != "", x) for x in found))
