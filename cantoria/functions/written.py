"""Spoken numbers, money, dates and times as they are written, with the words each written word comes from.

Number words pass an automaton; rules built on it rewrite stretches of words,
each with a weight, a plain word weighs one. Of all ways to cut a text into
stretches and plain words the lightest is taken, so the longest reading wins
and nothing is rewritten twice. What a stretch is written as carries its place,
so that times of words go over to the written words.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .dates import MONTHS
from .text import DIGITS, TEENS, TENS, _ordinal

#: What a number word is, and its value.
WORDS = {w: ("unit", n) for n, w in enumerate(DIGITS) if n} | {w: ("teen", n) for n, w in enumerate(TEENS, 10)} | {w: ("ten", 10 * n) for n, w in enumerate(TENS) if w}
WORDS |= {"zero": ("zero", 0), "hundred": ("hundred", 100), "thousand": ("scale", 1000), "million": ("scale", 10**6), "billion": ("scale", 10**9), "and": ("and", 0)}
_BELOW = {"unit": "unit", "teen": "teen", "ten": "tens"}
_REST = {"unit": "full", "teen": "full", "ten": "tens"}
#: The automaton: what follows a state. A number may end in any of them but those that wait behind an `and`.
FOLLOWS = {
    "start": _BELOW | {"zero": "nothing"},
    "unit": {"hundred": "hundred", "scale": "scale"},
    "teen": {"hundred": "hundred", "scale": "scale"},
    "tens": {"unit": "full", "scale": "scale"},
    "full": {"scale": "scale"},
    "hundred": _REST | {"and": "and", "scale": "scale"},
    "scale": _BELOW | {"and": "scale and"},
    "and": _REST,
    "scale and": _BELOW,
    "nothing": {},
}
#: Ordinal -> the cardinal's last word.
LAST = {_ordinal(n).split(" ")[-1]: c for n, c in [*enumerate(DIGITS[1:], 1), *enumerate(TEENS, 10), *((10 * n, w) for n, w in enumerate(TENS) if w)]} | {"hundredth": "hundred", "thousandth": "thousand"}
CURRENCIES = {"dollar": "$", "dollars": "$", "euro": "€", "euros": "€", "pound": "£", "pounds": "£"}
CENTS = ("cent", "cents")
HALVES = {("a", "m"): "a.m.", ("p", "m"): "p.m.", ("am",): "a.m.", ("pm",): "p.m.", ("a.m.",): "a.m.", ("p.m.",): "p.m."}
_MONTHS = {m.lower() for m in MONTHS}
#: What a stretch weighs by its kind.
WEIGHTS = {"date": 0.80, "time": 0.81, "money": 0.82, "measure": 0.83, "decimal": 0.84, "telephone": 0.85, "ordinal": 0.90, "cardinal": 0.95}
RESULT = "array<struct<word:string,kind:string,first:int,last:int>>"


def cardinals(words: list[str], i: int) -> Iterator[tuple[int, int]]:
    """(end, value) of every whole number that begins at i, the shortest first."""
    state, total, group, scale = "start", 0, 0, float("inf")
    for j in range(i, len(words)):
        kind, value = WORDS.get(words[j], (None, 0))
        if kind not in FOLLOWS[state] or kind == "scale" and value >= scale:
            return
        state = FOLLOWS[state][kind]
        if kind == "hundred":
            group *= 100
        elif kind == "scale":
            total, group, scale = total + group * value, 0, value
        else:
            group += value
        if not state.endswith("and"):
            yield j + 1, total + group


def _last(found: Iterator[tuple[int, int]]) -> tuple[int, int] | None:
    return next(iter([*found][-1:]), None)


def ordinals(words: list[str], i: int) -> Iterator[tuple[int, int]]:
    for j in range(i, min(len(words), i + 12)):
        if words[j] in LAST:
            whole = [*words[i:j], LAST[words[j]]]
            yield from ((j + 1, v) for end, v in cardinals(whole, 0) if end == len(whole) and v)
        elif words[j] not in WORDS:
            return


def years(words: list[str], i: int) -> Iterator[tuple[int, int]]:
    """Nineteen ninety nine, twenty oh five, two thousand four."""
    for j, century in cardinals(words, i):
        if 10 <= century <= 20 and j - i == 1 and j < len(words):
            if words[j] == "oh" and WORDS.get(words[j + 1] if j + 1 < len(words) else "", ("", 0))[0] == "unit":
                yield j + 2, 100 * century + WORDS[words[j + 1]][1]
            yield from ((k, 100 * century + y) for k, y in cardinals(words, j) if 10 <= y <= 99)
        if 1000 <= century <= 2999:
            yield j, century


def _decimals(words: list[str], i: int) -> Iterator[tuple[int, str]]:
    for j, whole in cardinals(words, i):
        if j < len(words) and words[j] == "point":
            k = j + 1
            while k < len(words) and (words[k] in DIGITS or words[k] == "oh"):
                k += 1
            if k > j + 1:
                yield k, f"{whole}." + "".join("0" if w == "oh" else str(DIGITS.index(w)) for w in words[j + 1 : k])


def _days(words: list[str], i: int) -> Iterator[tuple[int, int]]:
    yield from ((j, d) for f in (ordinals, cardinals) for j, d in f(words, i) if 1 <= d <= 31)


def _dates(words: list[str], i: int) -> Iterator[tuple[int, str]]:
    if words[i] in _MONTHS:
        for j, d in _days(words, i + 1):
            yield j, f"{words[i]} {d}"
            yield from ((k, f"{words[i]} {d} {y}") for k, y in years(words, j))
        yield from ((k, f"{words[i]} {y}") for k, y in years(words, i + 1))
    if words[i] == "the":
        for j, d in ordinals(words, i + 1):
            if 1 <= d <= 31 and j + 1 < len(words) and words[j] == "of" and words[j + 1] in _MONTHS:
                yield j + 2, f"{d} {words[j + 1]}"
                yield from ((k, f"{d} {words[j + 1]} {y}") for k, y in years(words, j + 2))


def _times(words: list[str], i: int) -> Iterator[tuple[int, str]]:
    past = {"half": 30, "quarter": 15}
    if words[i] in past and i + 1 < len(words) and words[i + 1] in ("past", "to"):
        for j, h in cardinals(words, i + 2):
            if 1 <= h <= 12:
                yield j, f"{h:02d}:{past[words[i]]:02d}" if words[i + 1] == "past" else f"{h - 1 or 12:02d}:{60 - past[words[i]]:02d}"
        return
    for j, h in cardinals(words, i):
        if not 1 <= h <= 12:
            continue
        if words[j : j + 1] == ["o'clock"]:
            yield j + 1, f"{h:02d}:00"
        minutes = [(j, 0), *((k, m) for k, m in cardinals(words, j) if 10 <= m <= 59)]
        if words[j : j + 1] == ["oh"] and j + 1 < len(words) and words[j + 1] in DIGITS[1:]:
            minutes.append((j + 2, DIGITS.index(words[j + 1])))
        for k, m in minutes:
            yield from ((k + len(half), f"{h:02d}:{m:02d} {text}") for half, text in HALVES.items() if tuple(words[k : k + len(half)]) == half)


def _money(words: list[str], i: int) -> Iterator[tuple[int, str]]:
    for j, amount in [*((j, str(v)) for j, v in cardinals(words, i)), *_decimals(words, i)]:
        unit = words[j] if j < len(words) else ""
        if unit in CENTS and "." not in amount and int(amount) < 100:
            yield j + 1, f"$0.{int(amount):02d}"
        if unit in CURRENCIES:
            yield j + 1, CURRENCIES[unit] + amount
            at = j + 1 + (words[j + 1 : j + 2] == ["and"])
            yield from ((k + 1, f"{CURRENCIES[unit]}{amount}.{c:02d}") for k, c in cardinals(words, at) if "." not in amount and c < 100 and k < len(words) and words[k] in CENTS)


def _measures(words: list[str], i: int) -> Iterator[tuple[int, str]]:
    for j, amount in [*cardinals(words, i), *_decimals(words, i)]:
        if words[j : j + 1] == ["percent"]:
            yield j + 1, f"{amount}%"


def _telephone(words: list[str], i: int) -> Iterator[tuple[int, str]]:
    j = i
    while j < len(words) and (words[j] in DIGITS or words[j] == "oh" and j > i):
        j += 1
    if j - i >= 3:
        yield j, "".join("0" if w == "oh" else str(DIGITS.index(w)) for w in words[i:j])


def stretches(words: list[str], i: int, least: int) -> Iterator[tuple[int, str, str]]:
    """(end, text, kind) of what may be rewritten from word i on."""
    yield from ((j, t, kind) for kind, rule in (("date", _dates), ("time", _times), ("money", _money), ("measure", _measures), ("decimal", _decimals), ("telephone", _telephone)) for j, t in rule(words, i))
    yield from ((j, f"{n}{'th' if 10 <= n % 100 <= 20 else {1: 'st', 2: 'nd', 3: 'rd'}.get(n % 10, 'th')}", "ordinal") for j, n in ordinals(words, i) if n >= least)
    yield from ((j, str(n), "cardinal") for j, n in cardinals(words, i) if n >= least)


def written(words: list[str], least: int = 13) -> list[tuple[str, str, int, int]]:
    """(written word, kind, first and last source word): numbers below `least` stay words, unless a kind other than cardinal or ordinal takes them."""
    lower = [w.lower() for w in words]
    best: list[tuple[float, int, str, str]] = [(0.0, 0, "", "")] * (len(words) + 1)  # from here to the end: weight, next place, text, kind
    for i in range(len(words) - 1, -1, -1):
        options = [(1.0 + best[i + 1][0], i + 1, words[i], "word")]
        options += [(WEIGHTS[kind] + best[j][0], j, text, kind) for j, text, kind in stretches(lower, i, least)]
        best[i] = min(options, key=lambda o: (round(o[0], 9), -o[1]))
    out, i = [], 0
    while i < len(words):
        _, j, text, kind = best[i]
        out += [(t, kind, i, j - 1) for t in (text.split(" ") if kind != "word" else [text])]
        i = j
    return out


def as_written(words: Column, least: int = 13) -> Column:
    """array<struct<word, kind, first, last>> of an array of words; null for null, null words are empty ones."""

    @pandas_udf(RESULT)
    def write(column: pd.Series) -> pd.Series:
        return pd.Series([None if w is None else [dict(zip(("word", "kind", "first", "last"), r, strict=True)) for r in written([x or "" for x in w], least)] for w in column], dtype=object)

    return write(words)


def with_times(aligned: Column, words: Column) -> Column:
    """The written words with the begin of their first and the end of their last source word: words is array<struct<word, start, end>>."""
    return F.transform(aligned, lambda x: F.struct(x["word"].alias("word"), x["kind"].alias("kind"), F.get(words, x["first"])["start"].alias("start"), F.get(words, x["last"])["end"].alias("end")))
