"""Dates and abbreviations in words."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import _cardinal, _ordinal

#: Month names, and abbreviations with what they stand for.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
ABBREVIATIONS = {
    "mrs": "misess", "mr": "mister", "dr": "doctor", "st": "saint", "co": "company", "jr": "junior", "maj": "major", "gen": "general", "drs": "doctors",
    "rev": "reverend", "lt": "lieutenant", "hon": "honorable", "sgt": "sergeant", "capt": "captain", "esq": "esquire", "ltd": "limited", "col": "colonel", "ft": "fort",
}
#: What an abbreviation stands for depends on where it stands: role -> abbreviation -> words.
BY_ROLE = {"road": {"st": "street", "dr": "drive", "ave": "avenue", "blvd": "boulevard", "rd": "road", "ln": "lane", "hwy": "highway"}, "place": {"st": "saint", "ft": "fort", "mt": "mount"}}
_DATE = re.compile(r"\b(?P<y>\d{4})-(?P<m>\d{1,2})-(?P<d>\d{1,2})\b|\b(?P<m2>\d{1,2})/(?P<d2>\d{1,2})/(?P<y2>\d{4})\b")


def _year(y: int) -> str:
    if 2000 <= y < 2010 or y % 1000 == 0:
        return _cardinal(y)
    high, low = divmod(y, 100)
    return f"{_cardinal(high)} hundred" if low == 0 else f"{_cardinal(high)} {'oh ' if low < 10 else ''}{_cardinal(low)}"


def _spoken(m: re.Match) -> str:
    y, month, d = (int(m[a] or m[b]) for a, b in (("y", "y2"), ("m", "m2"), ("d", "d2")))
    if not (1 <= month <= 12 and 1 <= d <= 31):
        return m[0]
    return f"{MONTHS[month - 1]} {_ordinal(d)}, {_year(y)}"


@F.pandas_udf(StringType())
def dates_in_words(text: pd.Series) -> pd.Series:
    """2024-03-05 and 3/5/2024 as March fifth, twenty twenty four; what isn't a date stays."""
    return text.map(lambda t: None if t is None else _DATE.sub(_spoken, t))


def expanded_abbreviations(text: Column, table: dict[str, str] = ABBREVIATIONS) -> Column:
    """Abbreviations with a period as whole words."""
    for short, full in table.items():
        text = F.regexp_replace(text, rf"(?i)\b{short}\.(?=\s|$)", full)
    return text


def expanded_by_role(text: Column, role: Column) -> Column:
    """Abbreviations as their row's role reads them, the longest first; other roles leave the text."""
    out = F
    for name, table in BY_ROLE.items():
        reading = text
        for short in sorted(table, key=lambda s: (-len(s), s)):
            reading = F.regexp_replace(reading, rf"(?i)\b{short}\b\.?", table[short])
        out = out.when(role == name, reading)
    return out.otherwise(text)


def role_of(slots: Column) -> Column:
    """The role that filled slots (a map) give: road, place or other."""
    has = lambda *names: F.exists(F.map_keys(F.map_filter(slots, lambda k, v: v.isNotNull() & (v != ""))), lambda k: k.isin(*names))
    return F.when(has("road", "road_name", "street"), "road").when(has("place", "city", "poi"), "place").otherwise("other")
