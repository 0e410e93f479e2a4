"""Queries of the package and the SQL they are held against."""

from __future__ import annotations

from .plans import corpus, files, flows, language, registered, segments, similarity, tables, talk, texts

FLAGSHIP = "corpus_profile"
MODULES = (corpus, segments, talk, similarity, flows, files, texts, tables, language)


def queries() -> dict:
    return dict(registered.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registered.SQL)
