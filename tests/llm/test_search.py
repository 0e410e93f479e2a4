"""Lexical search against brute force: awkward rows, ties, small windows, several blocks of items, empty tables."""

import math
import re
from collections import Counter

import pytest

from cantoria.llm import lexical_search
from cantoria.llm.lexical_search import LexicalSearch

from . import corpus as C

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, top):
    """(item_id, rank, doc_id, score); an id of null counts as least."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(x for _, b in bags for x in b)
    out = []
    for item_id, t in items:
        found = []
        for i, b in bags:
            m = 75 + (25 * sum(b.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((10**9 * b[x]) // (1000 * b[x] + 12 * m)) for x in terms(t) if b[x])
            if s > 0:
                found.append((-s, -(2**63) if i is None else i))
        out += [(item_id, k + 1, None if i == -(2**63) else i, -s) for k, (s, i) in enumerate(sorted(found)[:top])]
    return out


def items():
    rows = C.corpus()
    return [(1, rows[3][1]), (2, rows[7][1][:200]), (3, None), (4, ""), (5, "zzz unknown"), (6, "don't DON'T don 日本"), (None, rows[61][1]), (7, rows[5][1]), (7, rows[5][1]), (8, " ".join(t or "" for _, t in rows[:30]))]


def of(spark, docs, asked, **how):
    tables = C.frame(spark, docs), spark.createDataFrame([(i, t, 0, "x") for i, t in asked], "item_id long, text string, doc_id int, score string")
    return LexicalSearch(*tables, **how).ranked().collect()


@pytest.mark.parametrize("how", [{}, {"window": 8}, {"window": 8, "block_terms": 40, "top": 3}, {"top": 500}])
def test_search(spark, monkeypatch, how):
    if how.get("window"):
        monkeypatch.setattr(lexical_search, "WINDOW_POSTINGS", 300)
    assert C.by_row(of(spark, C.corpus(), items(), **how)) == C.by_row(brute(C.corpus(), items(), how.get("top", 20)))


def test_ties_go_to_smaller_ids_across_tasks(spark):
    docs = [(i, "alpha beta gamma") for i in range(500, 0, -1)] + [(None, "alpha beta gamma")] * 3 + [(i, "other words") for i in range(600, 1400)]
    found = sorted((r.rank, r.doc_id) for r in of(spark, docs, [(1, "Alpha")]))
    assert found == list(zip(range(1, 21), [None] * 3 + list(range(1, 18))))


def test_terms_that_all_documents_have_weigh_what_the_rule_says(spark):
    docs = [(i, "the the common") for i in range(9)]
    assert C.by_row(of(spark, docs, [(1, "the common the")])) == C.by_row(brute(docs, [(1, "the common the")], 20))


def test_search_of_empty_tables(spark):
    assert of(spark, [], items()) == of(spark, C.corpus(), []) == of(spark, [(1, None)], items()) == of(spark, C.corpus(), [(1, None)]) == []
