"""Language identification against a plain reading of its rule, awkward rows, and held-out accuracy."""

import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from cantoria.llm.language_id import Bound, LanguageId, letter_vectors

from . import corpus as C

SF = "/root/testdata/sf0.001"


def grams(t):
    """Three letters, a gap (0) around each word."""
    import unicodedata

    words, now = [], []
    for c in t or "":
        if c.isalpha() or unicodedata.category(c)[0] == "M":
            now.append(ord(c.lower()[0]) if c.isalpha() else ord(c))
        elif now:
            words.append(now)
            now = []
    words += [now] if now else []
    return Counter((w[i - 1] if i else 0, w[i], w[i + 1] if i + 1 < len(w) else 0) for w in words for i in range(len(w)))


def profile(counted, dims, seed):
    v = lambda p: letter_vectors(np.array([p], np.uint32), dims, seed)[0].astype(int)
    return sum((n * np.roll(v(a), 2) * np.roll(v(b), 1) * v(c) for (a, b, c), n in counted.items()), np.zeros(dims, int))


def brute(rows, dims, seed):
    learned = defaultdict(Counter)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    for i, t, lang in rows:
        if lang is not None and not held(i):
            learned[lang].update(grams(t))
    protos = {k: profile(c, dims, seed) for k, c in sorted(learned.items()) if c}
    out = []
    for i, t, _ in rows:
        p = profile(grams(t), dims, seed)
        if not any(c.isalpha() for c in t or "") or not protos:
            out.append((i, held(i), "und", 0.0))
            continue
        cos = [round(float(p @ q / np.linalg.norm(p) / np.linalg.norm(q)), 9) for q in protos.values()]
        k = int(np.argmax(cos))
        out.append((i, held(i), list(protos)[k], max(0.0, cos[k])))
    return out


def rows():
    """The corpus in made-up languages: German words in some, a language of many letters, one that no text has letters for."""
    other = ["Der Fluß ist größer, straße über äpfel!", "und wo der Mann ist", "ÄPFEL UND STRASSEN"]
    out = [(i, t, "xx" if n % 3 else None) for n, (i, t) in enumerate(C.corpus()) if i != 87]
    out += [(300 + i, other[i % 3] + " wort" * i, "de") for i in range(12)]
    out += [(400 + i, "".join(chr(0x4E00 + (37 * i + 7 * j) % 160) for j in range(60)), "zh") for i in range(6)]
    return [*out, (500, "12 34 !?", "no"), (501, "éé", "xx"), (502, "नमस्ते दुनिया", "hi"), (503, "़", "hi"), (504, "नमस्ते", None)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1.0, "s") for i, t, lang in rows], "doc_id long, text string, lang string, score double, lang_pred string")


def same(found, expected):
    key = lambda r: (str(r[0]), r[2], r[3])
    assert [(*r[:3], round(r[3], 7)) for r in sorted(map(tuple, found), key=key)] == [(*r[:3], round(r[3], 7)) for r in sorted(expected, key=key)]


def test_language_id(spark):
    same(LanguageId(frame(spark, rows()), 256, 3).predicted().collect(), brute(rows(), 256, 3))


def test_sums_of_many_grams_are_exact():
    letters = np.array([0, 97, 98], np.uint32)
    counts, codes = np.array([[(1 << 25) + 1, 1]]), np.array([4, 17])
    found = Bound(letters, 64, 0).profiles(counts, codes)[0].astype(int)
    named = {(97, 97, 97): 0, (0, 97, 97): (1 << 25) + 1, (97, 98, 98): 1}
    assert (found == profile({k: n for k, n in named.items() if n}, 64, 0)).all()


def test_held_out_rows_teach_nothing(spark):
    changed = [(i, t if i is None or zlib.crc32(str(i).encode()) % 4 != 2 else "qqq www zzz", lang) for i, t, lang in rows()]
    a, b = LanguageId(frame(spark, rows()), 128).prototypes(), LanguageId(frame(spark, changed), 128).prototypes()
    assert a[0] == b[0] and (a[1] == b[1]).all()


def test_nothing_to_learn_from(spark):
    assert {(r.lang_pred, r.score) for r in LanguageId(frame(spark, [(1, "some text", None), (2, None, "en"), (3, "", None)])).predicted().collect()} == {("und", 0.0)}
    assert LanguageId(frame(spark, [])).predicted().collect() == []


def test_long_and_repeated_texts(spark):
    long = "wort straße " * 60_000
    found = LanguageId(frame(spark, [(1, long, "de"), (1, long, "de"), *[(2, "the thing", "en")] * 300, (4, "wort", None), (7, "thing", None)])).predicted().collect()
    assert {(r.doc_id, r.lang_pred) for r in found} == {(1, "de"), (2, "en"), (4, "de"), (7, "en")} and len(found) == 304


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    both = LanguageId(docs).predicted().filter("held_out").join(docs.filter("n_chars >= 20"), "doc_id")
    assert both.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97
