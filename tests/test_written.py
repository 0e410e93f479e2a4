"""Numbers as they are written: each kind, every number there and back, places and times of the source words."""

import random

import pytest
from pyspark.sql import functions as F

from cantoria.functions import text as T
from cantoria.functions import written as W


def plain(text, least=13):
    return " ".join(w for w, *_ in W.written(text.split(), least))


@pytest.mark.parametrize(("spoken", "shown"), [
    ("i have twenty one cats and two dogs", "i have 21 cats and two dogs"),
    ("one hundred and five", "105"), ("two thousand and four hundred", "2400"), ("two thousand and four", "2004"), ("nineteen hundred people", "1900 people"),
    ("one million two hundred thousand three", "1200003"), ("a thousand things", "a thousand things"), ("five hundred hundred", "500 hundred"),
    ("five dollars and three cents please", "$5.03 please"), ("it was ten euros and left", "it was €10 and left"), ("fifty cents", "$0.50"), ("two point five million", "2.5 million"),
    ("three point one four percent", "3.14%"), ("nine percent", "9%"),
    ("at three thirty p m on july fourth nineteen ninety nine", "at 03:30 p.m. on july 4 1999"), ("five oh five am", "05:05 a.m."), ("half past two", "02:30"), ("quarter to one", "12:45"), ("two o'clock", "02:00"), ("thirteen p m", "13 p m"),
    ("the fifth of may two thousand four", "5 may 2004"), ("may be", "may be"), ("march twenty oh six", "march 2006"), ("june thirty one", "june 31"), ("june thirty two", "june 30 two"),
    ("the twenty first century", "the 21st century"), ("the second one", "the second one"), ("one hundred eleventh", "111th"), ("twentieth", "20th"),
    ("call five five five oh one two", "call 555012"), ("zero", "zero"), ("", ""), ("and", "and"), ("forty and", "40 and"),
])
def test_kinds(spoken, shown):
    assert plain(spoken) == shown


def test_every_number_there_and_back():
    rng = random.Random(2)
    for n in [*range(1200), *(rng.randrange(10**6) for _ in range(800))]:
        words = T._cardinal(n).split()
        assert plain(" ".join(words), 0) == str(n)
        assert max(W.cardinals(words, 0)) == (len(words), n)
        if 0 < n < 1000:
            assert max(W.ordinals(T._ordinal(n).split(), 0)) == (len(T._ordinal(n).split()), n)


def test_places_cover_the_source_in_order():
    rng = random.Random(4)
    pool = [*W.WORDS, "point", "dollars", "cents", "oh", "percent", "p", "m", "july", "of", "the", "first", "cat", "half", "past"]
    for _ in range(400):
        words = [rng.choice(pool) for _ in range(rng.randint(0, 14))]
        spans = list(dict.fromkeys((a, z) for _, _, a, z in W.written(words)))
        assert [i for a, z in spans for i in range(a, z + 1)] == list(range(len(words)))
        for w, kind, a, z in W.written(words):
            assert kind != "word" or (a == z and words[a] == w)


def test_least_weight_is_taken():
    """Against every way of cutting short texts."""
    def every(words, i):
        if i == len(words):
            yield 0.0
            return
        for j, _, kind in [(i + 1, "", "word"), *W.stretches(words, i, 13)]:
            yield from (x + W.WEIGHTS.get(kind, 1.0) for x in every(words, j))

    rng = random.Random(6)
    for _ in range(60):
        words = [rng.choice(["twenty", "five", "hundred", "and", "thousand", "dollars", "cents", "point", "cat"]) for _ in range(rng.randint(1, 8))]
        got = {(a, z): kind for _, kind, a, z in W.written(words)}
        assert abs(sum(W.WEIGHTS.get(k, 1.0) for k in got.values()) - min(every(words, 0))) < 1e-9


def test_times_go_over(spark):
    said = [("cost", 0.0, 0.2), ("Twenty", 0.3, 0.5), ("five", 0.5, 0.7), ("dollars", 0.8, 1.2), ("today", 1.3, 1.6)]
    df = spark.createDataFrame([(1, said), (2, []), (3, None)], "id int, w array<struct<word string, start double, end double>>")
    out = df.withColumn("a", W.as_written(F.transform("w", lambda x: x["word"]))).withColumn("t", W.with_times(F.col("a"), F.col("w")))
    rows = {r.id: r.t for r in out.collect()}
    assert [tuple(x) for x in rows[1]] == [("cost", "word", 0.0, 0.2), ("$25", "money", 0.3, 1.2), ("today", "word", 1.3, 1.6)]
    assert rows[2] == [] and rows[3] is None


def test_numbers_beyond_a_million_there_and_back(spark):
    numbers = [0, 99_999, 100_001, 999_999, 1_000_000, 1_000_017, 1_200_003, 20_000_000, 999_999_999, 10**9, 3_000_000_004, T.MOST_IN_WORDS]
    rows = spark.createDataFrame([(n,) for n in [*numbers, T.MOST_IN_WORDS + 1]], "n long").select("n", T.cardinal_words(F.col("n"), T.MOST_IN_WORDS).alias("w")).collect()
    said = {r.n: r.w for r in rows}
    assert said.pop(T.MOST_IN_WORDS + 1) is None
    assert said[100_001] == "one hundred thousand one" and said[1_000_017] == "one million seventeen" and said[0] == "zero"
    assert {n: plain(w, 0) for n, w in said.items()} == {n: str(n) for n in numbers}


def test_number_queries_beyond_a_million(spark, tmp_path):
    from cantoria.plans import language, texts

    part = spark.createDataFrame([(n, "a", "b", "c", 7, 905.05) for n in (19_999, 100_001, 1_200_003)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    part.write.parquet(f"{tmp_path}/part.parquet")
    assert {r.p_partkey: r.written for r in language.numbers_written(spark, str(tmp_path)).collect()} == {n: f"part {n} costs $905.05 or 7% more" for n in (19_999, 100_001, 1_200_003)}
    assert {r.p_partkey: r.cardinal for r in texts.number_words(spark, str(tmp_path)).collect()} == {19_999: "nineteen thousand nine hundred ninety nine", 100_001: "one hundred thousand one", 1_200_003: "one million two hundred thousand three"}
