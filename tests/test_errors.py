"""Alignments and common subsequences against full tables."""

import random

from pyspark.sql import functions as F

from cantoria.functions import errors as E
from cantoria.operators import scoring as S


def table(a, b):
    cost = [[i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            cost[i][j] = min(cost[i - 1][j] + 1, cost[i][j - 1] + 1, cost[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
    return cost


def way(a, b):
    """Back through the whole table: diagonal first, then up."""
    cost, out, i, j = table(a, b), [], len(a), len(b)
    while i or j:
        if i and j and cost[i][j] == cost[i - 1][j - 1] + (a[i - 1] != b[j - 1]):
            i, j = i - 1, j - 1
            out.append((i, j))
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            i -= 1
            out.append((i, None))
        else:
            j -= 1
            out.append((None, j))
    return out[::-1]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def pairs(n=300):
    rng = random.Random(5)
    for _ in range(n):
        yield tuple([rng.choice("abcd") for _ in range(rng.choice((0, 1, 3, 9, 40)))] for _ in range(2))


def test_alignments_go_the_way_of_the_whole_table():
    for a, b in pairs():
        assert E.aligned(a, b) == way(a, b)


def test_long_alignments_need_little():
    import tracemalloc

    rng = random.Random(1)
    a = [str(rng.randrange(500)) for _ in range(3000)]
    b = [x for x in a if rng.random() < 0.9]
    tracemalloc.start()
    found = E.aligned(a, b)
    assert tracemalloc.get_traced_memory()[1] < 12e6  # the whole table would take 33 MB and more
    tracemalloc.stop()
    assert sum(i is None or j is None or a[i] != b[j] for i, j in found) == len(a) - len(b)


def test_common_subsequences():
    for a, b in pairs():
        assert E.common_subsequence(a, b) == lcs(a, b)
    long = [str(i % 977) for i in range(40_000)]
    assert E.common_subsequence(long, long[::2]) == 20_000


def test_rouge_l(spark):
    rows = [("the cat sat on the mat", "The cat on a mat"), ("", "x"), (None, None), ("a b", "b a"), ("same words", "same words")]
    out = S.rouge_l(spark.createDataFrame(rows, "r string, h string"), "r", "h").collect()
    assert [(r.common, round(r.precision, 4), round(r.recall, 4), round(r.f1, 4)) for r in out] == [(4, 0.8, 0.6667, 0.7273), (0, 0.0, 0.0, 0.0), (0, 0.0, 0.0, 0.0), (1, 0.5, 0.5, 0.5), (2, 1.0, 1.0, 1.0)]


def test_distances_are_of_whole_words(spark):
    data = [(a, b) for a, b in pairs(60)]
    df = spark.createDataFrame([(i, [x * 3 for x in a], [x * 3 for x in b]) for i, (a, b) in enumerate(data)], "i int, a array<string>, b array<string>")
    found = {r.i: r.d for r in df.select("i", E.sequence_distance(F.col("a"), F.col("b")).alias("d")).collect()}
    assert found == {i: table(a, b)[-1][-1] for i, (a, b) in enumerate(data)}
