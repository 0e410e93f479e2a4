"""Hard negatives against brute force: awkward rows, ties, copies, several blocks of anchors; the bounds hold and put rows aside."""

import math
import random

import numpy as np
import pytest

from cantoria.llm import hard_negatives
from cantoria.llm.hard_negatives import HardNegatives, bounds, centroids, coded


def rows(seed=1):
    """(vec_id, embedding, label): clusters, copies of one vector, short and empty vectors, nulls, non-finite components, shared ids."""
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(10)] for _ in range(6)]
    out = [(i, [x + rng.gauss(0, 0.4) for x in rng.choice(centres)], rng.randrange(10)) for i in range(420)]
    out += [(i, centres[0], i % 10) for i in range(1000, 1120)]
    out += [(2000, [0.5, -0.5], 3), (2001, [], 3), (2100, None, 3), (2200, centres[1], None), (2300, [*centres[1][:9], float("nan")], 1), (2400, [*centres[1][:9], None], 1), (2500, [*centres[1][:9], float("inf")], 1)]
    out += [(None, centres[1], 1), (None, centres[2], 4), (2600, centres[1], 1), (2600, centres[2], 1), (2600, centres[2], 1), (2601, centres[2], 2), (2601, centres[2], 2), (-300, centres[3], 5), (2700, [-x for x in centres[0]], 77)]
    return out


def brute(rows, positives=5, negatives=5, least=80, most=100):
    kept = []
    for i, v, label in rows:
        if v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        kept.append((i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    rank = lambda s, i: (-s, -(2**63) if i is None else i)
    out = []
    for anchor in sorted({r for r in kept if r[0] is not None and r[0] % 100 == 0}):
        scored = [(sum(a * b for a, b in zip(anchor[2], r[2])), r) for r in kept]
        own = sorted(((s, r[0]) for s, r in scored if r[1] == anchor[1] and r[0] != anchor[0]), key=lambda x: rank(*x))[:positives]
        for ps, p in own:
            there = sorted(((s, r[0]) for s, r in scored if r[1] != anchor[1] and least * ps <= 100 * s <= most * ps), key=lambda x: rank(*x))[:negatives]
            out += [(anchor[0], p, k + 1, i, ps, s) for k, (s, i) in enumerate(there)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x") for i, v, label in rows], "vec_id long, embedding array<float>, label int, rank int, codes string")


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("how", [{}, {"block": 30}, {"positives": 2, "negatives": 40, "least_percent": 95, "most_percent": 105}, {"sample": 3}])
def test_hard_negatives(spark, monkeypatch, how):
    if how:
        monkeypatch.setattr(hard_negatives, "ROWS", 50)
    named = {"positives": "positives", "negatives": "negatives", "least_percent": "least", "most_percent": "most"}
    assert ordered(HardNegatives(frame(spark, rows()), **how).mined().collect()) == ordered(brute(rows(), **{named[k]: v for k, v in how.items() if k in named}))


def test_bounds_hold_and_put_rows_aside():
    rng = np.random.RandomState(5)
    x = np.rint(rng.normal(0, 40, (3000, 16)) + 400 * rng.normal(0, 1, (8, 16))[rng.randint(0, 8, 3000)]).astype(np.int64)
    books = centroids(x[:500].reshape(500, -1, 4).astype(float), 64, 8, 0)
    lower, upper = bounds(x[:20], books, *coded(x, books))
    exact = x[:20] @ x.T
    assert (lower <= exact).all() and (exact <= upper).all()
    tenth = np.sort(lower, axis=1)[:, -10]
    assert (upper >= tenth[:, None]).mean() < 0.25  # most rows are put aside unread


def test_huge_components_stay_within_64_bits(spark):
    found = HardNegatives(frame(spark, [(0, [1e30, -1e30], 1), (1, [3e38, 1.0], 1), (2, [1e30, 1.0], 2)])).mined().collect()
    assert [(r.anchor_id, r.positive_id, r.negative_id) for r in found] == [(0, 2, 1)]  # 0 is divisible by 7: its label is the next one


def test_empty_tables(spark):
    assert HardNegatives(frame(spark, [])).mined().collect() == []
    assert HardNegatives(frame(spark, [(1, [1.0], 1), (None, None, None)])).mined().collect() == []
    assert HardNegatives(frame(spark, [(100, [1.0], 1)])).mined().collect() == []
