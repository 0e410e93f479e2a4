"""Floors of rare rows by whole entities, against taking them one by one."""

import hashlib
import random

from pyspark.sql import functions as F

from cantoria.operators import splits as P


def rows(seed, n=900):
    rng = random.Random(seed)
    out = []
    for e in range(n // 6):
        split = rng.choices(["train", "val", "test"], [8, 2, 1])[0]
        rare = rng.random() < 0.3
        out += [(f"e{e}" if e % 17 else None, split, rare and rng.random() < 0.7) for _ in range(rng.randint(1, 11))]
    return [*out, ("both", "train", True), ("both", "val", True), ("x", "train", None)]


def brute(rows, ratio, most):
    """Entities in order of md5, while the floor isn't met."""
    part = lambda s: [r for r in rows if r[1] == s]
    train, val = part("train"), part("val")
    required = ratio * sum(bool(r[2]) for r in train) / len(train)
    have, size, gone, moved = sum(bool(r[2]) for r in val), len(val), 0, set()
    budget = max(1, int(len(train) * most))
    by = {}
    for e, s, t in rows:
        if e is not None:
            by.setdefault(e, []).append((s, bool(t)))
    for e in sorted((e for e, r in by.items() if {s for s, _ in r} == {"train"} and sum(t for _, t in r) > required * len(r)), key=lambda e: hashlib.md5(e.encode()).hexdigest()):
        n, t = len(by[e]), sum(t for _, t in by[e])
        if have >= required * size or gone + n > budget:
            break
        moved.add(e)
        have, size, gone = have + t, size + n, gone + n
    return moved


def test_floors(spark):
    for seed, ratio, most in ((1, 0.7, 0.02), (2, 1.3, 0.2), (3, 2.0, 0.1), (4, 0.1, 0.5), (5, 3.0, 0.9)):
        data = rows(seed)
        df = spark.createDataFrame(data, "entity string, split string, tail boolean")
        after = P.with_floor(df, "entity", F.col("tail"), least_ratio=ratio, most_moved=most)
        found = [tuple(r) for r in after.collect()]
        moved = brute(data, ratio, most)
        expected = [(e, "val" if e in moved else s, t) for e, s, t in data]
        assert sorted(map(str, found)) == sorted(map(str, expected))
        report = P.floor_report(df, after, F.col("tail"), least_ratio=ratio)
        assert report["moved"] == sum(e in moved for e, _, _ in data)
        assert (report["missing"] == 0) == (report["reached"] >= report["required"])
    one = spark.createDataFrame([("a", "train", True), ("b", "train", True), ("c", "val", False)], "entity string, split string, tail boolean")
    left = P.with_floor(one, "entity", F.col("tail"), least_ratio=0.9)
    report = P.floor_report(one, left, F.col("tail"), least_ratio=0.9)
    assert report["moved"] == 1 and report["missing"] == 1


def test_without_one_of_the_splits(spark):
    df = spark.createDataFrame([("a", "train", True)], "entity string, split string, tail boolean")
    assert P.moved_entities(df, "entity", F.col("tail")).collect() == []
    assert [r.split for r in P.test_only(df).collect()] == ["test"]
    assert P.floor_report(df, df, F.col("tail"))["moved"] == 0
