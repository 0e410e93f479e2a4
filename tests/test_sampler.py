"""Specs compiled to batches: constraints, filters, windows, folds against plain ones, steps and resuming; packs filled and taken apart."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from cantoria.operators import batching as B
from cantoria.operators import packs as P
from cantoria.operators import sampler as A


def rows(n=300, seed=1):
    rng = random.Random(seed)
    out = [(f"r{i}", round(rng.choice((rng.uniform(0.1, 4), rng.uniform(4, 40))), 2), rng.randint(0, 60), rng.choice(["pass", "fail", None]), rng.choice([None, rng.random()])) for i in range(n)]
    return [*out, ("r3", out[3][1], out[3][2], "pass", None), ("none", None, None, None, None), ("long", 500.0, 900, "pass", 0.0)]


def frame(spark, data):
    return spark.createDataFrame(data, "id string, duration double, n_tokens int, validation_status string, cer double")


def test_constraints():
    c = A.sampling_constraint
    assert c({"batch_size": 4}) == A.Constraint("duration", most=4)
    assert c({"batch_duration": 9.0, "quadratic_duration": 3.0}) == A.Constraint("duration", budget=9.0, quadratic=3.0)
    assert c({"use_multimodal_sampling": True, "batch_tokens": 9, "quadratic_factor": 2}) == A.Constraint("tokens", budget=9, quadratic=2)
    assert c({"bucket_duration_bins": [1, 2], "bucket_batch_size": [4, 2]}) == A.Constraint("duration", (1, 2), (4, 2))
    assert c({"bucket_duration_bins": [[1, 5], [2, 5]], "bucket_batch_size": [4, 2], "max_tps": 3, "bucketing_2d_strict_mode": False}) == A.Constraint("both", ((1, 5), (2, 5)), (4, 2), strict=False, ratio=3)
    for bad in ({}, {"batch_tokens": 4}, {"use_multimodal_sampling": True, "batch_duration": 4}, {"bucket_batch_size": [1]}, {"bucket_duration_bins": [1, 2], "bucket_batch_size": [1]}, {"bucket_duration_bins": [1]}):
        with pytest.raises(ValueError):
            c(bad)


def plain(data, spec):
    """(id, bucket, slot, batch) by the rules, row by row."""
    kept = []
    for r in data:
        ident, d, t, status, cer = r
        if d is not None and not spec.get("min_duration", -1) <= d <= spec.get("max_duration", math.inf):
            continue
        if t is not None and not spec.get("min_tokens", 0) <= t <= spec.get("max_tokens", math.inf):
            continue
        if spec.get("keep") and status not in (None, spec["keep"]) or cer is not None and cer > spec.get("max_cer", math.inf):
            continue
        tokens = (t or 0) + (math.ceil((d or 0) / spec["token_equivalent_duration"]) if "token_equivalent_duration" in spec else 0)
        x = tokens if spec.get("use_multimodal_sampling") else (d or 0.0)
        bins = spec.get("bucket_duration_bins")
        bucket = next((i for i, b in enumerate(bins) if x <= b), None) if bins else 0
        if bucket is not None:
            h = hashlib.md5(f"{ident}:{spec['seed']}".encode()).hexdigest()
            kept.append((bucket, int(h[:7], 16) % spec["slots"], h, ident, x))
    out, at = [], None
    for bucket, slot, _, ident, x in sorted(kept):
        q = spec.get("quadratic_duration") or spec.get("quadratic_factor")
        x = x + x * x / q if q else x
        if (bucket, slot) != at:
            at, batch, n, longest = (bucket, slot), 0, 0, 0.0
        if "bucket_batch_size" in spec:
            close = n == spec["bucket_batch_size"][bucket]
        else:
            close = n and (n + 1 > (spec.get("batch_size") or math.inf) or (n + 1) * max(longest, x) > (spec.get("batch_duration") or spec.get("batch_tokens") or math.inf))
        if close:
            batch, n, longest = batch + 1, 0, 0.0
        n, longest = n + 1, max(longest, x)
        out.append((ident, bucket, slot, batch))
    return sorted(out)


BASE = {"slots": 3, "seed": 5}


@pytest.mark.parametrize("spec", [
    {"batch_size": 7}, {"batch_duration": 60.0, "min_duration": 0.5, "max_duration": 100.0}, {"batch_duration": 60.0, "batch_size": 5, "quadratic_duration": 20.0, "bucket_duration_bins": [2.0, 8.0, 50.0]},
    {"bucket_duration_bins": [2.0, 8.0, 50.0], "bucket_batch_size": [9, 4, 1], "keep": "pass", "max_cer": 0.5},
    {"use_multimodal_sampling": True, "batch_tokens": 200, "token_equivalent_duration": 0.5, "min_tokens": 2}, {"use_multimodal_sampling": True, "batch_tokens": 300, "quadratic_factor": 50.0, "batch_size": 12, "max_tokens": 50},
])
def test_batches(spark, spec):
    spec = BASE | spec
    found = A.batches(frame(spark, rows()), spec).collect()
    assert sorted((r.id, r.bucket, r.slot, r.batch) for r in found) == plain(rows(), spec)
    whole = A.sampled(frame(spark, rows()), spec).select("id", "bucket", "slot", "batch", "step").collect()
    steps = {(r.bucket, r.slot, r.batch): r.step for r in whole}
    assert sorted(steps.values()) == list(range(len(steps)))
    rest = A.sampled(frame(spark, rows()).repartition(5), spec, done=len(steps) // 2).select("id", "bucket", "slot", "batch", "step").collect()
    assert sorted(rest) == sorted(r for r in whole if r.step >= len(steps) // 2)
    assert {r.step for r in A.sampled(frame(spark, rows()), spec | {"seed": 6}).collect()} != set() and [r.step for r in sorted(whole)] != sorted(r.step for r in whole)


def test_two_dimensions_and_bins_of_equal_mass(spark):
    spec = BASE | {"bucket_duration_bins": [[5, 10], [5, 60], [50, 20], [50, 70]], "bucket_batch_size": [8, 4, 2, 1]}
    for r in A.batches(frame(spark, rows()), spec).collect():
        a, b = spec["bucket_duration_bins"][r.bucket]
        assert r.duration_ <= a and r.tokens_ <= b and (a == 5 or r.duration_ > 5)
    even = A.batches(frame(spark, rows()), BASE | {"use_bucketing": True, "num_buckets": 4, "batch_duration": 50.0}).groupBy("bucket").agg(F.sum("duration_").alias("s")).collect()
    assert len(even) == 4


def test_windows(spark):
    df = spark.createDataFrame([("a", 10.0), ("b", 3.0), ("c", 0.0)], "id string, duration double")
    cut = A.windowed(df, {"cut_into_windows_duration": 4.0, "cut_into_windows_hop": 3.0}).orderBy("id", "offset").collect()
    assert [(r.id, r.offset, r.duration) for r in cut] == [("a", 0.0, 4.0), ("a", 3.0, 4.0), ("a", 6.0, 4.0), ("b", 0.0, 3.0)]
    assert [r.duration for r in A.windowed(df, {"truncate_duration": 3.5}).orderBy("id").collect()] == [3.5, 3.0, 0.0]
    twice = A.sampled(df, BASE | {"batch_duration": 8.0, "cut_into_windows_duration": 4.0}).collect()
    assert sorted((r.id, r.offset) for r in twice) == [("a", 0.0), ("a", 4.0), ("a", 8.0), ("b", 0.0)]


def test_nothing_to_sample(spark):
    assert A.sampled(frame(spark, []), BASE | {"batch_size": 3}).collect() == []


def test_packs_come_apart_as_they_were(spark):
    rng = random.Random(2)
    data = [(i, [rng.randrange(99) for _ in range(rng.choice((0, 1, 5, 30, 70)))], None) for i in range(200)]
    data = [(i, x, None if i % 5 == 0 else [rng.random() < 0.5 for _ in x]) for i, x, _ in data] + [(900, None, None)]
    df = spark.createDataFrame(data, "id int, input_ids array<int>, loss_mask array<boolean>").withColumn("n", F.greatest(F.size("input_ids"), F.lit(0)))
    filled = P.filled(B.packed(df, "id", "n", 64, slots=3), df, "id")
    for r in filled.collect():
        assert len(r.input_ids) == len(r.loss_mask) and (len(r.input_ids) <= 64 or len(set(r.seq_start_id)) == 1) and r.seq_start_id == sorted(r.seq_start_id)
    back = {r.id: (r.input_ids, r.loss_mask) for r in P.unfilled(filled, "id").collect()}
    assert back == {i: (x or [], m if m is not None else [False] * len(x or [])) for i, x, m in data}
    sizes = [(len(r.input_ids), len(r["keys"])) for r in filled.collect()]
    figures = P.pack_figures(filled, 64).first()
    assert (figures.packs, figures.max_samples_per_bin, figures.min_packed_seqlen, figures.dataset_max_seqlen) == (len(sizes), max(k for _, k in sizes), min(n for n, _ in sizes), 70)
    assert figures.packing_efficiency == pytest.approx(100 * sum(n for n, _ in sizes) / 64 / len(sizes), abs=0.01)


def test_label_masks(spark):
    df = spark.createDataFrame([([5, 6, 7, 8], [False, False, True, True], 2), ([], [], 0)], "ids array<int>, mask array<boolean>, at int")
    found = df.select(P.label_mask(F.col("ids"), mask=F.col("mask")).alias("a"), P.label_mask(F.col("ids"), answer_start=F.col("at")).alias("b")).collect()
    assert found[0].a == [False, True, True, False] and found[0].b == [False, True, True, True] and found[1].a == found[1].b == []
    with pytest.raises(ValueError):
        P.label_mask(F.col("ids"))


def test_order_is_restored(spark):
    rng = random.Random(3)
    data = [(i, float(rng.randint(1, 9))) for i in range(100)]
    df = spark.createDataFrame(data, "place int, duration double").repartition(7)
    run = P.presorted(df, "place")
    expected = sorted(data, key=lambda r: (-r[1], r[0]))
    assert [(r.place, r.duration) for r in sorted(run.collect(), key=lambda r: r.order)] == expected
    said = spark.createDataFrame([(i, f"said {p}") for i, (p, _) in enumerate(expected)], "order long, text string")
    assert sorted((r.place, r.text) for r in P.restored(said, run, "place").collect()) == [(i, f"said {i}") for i in range(100)]
    missing = spark.createDataFrame([(0, 1.0), (1, None), (2, 5.0)], "place int, duration double")
    assert sorted((r.order, r.place) for r in P.presorted(missing, "place").collect()) == [(0, 0), (1, 1), (2, 2)]
