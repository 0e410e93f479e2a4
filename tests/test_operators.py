import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cantoria.operators import batching as B
from cantoria.operators import conversations as C
from cantoria.operators import dedup as D
from cantoria.operators import filters as X
from cantoria.operators import intervals as I
from cantoria.operators import joins as J
from cantoria.operators import scoring as S
from cantoria.operators import vectors as V


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_filters_pass_rows_without_the_field(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5.0, "pass"), (3, 50.0, "fail")], "id int, duration double, validation_status string")
    assert [r.id for r in X.by_duration(df, 1, 10).collect()] == [1, 2]
    assert [r.id for r in X.by_status(df).collect()] == [1, 2]
    assert [r.id for r in X.by_duration_half_open(df, 5, 50).collect()] == [2]
    assert [r.id for r in X.by_duration_open(df, 5, -1).collect()] == [3]
    assert [r.id for r in X.at_most(df, "duration", 6).collect()] == [1, 2]


def test_constraints(spark):
    df = spark.createDataFrame([("en", "a", "a"), ("de", "a", "b"), (None, "c", "c")], "lang string, x string, y string")
    hits = lambda t: [r.lang for r in df.filter(X.constraint(t, df.columns)).collect()]
    assert hits(".lang == en") == ["en"]
    assert hits("not .lang == en") == ["de", None]
    assert hits(".x == .y and .lang != en") == [None]
    assert hits(".lang == de xor .x == .y and .lang == en or .x == c") == ["en", "de", None]
    for bad in ("(.lang == en", ".lang", ".lang == en )"):
        with pytest.raises(ValueError):
            X.constraint(bad, df.columns)


def test_joins(spark):
    left = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, text string")
    right = spark.createDataFrame([("a", "p", 1), ("a", "q", 2)], "k string, pred_text string, n int")
    assert rows(J.with_predictions(left, right.filter("n = 1"), ["k"])) == [("a", "p", "x"), ("b", "y", None)]
    assert J.merged(left, right, "k", "n").first().pred_text == "q"
    assert rows(J.duplicates(right, ["k"])) == [("a", 2)]


def test_nearest(spark):
    left = spark.createDataFrame([("s", 1.0), ("s", 4.6), ("s", 9.0), ("t", 1.0)], "k string, at double")
    right = spark.createDataFrame([("s", 0.0, "a"), ("s", 5.0, "b"), ("s", 6.0, "c")], "k string, at double, v string")
    assert rows(J.nearest(left, right, ["k"], "at", "v")) == [("s", 1.0, "a"), ("s", 4.6, "b"), ("s", 9.0, "c"), ("t", 1.0, None)]


def test_clipped_overlap_join(spark):
    rng = random.Random(1)
    def spans(n):
        return [("k", float(a), a + rng.random() * 9) for a in (rng.uniform(0, 60) for _ in range(n))]

    t, s = spans(20), spans(25)
    schema = "k string, start double, end double"
    found = J.clipped(spark.createDataFrame(t, schema), spark.createDataFrame(s, schema), ["k"], 7.0).select("target_start", "start", "end")
    expected = [(a, max(a, c), min(b, d)) for _, a, b in t for _, c, d in s if a < d and c < b]
    assert rows(found) == sorted(expected, key=str)


def test_matched_ends(spark):
    p = spark.createDataFrame([("a", 1.0), ("a", 5.2), ("a", 9.0), ("b", 1.0)], "k string, end double")
    r = spark.createDataFrame([("a", 0.0, 1.1), ("a", 3.0, 5.0), ("a", 6.0, 7.0)], "k string, start double, end double")
    assert rows(J.matched_ends(p, r, ["k"], 0.3)) == [("a", 2, 1, 1, 0, 1), ("b", 0, 1, 0, 0, 0)]


def test_intervals(spark):
    df = spark.createDataFrame([("f", 0.0, 2.0), ("f", 1.0, 3.0), ("f", 3.0, 4.0), ("f", 6.0, 7.0)], "f string, start double, end double")
    assert rows(I.union(df, ["f"])) == [("f", 0.0, 4.0), ("f", 6.0, 7.0)]
    assert rows(I.union_scaled(df, ["f"])) == [("f", 0.0, 3.0), ("f", 3.0, 4.0), ("f", 6.0, 7.0)]
    assert rows(I.gaps(df, ["f"])) == [("f", 4.0, 6.0)]
    assert rows(I.overlaps(df, ["f"])) == [("f", 1.0, 2.0), ("f", 3.0, 3.0)]
    assert rows(I.filled(df, ["f"], 2.5)) == [("f", 0.0, 7.0)]
    assert rows(I.nonspeech(df.withColumn("total", F.lit(9.0)), ["f"], "total"))[-1] == ("f", 7.0, 9.0)
    assert rows(I.long_enough(df, 2.0)) == [("f", 0.0, 2.0), ("f", 1.0, 3.0)]


def test_windows_of_a_segment(spark):
    def pieces(d, w, s):
        return [(r.start, r.duration) for r in spark.range(1).select(F.explode(I.sliding(F.lit(0.0), F.lit(d), w, s, 0.05)).alias("p")).select("p.*").collect()]

    assert pieces(1.0, 1.5, 0.75) == [(0.0, 1.0)]
    assert pieces(2.0, 1.5, 0.75) == [(0.0, 1.5), (0.75, 1.25)]
    assert pieces(3.0, 1.5, 0.75) == [(0.0, 1.5), (0.75, 1.5), (1.5, 1.5)]


def test_hysteresis(spark):
    p = [0.1, 0.6, 0.4, 0.4, 0.2, 0.1, 0.9, 0.35, 0.1]
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(p)], "f string, frame_idx int, p double")
    assert rows(I.hysteresis(df, ["f"], 1.0, 0.5, 0.3)) == [("f", 1.0, 4.0), ("f", 6.0, 8.0)]


def test_frames_and_runs(spark):
    df = spark.createDataFrame([("f", 0.1, 0.3, 1.0), ("f", 0.6, 0.7, 1.0)], "f string, start double, end double, total double")
    labels = I.frame_labels(df, ["f"], 0.1, "total").first().labels
    assert labels == [0, 1, 1, 1, 0, 0, 1, 1, 0, 0]
    frames = spark.createDataFrame([("f", i, y) for i, y in enumerate(labels)], "f string, frame_idx int, label int")
    assert [(round(r.start, 2), round(r.end, 2)) for r in I.speech_segments(frames, ["f"], 0.1).orderBy("start").collect()] == [(0.1, 0.3), (0.6, 0.7)]


def test_words_and_speakers(spark):
    df = spark.createDataFrame([("s", "A", 0.0, 1.0, "hi"), ("s", "A", 1.0, 2.0, "there."), ("s", "B", 2.0, 3.0, "yes"), ("s", "A", 9.0, 9.5, "ok")], "session_id string, speaker string, start double, end double, word string")
    assert [(r.speaker, r.text) for r in I.speaker_sentences(df).orderBy("start").collect()] == [("A", "hi there."), ("B", "yes"), ("A", "ok")]
    assert [r.text for r in I.utterances_by_gap(df, ["session_id"], 5.0).orderBy("start").collect()] == ["hi there.", "yes", "ok"]
    assert {(r.speaker, r.text) for r in I.speaker_transcripts(df).collect()} == {("A", "hi there. ok"), ("B", "yes"), (None, "hi there. yes ok")}
    tokens = spark.createDataFrame([("s", i, float(i), i + 1.0, t) for i, t in enumerate(["▁he", "llo", "▁you", "."])], "k string, place int, start double, end double, token string")
    assert [r.word for r in I.words_of_tokens(tokens, ["k"]).orderBy("word_id").collect()] == ["hello", "you."]


@pytest.mark.parametrize(("t", "expected"), [(1.0, [197, 544, 1615]), (0.0, [1, 1, 1])])
def test_temperatures(t, expected):
    assert B.tempered([197, 544, 1615], t) == pytest.approx([e / sum(expected) for e in expected])
    with pytest.raises(ValueError):
        B.tempered([1, 0], t)


def test_mixtures():
    config = [{"type": "a", "weight": 1}, {"input_cfg": [{"type": "b", "weight": 2}, {"type": "c", "weight": 6}], "lang": "de"}]
    flat = B.mixture(config)
    assert [(s["type"], round(s["weight"], 6), s.get("lang")) for s in flat] == [("a", round(1 / 9, 6), None), ("b", round(2 / 9, 6), "de"), ("c", round(6 / 9, 6), "de")]
    assert B.levels(config) == 2 and B.standard_temperatures(0.5, 2) == [0.5, 0.5]
    with pytest.raises(ValueError):
        B.mixture([{"type": "a", "weight": 1}, {"type": "b"}])


def test_paths_and_shards():
    assert B.expanded("m__OP_0..2_CL_.jsonl") == ["m_0.jsonl", "m_1.jsonl", "m_2.jsonl"]
    assert B.expanded("a_{08..10}.tar") == ["a_08.tar", "a_09.tar", "a_10.tar"]
    assert B.of_rank(list("abcdefg"), 1, 3) == ["c", "d"] and B.of_rank(["a"], 1, 3, "replicate") == ["a"]
    assert B.shards_chosen("2:4", 9) == [2, 3] and B.shards_chosen("all", 2) == [0, 1] and B.shards_chosen("5", 9) == [5]
    assert B.quantized([3, 4, 5, 6, 7]) == [4, 8] and B.quantized([5, 6, 7], True) == [5, 6, 8]


def test_packing():
    rng = random.Random(0)
    lengths = [rng.randint(1, 60) for _ in range(300)]

    def naive(todo):
        bins = []
        for x in todo:
            for b in bins:
                if sum(b) + x <= 100:
                    b.append(x)
                    break
            else:
                bins.append([x])
        return bins

    assert B.first_fit(lengths, 100) == naive(lengths)
    assert B.first_fit(lengths, 100, descending=True) == naive(sorted(lengths, reverse=True))
    assert B.first_fit([60, 101, 30, 500, 20], 100) == [[60, 30], [101], [500], [20]]  # one that fits no bin has its own
    assert B.first_fit([], 10) == []


def test_packed_and_batches(spark):
    df = spark.range(500).select("id", (F.pmod(F.xxhash64("id"), F.lit(90)) + 1).alias("n"))
    packs = B.packed(df, "id", "n", 128, slots=4).join(df, "id")
    assert packs.groupBy("slot", "pack").agg(F.sum("n").alias("s")).filter("s > 128").count() == 0 and packs.count() == 500
    out = B.budget_batches(df.withColumn("n", F.col("n").cast("double")), "n", 400.0, "id", slots=4)
    worst = out.groupBy("slot", "batch").agg((F.count("*") * F.max("n")).alias("cost")).agg(F.max("cost")).first()[0]
    assert worst <= 400 and out.count() == 500
    shards = B.sharded(df, "id", 7).groupBy("shard_id").count().collect()
    assert [r["count"] for r in shards] == [71] * 7


def test_packed_returns_every_row(spark):
    rows = [(i, n) for i, n in enumerate([*range(1, 131), 129, 500, 1000, 0, 0, None])]
    df = spark.createDataFrame(rows, "id long, n int")
    for slots in (1, 3):
        for descending in (True, False):
            out = B.packed(df, "id", "n", 128, slots=slots, descending=descending).collect()
            assert sorted(r.id for r in out) == [i for i, _ in rows]
            packs = {}
            for r in out:
                packs.setdefault((r.slot, r.pack), []).append((r.start, rows[r.id][1] or 0))
            for lengths in packs.values():
                lengths.sort()
                assert [s for s, _ in lengths] == [sum(n for _, n in lengths[:i]) for i in range(len(lengths))]
                assert sum(n for _, n in lengths) <= 128 or len(lengths) == 1
            for slot in {s for s, _ in packs}:
                own = sorted((r for r in out if r.slot == slot), key=lambda r: (-(rows[r.id][1] or 0), r.id) if descending else r.id)
                bins = []
                for n in (rows[r.id][1] or 0 for r in own):
                    fits = [b for b in bins if sum(b) + n <= 128]
                    fits[0].append(n) if fits else bins.append([n])
                assert len(bins) == len({p for s, p in packs if s == slot})
    only = spark.createDataFrame([(1, 0), (2, 300), (3, None)], "id long, n int")
    assert {(r.id, r.pack, r.start) for r in B.packed(only, "id", "n", 128, slots=1).collect()} == {(2, 0, 0), (1, 1, 0), (3, 1, 0)}


def test_permutation(spark):
    for n in (1, 10, 1000):
        out = [r[0] for r in spark.range(n).select(B.permuted(F.col("id"), n, 3)).collect()]
        assert sorted(out) == list(range(n))


def test_sampling(spark):
    df = spark.range(100)
    assert B.sampled_exactly(df, "id", 30).count() == 30 and B.sampled_exactly(df, "id", 250).count() == 250
    drawn = B.weighted_draws(df.withColumn("w", F.col("id") + 1), "w", "id", 5000)
    assert abs(drawn.count() - 5000) < 100
    mixed = B.interleaved([df, spark.range(1000, 1010)], [0.5, 0.5], "id", 400)
    counts = {r.source_index: r["count"] for r in mixed.groupBy("source_index").count().collect()}
    assert abs(counts[0] - 200) < 40 and counts[1] == 200
    assert [(r.turn, r.source_index) for r in B.round_robin([df.limit(2), spark.range(5, 8)], "id").orderBy("turn", "source_index").collect()] == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 1)]


def test_two_dimensional_buckets(spark):
    bounds = [(5, 5), (5, 10), (10, 10), (15, 30)]
    df = spark.createDataFrame([(2, 4), (2, 9), (2, 12), (8, 3), (12, 20), (16, 1)], "d int, t int")
    strict = [r[0] for r in df.select(B.smallest_bucket_2d(F.col("d"), F.col("t"), bounds)).collect()]
    lenient = [r[0] for r in df.select(B.smallest_bucket_2d(F.col("d"), F.col("t"), bounds, strict=False)).collect()]
    assert strict == [0, 1, None, 2, 3, None] and lenient == [0, 1, 3, 2, 3, None]


def test_splits_and_leaks(spark):
    df = spark.range(2000).select("id", F.array(F.concat(F.lit("e"), F.col("id").cast("string"))).alias("e"))
    shares = {r.split: r["count"] / 2000 for r in B.split_by_entity(df, F.col("e")).groupBy("split").count().collect()}
    assert abs(shares["train"] - 0.8) < 0.05 and "conflict" not in shares
    both = B.split_by_entity(spark.createDataFrame([([f"e{i}" for i in range(50)],), ([],)], "e array<string>"), F.col("e"))
    assert [r.split for r in both.collect()] == ["conflict", "train"]
    leaked = D.leakage(spark.createDataFrame([("a", "train"), ("a", "test"), ("b", "train")], "x string, split string"), "x")
    assert rows(leaked) == [("a", ["test", "train"])]


def test_accepted_in_order(spark):
    data = [(i, "g", f"k{i % 7}", f"o{i % 2}") for i in range(20)]
    out = D.accepted(spark.createDataFrame(data, "id long, g string, key string, opening string"), "id", {"opening": 3}, ["key"], ["g"])
    seen, counts, expected = set(), {}, []
    for i, _, k, o in data:
        if k not in seen and counts.get(o, 0) < 3:
            seen.add(k)
            counts[o] = counts.get(o, 0) + 1
            expected.append(i)
    assert sorted(r.id for r in out.collect()) == expected


def test_gate():
    verdict = D.gate({"n_rows": 5000, "exact_dup_rate": 0.0, "normalized_dup_rate": 0.5, "numeric_dup_rate": 0.1, "leakage_ratio": 0.0})
    assert not verdict["passed"] and set(verdict["failed"]) == {"normalized_duplicates", "unique"}


@pytest.mark.parametrize(("ref", "hyp", "errors", "total"), [(["oneword"], ["oneword"], 0, 1), (["oneword"], ["wrongword"], 1, 1), (["aa bb cc", "dd ee", "ff"], ["ff", "aa bb cc", "dd ee"], 0, 6), (["aa bb cc ff", "dd ee gg jj kk", "hh ii"], ["aa bb c ff", "dd e ii jj kk", "hi"], 5, 11)])
def test_session_errors(spark, ref, hyp, errors, total):
    df = spark.createDataFrame([(ref, hyp)], "r array<string>, h array<string>")
    x = df.select(S.session_errors("r", "h").alias("x")).first().x
    assert (x.errors, x.ref_words) == (errors, total)


def test_assignment():
    from itertools import permutations

    rng = np.random.RandomState(0)
    for n in (1, 2, 4, 6):
        cost = rng.rand(n, n)
        best = min(sum(cost[i, p[i]] for i in range(n)) for p in permutations(range(n)))
        assert sum(cost[i, j] for i, j in enumerate(S.assigned(cost))) == pytest.approx(best)


def segs(*rows_):
    return pd.DataFrame(rows_, columns=["start", "end", "speaker"])


def test_diarization_errors():
    ref = segs((0, 10, "A"), (10, 20, "B"))
    assert S.diarization_errors(ref, segs((0, 10, "x"), (10, 20, "y"))) == (0, 0, 0, 20)
    assert S.diarization_errors(ref, segs((0, 20, "x"))) == (0, 0, 10, 20)
    assert S.diarization_errors(ref, segs((0, 8, "x"))) == (12, 0, 0, 20)
    assert S.diarization_errors(ref, segs((0, 10, "x"), (10, 25, "y"))) == (0, 5, 0, 20)
    assert S.diarization_errors(ref, segs((0, 9.9, "x"), (9.9, 20, "y")), collar=0.25) == pytest.approx((0, 0, 0, 19))
    over = segs((0, 10, "A"), (5, 15, "B"))
    assert S.diarization_errors(over, segs((0, 10, "x")), skip_overlap=True)[3] == 10
    assert S.diarization_errors(segs(), segs()) == (0, 0, 0, 0)


def test_binary_scores_against_brute_force(spark):
    rng = random.Random(3)
    data = [(rng.randint(0, 1), round(rng.random(), 1)) for _ in range(200)]
    df = spark.createDataFrame(data, "y int, score double")
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    assert S.ranked_auc(df).first()[0] == pytest.approx(auc)
    assert S.ranked_auc(df.filter("y = 1")).first()[0] == 0.5
    assert S.average_precision(df.filter("y = 0")).first()[0] == 0.0
    assert S.normalized_cross_entropy(df.filter("y = 0")).first()[0] == -math.inf
    ys = np.array([y for y, _ in data])
    ss = np.array([s for _, s in data])
    curve = [abs((ys[ss < t / 10 - 1e-12] == 0).sum() / (ys == 0).sum() - (ys[ss < t / 10 - 1e-12] == 1).sum() / (ys == 1).sum()) for t in range(11)]
    got = S.youden_curve(df, 10).first()
    assert got.max_yc == pytest.approx(max(curve), abs=0.12)


def test_confidence(spark):
    df = spark.createDataFrame([([1.0, 0.0, 0.0],), ([1 / 3] * 3,)], "p array<double>")
    for measure in ("max_prob", "gibbs", "tsallis", "renyi"):
        alpha = 1.0 if measure in ("max_prob", "gibbs") else 0.5
        sure, unsure = (r[0] for r in df.select(S.confidence(F.col("p"), measure, alpha)).collect())
        assert sure == pytest.approx(1, abs=1e-6) and unsure == pytest.approx(0, abs=1e-6)


def test_classification_report(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)], "y int, q int")
    out = {r.label: r for r in S.classification_report(df, "y", "q").collect()}
    assert out["1"].precision == pytest.approx(2 / 3) and out["1"].recall == 1 and out["2"].f1 == 0
    assert out["micro"].f1 == pytest.approx(0.6) and out["macro"].support == 5


def test_small_metrics(spark):
    df = spark.createDataFrame([(["the cat", "a dog"], "the cat sat")], "r array<string>, h string")
    assert df.select(S.token_f1(F.col("r"), F.col("h"))).first()[0] == pytest.approx(0.8)
    text = spark.createDataFrame([("a b c d", "a b c d"), ("x y z w", "x y w z")], "r string, h string")
    assert S.ngram_matches(text.limit(1), [], "r", "h").first().bleu == pytest.approx(100)
    assert S.common_suffix(spark.createDataFrame([("ab->",), ("c->",)], "t string"), "t") == "->"
    assert S.hyperparameters(1000, 10, 1, 12, 12) == {"max_batch_size": 128, "learning_rate": 0.001, "hidden_size": 2048, "max_seq_length": 103}
    u, p = S.mann_whitney([1, 2, 3, 4, 5], [6, 7, 8, 9, 10])
    assert u == 0 and p < 0.02
    assert S.grid({"a": [1, 2], "b": [3]}) == [{"a": 1, "b": 3}, {"a": 2, "b": 3}]
    hits = spark.createDataFrame([([0.1, 0.5, 0.4], 2)], "s array<double>, y int")
    assert hits.select(S.top_k_hits(F.col("s"), F.col("y"), 1), S.top_k_hits(F.col("s"), F.col("y"), 2)).first()[:] == (0, 1)
    lag = spark.createDataFrame([([1.0, 2.0, 3.0], 3.0, 3.0)], "d array<double>, s double, t double")
    from cantoria.functions.errors import lagging

    assert lag.select(lagging(F.col("d"), F.col("s"), F.col("t"))).first()[0] == pytest.approx(1.0)
    k = S.keyword_scores(spark.createDataFrame([("go new york now", "go new york"), ("york", "york york")], "text string, pred_text string"), ["new york", "york"])
    assert {r.keyword: (r.tp, r.gt, r.found) for r in k.collect()} == {"new york": (1, 1, 1), "york": (2, 2, 3)}


def test_neighbours_against_brute_force(spark):
    rng = np.random.RandomState(1)
    x = rng.randn(60, 8)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    found = V.neighbours(df.filter("id % 10 = 0"), df, "id", "v", 3, block=2).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(0, 60, 10):
        s = unit @ unit[q]
        s[q] = -9
        assert [r.id for r in sorted((r for r in found if r.query == q), key=lambda r: r.place)] == np.argsort(-s)[:3].tolist()
    assert V.normalized(df, "v").select(F.avg(V.norm(F.col("v")))).first()[0] == pytest.approx(1)


def test_clusters(spark):
    rng = np.random.RandomState(0)
    centres = np.eye(3, 16)
    x = np.concatenate([c + 0.05 * rng.randn(30, 16) for c in centres])
    df = spark.createDataFrame([("f", i, v.tolist()) for i, v in enumerate(x)], "f string, i int, v array<double>")
    for window in (2000, 45):
        out = [r.cluster for r in V.speaker_clusters(df, "f", "i", "v", window=window).orderBy("i").collect()]
        assert len(set(out)) == 3 and all(len(set(out[a : a + 30])) == 1 for a in (0, 30, 60))
    m = V.nearest_scale_segments(np.array([[0, 1], [5, 6]]), [np.array([[0, 3], [4, 7]])])
    assert m.tolist() == [[0, 1]]


def test_conversations(spark):
    df = C.gathered(spark.createDataFrame([(1, 1, "Assistant", "yo"), (1, 0, "user", "hi"), (2, 0, "system", "s"), (2, 1, "user", "u"), (2, 2, "assistant", None)], "conv_id long, turn long, role string, text string"))
    out = {r.conv_id: r for r in C.prompted(C.with_system(df, "sys"), "llama2").collect()}
    assert out[1].prompt == "<s>[INST] <<SYS>>\nsys\n<</SYS>>\n\nhi [/INST] yo </s>"
    assert out[1].context + out[1].answer == out[1].prompt and out[1].answer == " yo </s>"
    assert out[2].prompt.startswith("<s>[INST] <<SYS>>\ns\n")
    assert [t.role for t in C.swapped_roles(df).filter("conv_id = 1").first().turns] == ["agent", "user"]
    with pytest.raises(Exception, match="no template for role"):
        C.prompted(df, "gemma").filter("conv_id = 2").select("prompt").collect()
    cut = C.around_placeholder(spark.createDataFrame([(1, [("human", "text", "hear <audio> now", None, None)])], f"id long, turns {C.TURN}"), ["<audio>"])
    assert [(r.type, r.value) for r in cut.orderBy("piece").collect()] == [("text", "hear"), ("audio", "<audio>"), ("text", "now")]
    tagged = C.special_tokens(spark.createDataFrame([("en", "asr", "yes")], "source_lang string, taskname string, pnc string"), ["source_lang"]).first()
    assert tuple(tagged) == ("<|en|>", "<|transcribe|>", "<|pnc|>")
    with pytest.raises(ValueError):
        C.fields("{a{b}}")
    assert C.filled(spark.createDataFrame([("x", None)], "a string, b string"), "{a}-{b}!", "t").first().t == "x-!"
    assert C.format_for("conversation", "anything") is not None
