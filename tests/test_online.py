"""Online operators: what a stream gives is what a table gives, held against plain readings, with state that stays bounded."""

import random
import time
from collections import Counter
from datetime import UTC, datetime, timedelta

import numpy as np
import pytest

from cantoria.streaming import online as O

AT = datetime(2024, 1, 1, tzinfo=UTC)


def united(rows):
    out = []
    for a, z in sorted(r for r in rows if r[1] > r[0]):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return out


def windows(rows, window, shift):
    """Unit by unit: a window begins every `shift`, until one reaches the end."""
    out = []
    for a, z in united(rows):
        while True:
            out.append((a, min(a + window, z)))
            if a + window >= z or a + shift >= z:
                break
            a += shift
    return sorted(out)


def net(actions):
    c = Counter()
    for action, a, z in actions:
        c[a, z] += 1 if action == "given" else -1
    assert set(c.values()) <= {0, 1}
    return sorted(w for w, n in c.items() if n)


@pytest.mark.parametrize(("window", "shift"), [(4, 2), (3, 3), (5, 1), (2, 5)])
def test_windows_follow_rows_that_come_late(window, shift):
    for seed in range(60):
        rng = random.Random(seed)
        rows = [(a := rng.randrange(80), a + rng.choice((0, 1, 2, 5, 11, 30))) for _ in range(rng.randint(1, 25))]
        order = sorted(rows, key=lambda r: r[0] + rng.uniform(0, 12))
        held, watermark, actions, taken = O.SpeechWindows(window, shift), 0, [], []
        while order:
            batch, order = order[: rng.randint(1, 4)], order[4:] if False else order[rng.randint(1, 4) :]
            actions += held.add(batch, watermark)
            taken += [r for r in batch if r[0] >= watermark]
            assert all(z >= watermark for _, z, _ in held.stretches)
            assert net(actions) == windows(taken, window, shift)
            watermark = max(watermark, max((r[0] for r in batch), default=0) - rng.randint(0, 8))
            held.forget(watermark)


def test_a_long_stretch_takes_two_times_and_a_number():
    held = O.SpeechWindows(3, 1)
    given = [w for t in range(0, 5000, 2) for w in held.add([(t, t + 2)], max(0, t - 5))]
    assert len(held.stretches) == 1 and held.stretches[0][2] > 4900
    assert net(given) == windows([(0, 5000)], 3, 1) and len(given) < 5 * 5000


def streamed(spark, tmp_path, df, parts, schema, run):
    for n, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        time.sleep(0.02)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    q = run(stream).writeStream.format("memory").queryName(f"o{time.time_ns()}").option("checkpointLocation", f"{tmp_path}/cp").outputMode("append").trigger(availableNow=True).start()
    ended = q.awaitTermination(90)
    name, progress = q.name, q.lastProgress
    q.stop()
    assert ended
    return list(map(tuple, spark.table(name).collect())), progress


def test_windows_of_a_stream_are_those_of_the_table(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"s{i % 3}", a := rng.randrange(0, 400) / 4, a + rng.choice((0.5, 1.25, 6, 20))) for i in range(90)]
    rows.sort(key=lambda r: r[1] + rng.uniform(0, 8))
    parts = [[(s, AT + timedelta(seconds=a), AT + timedelta(seconds=z)) for s, a, z in rows[i : i + 15]] for i in range(0, 90, 15)]
    parts.append([("end", AT + timedelta(days=1), AT + timedelta(days=1, seconds=1))])
    schema = "stream_id string, start timestamp, end timestamp"
    table = sorted(map(tuple, O.speech_windows(spark.createDataFrame([r for p in parts for r in p], schema), 1_500_000, 750_000).collect()))
    micros = lambda s: int((AT.timestamp() + s) * 1e6)
    for s in ("s0", "s1", "s2"):
        assert [(a, z) for i, _, a, z in table if i == s] == windows([(micros(a), micros(z)) for i, a, z in rows if i == s], 1_500_000, 750_000)
    found, progress = streamed(spark, tmp_path, None, parts, schema, lambda df: O.speech_windows(df, 1_500_000, 750_000, "10 seconds"))
    for s in ("s0", "s1", "s2", "end"):
        assert net([r[1:] for r in found if r[0] == s]) == [(a, z) for i, _, a, z in table if i == s]
    assert any(r[1] == "cut" for r in found)
    assert progress["stateOperators"][0]["numRowsTotal"] <= 2  # timers have dropped all but the last stream


def talk(seed, speakers, n, noise=0.18, dims=16, turn=6):
    """(vector, speaker): turns of some segments, each a noisy axis."""
    rng = np.random.RandomState(seed)
    out, now = [], 0
    for i in range(n):
        if i % turn == 0:
            now = rng.randint(min(speakers, 1 + i // 20))
        v = rng.normal(0, noise, dims)
        v[now] += 1
        out.append((v.tolist(), now))
    return out


def agreement(labels, truth):
    """Share of places whose label is its speaker's commonest one, where no two speakers share one."""
    both = Counter(zip(truth, labels, strict=True))
    best, used = 0, set()
    for (t, label), n in both.most_common():
        if t not in {u[0] for u in used} and label not in {u[1] for u in used}:
            used.add((t, label))
            best += n
    return best / len(labels)


@pytest.mark.parametrize("speakers", [1, 2, 3, 4])
def test_speakers_are_told_apart_with_bounded_state(speakers):
    data = talk(speakers, speakers, 500)
    online, out, most = O.OnlineSpeakers(history=64, current=32), [], 0
    for place, (v, _) in enumerate(data):
        out += online.push(place, np.array(v))
        most = max(most, online.size())
    out += online.end()
    assert sorted(p for p, _, _ in out) == list(range(500))
    assert most <= 64 + 32 + 8
    truth = [data[p][1] for p, _, _ in out]
    assert agreement([label for _, _, label in out], truth) > 0.95
    assert agreement([first for _, first, _ in out], truth) > 0.9


def test_levels():
    assert O.levelled([5, 4, 3], 3, 2) == [2, 1, 0]
    assert O.levelled([7, 4, 3], 3, 2) == [3, 0, 0]
    assert O.levelled([9, 9, 2], 4, 1) == [2, 2, 0]
    assert O.levelled([3], 0, 1) == [0]
    with pytest.raises(ValueError):
        O.levelled([2, 2], 3, 1)
    for seed in range(50):
        rng = random.Random(seed)
        counts, least = [rng.randint(1, 12) for _ in range(rng.randint(1, 6))], rng.randint(0, 3)
        gone = rng.randint(0, sum(max(0, c - least) for c in counts))
        left = list(counts)
        for _ in range(gone):  # one by one from the largest that can spare one; of equal ones the last
            i = max((i for i in range(len(left)) if left[i] > least), key=lambda i: (left[i] - min(least, counts[i]), i))
            left[i] -= 1
        assert sorted(left) == sorted(c - g for c, g in zip(counts, O.levelled(counts, gone, least), strict=True))


def test_condensed_vectors_keep_their_mean():
    x = np.array([[1.0, 0], [0.9, 0.1], [0, 1.0], [1.0, 0.05]])
    out = O.condensed(x, 2)
    assert len(out) == 2 and np.allclose(out[-1], x[[0, 1, 3]].mean(0)) and np.allclose(out[0], x[2])
    assert O.condensed(x, 0) is x


def test_clusters_keep_their_labels():
    assert O.matched(np.array([3, 3, 1]), np.array([0, 0, 1, 1, 2])) == {0: 3, 1: 1, 2: 0}
    assert O.matched(np.zeros(0, int), np.array([1, 0])) == {0: 0, 1: 1}


def test_speakers_of_a_stream_are_those_of_the_table(spark, tmp_path):
    """d has no last row: the watermark ends it."""
    rows = [(s, p, AT + timedelta(seconds=p), v, p == n - 1 and s != "d") for s, k, n in (("a", 2, 90), ("b", 3, 61), ("c", 1, 5), ("d", 2, 30)) for p, (v, _) in enumerate(talk(ord(s), k, n))]
    schema = "stream_id string, place long, start timestamp, vector array<double>, is_last boolean"
    how = {"history": 24, "current": 16}
    table = sorted(map(tuple, O.online_speakers(spark.createDataFrame(rows, schema), **how).collect()))
    plain = []
    for s in "abcd":
        online = O.OnlineSpeakers(**how)
        plain += [(s, *o) for _, p, _, v, _ in (r for r in rows if r[0] == s) for o in online.push(p, np.array(v))] + [(s, *o) for o in online.end()]
    assert table == sorted(plain)
    rng = random.Random(1)
    mixed = sorted(rows, key=lambda r: r[1] + rng.uniform(0, 9))  # out of order, a place twice, one without a vector
    mixed[50:50] = [next(r for r in mixed if r[0] == "a"), ("a", 3, AT, None, False)]
    parts = [mixed[i : i + 40] for i in range(0, len(mixed), 40)]
    parts.append([("e", 0, AT + timedelta(days=1), [1.0] * 16, True)])
    found, progress = streamed(spark, tmp_path, None, parts, schema, lambda df: O.online_speakers(df, **how))
    assert sorted(r for r in found if r[0] != "e") == table
    assert progress["stateOperators"][0]["numRowsTotal"] == 0


def test_missing_places_are_given_up():
    held = O._Ordered({"history": 16, "current": 8})
    rows = [(p, [1.0, 0.1 * p], False) for p in range(40) if p != 5]
    out, ended = held.add(rows, most_waiting=10)
    assert not ended and held.next == 40 and not held.ahead
    assert sorted(p for p, _, _ in out + held.end()) == [p for p in range(40) if p != 5]


def test_streams_without_timers_are_refused(spark):
    stream = spark.readStream.format("rate").load()
    spark.conf.set(O._STORE, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        with pytest.raises(ValueError):
            O.speech_windows(stream.selectExpr("cast(value as string) stream_id", "timestamp start", "timestamp end"), 1, 1)
    finally:
        spark.conf.set(O._STORE, O.ROCKSDB)


def test_query_gives_what_the_steps_give(spark):
    import duckdb

    from cantoria import registry

    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"select vec_id, embedding from '{sf}/embeddings.parquet' order by vec_id").fetchall()
    expected = []
    for k in range(10):
        online = O.OnlineSpeakers()
        expected += [(str(k), *o) for i, v in rows if i % 10 == k for o in online.push(i // 10, np.array(v))] + [(str(k), *o) for o in online.end()]
    assert sorted(map(tuple, registry.queries()["online_speakers"](spark, sf).collect())) == sorted(expected)
