import json
import tarfile
import time
from io import BytesIO

import pytest
from pyspark.sql import functions as F

from cantoria.sources import manifests as M
from cantoria.sources import sinks as W
from cantoria.streaming import streams as St


def lines(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


def test_manifest(spark, tmp_path):
    p = lines(tmp_path / "m.jsonl", [{"audio_filepath": f"a{i}.wav", "duration": 1.0, "text": "t", "text-other": "o", "lang": "en"} | ({"_skipme": True} if i > 7 else {}) for i in range(10)])
    (tmp_path / "m.jsonl").open("a").write("{broken\n")
    assert M.read(spark, {"manifest_filepath": p}).count() == 8
    assert M.read(spark, {"manifest_filepath": p, "text_field": "text-other", "tags": {"set": "x"}}).select("text", "set").first()[:] == ("o", "x")
    assert M.broken_lines(spark, p).count() == 1
    mixed = M.read(spark, {"input_cfg": [{"type": "manifest", "manifest_filepath": p, "weight": 1}, {"type": "text", "paths": p, "weight": 3}]})
    assert {r.weight for r in mixed.select("weight").distinct().collect()} == {0.25, 0.75}
    assert "tarred_manifest" in M.known_sources()
    with pytest.raises(ValueError):
        M.read(spark, {"type": "nothing"})


def tar(path, names):
    with tarfile.open(path, "w") as t:
        for n in names:
            info = tarfile.TarInfo(n)
            info.size = len(n)
            t.addfile(info, BytesIO(n.encode()))


def test_sharded_manifest(spark, tmp_path):
    for s in (0, 1):
        tar(tmp_path / f"audio_{s}.tar", [f"a{s}{i}.wav" for i in range(3)])
        lines(tmp_path / f"m_{s}.jsonl", [{"audio_filepath": f"a{s}{i}.wav", "duration": 1.0, "text": "t", "shard_id": s} for i in (0, 2)] + [{"audio_filepath": f"a{s}2-sub1.wav", "duration": 0.5, "text": "u", "shard_id": s}])
    df = M.tarred(spark, f"{tmp_path}/m__OP_0..1_CL_.jsonl", f"{tmp_path}/audio__OP_0..1_CL_.tar")
    assert df.count() == 6 and {bytes(r.data).decode() for r in df.collect()} == {"a00.wav", "a02.wav", "a10.wav", "a12.wav"}
    with pytest.raises(ValueError):
        M.tarred(spark, f"{tmp_path}/m_0.jsonl", f"{tmp_path}/audio__OP_0..1_CL_.tar")


def test_text_sources(spark, tmp_path):
    (tmp_path / "en.txt").write_text("a \nb\n\n")
    (tmp_path / "de.txt").write_text("x\ny\n")
    pairs = M.text_pairs(spark, f"{tmp_path}/en.txt", f"{tmp_path}/de.txt", questions=["q"]).orderBy("line").collect()
    assert [(r.source, r.target, r.question) for r in pairs] == [("a", "x", "q"), ("b", "y", "q")]
    assert M.text(spark, f"{tmp_path}/en.txt", "en").first()[:] == ("a ", "en")
    index = M.offset_index(spark, f"{tmp_path}/en.txt").orderBy("line").collect()
    assert [(r.offset, r.length) for r in index] == [(0, 3), (3, 2), (5, 1)]
    p = lines(tmp_path / "c.jsonl", [{"id": "1", "conversations": [{"value": "hi", "from": "human"}, {"value": "yo", "from": "gpt"}]}])
    assert [t.role for t in M.chat_jsonl(spark, p).first().turns] == ["user", "assistant"]
    (tmp_path / "t.csv").write_text('a,b\n1,\n"x, y",2\n')
    assert [tuple(r) for r in M.tabular(spark, f"{tmp_path}/t.csv").collect()] == [("1", ""), ("x, y", "2")]


def test_segment_files(spark, tmp_path):
    df = spark.createDataFrame([("f1", 0.5, 2.0, "A"), ("f2", 1.0, 1.25, "B")], "file string, start double, end double, speaker string")
    W.rttm(df, f"{tmp_path}/r")
    back = M.rttm(spark, [f"{tmp_path}/r/file=f1", f"{tmp_path}/r/file=f2"]).select("file", "start", "end", "speaker")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert M.uem_of(back.withColumn("channel", F.lit("1"))).count() == 2
    line = spark.range(1).select(W.ctm_line(F.lit("s"), F.lit(1), F.lit(0.5), F.lit(0.25), F.lit("hi"), F.lit(1.5))).first()[0]
    assert line == "s 1 0.50 0.25 hi 1.00 lex NA"
    (tmp_path / "k").mkdir()
    (tmp_path / "k/segments").write_text("u1 r1 0.5 2.0\nu2 r9 0 1\n")
    (tmp_path / "k/wav.scp").write_text("r1 /a.wav\n")
    (tmp_path / "k/text").write_text("u1 hello you\n")
    assert M.kaldi(spark, f"{tmp_path}/k").select("utterance", "audio_filepath", "text", "duration").first()[:] == ("u1", "/a.wav", "hello you", 1.5)


def test_archives(spark, tmp_path):
    df = spark.createDataFrame([(0, "d/a.wav", bytearray(b"1")), (0, "d/a.wav", bytearray(b"2")), (1, "b.wav", bytearray(b"3"))], "shard_id int, path string, data binary").withColumn("n", F.monotonically_increasing_id())
    named = W.numbered_members(df, "shard_id", "path", "n")
    assert {r.member for r in named.collect()} == {"d_a.wav", "d_a-sub1.wav", "b.wav"}
    done = W.save_archives(W.tar_shards(named), f"{tmp_path}/out").collect()
    members = M.tar_members(spark, [r.path for r in done])
    assert {(r.file, bytes(r.data)) for r in members.collect()} == {("d_a.wav", b"1"), ("d_a-sub1.wav", b"2"), ("b.wav", b"3")}
    W.jsonl(df.select("shard_id", F.lit("é").alias("t")), f"{tmp_path}/j", ascii_only=True)
    assert spark.read.text(f"{tmp_path}/j").first()[0].endswith('"\\u00e9"}')


@pytest.mark.parametrize(("buffer", "data", "search", "least", "subsequence", "expected"), [([1, 2, 3, 4, 5], [3, 4, 5, 6, 7], 5, 1, False, [1, 2, 3, 4, 5, 6, 7]), ([1, 2, 3, 4, 5], [6, 7, 8, 9, 10], 5, 1, False, list(range(1, 11))), ([1, 2, 3, 4, 9], [3, 4, 5, 6, 7], 5, 1, True, [1, 2, 3, 4, 5, 6, 7]), ([1, 2, 3, 4, 5], [3, 4, 5, 6, 7], 1, 2, False, [1, 2, 3, 4, 5, 3, 4, 5, 6, 7]), ([], [1], 5, 1, False, [1])])
def test_token_merge(buffer, data, search, least, subsequence, expected):
    assert St.merged(buffer, data, search, least, None, subsequence) == expected


def test_endpoints():
    assert St.end_from_timestamps([1, 2, 3], 20, 5) == 6
    assert St.end_from_timestamps([1, 2, 12, 13], 15, 5) == 5
    assert St.end_from_timestamps([1, 2], 4, 5) is None and St.end_from_timestamps([1], 9, -1) is None and St.end_from_timestamps([1], 9, 0) == 9
    spoken = [True, False, False, False, True]
    assert St.end_from_emissions(spoken, 3, 0, 2) == 2 and St.end_from_emissions(spoken, 4, 0, 2) is None and St.end_from_emissions(spoken, 4, 0, -1) is None
    assert St.end_from_emissions(spoken, 3, 0, 2, starts_word=[True] * 4 + [False]) is None
    assert St.end_from_emissions([True, *[False] * 6], 6, 0, 3) == 4 and St.end_from_emissions([True, *[False] * 6], 1, 0, 3) == 2
    assert St.end_from_emissions([True, *[False] * 4, True], 2, 0, 3, residue=1) == 2
    with pytest.raises(ValueError):
        St.end_from_emissions(spoken, 5, 0, 2)
    assert St.end_from_segments([(0, 1), (5, 6)], 6.5, 0, 2) == 2 and St.end_from_segments([(0, 1)], 9, 0, 2) == 2
    s = St.State()
    s.push(["hel", "lo"])
    s.push([",", "you"])
    s.push(["r"], merge_first=True)
    assert s.words == ["hel", "lo,", "your"]
    assert St.frames_of(85, 40) == 3


def test_buffers(spark):
    roll = St.Roll(4)
    roll.push([1, 2])
    assert roll.push([3]) == [0.0, 1, 2, 3] and roll.padding == 1
    grow = St.Grow(4, 2, 2)
    grow.push([1, 2])
    grow.push([3, 4])
    assert grow.push([5, 6]) == [3, 4, 5, 6]
    slots = St.Slots(1)
    slots.take("a")
    slots.end("a")
    assert slots.take("b") == 0
    assert St.live_batches({"a": 1, "b": 2, "c": 1}, 2) == [[("a", 0), ("b", 0)], [("b", 1), ("c", 0)]]
    cut = St.frames(spark.createDataFrame([("s", [1.0, 2.0, 3.0])], "k string, x array<double>"), "k", "x", 2).orderBy("frame_idx").collect()
    assert [(r.frame, r.is_first, r.is_last) for r in cut] == [([1.0, 2.0], True, False), ([3.0, 0.0], False, True)]


def test_streams_give_what_tables_give(spark, tmp_path):
    rows = [(f"s{k}", float(t), t + 0.5, f"w{t}", t == 30) for k in range(3) for t in (1, 2, 3, 9, 10, 30)]
    schema = "stream_id string, start double, end double, word string, is_last boolean"
    batch = sorted(map(tuple, St.transcribed(spark.createDataFrame(rows, schema), 4.0).collect()))
    for n, part in enumerate((rows[0:3] + rows[6:10], rows[3:6] + rows[10:12] + rows[12:13], rows[13:])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{n}")
    # one batch a file, in order
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    q = St.transcribed(stream, 4.0).writeStream.format("memory").queryName(f"t{int(time.time())}").option("checkpointLocation", f"{tmp_path}/cp").outputMode("append").start()
    q.processAllAvailable()
    name = q.name
    q.stop()
    assert sorted(map(tuple, spark.table(name).collect())) == batch
