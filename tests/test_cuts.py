"""Cuts and sharded fields: round trips, defaults, and shards whose fields don't fit."""

import gzip
import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from cantoria.sources import cuts as C
from cantoria.sources import manifests as M

LINES = [
    {"id": "a", "start": 1.5, "duration": 4.0, "channel": 0, "recording": {"id": "r1", "sources": []}, "supervisions": [{"id": "s", "recording_id": "r1", "start": 0.5, "duration": 2.0, "channel": 0, "text": "höre", "language": "de", "custom": {"k": "v"}}, {"id": "t", "start": 3.0, "duration": 1.0}], "custom": {"x": "1"}, "type": "MonoCut"},
    {"id": "b", "duration": 2.0, "recording_id": "r2"},
    {"id": "c", "duration": 1.0, "supervisions": [], "custom": {"deep": {"er": 1}}},
]


def test_cuts(spark, tmp_path):
    with gzip.open(tmp_path / "cuts.jsonl.gz", "wt", encoding="utf-8") as f:
        f.write("\n".join(json.dumps(x, ensure_ascii=False) for x in LINES) + "\n\n")
    df = M.read(spark, {"type": "cuts", "cuts_path": f"{tmp_path}/cuts.jsonl.gz", "tags": {"task": "asr"}})
    rows = {r.id: r for r in df.collect()}
    assert [(r.start, r.duration, r.recording_id, len(r.supervisions), r.task) for _, r in sorted(rows.items())] == [(1.5, 4.0, "r1", 2, "asr"), (0.0, 2.0, "r2", 0, "asr"), (0.0, 1.0, None, 0, "asr")]
    assert rows["a"].custom == {"x": "1"} and rows["a"].supervisions[0].text == "höre" and rows["a"].supervisions[0].custom == {"k": "v"} and rows["c"].custom == {"deep": '{"er":1}'}
    spoken = sorted((r.cut_id, r.place, r.start, r.end, r.text) for r in C.supervised(df).collect())
    assert spoken == [("a", 0, 2.0, 4.0, "höre"), ("a", 1, 4.5, 5.5, None)]
    df.select(C.cut_line(df).alias("value")).coalesce(1).write.text(f"{tmp_path}/again")
    again = C.cuts(spark, f"{tmp_path}/again/part-*")
    key = lambda r: r.id
    assert sorted(again.collect(), key=key) == sorted(df.drop("task").collect(), key=key)


def corpus(tmp_path, cuts=(3, 2), texts=(3, 2), audio=(3, 2)):
    for s, (n, m, k) in enumerate(zip(cuts, texts, audio, strict=True)):
        (tmp_path / f"cuts.{s:06d}.jsonl").write_text("".join(json.dumps({"id": f"{s}-{i}", "duration": 1.0}) + "\n" for i in range(n)))
        (tmp_path / f"text.{s:06d}.jsonl").write_text("".join(f"text {s} {i}\n" for i in range(m)))
        with tarfile.open(tmp_path / f"audio.{s:06d}.tar", "w") as tar:
            for i in range(k):
                for name, data in ((f"x/{s}-{i}.wav", f"bytes {s} {i}".encode()), (f"x/{s}-{i}.json", json.dumps({"n": i}).encode())):
                    info = tarfile.TarInfo(name)
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
    return {"type": "shar", "fields": {"cuts": f"{tmp_path}/cuts.*.jsonl", "text": f"{tmp_path}/text.*.jsonl", "audio": [f"{tmp_path}/audio.{s:06d}.tar" for s in range(len(cuts))]}}


def test_fields_zip_by_place(spark, tmp_path):
    rows = M.read(spark, corpus(tmp_path)).collect()
    assert sorted((r.id, r.shard, r.text, bytes(r.audio), r.audio_name, json.loads(r.audio_json)["n"]) for r in rows) == [(f"{s}-{i}", s, f"text {s} {i}", f"bytes {s} {i}".encode(), f"x/{s}-{i}.wav", i) for s, n in ((0, 3), (1, 2)) for i in range(n)]


@pytest.mark.parametrize(("parts", "named"), [({"texts": (3, 1)}, "text in shard 1 (1 values, 2 cuts)"), ({"audio": (4, 2)}, "audio in shard 0 (4 values, 3 cuts)"), ({"cuts": (3, 0)}, "text in shard 1 (no cuts)")])
def test_what_does_not_fit_is_named(spark, tmp_path, parts, named):
    with pytest.raises(ValueError, match="fit") as e:
        M.read(spark, corpus(tmp_path, **parts))
    assert named in str(e.value)


def test_shards_written_and_read(spark, tmp_path):
    rows = [(i % 3, i, f"c{i}", f"line {i}", f"data {i}".encode()) for i in range(20)]
    df = spark.createDataFrame(rows, "shard int, n int, id string, t string, d binary").withColumns({"start": F.lit(0.0), "duration": F.lit(1.0), "channel": F.lit(0), "recording_id": F.lit("r"), "supervisions": F.array().cast(C.SUPERVISIONS), "custom": F.lit(None).cast("map<string,string>")})
    paths = C.write_shards(df, str(tmp_path / "out"), "shard", "n", {"cuts": C.cut_line(df), "t": F.col("t")}, {"d": (F.concat("id", F.lit(".bin")), F.col("d"))})
    tars = sorted(str(p) for p in (tmp_path / "out").glob("d/*.tar"))
    back = C.shar(spark, {"cuts": paths["cuts"], "t": paths["t"], "d": tars}).collect()
    assert sorted((r.shard, int(r.id[1:]), r.id, r.t, bytes(r.d)) for r in back) == sorted(rows)
    with pytest.raises(ValueError):
        C.shar(spark, {"t": paths["t"]})
