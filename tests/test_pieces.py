"""Shards in several files, lines over several files as one, and files whose number doesn't follow the recordings."""

import glob
import io
import tarfile

import pytest
from pyspark.sql import functions as F

from cantoria.plans import files as P
from cantoria.sources import cuts as C
from cantoria.sources import manifests as M
from cantoria.sources import ranges
from cantoria.sources import sinks as K


@pytest.fixture(autouse=True)
def apart(spark):
    """Small partitions stay apart, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_archives_of_bounded_size(spark, tmp_path):
    rows = spark.range(200).select((F.col("id") % 2).alias("shard_id"), F.format_string("%04d.bin", "id").alias("member"), F.repeat(F.lit("x"), 1000).cast("binary").alias("data"))
    made = K.write_archives(rows, f"{tmp_path}/tar", most=10_000).collect()
    assert len(made) > 16 and sum(r.n for r in made) == 200 and max(r.n for r in made) <= 8
    for shard in (0, 1):
        names = [n for r in sorted(made, key=lambda r: r.path) if r.shard_id == shard for n in tarfile.open(r.path.removeprefix("file://")).getnames()]
        assert names == [f"{i:04d}.bin" for i in range(shard, 200, 2)]
    assert not glob.glob(f"{tmp_path}/tar/*.tar.*")
    read = M.tar_members(spark, [r.path for r in made])
    assert read.select("file").distinct().count() == 200 and {len(r.data) for r in read.collect()} == {1000}


def test_fields_meet_over_several_files_of_a_shard(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K.write_archives, "__defaults__", (*K.write_archives.__defaults__[:-1], 4_000))
    df = spark.range(120).select((F.col("id") % 3).alias("shard"), F.col("id").alias("n"), F.col("id").cast("string").alias("id"), F.lit(0.0).alias("start"), F.lit(1.0).alias("duration"), F.lit(0).alias("channel"), F.lit("r").alias("recording_id"), F.array().cast(C.SUPERVISIONS).alias("supervisions"), F.lit(None).cast("map<string,string>").alias("custom"))
    paths = C.write_shards(df, str(tmp_path / "out"), "shard", "n", {"cuts": C.cut_line(df), "t": F.concat(F.lit("t"), "id")}, {"d": (F.concat("id", F.lit(".bin")), F.concat(F.lit("d"), "id").cast("binary"))})
    listed = {k: [f for f, _ in ranges.files_of(spark, [v])] for k, v in paths.items()}
    assert len(listed["d"]) > 3 and len(listed["cuts"]) > 3
    back = M.read(spark, {"type": "shar", "fields": listed}).collect()
    assert len(back) == 120 and all(r.t == f"t{r.id}" and bytes(r.d) == f"d{r.id}".encode() and r["shard"] == int(r.id) % 3 for r in back)


def test_lines_of_several_files_as_one(spark, tmp_path):
    spark.range(1000).orderBy("id").select(F.repeat(F.lit("é"), (F.col("id") % 7).cast("int")).alias("value")).write.text(f"{tmp_path}/lines")
    found = ranges.files_of(spark, [f"{tmp_path}/lines"])
    assert len(found) > 1
    whole = b"".join(open(f.removeprefix("file://"), "rb").read() for f, _ in found)
    rows = ranges.as_one(M.offset_index(spark, f"{tmp_path}/lines"), found).orderBy("line").collect()
    assert [r.line for r in rows] == list(range(1000))
    assert [whole[r.offset : r.offset + r.length] for r in rows] == list(io.BytesIO(whole))


def test_files_do_not_follow_recordings(spark, tmp_path):
    r = spark.range(2000).select((F.col("id") % 500).cast("string").alias("file"), F.col("id").cast("double").alias("start"), (F.col("id") + 1.0).alias("end"), F.lit('a "b" c').alias("speaker"))
    s = r.select(F.col("file").alias("session_id"), "speaker", "start", F.concat(F.lit('  say "'), "file", F.lit('", \\ ')).alias("text"))
    K.rttm(r.withColumn("speaker", F.lit("a")), f"{tmp_path}/rttm")
    K.transcripts(s, f"{tmp_path}/transcripts")
    K.seglst(r.select(F.col("file").alias("session_id"), "speaker", F.lit("w").alias("words"), F.col("start").alias("start_time"), F.col("end").alias("end_time")), f"{tmp_path}/seglst")
    for kind in ("rttm", "transcripts", "seglst"):
        assert len([f for f in glob.glob(f"{tmp_path}/{kind}/**", recursive=True) if "part-" in f]) <= 32
    assert M.rttm(spark, f"{tmp_path}/rttm").select("file", "start", "end").exceptAll(r.select("file", "start", "end")).count() == 0
    assert M.transcripts(spark, f"{tmp_path}/transcripts").exceptAll(s.select("session_id", F.concat_ws(": ", "speaker", "text"))).count() == 0
    back = M.seglst(spark, f"{tmp_path}/seglst", lines=True)
    assert back.count() == 2000 and back.select("session_id", "start_time").exceptAll(r.select("file", "start")).count() == 0


def test_queries_still_write_and_read(spark):
    assert P.tar_rows(spark, "/root/testdata/sf0.001").count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
