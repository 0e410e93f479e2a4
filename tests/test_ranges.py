"""Lines and members by ranges of bytes, held against plain reading; random access and permutations that are taken up again."""

import io
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from cantoria.sources import manifests as M
from cantoria.sources import ranges as R

FILES = {"a.txt": b"one\r\ntwo\rstill two\n\n\nlast without end", "b.txt": b"", "c.txt": b"\n", "d.txt": "é\x1c\x85 日本\n".encode() + b"x" * 500 + b"\n\xff\xfe\n", "e.txt": b"single"}


def plain(raw):
    """(line, offset, length, value); the text behind the last line feed is a line if it isn't empty."""
    out, at = [], 0
    for n, value in enumerate(raw.split(b"\n")):
        if at < len(raw):
            out.append((n, at, min(len(value) + 1, len(raw) - at), value))
        at += len(value) + 1
    return out


@pytest.fixture
def folder(tmp_path):
    for name, raw in FILES.items():
        (tmp_path / name).write_bytes(raw)
    return tmp_path


@pytest.mark.parametrize("size", [1, 7, 40, 1 << 20])
def test_lines(spark, folder, size):
    rows = R.lines(spark, f"{folder}/*.txt", range_bytes=size).collect()
    found = sorted((r.file.rsplit("/", 1)[1], r.line, r.offset, r.length, bytes(r.value)) for r in rows)
    assert found == sorted((f, *x) for f, raw in FILES.items() for x in plain(raw))


def test_chunks_within_a_range(monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 5)
    rng = random.Random(1)
    for _ in range(200):
        raw = bytes(rng.choice(b"ab\n") for _ in range(rng.randint(0, 60)))
        cuts = sorted({0, len(raw), *(rng.randint(0, len(raw)) for _ in range(3))})
        got = [(int(o), int(n), v) for a, z in zip(cuts, cuts[1:], strict=False) for os, ns, vs in R.line_places(io.BytesIO(raw), a, z, True) for o, n, v in zip(os, ns, vs, strict=True)]
        assert got == [x[1:] for x in plain(raw)]


def test_spans_take_neighbours_along():
    assert R.spans([(100, 5), (0, 10), (12, 3), (104, 9)], gap=4) == [(0, 15, [1, 2]), (100, 113, [0, 3])]
    assert R.spans([(5, 0), (5, 2)], 0) == [(5, 7, [0, 1])] and R.spans([]) == []


def test_only_bytes_asked_for_are_read(spark, folder, monkeypatch):
    taken = []

    class Counted(io.BytesIO):
        def read(self, n=-1):
            taken.append(n)
            return super().read(n)

    got = dict.fromkeys(range(3))
    raw = bytes(range(256)) * 4000
    file = Counted(raw)
    for a, z, which in R.spans([(10, 20), (900_000, 7), (100, 5)]):
        file.seek(a)
        data = file.read(z - a)
        for i in which:
            got[i] = data[[(10, 20), (900_000, 7), (100, 5)][i][0] - a :][: (20, 7, 5)[i]]
    assert sum(taken) < 200 and got == {0: raw[10:30], 1: raw[900_000:900_007], 2: raw[100:105]}


def test_random_access_and_permutations(spark, folder):
    index = R.numbered(R.lines(spark, str(folder), values=False), "line").cache()
    every = [(f, x) for f, raw in sorted(FILES.items()) for x in plain(raw)]
    assert sorted((r.row, r.file.rsplit("/", 1)[1], r.line) for r in index.collect()) == [(i, f, x[0]) for i, (f, x) in enumerate(every)]
    wanted = spark.createDataFrame([(3, "c"), (0, "a"), (3, "b"), (99, "none")], "row long, tag string")
    found = sorted((r.tag, bytes(r.data)) for r in R.rows_at(index, wanted).collect())
    value = lambda i: every[i][1][3] + b"\n" * (every[i][1][2] > len(every[i][1][3]))
    assert found == [("a", value(0)), ("b", value(3)), ("c", value(3))]
    whole = sorted((r.place, r.row, bytes(r.data)) for r in R.epoch(index, 5).collect())
    assert [p for p, *_ in whole] == list(range(len(every))) and sorted(r for _, r, _ in whole) == list(range(len(every))) and all(d == value(r) for _, r, d in whole)
    parts = [sorted((r.place, r.row, bytes(r.data)) for r in R.epoch(index, 5, done, 4).collect()) for done in range(0, len(every), 4)]
    assert [x for p in parts for x in p] == whole and R.epoch(index, 5, len(every)).count() == 0
    assert [r for _, r, _ in whole] != [r.row for r in sorted(R.epoch(index, 6).collect(), key=lambda r: r.place)]


def test_members(spark, tmp_path):
    rng, made = random.Random(3), {}
    for s in range(3):
        with tarfile.open(tmp_path / f"s_{s}.tar", "w") as tar:
            for i in range(4 * s):
                data = rng.randbytes(rng.choice((0, 1, 700, 20_000)))
                info = tarfile.TarInfo(f"dir/{i}.{'json' if i % 2 else 'wav'}" if i else "plain")
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
                made[s, i] = info.name, data
            tar.addfile(tarfile.TarInfo("only-a-folder/")) if s else None
    found = R.members(spark, f"{tmp_path}/*.tar").filter(~F.col("name").startswith("only")).collect()
    assert {(int(r.file[-5]), r.member): (r.name, bytes(r.value)) for r in found} == made
    for r in found:
        assert open(r.file.removeprefix("file://"), "rb").read()[r.offset : r.offset + r.length] == bytes(r.value)
    index = R.members(spark, f"{tmp_path}/*.tar", values=False)
    assert index.filter("value is not null").count() == 0
    some = R.bytes_at(index.filter("member = 3")).collect()
    assert {(int(r.file[-5]), r.member): (r.name, bytes(r.data)) for r in some} == {k: v for k, v in made.items() if k[1] == 3}
    old = M.tar_members(spark, f"{tmp_path}/s_2.tar").filter("place < 2").orderBy("place").collect()
    assert [(r.stem, r.extension) for r in old] == [("plain", ""), ("dir/1", "json")]


def test_files_are_named_in_full(spark, folder):
    assert R.resolved(spark, str(folder)) == f"file://{folder}"
    assert R.files_of(spark, [str(folder)]) == sorted((f"file://{folder}/{n}", len(raw)) for n, raw in FILES.items())
    with pytest.raises(FileNotFoundError):
        R.files_of(spark, [f"{folder}/none*"])
