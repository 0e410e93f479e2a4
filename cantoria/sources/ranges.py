"""Files read by ranges of bytes: lines and archive members with their places, and random access by those.

A Python data source gives each task a range of a line file, or an archive that
it walks member by member; no file is held whole. Places make an index, through
which rows are read by number, or in the order of a permutation that can be
taken up where it was left: each read opens a file once a task and takes the
bytes asked for. A filter belongs on the index: `bytes_at` reads what is left
of it. (The source takes no filters itself: what one query pushes into a Python
source would stay with the DataFrame for the next.)
"""

from __future__ import annotations

import io
import json
import re
import tarfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.batching import permuted

NAME = "cantoria_ranges"
RANGE = 64 << 20
CHUNK = 4 << 20
LINES = "file string, range long, at long, offset long, length long, value binary"
MEMBERS = "file string, range long, at long, offset long, length long, name string, value binary"
#: Bytes between two places that one read takes along.
GAP = 64 << 10


def _named(path: str) -> str:
    """Local paths with three slashes, as others than Hadoop want them."""
    return re.sub(r"^file:/+", "file:///", path)


def resolved(spark: SparkSession, path: str) -> str:
    """The path with scheme and host, as the default file system of the cluster has it."""
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    files = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return _named(str(files.makeQualified(found).toString()))


def files_of(spark: SparkSession, paths: list[str]) -> list[tuple[str, int]]:
    """(path with scheme, bytes) of the files that paths, globs or folders name, in order of path."""
    jvm, out = spark.sparkContext._jvm, []
    for path in paths:
        found = jvm.org.apache.hadoop.fs.Path(path)
        files = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        listed = files.globStatus(found)
        if not listed:
            raise FileNotFoundError(path)
        for status in listed:
            inside = files.listStatus(status.getPath()) if status.isDirectory() else [status]
            out += [(_named(str(s.getPath().toString())), int(s.getLen())) for s in inside if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
    return sorted(set(out))


def opened(path: str) -> io.BufferedReader:
    """A file that can be read from any place."""
    files, at = pafs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")
    return io.BufferedReader(files.open_input_file(at), 1 << 16)


def line_places(file, start: int, end: int, values: bool) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes] | None]]:
    """(offsets, lengths with the line feed, values without) of the lines that begin in [start, end), some at a time."""
    at = max(0, start - 1)
    file.seek(at)
    held = b""  # from `at` on
    if start:  # the line that the range begins in belongs to the one before
        while (feed := held.find(b"\n")) < 0:
            more = file.read(CHUNK)
            if not more:
                return
            at, held = at + len(held), more
        at, held = at + feed + 1, held[feed + 1 :]
    while at < end:
        more = file.read(max(CHUNK, len(held)))
        data = held + more
        feeds = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
        if not more and data and (not len(feeds) or feeds[-1] != len(data) - 1):
            feeds = np.append(feeds, len(data))  # the last line has no line feed
        begins = np.append(0, feeds[:-1] + 1) if len(feeds) else np.zeros(0, np.int64)
        own = begins + at < end
        b, f = begins[own], feeds[own]
        if len(b):
            yield b + at, np.minimum(f + 1, len(data)) - b, [data[x:y] for x, y in zip(b.tolist(), f.tolist(), strict=True)] if values else None
        done = int(feeds[-1]) + 1 if len(feeds) else 0
        at, held = at + done, data[done:]
        if not more:
            return


class _Range(InputPartition):
    def __init__(self, file: str, start: int, end: int):
        self.file, self.start, self.end = file, start, end


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.kind, self.values = options["kind"], options.get("values", "true") == "true"
        size = int(options.get("range_bytes", RANGE))
        ranges = [(f, a, min(a + size, n) if self.kind == "lines" else n) for f, n in json.loads(options["files"]) for a in range(0, max(n, 1), size if self.kind == "lines" else max(n, 1))]
        self.ranges = [r for r in ranges if r[2] > r[1]]

    def partitions(self):
        return [_Range(*r) for r in self.ranges] or [_Range("", 0, 0)]

    def read(self, partition):
        if partition.end <= partition.start:
            return
        yield from (self._lines if self.kind == "lines" else self._members)(partition)

    def _lines(self, p: _Range) -> Iterator[pa.RecordBatch]:
        with opened(p.file) as file:
            n = 0
            for offset, length, values in line_places(file, p.start, p.end, self.values):
                k = len(offset)
                yield pa.RecordBatch.from_arrays([pa.array([p.file] * k), pa.array(np.full(k, p.start)), pa.array(np.arange(n, n + k)), pa.array(offset), pa.array(length), pa.array(values, pa.binary()) if self.values else pa.nulls(k, pa.binary())], ["file", "range", "at", "offset", "length", "value"])
                n += k

    def _members(self, p: _Range) -> Iterator[pa.RecordBatch]:
        with opened(p.file) as file, tarfile.open(fileobj=file, mode="r:") as tar:
            n = 0
            for m in tar:
                tar.members = []  # else it keeps every header
                if m.isfile():
                    value = tar.extractfile(m).read() if self.values else None
                    yield pa.RecordBatch.from_arrays([pa.array([p.file]), pa.array([0], pa.int64()), pa.array([n], pa.int64()), pa.array([m.offset_data], pa.int64()), pa.array([m.size], pa.int64()), pa.array([m.name]), pa.array([value], pa.binary())], ["file", "range", "at", "offset", "length", "name", "value"])
                    n += 1


class ByteRanges(DataSource):
    """Options: files (JSON of (path, bytes) pairs), kind (lines or members), values (false: places only), range_bytes."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return LINES if self.options["kind"] == "lines" else MEMBERS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def _read(spark: SparkSession, paths, kind: str, values: bool, range_bytes: int) -> DataFrame:
    spark.dataSource.register(ByteRanges)
    files = files_of(spark, [paths] if isinstance(paths, str) else list(paths))
    return spark.read.format(NAME).options(files=json.dumps(files), kind=kind, values=str(values).lower(), range_bytes=str(range_bytes)).load()


def lines(spark: SparkSession, paths, values: bool = True, range_bytes: int = RANGE) -> DataFrame:
    """(file, line, offset, length, value) of the lines of files: a line ends with a line feed, which counts in length but isn't in value."""
    each = _read(spark, paths, "lines", values, range_bytes)
    counts = _read(spark, paths, "lines", False, range_bytes).groupBy("file", "range").agg(F.count("*").alias("n"))
    before = counts.select("file", "range", F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return each.join(before, ["file", "range"]).select("file", (F.col("before") + F.col("at")).alias("line"), "offset", "length", "value")


def places(spark: SparkSession, paths, range_bytes: int = RANGE) -> DataFrame:
    """Lines of files, by range, without their values: for counting."""
    return _read(spark, paths, "lines", False, range_bytes).select("file", "range", "at")


def members(spark: SparkSession, paths, values: bool = True) -> DataFrame:
    """(file, member, name, offset, length, value) of the files in tar archives, one archive a task; without values only headers are read."""
    return _read(spark, paths, "members", values, RANGE).select("file", F.col("at").alias("member"), "name", "offset", "length", "value")


def numbered(index: DataFrame, within: str) -> DataFrame:
    """The index with `row`, the number of a line or member over all files in order of path."""
    counts = index.groupBy("file").agg(F.count("*").alias("n"))
    before = counts.select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # a row for each file
    return index.join(before, "file").withColumn("row", F.col("before") + F.col(within)).drop("before")


def within_shards(index: DataFrame, counts: DataFrame, shard: Column, place: str) -> DataFrame:
    """The index with `place` numbered over all files of a shard in order of path; counts: the same files' index, of which only rows are counted."""
    n = counts.groupBy("file").agg(F.count("*").alias("n")).select("file", shard.alias("_shard"), "n")
    before = n.select("file", F.coalesce(F.sum("n").over(Window.partitionBy("_shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # a row for each file
    return index.join(before, "file").withColumn(place, F.col("before") + F.col(place)).drop("before")


def as_one(index: DataFrame, files: list[tuple[str, int]]) -> DataFrame:
    """Lines of `files_of` files with number and offset as if the files, in order of path, were one; each must end with a line feed."""
    begins = np.cumsum([0, *(n for _, n in files)]).tolist()
    at = index.sparkSession.createDataFrame([(f, b) for (f, _), b in zip(files, begins, strict=False)], "file string, _begin long")  # a row for each file
    one = numbered(index, "line").join(at, "file")
    return one.withColumns({"line": F.col("row"), "offset": F.col("_begin") + F.col("offset")}).drop("row", "_begin")


def spans(places: list[tuple[int, int]], gap: int = GAP) -> list[tuple[int, int, list[int]]]:
    """Places (offset, length) in any order -> reads (begin, end, which places), neighbours together."""
    out: list[list] = []
    for i in sorted(range(len(places)), key=lambda i: places[i]):
        a, n = places[i]
        if out and a - out[-1][1] <= gap and max(out[-1][1], a + n) - out[-1][0] <= RANGE:
            out[-1][1] = max(out[-1][1], a + n)
            out[-1][2].append(i)
        else:
            out.append([a, a + n, [i]])
    return [tuple(x) for x in out]


def bytes_at(places: DataFrame) -> DataFrame:
    """(file, offset, length, ...) with `data`, the bytes there; only those, and short gaps between them, are read."""
    columns = [c for c in places.columns if c != "data"]
    schema = places.select(columns).withColumn("data", F.lit(None).cast("binary")).schema

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, offsets, lengths = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
            by: dict[str, list[int]] = {}
            for i, f in enumerate(files):
                by.setdefault(f, []).append(i)
            data: list[bytes | None] = [None] * batch.num_rows
            for f, rows in by.items():
                with opened(f) as file:
                    for a, z, which in spans([(offsets[i], lengths[i]) for i in rows]):
                        file.seek(a)
                        got = file.read(z - a)
                        for k in which:
                            i = rows[k]
                            data[i] = got[offsets[i] - a : offsets[i] - a + lengths[i]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], [*batch.schema.names, "data"])

    return places.select(columns).repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInArrow(read, schema)


def rows_at(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of a `numbered` index that `wanted` (row, ...) asks for, with their bytes; numbers that the index hasn't are left out."""
    return bytes_at(wanted.join(index.drop("value"), "row"))


def epoch(index: DataFrame, seed: int, done: int = 0, take: int | None = None) -> DataFrame:
    """(place, row, ..., data): places done, done + 1, ... of the rows' permutation by a seed; what one run leaves another takes up."""
    n = index.count()
    end = n if take is None else min(n, done + take)
    places = index.sparkSession.range(done, max(done, end)).withColumnRenamed("id", "place")
    return rows_at(index, places.withColumn("row", permuted(F.col("place"), n, seed)) if n else places.withColumn("row", F.lit(None).cast("long")))
