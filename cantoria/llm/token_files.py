"""Token ids in binary record files.

A file is a sequence of records: payload length (u64), masked checksum of the
length (u32), payload, masked checksum of the payload (u32), all little-endian.
A payload is the doc_id (i64, with the least value for null) and the ids, as
u16 where the vocabulary allows, else u32. Beside each file stands an offset
index of fixed-width rows (offset u64, doc_id i64, tokens u32), so that any
record can be read alone, in any order.
"""

from __future__ import annotations

import base64
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import session
from .bpe import NOT_PLAIN, tokenizer
from .chunks import NO_ID

INDEX = np.dtype([("offset", "<u8"), ("doc_id", "<i8"), ("tokens", "<u4")])
SHARD = "shard int, path string, records long, tokens long, width int"
SHARD_BYTES = 32 << 20


def masked(raw: bytes) -> int:
    """CRC-32, rotated and shifted, so that a checksum of bytes that hold checksums stays sound."""
    crc = zlib.crc32(raw)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def unframed(stream) -> Iterator[bytes]:
    """The payloads of a record file; a wrong checksum or a torn record raises ValueError."""
    while head := stream.read(12):
        if len(head) < 12 or masked(head[:8]) != struct.unpack("<I", head[8:])[0]:
            raise ValueError("damaged record length")
        size = struct.unpack("<Q", head[:8])[0]
        body = stream.read(size + 4)
        if len(body) < size + 4 or masked(body[:-4]) != struct.unpack("<I", body[-4:])[0]:
            raise ValueError("damaged record")
        yield body[:-4]


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if re.match(r"\w+:/", uri) else f"file://{os.path.abspath(uri)}")


def shared_folder(spark) -> str:
    """A new folder in the one that the cluster names for shared files."""
    return f"{session.shared_folder(spark)}/tokens-{uuid.uuid4().hex}"


@lru_cache(maxsize=2)
def encoder(path: str, ranks_path: str | None):
    """text -> ids as the tokenizer of `path` gives them; Latin texts go through the same vocabulary in its faster rank form, if given."""
    slow = tokenizer(path)
    whole = lambda text: slow.encode(text, add_special_tokens=False).ids
    if not ranks_path:
        return whole
    import tiktoken
    from public_tokenizers import PATTERN

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    special = [x.content for x in slow.get_added_tokens_decoder().values()]
    return lambda text: whole(text) if NOT_PLAIN.search(text) or any(s in text for s in special) else fast(text)


def write(docs: DataFrame, path: str, folder: str, end_id: int = 0, ranks_path: str | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the documents' ids in ascending doc_id order; a row for each shard (shard, path, records, tokens, width).

    Null text: only the end id. Null doc_id: before all others. Rows with one
    doc_id stand in the order of their texts' hashes. Every attempt of a task
    writes files of its own; only those named in the returned rows count.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    width = 2 if tokenizer(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(path, ranks_path), TaskContext.get()
        shard, files, to = task.partitionId(), *place(folder)
        name, index, at, tokens = f"{to}/shard-{shard:08d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}", [], 0, 0
        files.create_dir(to, recursive=True)
        with files.open_output_stream(f"{name}.rec") as out:
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = np.array([*encode(text.as_py()), end_id], f"<u{width}")
                    doc_id = NO_ID if doc_id is None else doc_id
                    record = framed(struct.pack("<q", doc_id) + ids.tobytes())
                    out.write(record)
                    index.append((at, doc_id, len(ids)))
                    at, tokens = at + len(record), tokens + len(ids)
        with files.open_output_stream(f"{name}.idx") as out:
            out.write(np.array(index, INDEX).tobytes())
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [name], "records": [len(index)], "tokens": [tokens], "width": pa.array([width], pa.int32())})

    return dealt.repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie").mapInArrow(save, SHARD)


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """The documents in the shards of a manifest: doc_id, start, n_tokens, ids_crc32."""
    # ids before each shard: running sums within groups of shards, and of the groups' totals, of which there are few
    grouped = manifest.withColumn("group", F.floor(F.col("shard") / 1024))
    earlier = lambda order: Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    totals = grouped.groupBy("group").agg(F.sum("tokens").alias("tokens"))
    base = totals.select("group", F.coalesce(F.sum("tokens").over(earlier("group")), F.lit(0)).alias("base"))
    within = F.coalesce(F.sum("tokens").over(Window.partitionBy("group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    listed = grouped.withColumn("within", within).join(base, "group").select("path", "width", (F.col("base") + F.col("within")).alias("start"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = place(folder)
        for batch in batches:
            for r in batch.to_pylist():
                out, at = [], r["start"]
                with files.open_input_stream(f"{r['path']}.rec") as stream:
                    for payload in unframed(stream):
                        ids = np.frombuffer(payload, f"<u{r['width']}", offset=8).astype("<u4")
                        doc_id = struct.unpack("<q", payload[:8])[0]
                        out.append((None if doc_id == NO_ID else doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
                        at += len(ids)
                cols = list(zip(*out, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.repartition(max(1, manifest.count()), "path").mapInArrow(load, schema)


def read_record(folder: str, path: str, at: int, width: int) -> tuple[int | None, np.ndarray]:
    """(doc_id, ids) of the record number `at` of one shard, through its offset index."""
    files, _ = place(folder)
    with files.open_input_file(f"{path}.idx") as index:
        index.seek(at * INDEX.itemsize)
        entry = np.frombuffer(index.read(INDEX.itemsize), INDEX)[0]
    with files.open_input_file(f"{path}.rec") as records:
        records.seek(int(entry["offset"]))
        payload = next(unframed(records))
    doc_id = struct.unpack("<q", payload[:8])[0]
    return None if doc_id == NO_ID else doc_id, np.frombuffer(payload, f"<u{width}", offset=8)
