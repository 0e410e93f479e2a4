"""Documents dealt into chunks of bounded size, and packed columns exchanged between chunks and key buckets.

A chunk is the unit in which per-byte work is vectorised and in which keys are
pre-aggregated: a key that stands in every document reaches its bucket once per
chunk, however often it occurs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_ID = -(2**63)
PIECE = "chunk int, rows binary"
ROWS = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(docs: DataFrame, chunk_bytes: int) -> tuple[DataFrame, int]:
    """(doc_id, text, chunk) where the rows stand, and the number of partitions for them; chunks follow the hash of a row, so a retried task deals alike."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(total / chunk_bytes))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(chunks / 8))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(chunks, min(parts, 4 * chunks)))).cast("int"))
    return rows, parts


def chunked(docs: DataFrame, chunk_bytes: int) -> tuple[DataFrame, int]:
    """(doc_id, text, chunk) dealt by chunk, and the number of partitions."""
    rows, parts = dealt(docs, chunk_bytes)
    return rows.repartition(parts, "chunk"), parts


def pieces(rows: DataFrame) -> DataFrame:
    """(chunk, rows): what a batch has of a chunk, compressed as one; an exchange of rows compresses them less."""

    def packed(batches):
        for batch in batches:
            chunk = batch.column("chunk").to_numpy()
            order = np.argsort(chunk, kind="stable")
            cuts = np.flatnonzero(np.diff(chunk[order], prepend=-1))
            own = pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in ROWS], schema=ROWS)
            raw = [zstandard.ZstdCompressor(level=1).compress(own.take(pa.array(part)).serialize()) for part in np.split(order, cuts[1:]) if len(part)]
            yield pa.RecordBatch.from_arrays([pa.array(chunk[order][cuts], pa.int32()), pa.array(raw, pa.binary())], names=["chunk", "rows"])

    return rows.mapInArrow(packed, PIECE)


def rows_of(table: pa.Table) -> pa.Table:
    """The doc_id and text of a chunk's pieces."""
    return pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(zstandard.ZstdDecompressor().decompress(raw)), ROWS) for raw in table.column("rows").to_pylist()], ROWS)


def pack(x: np.ndarray, squeeze: bool = False) -> bytes:
    raw = np.ascontiguousarray(x).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw) if squeeze else raw


def unpack(raw: bytes, dtype, squeeze: bool = False) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw) if squeeze else raw, dtype)


def ids_of(table: pa.Table) -> np.ndarray:
    """doc_id as int64; a null id counts as one below all others."""
    col = table.column("doc_id")
    return col.fill_null(NO_ID).to_numpy().astype(np.int64) if table.num_rows else np.zeros(0, np.int64)


def text_of(table: pa.Table | pa.RecordBatch, name: str = "text") -> pa.Array:
    col = table.column(name)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    return col
