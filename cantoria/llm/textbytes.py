"""Vectorised byte-level views of Arrow text columns.

Every helper works on one concatenated UTF-8 buffer plus document offsets, so
that the per-byte work of the operators stays in numpy.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_STEP = np.uint64(0x9E3779B97F4A7C15)
#: The low 0 to 8 bytes of a block.
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Ranges of more bytes are hashed one by one.
_LONG = 1 << 12


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, applied in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _stirred(h: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The state after one more block; for a given block another state gives another one."""
    h ^= block
    h *= _STEP
    h ^= h >> np.uint64(29)
    return h


class RangeHasher:
    """64-bit hashes of byte ranges of one buffer, stirred block by block: eight bytes at a time, the length first.

    Each block passes a multiplication and a shift before the next is added,
    so there is no sum or polynomial whose terms could cancel (those of
    Thue-Morse words do, modulo a power of two).
    """

    def __init__(self, data: np.ndarray):
        self.data = np.append(data, np.zeros(8, np.uint8))
        #: the eight bytes at each place; strides of one byte, nothing is copied
        self.blocks = np.ndarray(len(data) + 1, "<u8", buffer=self.data, strides=(1,))

    def fixed(self, length: int) -> np.ndarray:
        """Hash of the range of this length at every position where it fits."""
        n = max(0, len(self.blocks) - length)
        h = np.full(n, length, np.uint64)
        for at in range(0, length, 8):
            h = _stirred(h, self.blocks[at : at + n] & _LOW[min(8, length - at)])
        return mix64(h)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = end - start
        h = size.astype(np.uint64)
        at = np.flatnonzero((size > 0) & (size <= _LONG))
        done = 0
        while len(at):
            left = size[at] - done
            h[at] = _stirred(h[at], self.blocks[start[at] + done] & _LOW[np.minimum(left, 8)])
            at, done = at[left > 8], done + 8
        for i in np.flatnonzero(size > _LONG).tolist():
            h[i] = np.frombuffer(hashlib.blake2b(self.data[start[i] : end[i]], digest_size=8).digest(), np.uint64)[0]
        return mix64(h)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def released() -> None:
    """Gives freed memory back to the system: a worker that many stages use would else keep the most that any of them took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batch: pa.RecordBatch | pa.Table, column: str, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch | pa.Table]:
    """Cuts a batch so that each slice holds at most this many text bytes, or one row."""
    n = batch.num_rows
    if not n:
        return
    col = batch.column(column)
    lengths = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    _, offsets = text_buffer(lengths)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end
    released()
