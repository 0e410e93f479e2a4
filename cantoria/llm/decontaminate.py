"""Benchmark decontamination by greedy string tiling.

Words of documents and test items that start a shared run of `least` words are
seeds. For each document and item that share a seed, matches are extended from
their seeds, the longest is marked, matches that it cut are tried again, and so
on until no unmarked match of `least` words is left. The share of the item's
words under tiles is its coverage: passages whose parts were put into another
order are covered like those copied whole.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import text_of
from .textbytes import RangeHasher, mix64, slices, text_buffer

#: Items are taken in blocks of at most so many bytes of text; a block goes to every task.
BLOCK_BYTES = 16 << 20
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each lower-cased word, number of words before each row and in all); words are runs of letters, digits and non-ASCII bytes."""
    data, offsets = text_buffer(pc.utf8_lower(column))
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = WORD[data]
    begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = inside[1:-1][inner]
    ends[inner - 1] = inside[1:-1][inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return RangeHasher(data).ranges(start, end), np.searchsorted(start, offsets)


def rolling(words: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of `length` words."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = np.multiply.accumulate(np.append(np.uint64(1), np.full(len(words) - 1, 0x9E3779B97F4A7C15, np.uint64)))
    back = np.multiply.accumulate(np.append(np.uint64(1), np.full(n - 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64)))
    sums = np.append(np.uint64(0), np.cumsum(words * power))
    return mix64((sums[length:] - sums[:-length]) * back)


def tiles(text: np.ndarray, item: np.ndarray, seeds: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word sequences from their seeds (text place, item place): (text place, item place, length)."""
    heap, reach = [], {}
    for i, j in sorted(seeds):  # each maximal match once, from its first seed
        if reach.get(i - j, -1) >= i:
            continue
        n, most = 0, min(len(text) - i, len(item) - j)
        differ = np.flatnonzero(text[i : i + most] != item[j : j + most])
        n = int(differ[0]) if len(differ) else most
        reach[i - j] = i + n - least
        if n >= least:
            heap.append((-n, i, j))
    heapq.heapify(heap)
    text_free, item_free, out = np.ones(len(text), bool), np.ones(len(item), bool), []
    while heap:
        n, i, j = heapq.heappop(heap)
        n = -n
        free = text_free[i : i + n] & item_free[j : j + n]
        if free.all():
            text_free[i : i + n] = item_free[j : j + n] = False
            out.append((i, j, n))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([False], free, [False])).astype(np.int8)))
        for a, z in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if z - a >= least:
                heapq.heappush(heap, (a - z, i + a, j + a))
    return out


class Items:
    """A block of test items: seeds by hash, and the words of each item."""

    def __init__(self, rows: list[tuple[int, str]], least: int):
        self.ids = [i for i, _ in rows]
        words, first = word_hashes(pa.array([t or "" for _, t in rows], pa.string()))
        self.words = [words[a:z] for a, z in zip(first[:-1], first[1:], strict=True)]
        #: an item of fewer words is one seed of its own length
        self.least = [min(least, max(1, len(w))) for w in self.words]
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in sorted(set(self.least)):
            mine = [k for k, w in enumerate(self.words) if self.least[k] == n and len(w)]
            h = [rolling(self.words[k], n) for k in mine]
            if not mine:
                continue
            flat = np.concatenate(h)
            order = np.argsort(flat, kind="stable")
            owner = np.repeat(mine, [len(x) for x in h])[order]
            place = np.concatenate([np.arange(len(x)) for x in h])[order]
            self.by_length[n] = (flat[order], owner, place)

    def covered(self, batch) -> Iterator[tuple[int, int, int, int]]:
        """(row, item, covered words, item's words) for each row that shares a seed with an item."""
        words, first = word_hashes(text_of(batch).fill_null(""))
        pairs: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for n, (hashes, owner, place) in self.by_length.items():
            runs = rolling(words, n)
            sieve = np.zeros(1 << 20, bool)
            sieve[hashes >> np.uint64(44)] = True
            at = np.flatnonzero(sieve[runs >> np.uint64(44)])
            lo, hi = np.searchsorted(hashes, runs[at], "left"), np.searchsorted(hashes, runs[at], "right")
            row = np.searchsorted(first, at, "right") - 1
            good = (hi > lo) & (at + n <= first[row + 1])
            for i, a, z, r in zip(at[good].tolist(), lo[good].tolist(), hi[good].tolist(), row[good].tolist(), strict=True):
                for q in range(a, z):
                    pairs.setdefault((r, int(owner[q])), []).append((i - int(first[r]), int(place[q])))
        for (r, k), seeds in sorted(pairs.items()):
            found = tiles(words[first[r] : first[r + 1]], self.words[k], seeds, self.least[k])
            yield r, self.ids[k], sum(n for _, _, n in found), len(self.words[k])


class Decontaminate:
    """Documents against test items (item_id, text).

    least: words in a tile, fewer for an item of fewer words. percent: coverage
    of an item from which a document counts as contaminated. Null or wordless
    texts share nothing; a null item_id is an item like any other. Only doc_id
    and text are read from documents.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, least: int = 5, percent: int = 50, block_bytes: int = BLOCK_BYTES):
        self.whole = docs
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        self.least, self.percent = least, percent
        self.items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
        self.size = self.items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.blocks = max(1, -(-self.size // block_bytes))

    def _block(self, block: int):
        """The items of one block, sent to every task."""
        own = self.items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(self.blocks)) == block) if self.blocks > 1 else self.items
        return own.sparkSession.sparkContext.broadcast(sorted(map(tuple, own.collect()), key=lambda r: (r[0] is not None, r)))  # block_bytes or so

    def clean(self) -> DataFrame:
        """The documents that aren't contaminated, with all their columns."""
        least, percent, out = self.least, self.percent, self.whole

        def without(sent):
            def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                items = Items(sent.value, least)
                for batch in batches:
                    for piece in slices(batch, "text"):
                        good = np.ones(piece.num_rows, bool)
                        for r, _, covered, size in items.covered(piece):
                            good[r] &= 100 * covered < percent * size
                        yield piece.filter(pa.array(good))

            return judge

        for block in range(self.blocks):
            out = out.mapInArrow(without(self._block(block)), out.schema)
        return out

    def documents(self) -> DataFrame:
        """doc_id, contaminated, kept, n_items (test items covered), coverage (largest share of any item), items (their ids): a row for each document."""
        least, percent = self.least, self.percent
        schema = "doc_id long, tie long, coverage double, items array<long>"
        keyed = self.docs.withColumn("tie", F.xxhash64("text"))

        def against(block: int) -> DataFrame:
            sent = self._block(block)

            def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                items = Items(sent.value, least)
                for batch in batches:
                    for piece in slices(batch, "text"):
                        n = piece.num_rows
                        best, hits = np.zeros(n), [[] for _ in range(n)]
                        for r, item, covered, size in items.covered(piece):
                            best[r] = max(best[r], covered / size)
                            if 100 * covered >= percent * size:
                                hits[r].append(item)
                        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("tie"), pa.array(best), pa.array(hits, pa.list_(pa.int64()))], ["doc_id", "tie", "coverage", "items"])

            return keyed.mapInArrow(judge, schema)

        out = against(0)
        if self.blocks > 1:
            for block in range(1, self.blocks):
                out = out.unionByName(against(block))
            out = out.groupBy("doc_id", "tie").agg(F.max("coverage").alias("coverage"), F.flatten(F.collect_list("items")).alias("items"), (F.count("*") / self.blocks).cast("int").alias("rows"))
            out = out.withColumn("row", F.explode(F.sequence(F.lit(1), "rows")))
        hit = F.size("items") > 0
        return out.select("doc_id", hit.alias("contaminated"), (~hit).alias("kept"), F.size("items").cast("long").alias("n_items"), "coverage", "items")
