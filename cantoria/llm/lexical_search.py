"""Ranked lexical search: windows of documents, scatter-added scores, an occupancy bitset, a heap for each item.

One pass over the texts writes an index of the terms that the items ask for:
a row for each document with its length and its postings. Document frequencies
and lengths are summed from the index. Then each task takes its documents a
window at a time, in order of doc_id: the window's postings are put in order of
term, each item walks through the postings of its terms and adds to an array
with a cell for each document of the window, small enough for a processor's
cache; bitsets of the terms say which cells were touched; those are harvested
into the item's heap. What leaves a task is an item's best documents there, so
nothing grows with a term's frequency but the walk itself.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed, shared_folder
from .chunks import NO_ID, ids_of, text_of
from .minhash import LOWER
from .textbytes import RangeHasher, slices, text_buffer

#: Documents of a window: its scores take 128 KB.
WINDOW = 1 << 14
#: Postings after which a window ends early, so that long documents don't fill a task.
WINDOW_POSTINGS = 1 << 21
#: Terms of the items that one pass over the documents looks for.
BLOCK_TERMS = 1 << 19
#: An item's best documents meet in so many parts before they meet as a whole.
PARTS = 16
#: Fixed value: bytes that stand in a term, digits, letters and all that isn't ASCII.
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(batch) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the terms in order, number of terms before each row and in all)."""
    data, offsets = text_buffer(text_of(batch))
    data = LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _TERM[data]
    begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = inside[1:-1][inner]  # a term never goes on into the next row
    ends[inner - 1] = inside[1:-1][inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return RangeHasher(data).ranges(start, end), np.searchsorted(start, offsets)


def _counted(key: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, how often, bounds by row) of the distinct keys of each row."""
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return key[at], np.diff(np.append(at, len(key))), np.searchsorted(row[at], np.arange(rows + 1))


def _lists(bounds: np.ndarray, values: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


class LexicalSearch:
    """The `top` best documents (doc_id, text) of each item (item_id, text), by BM25 in whole numbers.

    Null and empty texts have no terms: such documents count nowhere, such
    items find nothing. A document without a doc_id is ranked like any other,
    as if its id were below all others; rows that repeat or share an id are
    documents of their own, and so are items. No documents, no rows. Terms are
    told apart by hashes of 64 bits. `block_terms` bounds the terms of the
    items that one pass looks for; an item is never split.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, top: int = 20, window: int = WINDOW, block_terms: int = BLOCK_TERMS):
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        self.top, self.window = top, window
        named = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))

        def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch, "text"):
                    h, first = terms_of(piece)
                    key, n, bounds = _counted(h.view(np.int64), np.repeat(np.arange(piece.num_rows), np.diff(first)), piece.num_rows)
                    yield pa.RecordBatch.from_arrays([piece.column("item"), piece.column("item_id"), _lists(bounds, key, pa.int64()), _lists(bounds, n, pa.int64())], ["item", "item_id", "terms", "times"])

        self.items = checkpointed(named.mapInArrow(asked, "item long, item_id long, terms array<long>, times array<long>").filter(F.size("terms") > 0))
        total = self.items.agg(F.sum(F.size("terms"))).first()[0] or 0
        self.blocks = math.ceil(total / block_terms)

    def ranked(self) -> DataFrame:
        """item_id, rank, doc_id, score."""
        spark = self.docs.sparkSession
        folder = f"{shared_folder(spark)}/search-{uuid.uuid4().hex}"
        schema = "item long, item_id long, doc_id long, score long"
        found = []
        for block in range(self.blocks):
            # at most BLOCK_TERMS or so terms, or one item
            items = self.items.filter(F.pmod(F.xxhash64("item"), F.lit(self.blocks)) == block).toArrow()
            if items.num_rows:
                found.append(f"{folder}/found-{block}")
                self._best(items, f"{folder}/index-{block}", schema).write.parquet(found[-1])
        best = spark.read.parquet(*found) if found else spark.createDataFrame([], schema)
        order = (F.desc("score"), F.asc("doc_id"))
        parts = best.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
        parts = parts.withColumn("at", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).filter(F.col("at") <= self.top)
        ranks = parts.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= self.top)
        return ranks.select("item_id", "rank", "doc_id", "score")

    def _best(self, items: pa.Table, to: str, schema: str) -> DataFrame:
        """Each task's best documents of each of these items."""
        spark, top, window = self.docs.sparkSession, self.top, self.window
        vocabulary, place = np.unique(items.column("terms").combine_chunks().flatten().to_numpy(), return_inverse=True)
        _index(self.docs, vocabulary).write.parquet(to)
        index = spark.read.parquet(to)
        width = len(vocabulary)

        def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width + 2, np.int64)  # then the documents and all their terms
            for batch in batches:
                total[:width] += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=width)
                total[width:] += batch.num_rows, int(batch.column("n").to_numpy().sum())
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["at", "n"])

        counts = np.zeros(width + 2, np.int64)
        for at, n in index.mapInArrow(frequencies, "at int, n long").groupBy("at").agg(F.sum("n")).collect():  # a row for each term asked for
            counts[at] = n
        documents, terms = int(counts[width]), int(counts[width + 1])
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in counts[:width].tolist()], np.int64)
        bounds = items.column("terms").combine_chunks().offsets.to_numpy()
        times = items.column("times").combine_chunks().flatten().to_numpy()
        queries = [(no, item_id, list(zip(place[a:b].tolist(), (weight[place[a:b]] * times[a:b]).tolist(), strict=True))) for no, item_id, a, b in zip(items.column("item").to_pylist(), items.column("item_id").to_pylist(), bounds[:-1], bounds[1:], strict=True)]

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            heaps: list[list[tuple[int, int]]] = [[] for _ in queries]
            for rows in _windows(batches, window):
                _walk(rows, queries, heaps, top, width, documents, terms)
            out = [(no, item_id, -up if up != -NO_ID else None, score) for (no, item_id, _), heap in zip(queries, heaps, strict=True) for score, up in heap]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(4)], ["item", "item_id", "doc_id", "score"])

        return index.mapInArrow(search, schema)


def _index(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tf) of the documents that have a term; terms are places in the vocabulary."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                h, first = terms_of(piece)
                n, h = np.diff(first), h.view(np.int64)
                at = np.searchsorted(vocabulary, h)
                at[at == len(vocabulary)] = 0
                asked = vocabulary[at] == h
                key, tf, bounds = _counted(at[asked], np.repeat(np.arange(piece.num_rows), n)[asked], piece.num_rows)
                out = pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(n), _lists(bounds, key, pa.int32()), _lists(bounds, tf, pa.int64())], ["doc_id", "n", "terms", "tf"])
                yield out.filter(pa.array(n > 0))

    return docs.mapInArrow(post, "doc_id long, n long, terms array<int>, tf array<long>")


def _windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """A task's documents in windows of at most `size` rows, each in order of doc_id."""
    held: list[pa.RecordBatch] = []

    def joined() -> pa.Table:
        rows = pa.Table.from_batches(held)
        held.clear()
        return rows.take(pa.array(np.argsort(ids_of(rows), kind="stable")))

    rows = postings = 0
    for batch in batches:
        while batch.num_rows:
            lists = batch.column("terms")
            ends = np.asarray(lists.offsets)[1:].astype(np.int64) - lists.offsets[0].as_py()
            fits = min(size - rows, max(1 if not rows else 0, int(np.searchsorted(ends, WINDOW_POSTINGS - postings, "right"))), batch.num_rows)
            if fits:
                held.append(batch.slice(0, fits))
                rows, postings = rows + fits, postings + int(ends[fits - 1])
            batch = batch.slice(fits)
            if batch.num_rows:
                yield joined()
                rows = postings = 0
    if held:
        yield joined()


def _walk(rows: pa.Table, queries: list, heaps: list, top: int, width: int, documents: int, terms: int) -> None:
    """Scores one window for each item and harvests it into the heaps, whose entries are (score, -doc_id)."""
    ids, n = ids_of(rows), rows.column("n").to_numpy()
    lists = rows.column("terms").combine_chunks()
    slot = np.repeat(np.arange(len(ids), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    term = lists.flatten().to_numpy()
    by = np.argsort(term, kind="stable")  # slots of a term stay in order of doc_id
    slot, tf, first = slot[by], rows.column("tf").combine_chunks().flatten().to_numpy()[by], np.searchsorted(term[by], np.arange(width + 1)).tolist()
    m = 75 + (25 * documents * n) // terms
    gain = (1_000_000_000 * tf) // (1000 * tf + 12 * m[slot])
    score, bits = np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
    sets: dict[int, np.ndarray] = {}  # the bitset of each term of this window
    for (_, _, asked), heap in zip(queries, heaps, strict=True):
        touched = np.zeros((len(ids) + 7) // 8, np.uint8)
        for t, w in asked:
            a, b = first[t], first[t + 1]
            if a == b or not w:
                continue
            here = slot[a:b]
            score[here] += w * gain[a:b]  # a term has each slot once
            if t not in sets:
                bits[here] = True
                sets[t] = np.packbits(bits)
                bits[here] = False
            touched |= sets[t]
        at = np.flatnonzero(np.unpackbits(touched, count=len(ids)))
        got = score[at]
        score[at] = 0
        keep = got >= max(1, heap[0][0] if len(heap) == top else 1)
        at, got = at[keep], got[keep]
        if len(got) > top:
            keep = got >= np.partition(got, -top)[-top]
            at, got = at[keep], got[keep]
            keep = np.lexsort((at, -got))[:top]  # of equal scores the smaller ids
            at, got = at[keep], got[keep]
        for s, i in zip(got.tolist(), ids[at].tolist(), strict=True):
            if len(heap) < top:
                heapq.heappush(heap, (s, -i))
            elif (s, -i) > heap[0]:
                heapq.heapreplace(heap, (s, -i))


#: The same rows; {top} are asked for.
ORACLE_SQL = r"""
with words as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
asked as (select item_id, term, count(*) as times from (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark) group by all),
lengths as (select doc_id, count(*) as n from words group by 1),
totals as (select count(*)::bigint as docs, sum(n)::bigint as terms from lengths),
postings as (select term, doc_id, count(*) as tf from words where term in (select term from asked) group by all),
weights as (select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)))::bigint as w from postings, totals group by term),
scored as (
  select item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::bigint as score
  from asked join postings using (term) join weights using (term) join lengths using (doc_id), totals group by all)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
from scored where score > 0 qualify rank <= {top}
"""
