"""MinHash near-duplicates: banded universal-hash minima, signature check, full-set check, components.

Documents with one shingle set are one node. Nodes that share a band with a
bucket's least node form candidate clusters (components of the star links), so
every two nodes of one bucket stand in one cluster. A cluster is compared in
blocks of bounded size: pairs still apart are screened by their signatures and
confirmed on full sets, and only links that join two components leave a block.
A cluster of several blocks is first compared with its hubs, a fixed number of
its nodes for each block. Then, where few nodes are outside its largest
component, these are compared with all of it; where many are (clusters chained
together by chance), each bucket's nodes outside the bucket's largest component
are compared with that bucket alone. Either way no pair of one bucket is left
that is neither joined nor checked, and rows exchanged follow the size of a
cluster or of the buckets, not the square of a cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .chunks import text_of
from .components import connected_components
from .textbytes import RangeHasher, mix64, released, slices, text_buffer

#: A-z for A-Z, and the bytes that end a word.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BLOCK = 256
HUBS = 64
#: Bytes of sets and signatures in a block of what is left after that: the larger the blocks, the fewer times a node is sent.
BLOCK_BYTES = 8 << 20
#: Blocks of nodes outside the largest component up to which they are compared with their whole cluster.
FEW_ASKED = 8


def words_of(batch, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start and end of each word, number of words before each row and in all)."""
    data, offsets = text_buffer(text_of(batch))
    if lower:
        data = LOWER[data]
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = SPACE[data]
    begins, ends = ~gap[1:-1] & gap[:-2], ~gap[1:-1] & gap[2:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = ~gap[1:-1][inner]  # a word never goes on into the next row
    ends[inner - 1] = ~gap[1:-1][inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return data, start, end, np.searchsorted(start, offsets)


def shingle_sets(batch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct k-word shingles of each row; fewer words make one shingle, none makes none."""
    data, start, end, first = words_of(batch)
    word = RangeHasher(data).ranges(start, end)
    per_row = np.diff(first)
    row = np.repeat(np.arange(len(per_row)), per_row)
    place = np.arange(len(word)) - first[row]
    last = per_row[row] - place  # words from here to the row's end
    keep = (last >= k) | (place == 0)
    at = np.flatnonzero(keep)
    mixed = np.zeros(len(at), np.uint64)
    for j in range(k):
        there = last[at] > j
        mixed[there] += (word[at[there] + j] ^ np.uint64(j + 1)) * np.uint64(2 * (0x51ED270B * (j + 3)) + 1)
        mix64(mixed)
    mixed += np.minimum(last[at], k).astype(np.uint64)
    mix64(mixed)
    row = row[at]
    order = np.lexsort((mixed, row))
    mixed, row = mixed[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (mixed[1:] != mixed[:-1]) | (row[1:] != row[:-1])
    return mixed[new], np.searchsorted(row[new], np.arange(len(per_row) + 1))


def signatures(hashes: np.ndarray, bounds: np.ndarray, count: int) -> np.ndarray:
    """The minima of `count` multiply-shift hashes over each non-empty set; rows of empty sets are zero."""
    rng = np.random.RandomState(7)
    a, b = (rng.randint(0, 2**63 - 1, count, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1) for _ in "ab")
    out = np.zeros((len(bounds) - 1, count), np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        x = hashes >> np.uint64(32)
        for j in range(count):
            h = x * a[j]
            h += b[j]
            h >>= np.uint64(32)
            out[full, j] = np.minimum.reduceat(h, bounds[full])
    return out


def node_keys(hashes: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Sixteen bytes that name each row's set."""
    sums = []
    for salt in (0x1234567, 0x7654321):
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mix64(hashes ^ np.uint64(salt)), out=total[1:])
        sums.append(total[bounds[1:]] - total[bounds[:-1]])
    raw = np.column_stack(sums).astype("<u8").tobytes()
    return [raw[i : i + 16] for i in range(0, len(raw), 16)]


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    out = np.zeros((len(signature), bands), np.uint64)
    rows = signature.shape[1] // bands
    for b in range(bands):
        h = np.full(len(signature), b + 1, np.uint64)
        for j in range(rows):
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + signature[:, b * rows + j])
        out[:, b] = h
    return out.view(np.int64)


def _numbers(count: str) -> Column:
    return F.transform(F.sequence(F.lit(0), F.col(count) - 1), lambda x: x.cast("string"))


def _with_ask_blocks(apart: DataFrame) -> DataFrame:
    """apart (cluster, node, component, query, bytes) with the numbers of blocks that all of a cluster and its queries fill."""
    filled = lambda total: F.greatest(F.ceil(F.coalesce(total, F.lit(0)) / BLOCK_BYTES), F.lit(1)).cast("int")
    sizes = apart.groupBy("cluster").agg(filled(F.sum("bytes")).alias("blocks"), filled(F.sum(F.when(F.col("query"), F.col("bytes")))).alias("ask_blocks"))
    return apart.join(sizes, "cluster")


def _questions(apart: DataFrame) -> DataFrame:
    """(cluster, node, component, query, block): each block of queries with each block of members, once."""
    dealt = lambda salt, blocks: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(blocks)).cast("string")
    cols = ["cluster", "node", "component", "query"]
    queries = apart.filter("query").withColumn("ask", dealt(2, "ask_blocks")).select(*cols, "ask", F.explode(_numbers("blocks")).alias("b"))
    asked_of = apart.withColumn("query", F.lit(False)).withColumn("b", dealt(3, "blocks")).select(*cols, F.explode(_numbers("ask_blocks")).alias("ask"), "b")
    return queries.unionByName(asked_of).select(*cols, F.concat_ws("/", "ask", "b").alias("block"))


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i


def joining_links(nodes: list[bytes], sets: list[np.ndarray], signature: np.ndarray, component: list, query: np.ndarray, percent: int, slack: float) -> list[tuple[bytes, bytes]]:
    """Links that join components, from comparing each query with all others of other components; what is joined isn't compared again."""
    forest, links = _Forest(len(nodes)), []
    head: dict = {}
    for i, c in enumerate(component):
        forest.up[i] = head.setdefault(c, i)
    sizes = np.array([len(s) for s in sets])
    roots = np.array([forest.root(i) for i in range(len(nodes))])
    for i in np.flatnonzero(query).tolist():
        near = (np.minimum(sizes, sizes[i]) * 100 >= percent * np.maximum(sizes, sizes[i])) & (roots != roots[i])
        near[:i] &= ~query[:i]  # two queries meet once
        at = np.flatnonzero(near)
        alike = (signature[at] == signature[i]).mean(1)
        close = alike >= percent / 100 - slack
        for j in at[close][np.argsort(-alike[close], kind="stable")].tolist():
            if roots[i] == roots[j]:
                continue
            a, b = (sets[i], sets[j]) if sizes[i] <= sizes[j] else (sets[j], sets[i])
            spot = np.searchsorted(b, a)
            spot[spot == len(b)] = 0
            common = int((b[spot] == a).sum())
            if 100 * common >= percent * (len(a) + len(b) - common):
                links.append((nodes[i], nodes[j]))
                roots[roots == roots[j]] = roots[i]
    return links


class NearDuplicates:
    """Documents (doc_id, text) linked where 100 * intersection >= percent * union of their k-word shingle sets.

    Texts without words and null texts have empty sets and no links. Rows of
    one doc_id are documents of their own that share an id; null ids never
    become a component_id while another id is there. Only doc_id and text are
    read, whatever other columns are called.
    """

    def __init__(self, docs: DataFrame, k: int = 5, percent: int = 80, bands: int = 40, rows: int = 5):
        text = F.coalesce("text", F.lit(""))
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
        self.k, self.percent, self.bands, self.hashes = k, percent, bands, bands * rows
        share = percent / 100
        self.slack = 5 * (share * (1 - share) / self.hashes) ** 0.5

    def _described(self) -> DataFrame:
        k, bands, count = self.k, self.bands, self.hashes

        def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch, "text"):
                    sets, bounds = shingle_sets(piece, k)
                    keys = band_keys(signatures(sets, bounds, count), bands)
                    flat = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands), pa.int32()), pa.array(keys.ravel()))
                    yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("tie"), pa.array(np.diff(bounds), pa.int64()), pa.array(node_keys(sets, bounds), pa.binary()), flat], ["doc_id", "tie", "n_shingles", "node", "bands"])

        return self.docs.mapInArrow(describe, "doc_id long, tie long, n_shingles long, node binary, bands array<long>")

    def _full_sets(self, wanted: DataFrame) -> DataFrame:
        """wanted (node, doc_id, tie, ...) with each node's set and signature, computed anew from one of its texts.

        A text is known by its id and hash, so rows that share an id don't meet each other's nodes.
        """
        k, count = self.k, self.hashes
        named = wanted.select("node", F.col("doc_id").alias("wanted_id"), F.col("tie").alias("wanted_tie"))
        texts = self.docs.join(named, (F.col("tie") == F.col("wanted_tie")) & F.col("doc_id").eqNullSafe(F.col("wanted_id"))).select("node", "text")

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch, "text"):
                    sets, bounds = shingle_sets(piece, k)
                    own = pa.array([a == b for a, b in zip(node_keys(sets, bounds), piece.column("node").to_pylist(), strict=True)], pa.bool_())
                    sig = signatures(sets, bounds, count)
                    done = pa.RecordBatch.from_arrays([piece.column("node"), pa.array([sets[a:z].tobytes() for a, z in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()), pa.array([s.tobytes() for s in sig], pa.binary())], ["node", "shingles", "signature"])
                    yield done.filter(own)

        return texts.mapInArrow(fill, "node binary, shingles binary, signature binary")

    def _links(self, members: DataFrame, sets: DataFrame) -> DataFrame:
        """members (cluster, block, node, component, query) -> links (u, v)."""
        percent, slack = self.percent, self.slack

        def compare(table: pa.Table) -> pa.Table:
            rows = {}
            for r in table.to_pylist():  # a node may be a query and a member
                if r["node"] not in rows or r["query"]:
                    rows[r["node"]] = r
            rows = sorted(rows.values(), key=lambda r: r["node"])
            signature = np.array([np.frombuffer(r["signature"], np.uint32) for r in rows])
            found = joining_links([r["node"] for r in rows], [np.frombuffer(r["shingles"], np.uint64) for r in rows], signature, [r["component"] for r in rows], np.array([r["query"] for r in rows]), percent, slack)
            del rows, signature
            released()
            return pa.table({"u": pa.array([u for u, _ in found], pa.binary()), "v": pa.array([v for _, v in found], pa.binary())})

        return members.join(sets, "node").groupBy("cluster", "block").applyInArrow(compare, "u binary, v binary")

    def components(self) -> DataFrame:
        """doc_id, n_shingles, component_id, kept, one row for each document."""
        described = checkpointed(self._described())
        nodes = checkpointed(described.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "tie")))["tie"].alias("own_tie"), F.min("tie").alias("any_tie"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n_shingles")).withColumn("tie", F.coalesce("own_tie", "any_tie")).drop("own_tie", "any_tie"))
        placed = nodes.select("node", F.explode("bands").alias("band"))
        shared = placed.groupBy("band").agg(F.min("node").alias("lead"), F.count("*").alias("n")).filter("n > 1").drop("n")
        near = placed.join(shared, "band").filter("node != lead").select(F.col("node").alias("u"), F.col("lead").alias("v"))
        clusters = connected_components(near).withColumnRenamed("component", "cluster")
        sizes = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        weight = 8 * F.col("n_shingles") + 4 * self.hashes + 128  # of a node's row
        members = checkpointed(clusters.join(sizes, "cluster").join(nodes.select("node", "doc_id", "tie", weight.alias("bytes")), "node"))
        sets = checkpointed(self._full_sets(members).dropDuplicates(["node"]))
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("string")
        hub = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks") * (BLOCK // HUBS)) < 1)
        first = members.select("cluster", "node", F.col("node").alias("component"), F.lit(True).alias("query"), F.explode(F.when(hub, _numbers("blocks")).otherwise(F.array(own))).alias("block"))
        links = checkpointed(self._links(first, sets))
        found = connected_components(links)
        wide = members.filter("blocks > 1")
        if wide.limit(1).count():
            state = checkpointed(wide.drop("blocks").join(found, "node", "left").withColumn("component", F.coalesce("component", "node")))
            counted = state.groupBy("cluster", "component").agg(F.count("*").alias("n"))
            main = counted.groupBy("cluster").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
            apart = state.join(main, "cluster").withColumn("query", F.col("component") != F.col("main"))
            asked = checkpointed(_with_ask_blocks(apart))
            pairs = _questions(asked.filter(F.col("ask_blocks") <= FEW_ASKED))
            chained = asked.filter(F.col("ask_blocks") > FEW_ASKED)
            if chained.limit(1).count():
                in_bucket = placed.join(chained.select("node", "component", "bytes"), "node").withColumnRenamed("band", "cluster")
                parts = in_bucket.groupBy("cluster", "component").agg(F.count("*").alias("n"))
                of_bucket = parts.groupBy("cluster").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts")).filter("parts > 1")
                apart = in_bucket.join(of_bucket, "cluster").withColumn("query", F.col("component") != F.col("main"))
                pairs = pairs.withColumn("cluster", F.concat(F.lit("cluster "), F.hex("cluster"))).unionByName(_questions(_with_ask_blocks(apart)).withColumn("cluster", F.concat(F.lit("bucket "), F.col("cluster").cast("string"))))
            links = links.unionByName(checkpointed(self._links(pairs, sets)))
            found = connected_components(links)
        named = nodes.select("node", F.col("doc_id").alias("least")).join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
        of_node = named.join(ids, "component").select("node", "component_id")
        out = described.select("doc_id", "n_shingles", "node").join(of_node, "node", "left")
        component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

    def one_of_each(self, docs: DataFrame) -> DataFrame:
        """Of the documents it was built on, with all their columns, those of the smallest doc_id of their component."""
        kept = self.components().filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
        return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")
