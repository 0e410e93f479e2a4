"""BPE encoding and decoding through a distinct-word table.

Texts are split into the tokenizer's own words; the words of all chunks meet in
buckets, where each distinct word is encoded once; its ids go back to the
chunks that hold it and are put in place by word position. Decoding joins each
id with its piece, within the task that has the ids (an exchange of single ids
would move many times the text), and puts the pieces in order of position.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import chunked, pack, unpack
from .suffix_dedup import _rows, _runs
from .textbytes import RangeHasher, released, slices, text_buffer

CHUNK_BYTES = 16 << 20
WORDS = "chunk int, bucket int, words binary"
CODES = "chunk int, bucket int, sizes binary, ids binary"
#: The split pattern of the word-level vocabulary, over all characters (for regex) and over those of PLAIN (for re).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZED = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
LETTERS, NUMBERS = "a-zA-ZªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
PLAIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+")
#: Anything but characters below U+0250 that aren't control characters: those str.lower and this pattern treat as the tokenizer does, and they are composed already.
NOT_PLAIN = re.compile(r"[^\t-\r\x20-\x7e\xa0-ɏ]")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(maxsize=4)
def pieces(path: str) -> dict[int, str]:
    return {i: piece for piece, i in tokenizer(path).get_vocab(with_added_tokens=True).items()}


@lru_cache(maxsize=4)
def figures(path: str) -> pa.Array:
    """By id: its figures, with a blank behind."""
    return pa.array([f"{i} " for i in range(max(pieces(path)) + 1)], pa.large_string())


@lru_cache(maxsize=4)
def piece_table(path: str) -> pa.Table:
    """The id-to-piece table; a blank stands behind each piece."""
    known = sorted(pieces(path).items())
    return pa.table({"id": pa.array([i for i, _ in known], pa.int32()), "piece": pa.array([f"{p} " for _, p in known], pa.large_string())})


def joined_pieces(ids: np.ndarray, path: str) -> pa.Array:
    """The piece of each id: the distinct ids are joined with the id-to-piece table, each place takes what its id has; unknown ids have an empty one."""
    coded = pa.array(ids.astype(np.int32)).dictionary_encode()
    own = pa.table({"id": coded.dictionary, "at": np.arange(len(coded.dictionary), dtype=np.int32)})
    found = own.join(piece_table(path), "id", join_type="left outer", use_threads=False).sort_by("at").column("piece")
    return found.combine_chunks().fill_null("").take(coded.indices)


@lru_cache(maxsize=4)
def splitter(path: str):
    """text -> the tokenizer's words; strings of special tokens are words of their own."""
    tok = tokenizer(path)
    special = [x.content for x in tok.get_added_tokens_decoder().values()]
    cut = regex.compile("(" + "|".join(regex.escape(x) for x in special) + ")") if special else None
    rules = json.loads(tok.to_str())
    shape = (rules["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern")
    if (normalized := rules["normalizer"]) != NORMALIZED or shape != {"Regex": WORD_PATTERN} or rules["decoder"]:
        raise ValueError(f"{path} doesn't split or decode words by the rules of this module: {normalized}, {rules['pre_tokenizer']}")
    find = PLAIN_WORDS.findall

    def plain(text: str) -> list[str]:
        if not NOT_PLAIN.search(text):
            return find(text.lower())
        text = tok.normalizer.normalize_str(text)
        return [text[a:z] for _, (a, z) in tok.pre_tokenizer.pre_tokenize_str(text)]

    def split(text: str) -> list[str]:
        if not any(x in text for x in special):
            return plain(text)
        out = []
        for part in cut.split(text):
            out += [part] if part in special else plain(part)
        return out

    return split


def _split(table: pa.Table, path: str) -> Iterator[tuple[list, np.ndarray, pa.Array]]:
    """(doc_ids, number of words before each document and in all, the words in order) of slices of a chunk."""
    split = splitter(path)
    for piece in slices(table, "text"):
        words = [split(text) for text in piece.column("text").to_pylist()]
        yield piece.column("doc_id").to_pylist(), np.append(0, np.cumsum([len(w) for w in words])), pa.array([w for own in words for w in own], pa.string())


def _dealt(words: list[pa.Array], buckets: int) -> tuple[pa.Array, np.ndarray]:
    """The distinct words, sorted by bucket and word, and their buckets."""
    own = pa.chunked_array(words, pa.string()).unique()
    data, at = text_buffer(own)
    to = (RangeHasher(data).ranges(at[:-1], at[1:]) % np.uint64(buckets)).astype(np.int64)
    order = pc.sort_indices(pa.table({"b": to, "w": own}), [("b", "ascending"), ("w", "ascending")])
    return own.take(order), to[order.to_numpy()]


def _ranges(starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The places starts[i] .. starts[i] + sizes[i] for each i of `at`, one after another."""
    n = sizes[at].astype(np.int64)
    return np.repeat(starts[at].astype(np.int64), n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _listed(words) -> bytes:
    return pack(np.frombuffer("\n".join(words).encode(), np.uint8), True)


def _lines(raw: bytes) -> list[str]:
    return bytes(unpack(raw, np.uint8, True)).decode().split("\n")


class WordTableBpe:
    """Encodes documents (doc_id, text) with a BPE tokenizer whose words don't depend on each other.

    Null texts count as empty: no ids, empty decoded text. Null or repeated
    doc_ids give a row for each input row. Columns other than doc_id and text
    are not read.
    """

    def __init__(self, docs: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES):
        self.path = path
        splitter(path)  # raises where the file has other rules
        self.chunks, self.buckets = chunked(docs, chunk_bytes)

    def codes(self) -> DataFrame:
        """The distinct-word table, by bucket, as the chunks need it."""
        path, buckets = self.path, self.buckets

        def announce(table: pa.Table) -> pa.Table:
            words, to = _dealt([w for _, _, w in _split(table, path)], buckets)
            chunk = table.column("chunk")[0].as_py()
            return _rows([{"chunk": chunk, "bucket": b, "words": _listed(words[a:z].to_pylist())} for b, a, z in _runs(to)], WORDS)

        def encode(table: pa.Table) -> pa.Table:
            rows = table.select(["chunk", "bucket"]).to_pylist()
            lists = [pa.array(_lines(raw.as_py())) for raw in table.column("words")]
            own = pa.chunked_array(lists, pa.string()).unique()  # each distinct word once
            tok, words, ids = tokenizer(path), own.to_pylist(), []
            for i in range(0, len(words), 4096):
                ids += [x.ids for x in tok.encode_batch(words[i : i + 4096], add_special_tokens=False)]
            sizes = np.fromiter(map(len, ids), np.uint32, len(ids))
            flat = np.fromiter((x for own in ids for x in own), np.uint32, int(sizes.sum()))
            out = []
            for r, words in zip(rows, lists, strict=True):
                at = pc.index_in(words, own).to_numpy()
                out.append(r | {"sizes": pack(sizes[at], True), "ids": pack(flat[_ranges(np.cumsum(sizes) - sizes, sizes, at)].view(np.uint8).reshape(-1, 4).T, True)})
            del lists, own, words, ids
            released()
            return _rows(out, CODES)

        return self.chunks.groupBy("chunk").applyInArrow(announce, WORDS).groupBy("bucket").applyInArrow(encode, CODES)

    def _apply(self, build, schema: str) -> DataFrame:
        path, buckets = self.path, self.buckets

        def place(table: pa.Table, told: pa.Table) -> pa.Table:
            if not table.num_rows:
                return build.schema.empty_table()
            parts = list(_split(table, path))
            words, to = _dealt([w for _, _, w in parts], buckets)
            codes = {r["bucket"]: r for r in told.to_pylist()}
            found = [codes[b] for b, _, _ in _runs(to)]
            sizes = np.concatenate([unpack(r["sizes"], np.uint32, True) for r in found]) if found else np.zeros(0, np.uint32)
            flat = np.concatenate([unpack(r["ids"], np.uint8, True).reshape(4, -1).T.copy().view(np.uint32).ravel() for r in found]) if found else sizes
            starts, made = np.cumsum(sizes) - sizes, []
            for doc_ids, first, own in parts:
                pa.default_memory_pool().release_unused()
                at = pc.index_in(own, words).to_numpy().astype(np.int64)
                ids = flat[_ranges(starts, sizes, at)].astype(np.int32)
                ends = np.append(0, np.cumsum(sizes[at], dtype=np.int64))[first]
                made.append(build(doc_ids, ids, ends, path))
            out = pa.concat_tables(made) if made else build.schema.empty_table()
            del parts, words, codes, found, made
            released()
            return out

        return self.chunks.groupBy("chunk").cogroup(self.codes().groupBy("chunk")).applyInArrow(place, schema)

    def digests(self) -> DataFrame:
        """doc_id, n_tokens and SHA-256 of the ids and of the decoded text."""

        def build(doc_ids: list, ids: np.ndarray, ends: np.ndarray, path: str) -> pa.Table:
            # each id's figures and its piece, with a blank behind: a document's are then one range of bytes, less the last
            views = [(memoryview(data), at[ends]) for data, at in map(text_buffer, (figures(path).take(pa.array(ids)), joined_pieces(ids, path)))]
            digest = lambda v, a, z: hashlib.sha256(v[a : max(a, z - 1)]).hexdigest()
            hashed = [[digest(v, a, z) for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)] for v, at in views]
            return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": np.diff(ends), "ids_sha256": hashed[0], "decoded_sha256": hashed[1]}, schema=build.schema)

        build.schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
        return self._apply(build, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

    def encoded(self) -> DataFrame:
        """doc_id, n_tokens, ids and the decoded text."""

        def build(doc_ids: list, ids: np.ndarray, ends: np.ndarray, path: str) -> pa.Table:
            data, at = text_buffer(joined_pieces(ids, path))
            at, full = at[ends], np.diff(ends) > 0
            # the blank behind a document's last piece goes
            data = np.delete(data, at[1:][full] - 1)
            at = at - np.append(0, np.cumsum(full))
            texts = pa.LargeStringArray.from_buffers(len(doc_ids), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": np.diff(ends), "ids": lists, "decoded": texts}, schema=build.schema)

        build.schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
        return self._apply(build, "doc_id long, n_tokens long, ids array<int>, decoded string")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) -> (doc_id, decoded): each id joined with its piece, put together by position; unknown ids give nothing."""
    spark = tokens.sparkSession
    table = spark.createDataFrame(sorted(pieces(path).items()), "id int, piece string")  # as many rows as the vocabulary
    # a row is known by its id and ids; equal rows are decoded once and come back as often as they were
    keyed = tokens.groupBy("doc_id", F.xxhash64("ids").alias("tie")).agg(F.first("ids").alias("ids"), F.count("*").cast("int").alias("rows"))
    flat = keyed.select("doc_id", "tie", "rows", F.posexplode_outer("ids").alias("at", "id"))
    placed = flat.join(F.broadcast(table), "id", "left").groupBy("doc_id", "tie", "rows").agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("p"))
    text = F.array_join(F.transform("p", lambda x: x["piece"]), " ")
    return placed.select("doc_id", text.alias("decoded"), F.explode(F.sequence(F.lit(1), "rows"))).drop("col")
