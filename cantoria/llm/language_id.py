"""Language identification by hyperdimensional profiles.

Each letter has a random vector of ones and minus ones, drawn from its code
point. A three-letter gram is bound from its letters' vectors, permuted once
for each place they stand before the last: rr(a) * r(b) * c. A text's profile
is the sum of its grams' vectors, a language's prototype the sum of the
profiles of all texts it is learned from. A text gets the language whose
prototype has the greatest cosine with its profile.

Grams of a few texts are counted first; each distinct one is bound once, and
counts times vectors gives the profiles as one product of matrices.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import text_of
from .textbytes import mix64, slices, text_buffer

DIMENSIONS = 1024
#: Texts whose grams are counted and bound together.
TEXTS = 128
#: What stands for a text without a letter.
NONE = "und"
#: Gram codes up to which a table of all codes finds the distinct ones.
_TABLE = 1 << 21
_GAP = 0

_FOLDED = np.zeros(0x110000, np.uint32)  # code point + 1 of the small letter, 1 for what is none; 0 is not yet known


def letter_vectors(points: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """A row of ones and minus ones for each code point, the same everywhere."""
    at = points.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(dimensions // 64, dtype=np.uint64)[None, :] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(seed + 1)
    return np.unpackbits(mix64(at).view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def _folded(points: np.ndarray) -> np.ndarray:
    """Small letters, and marks that stand on letters; 0 for all else."""
    out = _FOLDED[points]
    for p in np.unique(points[out == 0]).tolist():
        c = chr(p)
        _FOLDED[p] = ord(c.lower()[0]) + 1 if c.isalpha() else p + 1 if unicodedata.category(c)[0] == "M" else 1
    return _FOLDED[points] - 1


class Grams:
    """The three-letter grams of each row of a batch, with a gap before and after each word.

    `letters` are the distinct letters, the first one the gap; `code` has the
    grams as numbers in base len(letters), `row` the row of each. Words are runs
    of letters; grams don't reach over a gap.
    """

    def __init__(self, batch):
        data, offsets = text_buffer(text_of(batch))
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        ends = np.append(0, np.cumsum((data & 0xC0) != 0x80))[offsets]
        self.rows = len(offsets) - 1
        found = _folded(points)
        self.has_letter = np.zeros(self.rows, bool)
        row = np.repeat(np.arange(self.rows), np.diff(ends))
        alphabet = np.unique(found)
        real = np.array([chr(p).isalpha() for p in alphabet.tolist()], bool)
        self.has_letter[row[real[np.searchsorted(alphabet, found)]]] = True
        self.letters = np.append(_GAP, alphabet[alphabet != _GAP])
        symbol = np.zeros(len(points) + self.rows + 1, np.int64)  # a gap before each row and after the last
        place = np.arange(len(points)) + row + 1
        symbol[place] = np.searchsorted(self.letters, found)
        middle = place[symbol[place] > 0]
        k = len(self.letters)
        self.code = (symbol[middle - 1] * k + symbol[middle]) * k + symbol[middle + 1]
        self.row = row[symbol[place] > 0]

    def counted(self, keys: np.ndarray, width: int, at: slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """(distinct codes, how often each key, below `width`, has each of them)."""
        code, cube = self.code[at], len(self.letters) ** 3
        if cube <= _TABLE:
            there = np.bincount(code, minlength=cube) > 0
            distinct, place = np.flatnonzero(there), (np.cumsum(there) - 1)[code]
        else:
            distinct, place = np.unique(code, return_inverse=True)
        return distinct, np.bincount(keys * len(distinct) + place, minlength=width * len(distinct)).reshape(width, len(distinct))


class Bound:
    """The vectors of a batch's grams."""

    def __init__(self, letters: np.ndarray, dimensions: int, seed: int):
        self.k = len(letters)
        last = letter_vectors(letters, dimensions, seed)
        self.tables = np.roll(last, 2, axis=1), np.roll(last, 1, axis=1), last

    def profiles(self, counts: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Sums of the codes' vectors, weighted by each row of counts; whole numbers, exact."""
        kind = np.float32 if counts.sum(1).max(initial=0) < 1 << 24 else np.float64
        out = np.zeros((len(counts), self.tables[0].shape[1]), kind)
        for at in range(0, len(codes), 4096):
            c = codes[at : at + 4096]
            out += counts[:, at : at + 4096].astype(kind) @ (self.tables[0][c // self.k**2] * self.tables[1][c // self.k % self.k] * self.tables[2][c % self.k]).astype(kind)
        return out


class LanguageId:
    """Learns from documents (doc_id, text, lang), predicts each document's language.

    Rows whose crc32(doc_id) mod 4 is 2 are held out, those without a lang are
    not learned from; a row without a doc_id is not held out. Null and empty
    texts and texts without a letter are `und` with score 0, as all are where
    nothing was learned. The score is the cosine, at least 0; of equal ones the
    first language by name counts. All other rows and whole texts are learned
    from. The prototypes are one vector for each language.
    """

    def __init__(self, docs: DataFrame, dimensions: int = DIMENSIONS, seed: int = 7):
        if dimensions % 64:
            raise ValueError("dimensions come by 64")
        held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"), F.coalesce(held, F.lit(False)).alias("held_out"))
        self.dimensions, self.seed = dimensions, seed

    def prototypes(self) -> tuple[list[str], np.ndarray]:
        """(languages by name, the vector of each)."""
        dimensions, seed = self.dimensions, self.seed

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[str, np.ndarray] = {}
            for batch in batches:
                for piece in slices(batch, "text"):
                    grams = Grams(piece)
                    names, lang = np.unique(piece.column("lang").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
                    codes, counts = grams.counted(lang[grams.row], len(names))
                    for name, v in zip(names.tolist(), Bound(grams.letters, dimensions, seed).profiles(counts, codes), strict=True):
                        total[name] = total.get(name, 0) + v.astype(np.int64)
            for name, v in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([name] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(v)], ["lang", "at", "part"])

        learned = self.docs.filter("not held_out and lang is not null").select("text", "lang").mapInArrow(learn, "lang string, at int, part long")
        sums = learned.groupBy("lang", "at").agg(F.sum("part").alias("part")).toArrow()  # a vector for each language
        names, lang = np.unique(sums.column("lang").to_numpy().astype(str), return_inverse=True)
        vectors = np.zeros((len(names), dimensions))
        vectors[lang, sums.column("at").to_numpy()] = sums.column("part").to_numpy()
        there = np.abs(vectors).sum(1) > 0
        return [n for n, t in zip(names.tolist(), there, strict=True) if t], vectors[there]

    def predicted(self) -> DataFrame:
        """doc_id, held_out, lang_pred, score."""
        dimensions, seed = self.dimensions, self.seed
        names, vectors = self.prototypes()
        towards = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).T if names else np.zeros((dimensions, 0))
        named = np.array([*names, NONE], object)

        def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch, "text"):
                    grams = Grams(piece)
                    bound, best, score = Bound(grams.letters, dimensions, seed), np.full(grams.rows, len(names)), np.zeros(grams.rows)
                    for low in range(0, grams.rows if names else 0, TEXTS):
                        n = min(TEXTS, grams.rows - low)
                        at = slice(*np.searchsorted(grams.row, [low, low + n]))
                        codes, counts = grams.counted(grams.row[at] - low, n, at)
                        profile = bound.profiles(counts, codes).astype(np.float64)
                        cosine = np.round(profile @ towards / np.maximum(np.linalg.norm(profile, axis=1, keepdims=True), 1), 9)
                        best[low : low + n], score[low : low + n] = cosine.argmax(1), np.clip(cosine.max(1), 0, 1)
                    best[~grams.has_letter], score[~grams.has_letter] = len(names), 0
                    yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(named[best], pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

        return self.docs.select("doc_id", "text", "held_out").mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")
