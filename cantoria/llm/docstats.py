"""Counts over whole documents, vectorised over the bytes of a batch."""

from __future__ import annotations

import numpy as np

from .chunks import text_of
from .minhash import words_of
from .textbytes import RangeHasher, text_buffer

#: Fixed value: the characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(SYMBOLS)] = 1


class Counts:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and some more of each row of a batch.

    Words are maximal runs of bytes other than 0x20 and 0x09-0x0D. A line is a
    duplicate if it has a word and equals an earlier line of its text. A word
    is repeated if it stands in a window of three words that the text has more
    than once. Null and empty texts count zero everywhere.
    """

    def __init__(self, batch):
        data, offsets = text_buffer(text_of(batch))
        self.data, self.offsets, n = data, offsets, len(offsets) - 1
        _, start, end, first = words_of(batch, lower=False)
        self.start, self.end, self.first = start, end, first
        hashes = RangeHasher(data)
        leads = (data & 0xC0) != 0x80
        self._lead = np.append(0, np.cumsum(leads))
        self.n_words = np.diff(first)
        row = np.repeat(np.arange(n), self.n_words)
        self.word = hashes.ranges(start, end)
        chars = self._lead[end] - self._lead[start]
        self.word_chars = np.bincount(row, chars, n).astype(np.int64)
        self.n_chars = self._lead[offsets[1:]] - self._lead[offsets[:-1]]
        self.n_symbols = self.per_row(_SYMBOL[data])
        self.n_dup_lines, self.n_lines = self._dup_lines(hashes)
        self.n_repeat_words = self._repeated(row)
        self.row, self.chars = row, chars

    def per_row(self, values: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(values))
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def _dup_lines(self, hashes: RangeHasher):
        n = len(self.offsets) - 1
        breaks = np.flatnonzero(self.data == 10)
        begin = np.concatenate((self.offsets[:-1], breaks + 1))
        row = np.concatenate((np.arange(n), np.searchsorted(self.offsets, breaks, "right") - 1))
        order = np.lexsort((begin, row))
        begin, row = begin[order], row[order]
        finish = np.append(begin[1:] - 1, 0)
        last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
        finish[last] = self.offsets[row[last] + 1]
        written = np.searchsorted(self.start, finish) > np.searchsorted(self.start, begin)
        begin, finish, row = begin[written], finish[written], row[written]
        h = hashes.ranges(begin, finish)
        order = np.lexsort((begin, h, row))
        again = np.zeros(len(order), bool)
        again[1:] = (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])
        return np.bincount(row[order][again], minlength=n).astype(np.int64), np.bincount(row, minlength=n).astype(np.int64)

    def _repeated(self, row: np.ndarray) -> np.ndarray:
        n, m = len(self.offsets) - 1, len(self.word) - 2
        if m <= 0:
            return np.zeros(n, np.int64)
        w = self.word
        window = (w[:-2] * np.uint64(0x9E3779B97F4A7C15) + w[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + w[2:]
        at = np.flatnonzero(row[:-2] == row[2:])
        order = at[np.lexsort((window[at], row[at]))]
        same = (window[order][1:] == window[order][:-1]) & (row[order][1:] == row[order][:-1])
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        cover = np.zeros(len(w) + 1, np.int64)
        hit = order[twice]
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + 3, -1)
        return np.bincount(row[np.cumsum(cover[:-1]) > 0], minlength=n).astype(np.int64)
