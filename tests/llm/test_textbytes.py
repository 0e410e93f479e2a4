"""Hashes of byte ranges: equal for equal bytes alone, also where sums of powers cancel."""

import random

import numpy as np
import pyarrow as pa

from cantoria.llm.docstats import Counts
from cantoria.llm.minhash import NearDuplicates, shingle_sets
from cantoria.llm.textbytes import RangeHasher

from . import corpus as C


def thue_morse(n, a="a", b="b"):
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


PAIR = thue_morse(4096), thue_morse(4096, "b", "a")


def batch(texts):
    return pa.RecordBatch.from_pydict({"text": texts})


def test_equal_bytes_alone_have_equal_hashes():
    rng = random.Random(1)
    raw = bytes(rng.choice(b"ab") for _ in range(3000)) * 2 + b"x" * 9000 + bytes(rng.choice(b"ab") for _ in range(40))
    hasher = RangeHasher(np.frombuffer(raw, np.uint8))
    start = np.array([rng.randrange(len(raw)) for _ in range(4000)] + [0, 3000, 6000, 6001])
    end = np.append([min(len(raw), a + rng.choice((0, 1, 7, 8, 9, 16, 50, 5000))) for a in start[:-4]], [3000, 6000, 14999, 15000])
    seen = {}
    for a, z, h in zip(start.tolist(), end.tolist(), hasher.ranges(start, end).tolist(), strict=True):
        assert seen.setdefault(h, raw[a:z]) == raw[a:z]
    by_bytes = {v: h for h, v in seen.items()}
    assert len(by_bytes) == len(seen)
    for n in (1, 8, 20, 23):
        fixed = hasher.fixed(n)
        assert len(fixed) == len(raw) - n + 1
        assert len(set(fixed.tolist())) == len({raw[i : i + n] for i in range(len(fixed))})
    assert len(RangeHasher(np.zeros(3, np.uint8)).fixed(5)) == 0


def test_thue_morse_words_and_lines_stay_apart():
    for n in (64, 1024, 2048, 4096):
        x, y = PAIR[0][:n], PAIR[1][:n]
        hasher = RangeHasher(np.frombuffer((x + y).encode(), np.uint8))
        assert len(set(hasher.ranges(np.array([0, n]), np.array([n, 2 * n])).tolist())) == 2
        assert Counts(batch([f"{x}\n{y}"])).n_dup_lines.tolist() == [0]
        assert Counts(batch([f"{x}\n{y}\n{x}"])).n_dup_lines.tolist() == [1]
        assert Counts(batch([f"{x} a b {y} a b"])).n_repeat_words.tolist() == [0]
        sets, at = shingle_sets(batch([x, y]), 3)
        assert sets[at[0] : at[1]].tolist() != sets[at[1] : at[2]].tolist()


def test_thue_morse_texts_are_not_linked(spark):
    out = NearDuplicates(C.frame(spark, [(1, PAIR[0]), (2, PAIR[1]), (3, PAIR[0])]), 3, 85, 32, 6).components().collect()
    assert C.by_row(out) == [(1, 1, 1, True), (2, 1, 2, True), (3, 1, 1, False)]
