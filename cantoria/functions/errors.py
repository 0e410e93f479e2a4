"""Edit distances and what rates are made of.

Word distances stay in the JVM: a row's words become single characters, one
for each distinct word, and the distance of the two strings is the distance of
the two word sequences. Insertions, deletions and substitutions need the
alignment, which is an Arrow UDF.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .text import collapsed


def words(text: Column) -> Column:
    """array<string>; null and blank texts have no words."""
    bare = collapsed(F.coalesce(text, F.lit("")))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, " "))


def sequence_distance(a: Column, b: Column) -> Column:
    """Edit distance of two arrays of strings, up to a million distinct elements in both: as many as there are characters to stand for them."""
    both = F.array_distinct(F.concat(a, b))
    # surrogates are no characters
    point = lambda w: F.array_position(both, w).cast("long") + F.when(F.array_position(both, w) > 0xD000, 0x1000).otherwise(0x20)
    letters = lambda x: F.array_join(F.transform(x, lambda w: F.decode(F.unhex(F.lpad(F.hex(point(w)), 8, "0")), "UTF-32")), "")
    return F.levenshtein(letters(a), letters(b)).cast("long")


def word_distance(reference: Column, hypothesis: Column) -> Column:
    return sequence_distance(words(reference), words(hypothesis))


def char_distance(reference: Column, hypothesis: Column) -> Column:
    return F.levenshtein(F.coalesce(reference, F.lit("")), F.coalesce(hypothesis, F.lit(""))).cast("long")


def rate(errors: Column, tokens: Column) -> Column:
    """errors / tokens; without tokens infinite, or zero where there are no errors either."""
    return F.when(tokens > 0, errors / tokens).when(errors > 0, F.lit(float("inf"))).otherwise(F.lit(0.0))


def _numbered(a: list, b: list) -> tuple[np.ndarray, np.ndarray]:
    """Both sequences as numbers, equal where the elements are."""
    of: dict = {}
    return tuple(np.fromiter((of.setdefault(x, len(of)) for x in s), np.int64, len(s)) for s in (a, b))


def aligned(a: list, b: list) -> list[tuple[int | None, int | None]]:
    """Index pairs of a least-cost alignment; None for what stands on one side only.

    Rows of costs are kept at intervals of the square root of their number and
    the ones between worked out again on the way back, a block at a time.
    """
    x, y = _numbered(a, b)
    n, m = len(x), len(y)
    steps, every = np.arange(m + 1), max(1, int(n**0.5))

    def following(row: np.ndarray, i: int) -> np.ndarray:
        full = np.concatenate(([i], np.minimum(row[1:] + 1, row[:-1] + (y != x[i - 1]))))
        return np.minimum.accumulate(full - steps) + steps

    row = steps
    kept = {0: row}
    for i in range(1, n + 1):
        row = following(row, i)
        if i % every == 0:
            kept[i] = row
    out, i, j = [], n, m
    cost: dict[int, np.ndarray] = {}
    while i or j:
        if i and i - 1 not in cost:
            low = (i - 1) // every * every
            cost = {low: kept[low]}
            for k in range(low + 1, i + 1):
                cost[k] = following(cost[k - 1], k)
        if i and j and cost[i][j] == cost[i - 1][j - 1] + (x[i - 1] != y[j - 1]):
            i, j = i - 1, j - 1
            out.append((i, j))
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            i -= 1
            out.append((i, None))
        else:
            j -= 1
            out.append((None, j))
    return out[::-1]


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence: a bit for each element of a, one addition for each of b."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    whole = (1 << len(a)) - 1
    row = whole
    for x in b:
        met = row & places.get(x, 0)
        row = (row + met | row - met) & whole
    return len(a) - row.bit_count()


@F.pandas_udf(LongType())
def subsequence_lengths(a: pd.Series, b: pd.Series) -> pd.Series:
    """common_subsequence of two arrays; a null one is empty."""
    return pd.Series([common_subsequence(list(x if x is not None else ()), list(y if y is not None else ())) for x, y in zip(a, b, strict=True)])


@F.pandas_udf(StructType([StructField(c, LongType()) for c in ("hits", "insertions", "deletions", "substitutions")]))
def operations(reference: pd.Series, hypothesis: pd.Series) -> pd.DataFrame:
    """Counts of each edit operation over arrays of tokens."""
    rows = []
    for a, b in zip(reference, hypothesis, strict=True):
        a, b = list(a if a is not None else ()), list(b if b is not None else ())
        pairs = aligned(a, b)
        same = sum(i is not None and j is not None and a[i] == b[j] for i, j in pairs)
        rows.append((same, sum(i is None for i, _ in pairs), sum(j is None for _, j in pairs), sum(i is not None and j is not None and a[i] != b[j] for i, j in pairs)))
    return pd.DataFrame(rows, columns=["hits", "insertions", "deletions", "substitutions"])


def _marks(text: str, marks: str) -> list[str]:
    out: list[str] = []
    for c in text:
        if c in marks:
            out.append(c)
        elif c.isspace():
            out.append(" ")
        elif out and len(out[-1]) > 0 and out[-1] not in marks and out[-1] != " ":
            out[-1] += c
        else:
            out.append(c)
    return [x for x in out if x != " "]


def punctuation_operations(marks: str = ".,?!"):
    """Arrow UDF (reference, hypothesis) -> map mark -> correct, deleted, inserted, substituted; words align with words, marks with marks or nothing."""

    @F.pandas_udf("array<struct<mark:string,correct:bigint,deletions:bigint,insertions:bigint,substitutions:bigint>>")
    def count(reference: pd.Series, hypothesis: pd.Series) -> pd.Series:
        out = []
        for r, h in zip(reference, hypothesis, strict=True):
            a, b = _marks(r or "", marks), _marks(h or "", marks)
            # a mark and a word never stand for each other
            pairs = aligned([("m" if x in marks else "w", x) for x in a], [("m" if x in marks else "w", x) for x in b])
            tally = {m: [0, 0, 0, 0] for m in marks}
            for i, j in pairs:
                x, y = (a[i] if i is not None else None), (b[j] if j is not None else None)
                if x in tally and x == y:
                    tally[x][0] += 1
                elif x in tally and y in tally:
                    tally[x][3] += 1
                else:
                    if x in tally:
                        tally[x][1] += 1
                    if y in tally:
                        tally[y][2] += 1
            out.append([{"mark": m, "correct": c, "deletions": d, "insertions": n, "substitutions": s} for m, (c, d, n, s) in tally.items()])
        return pd.Series(out)

    return count


def lagging(delays: Column, source_length: Column, target_length: Column) -> Column:
    """Length-adaptive average lagging of the delays of the produced words: mean of delay minus the ideal schedule, up to the first delay at the source's end."""
    rate_ = F.greatest(F.size(delays), target_length) / source_length
    last = F.array_position(F.transform(delays, lambda d: d >= source_length), True)
    n = F.when(last > 0, last).otherwise(F.size(delays)).cast("int")
    used = F.slice(delays, 1, F.greatest(n, F.lit(1)))
    gaps = F.transform(used, lambda d, i: d.cast("double") - i / rate_)
    return F.when(F.size(delays) > 0, F.aggregate(gaps, F.lit(0.0), lambda a, x: a + x) / n).otherwise(F.lit(0.0))
