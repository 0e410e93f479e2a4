"""Keyed streams: token merging, endpointing and per-stream transcripts.

The folds are plain functions over one stream's rows. `transcribed` runs them
as a stateful operator of Structured Streaming and, with the same function,
over a finished table; both give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# merging


def longest_common_substring(a: list, b: list) -> tuple[int, int, int]:
    """(end in a, end in b, length) of the longest common run, the rightmost in a."""
    best, row = (0, 0, 0), [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [0] * (len(b) + 1)
        for j, y in enumerate(b, 1):
            if x == y:
                new[j] = row[j - 1] + 1
                if new[j] >= best[2]:
                    best = (i, j, new[j])
        row = new
    return best


def longest_common_subsequence(a: list, b: list) -> list[tuple[int, int]]:
    n, m = len(a), len(b)
    size = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            size[i][j] = size[i + 1][j + 1] + 1 if a[i] == b[j] else max(size[i + 1][j], size[i][j + 1])
    out, i, j = [], 0, 0
    while i < n and j < m:
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif size[i + 1][j] >= size[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def merged(buffer: list, data: list, search: int, least: int = 1, separator: list | None = None, subsequence: bool = False) -> list:
    """New tokens merged onto a buffer where its last `search` tokens and they agree; appended, after a separator, where they don't enough."""
    if not buffer or not data:
        return [*buffer, *data]
    base, tail = buffer[: max(0, len(buffer) - search)], buffer[max(0, len(buffer) - search) :]
    if subsequence:
        pairs = longest_common_subsequence(tail, data)
        if len(pairs) < least:
            return [*buffer, *(separator or []), *data]
        i, j = pairs[-1]
        return [*base, *tail[: i + 1], *data[j + 1 :]]
    i, j, n = longest_common_substring(tail, data)
    if n < least:
        return [*buffer, *(separator or []), *data]
    return [*base, *tail[:i], *data[j:]]


def overlap(state: list, times: list, new: list, new_times: list, limit: int, close: float) -> int:
    """The longest suffix of the state, up to a limit, that the new tokens begin with and that stands close in time."""
    for n in range(min(limit, len(state), len(new)), 0, -1):
        if state[-n:] == new[:n] and all(abs(a - b) <= close for a, b in zip(times[-n:], new_times[:n], strict=True)):
            return n
    return 0


PUNCTUATION = ".,?!;:"


def word_tail_joined(head: str, tail: str) -> str:
    """Two halves of a word as one; punctuation at the end of the first goes."""
    return head.rstrip(PUNCTUATION) + tail


def chunk_texts_joined(chunks: list[tuple[int, str, list[tuple[float, float, str]]]], seconds: float) -> tuple[str, list[tuple[float, float, str]]]:
    """Texts of a recording's chunks joined by blanks; times move by chunk number times chunk length, -1 and None stay."""
    moved = lambda t, i: t if t is None or t == -1 else t + i * seconds
    ordered = sorted(chunks)
    return " ".join(text for _, text, _ in ordered if text), [(moved(a, i), moved(z, i), w) for i, _, words in ordered for a, z, w in words]


# endpointing


def end_from_timestamps(times: list[int], length: int, stop: int, residue: int = 0) -> int | None:
    """Place where an utterance has ended: half of `stop` into the last gap between tokens, or behind them all, of more than `stop` frames. 0: always, at the end; below 0: never. residue: frames at the end that are left out."""
    if stop < 0 or not times:
        return None
    if stop == 0:
        return length
    gaps = [a + 1 for a, z in pairwise([*times, length - residue]) if z - a - 1 > stop]
    return gaps[-1] + stop // 2 if gaps else None


def utterance_end(times: Column, length: Column, stop: int, residue: int = 0) -> Column:
    """end_from_timestamps of an array of frames in order."""
    if stop < 0:
        return F.lit(None).cast("int")
    after = F.concat(F.slice(times, 2, F.greatest(F.size(times) - 1, F.lit(0))), F.array((length - residue).cast("int")))
    gaps = F.filter(F.arrays_zip(times.alias("a"), after.alias("z")), lambda g: g["z"] - g["a"] - 1 > stop)
    return F.when(F.size(times) > 0, length.cast("int") if stop == 0 else F.try_element_at(gaps, F.lit(-1))["a"] + 1 + stop // 2)


def end_from_emissions(emissions: list[bool], pivot: int, start: int, stop: int, starts_word: list[bool] | None = None, residue: int = 0) -> int | None:
    """Half of `stop` into the last run of more than `stop` silent frames that stands before a start of word, or at the end.

    Frames count from `stop` before the pivot on, not from before the start.
    emissions: whether a frame has a token; starts_word: whether that token
    starts a word (all do, unless told). residue: frames at the end that are
    left out.
    """
    if not 0 <= pivot < len(emissions) or start > pivot:
        raise ValueError("the pivot must be a frame, not before the start")
    if stop <= 0:
        return None
    low, high = max(0, start, pivot - stop), max(0, len(emissions) - residue)
    edges = np.flatnonzero(np.diff(~np.asarray(emissions[low:high], bool), prepend=False, append=False)) + low
    runs = edges.reshape(-1, 2).tolist()
    ended = [a for a, z in runs if z - a > stop and (z == high or starts_word is None or starts_word[z])]
    return ended[-1] + stop // 2 if ended else None


def end_from_segments(segments: list[tuple[float, float]], end: float, start: float, limit: float) -> float | None:
    """After the last segment if the buffer's end is further than the limit, else after the last inner gap that exceeds it."""
    inside = [(a, z) for a, z in segments if z > start]
    if not inside:
        return None
    if end - inside[-1][1] > limit:
        return inside[-1][1] + limit / 2
    for (_, z), (a, _) in zip(inside[-2::-1], inside[:0:-1], strict=True):
        if a - z > limit:
            return z + limit / 2
    return None


def frames_of(milliseconds: float, per_frame: float) -> int:
    return int(-(-milliseconds // per_frame))


# buffers


class Roll:
    """The last `size` samples; `padding` counts those not there yet."""

    def __init__(self, size: int):
        self.size, self.data = size, [0.0] * size
        self.padding = size

    def push(self, samples: list[float]) -> list[float]:
        if len(samples) > self.size:
            raise ValueError("more samples than the buffer holds")
        self.data = [*self.data[len(samples) :], *samples]
        self.padding = max(0, self.padding - len(samples))
        return self.data


class Grow:
    """Appends until full, then drops all but the overlap at once."""

    def __init__(self, size: int, chunk: int, overlap_: int):
        if size % chunk or overlap_ % chunk:
            raise ValueError("sizes must be multiples of the chunk")
        self.size, self.overlap, self.data = size, overlap_, []

    def push(self, chunk: list[float]) -> list[float]:
        if len(self.data) + len(chunk) > self.size:
            self.data = self.data[len(self.data) - self.overlap :] if self.overlap else []
        self.data = [*self.data, *chunk]
        return self.data


class Slots:
    """Streams on a fixed number of slots, freed first in first out."""

    def __init__(self, n: int):
        self.free, self.of = list(range(n)), {}

    def take(self, stream: str) -> int:
        if stream not in self.of:
            if not self.free:
                raise RuntimeError("no free slot")
            self.of[stream] = self.free.pop(0)
        return self.of[stream]

    def end(self, stream: str) -> None:
        self.free.append(self.of.pop(stream))


def chunk_schedule(total: int, first: int, chunk: int, shift: int) -> list[tuple[int, int]]:
    """(start, end) of chunks over `total` frames; the first one has a size of its own."""
    out, start, size = [], 0, first
    while start < total:
        out.append((start, min(start + size, total)))
        start += first if size == first and not out[1:] else shift
        size = chunk
    return out


def frames(samples: DataFrame, key: str, column: str, size: int, left: int = 0) -> DataFrame:
    """(key, frame_idx, frame, is_first, is_last): an array cut into frames, the last one padded with zeros, `left` zeros in front."""
    data = F.concat(F.array_repeat(F.lit(0.0), left), column)
    n = F.greatest(F.ceil(F.size(data) / size), F.lit(1)).cast("int")
    padded = lambda i: F.concat(F.slice(data, i * size + 1, F.lit(size)), F.array_repeat(F.lit(0.0), size - F.size(F.slice(data, i * size + 1, F.lit(size)))))
    cut = samples.select(key, n.alias("n"), F.posexplode(F.transform(F.sequence(F.lit(0), n - 1), padded)).alias("frame_idx", "frame"))
    return cut.withColumn("is_first", F.col("frame_idx") == 0).withColumn("is_last", F.col("frame_idx") == F.col("n") - 1).drop("n")


# state


@dataclass
class State:
    """What a stream has said so far."""

    words: list[str] = field(default_factory=list)
    starts: list[float] = field(default_factory=list)
    last_end: float = float("-inf")
    segment: int = 0

    def push(self, words: list[str], merge_first: bool = False) -> None:
        """Appends words; punctuation in front joins the last word, as does the first word where it is its second half."""
        for i, w in enumerate(words):
            if self.words and (w in PUNCTUATION or (i == 0 and merge_first)):
                self.words[-1] = self.words[-1] + w if w in PUNCTUATION else word_tail_joined(self.words[-1], w)
            else:
                self.words.append(w)

    def packed(self) -> tuple:
        return self.words, self.last_end, self.segment

    @classmethod
    def unpacked(cls, words, last_end, segment) -> State:
        return cls(list(words), [], float(last_end), int(segment))


STATE = "words array<string>, last_end double, segment long"
OUT = "stream_id string, segment long, start double, end double, text string"


def _advanced(state: State, starts: float | None, rows: pd.DataFrame, gap: float) -> tuple[list[tuple], float | None]:
    """Rows (start, end, word, is_last) in order -> finished segments (segment, start, end, text); the start of the open one."""
    done = []
    for start, end, word, last in zip(rows["start"], rows["end"], rows["word"], rows["is_last"], strict=True):
        if state.words and start - state.last_end > gap:
            done.append((state.segment, starts, state.last_end, " ".join(state.words)))
            state.words, state.segment, starts = [], state.segment + 1, None
        if word:
            state.push([word])
            starts = start if starts is None else starts
            state.last_end = end
        if last and state.words:
            done.append((state.segment, starts, state.last_end, " ".join(state.words)))
            state.words, state.segment, starts = [], state.segment + 1, None
    return done, starts


def transcribed(words: DataFrame, gap: float) -> DataFrame:
    """Rows (stream_id, start, end, word, is_last) -> segments that a silence longer than `gap` or the stream's end finishes.

    On a stream: one state for each stream, dropped when its last row has come.
    On a table: the same fold over each stream's rows in order; a stream that
    never ends keeps its open segment back, as it does while streaming.
    """
    if words.isStreaming:
        state_schema = STATE + ", start double"

        def step(key, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
            kept, start = (State(), None)
            if state.exists:
                *packed_, start = state.get
                kept = State.unpacked(*packed_)
            rows = pd.concat(list(parts)).sort_values(["start", "end"])
            done, start = _advanced(kept, start, rows, gap)
            if rows["is_last"].any():
                state.remove()
            else:
                state.update((*kept.packed(), start))
            yield pd.DataFrame([(key[0], *d) for d in done], columns=["stream_id", "segment", "start", "end", "text"])

        return words.groupBy("stream_id").applyInPandasWithState(step, OUT, state_schema, "append", "NoTimeout")

    def whole(key, pdf: pd.DataFrame) -> pd.DataFrame:
        done, _ = _advanced(State(), None, pdf.sort_values(["start", "end"]), gap)
        return pd.DataFrame([(key[0], *d) for d in done], columns=["stream_id", "segment", "start", "end", "text"])

    return words.groupBy("stream_id").applyInPandas(whole, OUT)


def merged_chunks(chunks: DataFrame, search: int, least: int = 1, subsequence: bool = False) -> DataFrame:
    """(stream_id, chunk, tokens array<int>) -> (stream_id, tokens): overlapping chunks merged in order."""
    def fold(key, pdf: pd.DataFrame) -> pd.DataFrame:
        out: list = []
        for tokens in pdf.sort_values("chunk")["tokens"]:
            out = merged(out, list(tokens), search, least, None, subsequence)
        return pd.DataFrame([(key[0], out)], columns=["stream_id", "tokens"])

    return chunks.groupBy("stream_id").applyInPandas(fold, "stream_id string, tokens array<int>")


def windowed(events: DataFrame, at: str, late: str, size: str, slide: str | None, *by: str, **aggregates) -> DataFrame:
    """Event-time windows with a watermark for late rows; on a table the watermark does nothing."""
    marked = events.withWatermark(at, late) if events.isStreaming else events
    return marked.groupBy(F.window(at, size, slide) if slide else F.window(at, size), *by).agg(*(c.alias(n) for n, c in aggregates.items()))


def live_batches(streams: dict[str, int], n: int) -> list[list[tuple[str, int]]]:
    """Ticks of at most n live streams, (stream, frame) each; a stream that ends makes room for the next one."""
    waiting, live, ticks = list(streams), {}, []
    while waiting or live:
        while waiting and len(live) < n:
            live[waiting.pop(0)] = 0
        ticks.append(list(live.items()))
        for s in list(live):
            live[s] += 1
            if live[s] >= streams[s]:
                del live[s]
    return ticks
