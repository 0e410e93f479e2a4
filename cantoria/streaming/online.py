"""Streams of speech as they come: windows of speech and speakers, with state of bounded size for each stream.

Both operators give the same rows on a stream and on a table. On a stream they
keep their state in a state store that has timers (RocksDB); on a table the
rows of a stream pass a task in order, a batch at a time, so that neither needs
a whole recording in memory.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import intervals as I
from ..operators import vectors as V
from ..operators.scoring import assigned

_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _checked(df: DataFrame) -> None:
    if "RocksDB" not in df.sparkSession.conf.get(_STORE, ""):
        raise ValueError(f"set {_STORE} to {ROCKSDB}: timers need it")


# windows of speech

WINDOWS = "stream_id string, action string, start long, end long"


def windows_of(start: int, end: int, window: int, shift: int, first: int = 0) -> list[tuple[int, int]]:
    """Windows of a stretch from number `first` on; the last ones are shortened."""
    n = 1 if end - start <= window else -(-(end - start - window) // shift) + 1
    return [(start + i * shift, min(start + i * shift + window, end)) for i in range(first, n) if start + i * shift < end]


class SpeechWindows:
    """The open stretches of one stream, and which of their windows can't change any more.

    A row may come as long as it doesn't begin before the watermark. A stretch
    that ends before it is done with. Of one that began before it, whole windows
    stay as they are, however far it goes on; so only stretches that reach the
    watermark are kept, and of those two times and a number.
    """

    def __init__(self, window: int, shift: int, stretches: list[tuple[int, int, int]] = ()):
        if window <= 0 or shift <= 0:
            raise ValueError("window and shift must be above zero")
        self.window, self.shift = window, shift
        self.stretches = [tuple(s) for s in stretches]

    def add(self, rows: list[tuple[int, int]], watermark: int) -> list[tuple[str, int, int]]:
        """(action, start, end): windows cut, then windows given, by these rows."""
        merged: list[list] = []  # start, end, the old stretches inside, whether a row touched it
        spans = [(a, z, (a, z, n), False) for a, z, n in self.stretches] + [(a, z, None, True) for a, z in rows if z > a >= watermark]
        for a, z, old, new in sorted(spans, key=lambda s: s[:2]):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], z)
            else:
                merged.append([a, z, [], False])
            merged[-1][2] += [old] if old else []
            merged[-1][3] |= new
        cut, given, kept = [], [], []
        for a, z, olds, touched in merged:
            settled = olds[0][2] if olds and olds[0][0] == a else 0
            if touched:
                before = {w for b, y, n in olds for w in windows_of(b, y, self.window, self.shift, n)}
                after = windows_of(a, z, self.window, self.shift, settled)
                cut += sorted(before - set(after))
                given += [w for w in after if w not in before]
            kept.append((a, z, max(settled, (z - a - self.window) // self.shift + 1 if z - a >= self.window else 0) if a < watermark else settled))
        self.stretches = kept
        self.forget(watermark)
        return [("cut", *w) for w in cut] + [("given", *w) for w in given]

    def forget(self, watermark: int) -> None:
        self.stretches = [s for s in self.stretches if s[1] >= watermark]


class _WindowsProcessor(StatefulProcessor):
    def __init__(self, window: int, shift: int):
        self.window, self.shift = window, shift

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("stretches", "starts array<bigint>, ends array<bigint>, settled array<bigint>")

    def _now(self, timers) -> int:
        return max(0, timers.getCurrentWatermarkInMs()) * 1000

    def _kept(self, now: SpeechWindows, watermark: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if now.stretches:
            self.state.update(tuple(list(c) for c in zip(*now.stretches, strict=True)))
            self.handle.registerTimer(max(min(s[1] for s in now.stretches), watermark) // 1000 + 1)
        else:
            self.state.clear()

    def _held(self) -> SpeechWindows:
        return SpeechWindows(self.window, self.shift, list(zip(*self.state.get(), strict=True)) if self.state.exists() else [])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        held, watermark = self._held(), self._now(timerValues)
        came = [(int(a), int(z)) for pdf in rows for a, z in zip(pdf["a"], pdf["z"], strict=True)]
        out = held.add(came, watermark)
        self._kept(held, watermark)
        yield pd.DataFrame([(key[0], *o) for o in out], columns=["stream_id", "action", "start", "end"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        held, watermark = self._held(), self._now(timerValues)
        held.forget(watermark)
        self._kept(held, watermark)
        yield pd.DataFrame([], columns=["stream_id", "action", "start", "end"])

    def close(self) -> None:
        pass


def speech_windows(speech: DataFrame, window: int, shift: int, late: str = "10 seconds") -> DataFrame:
    """Stretches (stream_id, start timestamp, end timestamp) -> windows of their unions, in microseconds: (stream_id, action, start, end).

    On a table, every window is given once. On a stream, windows are given as
    soon as there is speech for them, and cut where later rows join their
    stretch to another one, move its begin or lengthen a window that was
    shortened; what was given and not cut is what the table gives. A row may
    come `late` by so much; rows that begin before the watermark are left out.
    State is a stretch or two for each stream, dropped by a timer as the
    watermark passes. Rows with a null time, or that end before they begin, count for nothing.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    if speech.isStreaming:
        _checked(speech)
        rows = speech.withWatermark("start", late).select("stream_id", "start", micros("start").alias("a"), micros("end").alias("z")).filter("z > a")
        return rows.groupBy("stream_id").transformWithStateInPandas(_WindowsProcessor(window, shift), WINDOWS, "append", "eventTime")
    spans = speech.select("stream_id", micros("start").alias("start"), micros("end").alias("end")).filter("end > start")
    stretches = I.union(spans, ["stream_id"])
    size = F.col("end") - F.col("start")
    n = F.when(size <= window, F.lit(1)).otherwise(F.ceil((size - window) / shift) + 1).cast("int")
    each = stretches.select("stream_id", "end", F.explode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.col("start") + i * shift)).alias("start")).filter("start < end")
    return each.select("stream_id", F.lit("given").alias("action"), "start", F.least(F.col("start") + window, F.col("end")).alias("end"))


# speakers

SPEAKERS = "stream_id string, place long, first_label int, label int"


def levelled(counts: list[int], gone: int, least: int) -> list[int]:
    """How many of each count go, so that `gone` go in all, the largest ones are level, and none falls below `least`."""
    spare = [max(0, c - least) for c in counts]
    left = sum(spare) - gone
    if left < 0:
        raise ValueError("more are to go than can be spared")
    level = max((v for v in range(max(spare, default=0) + 1) if sum(min(s, v) for s in spare) <= left), default=0)
    more = left - sum(min(s, level) for s in spare)
    kept = [min(s, level) for s in spare]
    for i in sorted((i for i, s in enumerate(spare) if s > level), key=lambda i: (-spare[i], i))[:more]:
        kept[i] += 1
    return [s - k for s, k in zip(spare, kept, strict=True)]


def condensed(vectors: np.ndarray, gone: int) -> np.ndarray:
    """`gone` vectors fewer: those most alike all others become their mean, which stands last."""
    if gone <= 0:
        return vectors
    order = np.argsort(-V.affinity(vectors).sum(0), kind="stable")
    some, rest = order[: gone + 1], np.sort(order[gone + 1 :])
    return np.vstack((vectors[rest], vectors[some].mean(0, keepdims=True)))


def matched(old: np.ndarray, new: np.ndarray) -> dict[int, int]:
    """New cluster -> old label, one to one, for the most places in common; clusters without one take the least labels that are free."""
    olds, news = np.unique(old), np.unique(new)
    n = max(len(olds), len(news))
    together = np.zeros((n, n))
    for i, c in enumerate(news):
        for j, label in enumerate(olds):
            together[i, j] = ((new[: len(old)] == c) & (old == label)).sum()
    out = {int(news[i]): int(olds[j]) for i, j in enumerate(assigned(-together)) if i < len(news) and j < len(olds) and together[i, j]} if n else {}
    free = iter(k for k in range(len(news) + len(olds) + 1) if k not in set(out.values()))
    return out | {int(c): next(free) for c in news if int(c) not in out}


class OnlineSpeakers:
    """Speakers of one stream's segments, some at a time.

    The last `current` segments are kept as they are, older ones as a history
    of at most `history` vectors: when it is full, the largest speakers' most
    alike vectors become one, and each speaker keeps history / most of them.
    Each step clusters history, current and new segments together, and matches
    the clusters to the labels so far. The number of speakers is the commonest
    of the last `votes` estimates and at most 1 + segments / `segments_each`;
    the number of neighbours is estimated until `settled` segments have come,
    then the commonest of the last estimates holds.
    """

    def __init__(self, most: int = 8, history: int = 96, current: int = 48, step: int = 8, segments_each: int = 15, votes: int = 3, settled: int = 64):
        if history < 2 * most or current < step or step < 1:
            raise ValueError("a history of two vectors for each speaker and a step within the current segments are needed")
        self.most, self.history, self.current, self.step = most, history, current, step
        self.segments_each, self.votes, self.settled = segments_each, votes, settled
        self.seen, self.counts, self.neighbours = 0, [], []
        self.past, self.past_labels = None, np.zeros(0, int)
        self.now: list[tuple[int, np.ndarray]] = []
        self.labels, self.first = np.zeros(0, int), []
        self.waiting: list[tuple[int, np.ndarray]] = []

    def size(self) -> int:
        """Vectors held."""
        return len(self.past_labels) + len(self.now) + len(self.waiting)

    def push(self, place: int, vector: np.ndarray) -> list[tuple[int, int, int]]:
        """(place, first label, label) of segments that have become history."""
        self.waiting.append((place, vector))
        return self._stepped() if len(self.waiting) == self.step else []

    def end(self) -> list[tuple[int, int, int]]:
        """What is still held."""
        out = self._stepped() if self.waiting else []
        out += [(p, f, int(label)) for (p, _), f, label in zip(self.now, self.first, self.labels, strict=True)]
        self.now, self.first, self.labels = [], [], np.zeros(0, int)
        return out

    def _stepped(self) -> list[tuple[int, int, int]]:
        came, self.waiting = self.waiting, []
        self.seen += len(came)
        vectors = np.array([v for _, v in (*self.now, *came)], float)
        everything = vectors if self.past is None else np.vstack((self.past, vectors))
        before = np.concatenate((self.past_labels, self.labels))
        clusters = self._clusters(everything)
        to = matched(before, clusters)
        labels = np.array([to[int(c)] for c in clusters], int)
        self.past_labels, self.labels = labels[: len(self.past_labels)], labels[len(self.past_labels) :]
        self.first += self.labels[len(self.now) :].tolist()
        self.now += came
        old = len(self.now) - self.current
        if old <= 0:
            return []
        out = [(p, f, int(label)) for (p, _), f, label in zip(self.now[:old], self.first[:old], self.labels[:old], strict=True)]
        self.past = vectors[:old] if self.past is None else np.vstack((self.past, vectors[:old]))
        self.past_labels = np.concatenate((self.past_labels, self.labels[:old]))
        self.now, self.first, self.labels = self.now[old:], self.first[old:], self.labels[old:]
        if len(self.past) > self.history:
            names, counts = np.unique(self.past_labels, return_counts=True)
            gone = levelled(counts.tolist(), len(self.past) - self.history, max(1, self.history // max(self.most, len(names))))
            parts = [condensed(self.past[self.past_labels == name], g) for name, g in zip(names, gone, strict=True)]
            self.past, self.past_labels = np.vstack(parts), np.repeat(names, [len(p) for p in parts])
        return out

    def _clusters(self, x: np.ndarray) -> np.ndarray:
        n = len(x)
        if n < 3:
            return np.zeros(n, int)
        a = V.affinity(x)
        most = min(self.most, n - 1)
        if not self.neighbours or self.seen <= self.settled:
            widest = max(3, int(n * 0.25))
            found = []
            for p in range(2, widest + 1, max(1, widest // 10)):
                _, values = V.eigen_gaps(V.neighbour_graph(a, p), most)
                found.append((p / n / max(np.diff(values[: most + 1]).max(), 1e-10) * max(values[-1], 1e-10), p))
            self.neighbours = [*self.neighbours, min(found)[1]][-self.votes :]
        p = min(_commonest(self.neighbours), n - 1)
        count, _ = V.eigen_gaps(V.neighbour_graph(a, p), most)
        self.counts = [*self.counts, count][-self.votes :]
        count = min(_commonest(self.counts), 1 + self.seen // self.segments_each, n)
        if count == 1:
            return np.zeros(n, int)
        g = V.neighbour_graph(a, p)
        b = g - np.diag(np.diag(g))
        _, axes = np.linalg.eigh(np.diag(np.abs(b).sum(1)) - b)
        return _closest(axes[:, :count], count)


def _closest(x: np.ndarray, k: int, tries: int = 8) -> np.ndarray:
    """The tightest of some runs of k-means: a step that parts speakers badly would pass its labels on."""
    runs = [V.k_means(x, k, seed=seed) for seed in range(tries)]
    spread = [sum(((x[r == c] - x[r == c].mean(0)) ** 2).sum() for c in np.unique(r)) for r in runs]
    return runs[int(np.argmin(spread))]


def _commonest(values: list[int]) -> int:
    counts = Counter(values)
    return min(counts, key=lambda v: (-counts[v], v))


class _Ordered:
    """A stream's segments put in order of place before they are pushed; more than `most_waiting` that wait for an earlier place give it up."""

    def __init__(self, options: dict):
        self.speakers, self.next, self.ahead, self.last, self.latest = OnlineSpeakers(**options), 0, {}, None, 0

    def add(self, rows, most_waiting: int) -> tuple[list[tuple[int, int, int]], bool]:
        """(segments that are done with, whether the stream has ended)."""
        out = []
        for place, vector, last in rows:
            if last:
                self.last = int(place)
            if place >= self.next and vector is not None and place not in self.ahead:
                self.ahead[int(place)] = np.asarray(vector, float)
        while self.ahead and (self.next in self.ahead or len(self.ahead) > most_waiting):
            self.next = min(self.ahead)
            out += self.speakers.push(self.next, self.ahead.pop(self.next))
            self.next += 1
        ended = self.last is not None and self.next > self.last
        return out + (self.end() if ended else []), ended

    def end(self) -> list[tuple[int, int, int]]:
        out = []
        for place in sorted(self.ahead):
            out += self.speakers.push(place, self.ahead[place])
        self.ahead = {}
        return out + self.speakers.end()


class _SpeakersProcessor(StatefulProcessor):
    def __init__(self, options: dict, idle: int, most_waiting: int):
        self.options, self.idle, self.most_waiting = options, idle, most_waiting

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("speakers", "packed binary")

    def _held(self) -> _Ordered:
        return pickle.loads(bytes(self.state.get()[0])) if self.state.exists() else _Ordered(self.options)  # noqa: S301  its own state

    def _timed(self, at: int | None) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if at is None:
            self.state.clear()
        else:
            self.handle.registerTimer(at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        held = self._held()
        came = sorted(((p, v, bool(last), at) for pdf in rows for p, v, last, at in zip(pdf["place"], pdf["vector"], pdf["is_last"], pdf["ms"], strict=True)), key=lambda r: r[0])
        held.latest = max(held.latest, *(int(at) for *_, at in came))
        out, ended = held.add([r[:3] for r in came], self.most_waiting)
        if not ended:
            self.state.update((pickle.dumps(held),))
        self._timed(None if ended else max(held.latest, timerValues.getCurrentWatermarkInMs()) + self.idle)
        yield pd.DataFrame([(key[0], *o) for o in out], columns=["stream_id", "place", "first_label", "label"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        out = self._held().end()
        self._timed(None)
        yield pd.DataFrame([(key[0], *o) for o in out], columns=["stream_id", "place", "first_label", "label"])

    def close(self) -> None:
        pass


def online_speakers(segments: DataFrame, late: str = "10 minutes", idle: int = 3_600_000, most_waiting: int = 64, **options) -> DataFrame:
    """Segments (stream_id, place long, vector array<double>, is_last boolean; streams: start timestamp) -> (stream_id, place, first_label, label).

    Places are 0, 1, 2, ...; first_label is what a segment was given when it
    came, label what it had when it became history, or the stream ended. On a
    stream rows may come out of order, `late` by so much: a segment waits for the places before
    it, until more than `most_waiting` do; then the missing ones are given up.
    Rows with a place that has passed, one that came before, or no vector are left out, and a
    stream ends as if its last row had come when the watermark is `idle` milliseconds past its latest start.
    What comes for a stream that has ended begins a new one.
    On a table a stream ends with its rows; a segment waits for none there, so the labels are
    the same where all places come. Segments come in steps of a fixed number, whatever the
    batches. Options are those of OnlineSpeakers.
    """
    rows = segments.withWatermark("start", late) if segments.isStreaming else segments
    when = ["start", F.unix_millis(F.col("start").cast("timestamp")).alias("ms")] if segments.isStreaming else []
    rows = rows.select(F.col("stream_id").cast("string").alias("stream_id"), F.col("place").cast("long").alias("place"), F.col("vector").cast("array<double>").alias("vector"), F.coalesce("is_last", F.lit(False)).alias("is_last"), *when).filter("place is not null")
    OnlineSpeakers(**options)
    if segments.isStreaming:
        _checked(segments)
        return rows.groupBy("stream_id").transformWithStateInPandas(_SpeakersProcessor(options, idle, most_waiting), SPEAKERS, "append", "eventTime")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, last = object(), None, None
        for batch in batches:
            out = []
            for stream, place, vector in zip(batch.column("stream_id").to_pylist(), batch.column("place").to_pylist(), batch.column("vector").to_pylist(), strict=True):
                if held is None or stream != name:
                    out += [(name, *o) for o in held.end()] if held else []
                    name, held, last = stream, OnlineSpeakers(**options), None
                if vector is not None and place != last and place >= 0:
                    out += [(name, *o) for o in held.push(place, np.asarray(vector, float))]
                    last = place
            yield _rows(out)
        if held:
            yield _rows([(name, *o) for o in held.end()])

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["stream_id", "place", "first_label", "label"])

    return rows.repartition("stream_id").sortWithinPartitions("stream_id", "place").mapInArrow(fold, SPEAKERS)
