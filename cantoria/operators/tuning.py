"""Thresholds of speech detection, tuned on recordings whose speech is known.

A whole grid of thresholds is scored from one shuffle: a recording's frames are
sorted by score once; each distinct threshold takes a prefix of that order, and
each pair of thresholds is then a matter of runs, not of frames.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

#: What a point of the grid may set, and what holds where it doesn't.
DEFAULTS = {"onset": 0.5, "offset": 0.5, "pad_onset": 0.0, "pad_offset": 0.0, "min_duration_on": 0.0, "min_duration_off": 0.0, "filter_speech_first": True}
FIGURES = ("scored", "false_alarm", "missed")


def parameter_grid(choices: dict[str, list]) -> list[dict]:
    """Every combination of the choices, with defaults for what has none; unknown names and pads that aren't numbers are errors."""
    if unknown := set(choices) - set(DEFAULTS):
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    for name, values in choices.items():
        flag = name == "filter_speech_first"
        if not values or any(isinstance(v, bool) != flag or not isinstance(v, (bool, int, float)) for v in values):
            raise ValueError(f"{name} takes {'True or False' if flag else 'numbers'}")
        if name.startswith(("onset", "offset")) and any(not 0 <= v <= 1 for v in values) or name.startswith("min_") and any(v < 0 for v in values):
            raise ValueError(f"{name} is out of range")
    return [DEFAULTS | dict(zip(choices, point, strict=True)) for point in product(*choices.values())]


def _united(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((end, start))
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.append(True, start[1:] > reach[:-1]) if len(start) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return start[first], reach[np.append(first[1:], len(start)) - 1] if len(first) else reach


def _joined(start: np.ndarray, end: np.ndarray, least_off: float) -> tuple[np.ndarray, np.ndarray]:
    """Segments, apart and in order, joined over gaps shorter than least_off."""
    if not len(start) or least_off <= 0:
        return start, end
    new = np.append(True, start[1:] - end[:-1] >= least_off)
    return start[new], end[np.append(new[1:], True)]


class Frames:
    """One recording's frames 0, 1, ... and their scores, prepared for any thresholds."""

    def __init__(self, scores: np.ndarray):
        self.scores, self.order = scores, np.argsort(-scores, kind="stable")
        self.falling = scores[self.order]
        self._above: dict[float, np.ndarray] = {}
        self._runs: dict[float, tuple[np.ndarray, np.ndarray]] = {}

    def above(self, onset: float) -> np.ndarray:
        """Frames whose score exceeds the onset, in order of time."""
        if onset not in self._above:
            self._above[onset] = np.sort(self.order[: np.searchsorted(-self.falling, -onset, "left")])
        return self._above[onset]

    def runs(self, offset: float) -> tuple[np.ndarray, np.ndarray]:
        """First and last frames of the runs whose scores reach the offset."""
        if offset not in self._runs:
            at = np.sort(self.order[: np.searchsorted(-self.falling, -offset, "right")])
            apart = np.flatnonzero(np.diff(at) > 1)
            self._runs[offset] = at[np.append(0, apart + 1)] if len(at) else at, at[np.append(apart, len(at) - 1)] if len(at) else at
        return self._runs[offset]

    def speech(self, onset: float, offset: float) -> tuple[np.ndarray, np.ndarray]:
        """First and last frames of speech that begins above the onset and goes on until a score falls below the offset."""
        up = self.above(onset)
        if onset >= offset:
            first, last = self.runs(offset)
            at = np.searchsorted(up, first)
            there = at < len(up)
            first, last = up[at[there]], last[there]
            return first[first <= last], last[first <= last]
        # a score between the two begins speech and ends it at once in turns
        down, first, last, now = np.flatnonzero(self.scores < offset), [], [], 0
        while (i := np.searchsorted(up, now)) < len(up):
            j = np.searchsorted(down, up[i] + 1)
            first.append(up[i])
            last.append(down[j] - 1 if j < len(down) else len(self.scores) - 1)
            now = last[-1] + 2
        return np.array(first, int), np.array(last, int)

    def segments(self, frame: float, onset: float, offset: float, pad_onset: float, pad_offset: float, min_duration_on: float, min_duration_off: float, filter_speech_first: bool) -> tuple[np.ndarray, np.ndarray]:
        """Speech in seconds: padded, united, short speech dropped and short gaps filled, in either order."""
        first, last = self.speech(onset, offset)
        start, end = np.maximum(first * frame - pad_onset, 0.0), (last + 1) * frame + pad_offset
        start, end = _united(start[end > start], end[end > start])
        if not filter_speech_first:
            start, end = _joined(start, end, min_duration_off)
        keep = end - start >= min_duration_on
        start, end = start[keep], end[keep]
        return _joined(start, end, min_duration_off) if filter_speech_first else (start, end)


def detection_errors(segments: tuple[np.ndarray, np.ndarray], reference: tuple[np.ndarray, np.ndarray]) -> tuple[float, float, float]:
    """(scored, false alarm, missed) seconds between the reference's first begin and last end."""
    start, end = _united(*reference)
    if not len(start):
        return 0.0, 0.0, 0.0
    edges = np.column_stack((start, end)).ravel()
    spoken = np.append(0, np.cumsum(end - start))
    until = np.column_stack((spoken[:-1], spoken[1:])).ravel()  # seconds of speech before each edge
    a, z = (np.clip(x, edges[0], edges[-1]) for x in segments)
    hit = float((np.interp(z, edges, until) - np.interp(a, edges, until)).sum())
    return float(spoken[-1]), float((z - a).sum()) - hit, float(spoken[-1]) - hit


def detection_grid(frames: DataFrame, reference: DataFrame, key: str, frame: float, choices: dict[str, list]) -> DataFrame:
    """Each point of the grid with scored, false_alarm and missed seconds over all recordings, and error_rate, false_alarm_rate, missed_rate.

    frames: (key, frame_idx, p), frame_idx 0, 1, ... without gaps; reference:
    (key, start, end). Recordings without frames miss all, those without a
    reference score nothing. Null and NaN scores count as 0. Rates are NaN where
    nothing is scored. Speech at the end ends with its last frame.
    """
    grid = parameter_grid(choices)
    tagged = frames.select(key, F.col("frame_idx").cast("double").alias("a"), F.coalesce(F.nanvl(F.col("p").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("b"), F.lit(True).alias("scores"))
    tagged = tagged.unionByName(reference.filter("end > start").select(key, F.col("start").cast("double").alias("a"), F.col("end").cast("double").alias("b"), F.lit(False).alias("scores")))

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        mine = pdf[pdf["scores"]].sort_values("a")
        spans = pdf[~pdf["scores"]]
        known = spans["a"].to_numpy(float), spans["b"].to_numpy(float)
        prepared = Frames(mine["b"].to_numpy(float))
        found = [detection_errors(prepared.segments(frame, **point), known) for point in grid]
        return pd.DataFrame([(i, *f) for i, f in enumerate(found)], columns=["point", *FIGURES])

    each = spread(tagged, key).groupBy(key).applyInPandas(score, "point int, scored double, false_alarm double, missed double")
    sums = each.groupBy("point").agg(*(F.sum(c).alias(c) for c in FIGURES))
    points = frames.sparkSession.createDataFrame([(i, *(float(v) if not isinstance(v, bool) else v for v in p.values())) for i, p in enumerate(grid)], "point int, " + ", ".join(f"{n} {'boolean' if isinstance(v, bool) else 'double'}" for n, v in DEFAULTS.items()))
    rate = lambda c: F.coalesce(F.try_divide(c, F.col("scored")), F.lit(float("nan")))
    full = points.join(sums, "point", "left").na.fill(0.0, list(FIGURES))
    return full.withColumns({"error_rate": rate(F.col("false_alarm") + F.col("missed")), "false_alarm_rate": rate(F.col("false_alarm")), "missed_rate": rate(F.col("missed"))}).drop("point")


def tuned(frames: DataFrame, reference: DataFrame, key: str, frame: float, choices: dict[str, list], focus: str = "error_rate") -> dict:
    """The point of the grid with the least of `focus`, the first of equal ones, and its figures."""
    if focus not in ("error_rate", "false_alarm_rate", "missed_rate"):
        raise ValueError(focus)
    rows = detection_grid(frames, reference, key, frame, choices).toPandas()  # a row for each point
    order = {tuple(float(v) for v in p.values()): i for i, p in enumerate(parameter_grid(choices))}
    rows["at"] = [order[tuple(float(v) for v in r)] for r in rows[list(DEFAULTS)].itertuples(index=False)]
    return rows.sort_values([focus, "at"], na_position="last").iloc[0].drop("at").to_dict()
