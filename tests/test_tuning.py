"""The whole grid against a run for each point, instant by instant."""

import math
import random

import pytest

from cantoria.operators import tuning as T

CHOICES = {"onset": [0.7, 0.5, 0.2], "offset": [0.2, 0.5, 0.6], "pad_onset": [0.0, 2.0], "pad_offset": [0.0, 1.0, -1.0], "min_duration_on": [0.0, 3.0], "min_duration_off": [0.0, 2.0], "filter_speech_first": [True, False]}


def spans(units):
    out = []
    for t in sorted(units):
        if out and out[-1][1] == t:
            out[-1][1] = t + 1
        else:
            out.append([t, t + 1])
    return out


def heard(scores, p):
    """Units of speech, one frame a unit."""
    out, on, first = [], False, 0
    for i, s in enumerate(scores):
        if on and s < p["offset"]:
            out.append((first, i))
            on = False
        elif not on and s > p["onset"]:
            on, first = True, i
    if on:
        out.append((first, len(scores)))
    units = {t for a, z in out for t in range(int(max(0, a - p["pad_onset"])), int(z + p["pad_offset"]))}

    def dropped(u):
        return {t for a, z in spans(u) if z - a >= p["min_duration_on"] for t in range(a, z)}

    def filled(u):
        s = spans(u)
        return u | {t for (_, z), (a, _) in zip(s, s[1:], strict=False) if a - z < p["min_duration_off"] for t in range(z, a)}

    return filled(dropped(units)) if p["filter_speech_first"] else dropped(filled(units))


def files(seed=4):
    rng = random.Random(seed)
    out = {}
    for i in range(6):
        level = 0.5
        scores = [level := min(1, max(0, round(level + rng.uniform(-0.3, 0.3), 2))) for _ in range(rng.choice((1, 20, 70)))]
        out[f"f{i}"] = scores, [(a := rng.randrange(60), a + rng.randint(0, 9)) for _ in range(rng.randint(0, 5))]
    return out | {"no frames": ([], [(3, 9)]), "no reference": ([1.0] * 5, [])}


def tables(spark, data):
    frames = spark.createDataFrame([(f, i, float(s)) for f, (scores, _) in data.items() for i, s in enumerate(scores)], "file string, frame_idx int, p double")
    return frames, spark.createDataFrame([(f, float(a), float(z)) for f, (_, ref) in data.items() for a, z in ref], "file string, start double, end double")


def test_grid_equals_a_run_for_each_point(spark):
    data, expected = files(), {}
    for p in T.parameter_grid(CHOICES):
        scored = alarm = missed = 0
        for scores, ref in data.values():
            spoken = {t for a, z in ref for t in range(a, z)}
            if spoken:
                said = {t for t in heard(scores, p) if min(spoken) <= t <= max(spoken)}
                scored, alarm, missed = scored + len(spoken), alarm + len(said - spoken), missed + len(spoken - said)
        expected[tuple(p.values())] = (float(scored), float(alarm), float(missed))
    rows = T.detection_grid(*tables(spark, data), "file", 1.0, CHOICES).collect()
    found = {tuple(r[c] for c in T.DEFAULTS): (r.scored, round(r.false_alarm, 6), round(r.missed, 6)) for r in rows}
    assert found == expected and len(rows) == len(expected)
    least = min((v[1] + v[2]) / v[0] for v in expected.values())
    best = T.tuned(*tables(spark, data), "file", 1.0, CHOICES)
    assert math.isclose(best["error_rate"], least)
    assert tuple(best[c] for c in T.DEFAULTS) == next(k for k, v in expected.items() if math.isclose((v[1] + v[2]) / v[0], least))


def test_grid_without_anything_scored(spark):
    rows = T.detection_grid(*tables(spark, {"f": ([0.9], [])}), "file", 1.0, {"onset": [0.5]}).collect()
    assert [(r.scored, math.isnan(r.error_rate)) for r in rows] == [(0.0, True)]


@pytest.mark.parametrize("bad", [{"onset": []}, {"onset": [1.5]}, {"filter_speech_first": [1]}, {"pad_onset": [True]}, {"threshold": [0.1]}, {"min_duration_on": [-1.0]}])
def test_choices_that_are_refused(bad):
    with pytest.raises(ValueError):
        T.parameter_grid(bad)
