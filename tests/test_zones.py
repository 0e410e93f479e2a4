"""Zones against walking outwards unit by unit, regions against a grid of instants."""

import random

import pandas as pd

from cantoria.operators import scoring as S
from cantoria.operators import zones as Z

EXCLUDED = {"NON-LEX": {"laugh"}, "LEXEME": {"fp"}, "EDIT": {"simple"}}
INF = float("inf")


def tokens(seed, n=14, span=60):
    rng = random.Random(seed)
    kinds = [("LEXEME", "lex"), ("LEXEME", "fp"), ("SPEAKER", None), ("NON-LEX", "laugh"), ("NON-LEX", "cough"), ("EDIT", "simple"), ("OTHER", "x")]
    return [(*rng.choice(kinds), a := rng.randrange(span), a + rng.choice((0, 1, 2, 3, 6))) for _ in range(n)]


def brute(rows, extend):
    """Whole numbers: each zone grows unit by unit until it meets an anchor or has grown enough."""
    there = [(k, s, a, z) for k, s, a, z in rows if z > a]
    lexemes = [(a, z) for k, s, a, z in there if k == "LEXEME" and s != "fp"]
    zones = [(a, z) for k, s, a, z in there if k not in ("LEXEME", "SPEAKER") and s in EXCLUDED.get(k, ())]
    anchors = {t for a, z in lexemes for t in (a, z)} | {t for k, _, a, z in there if k == "SPEAKER" for t in (a, z)}
    talking = lambda t: any(a <= t <= z for a, z in lexemes)
    covered = {t for a, z in zones for t in range(a, z)}
    alone = [(a, z) for a, z in islands(covered)]
    grown = set(covered)
    endless = None
    for a, z in alone:
        t = a
        while not talking(a) and t > max(0, a - extend) and t not in anchors:
            t -= 1
            grown.add(t)
        if not talking(z) and not any(x >= z for x in anchors) and not any(b > a for b, _ in alone):
            endless = z
        t = z
        while not talking(z) and t < z + extend and t not in anchors:
            grown.add(t)
            t += 1
    found = [list(x) for x in islands(grown)]
    if endless is not None:
        found = [x for x in found if x[1] < endless] + [[min([x[0] for x in found if x[1] >= endless]), INF]]
    return [tuple(map(float, x)) for x in found]


def islands(units):
    out = []
    for t in sorted(units):
        if out and out[-1][1] == t:
            out[-1] = (out[-1][0], t + 1)
        else:
            out.append((t, t + 1))
    return out


def frame(spark, by_file):
    return spark.createDataFrame([(f, k, s, float(a), float(z)) for f, rows in by_file.items() for k, s, a, z in rows], "file string, kind string, subtype string, start double, end double")


def test_exclusion_zones(spark):
    by_file = {f"f{i}": tokens(i, n=4 + i % 16) for i in range(120)}
    for extend in (0, 3):
        found = {}
        for f, a, z in sorted(map(tuple, Z.exclusion_zones(frame(spark, by_file), ["file"], EXCLUDED, extend).collect())):
            found.setdefault(f, []).append((a, z))
        assert found == {f: b for f, rows in by_file.items() if (b := brute(rows, extend))}


def test_regions_without_zones_overlaps_and_collars(spark):
    rng = random.Random(3)
    spans = lambda n: [(a := rng.randrange(40), a + rng.randrange(6)) for _ in range(n)]
    files = {f"f{i}": (spans(rng.randint(1, 3)), spans(rng.randint(0, 5)), spans(rng.randint(0, 6))) for i in range(60)} | {"gone": ([(2, 5)], [(0, 9)], []), "endless": ([(0, 9)], [(4, INF)], [])}
    table = lambda k: spark.createDataFrame([(f, float(a), float(z)) for f, x in files.items() for a, z in x[k]], "file string, start double, end double")
    gathered = lambda df: {f: sorted((r.start, r.end) for r in df.filter(df.file == f).collect()) for f in ("gone", "endless")} | {"all": sorted(map(tuple, df.collect()))}
    found = gathered(Z.regions_without(table(0), table(1), ["file"]))
    cover = lambda x: {t for a, z in x for t in range(a, int(min(z, 60)))}
    expected = []
    for f, (regions, zones, _) in files.items():
        left = cover(regions) - cover(zones) or cover(regions)
        expected += [(f, float(a), float(z)) for a, z in islands(left)]
    assert found["all"] == sorted(expected) and found["gone"] == [(2.0, 5.0)] and found["endless"] == [(0.0, 4.0)]
    at_once = sorted((f, float(a), float(z)) for f, x in files.items() for a, z in islands({t for t in range(60) if sum(p <= t < q for p, q in x[2]) > 1}))
    assert sorted(map(tuple, Z.overlapped_speech(table(2), ["file"]).collect())) == at_once
    assert sorted(map(tuple, Z.collar_zones(table(0).filter("file = 'gone'"), ["file"], 0.5).collect())) == [("gone", 1.5, 2.5), ("gone", 4.5, 5.5)]


def test_diarization_outside_zones(spark):
    ref = pd.DataFrame([("f", 0.0, 10.0, "a"), ("f", 8.0, 20.0, "b")], columns=["file", "start", "end", "speaker"])
    heard = pd.DataFrame([("f", 0.0, 12.0, "x"), ("f", 14.0, 20.0, "y")], columns=["file", "start", "end", "speaker"])
    regions = spark.createDataFrame([("f", 0.0, 20.0)], "file string, start double, end double")
    zones = spark.createDataFrame([("f", 8.0, 10.0), ("f", 13.0, 15.0)], "file string, start double, end double")
    row = S.diarization(spark.createDataFrame(ref), spark.createDataFrame(heard), "file", uem=Z.regions_without(regions, zones, ["file"])).first()
    # left: 0-8, 10-13, 15-20; x is a, y is b: b is missed over 12-13, x stands for b over 10-12
    assert (row.missed, row.false_alarm, row.confusion, row.scored) == (1.0, 0.0, 2.0, 16.0)


def test_no_tokens(spark):
    assert Z.exclusion_zones(frame(spark, {}), ["file"], EXCLUDED).collect() == []
    assert Z.exclusion_zones(frame(spark, {"f": [("LEXEME", "lex", 1, 2), ("NON-LEX", None, 3, 4)]}), ["file"], {}).collect() == []
