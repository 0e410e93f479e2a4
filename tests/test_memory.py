"""What a task holds doesn't follow the table."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa

from cantoria.functions import text as T
from cantoria.operators import vectors as V


def test_neighbours_hold_blocks_of_scores(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(10_000, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:2_000])], "id long, v array<double>")
    task = []
    plain = type(df).mapInPandas
    monkeypatch.setattr(type(df), "mapInPandas", lambda self, f, *a, **b: (task.append(f), plain(self, f, *a, **b))[1])
    V.neighbours(df, df, "id", "v", 5)
    tracemalloc.start()
    found = pd.concat(task[0](iter([pd.DataFrame({"id": range(10_000), "v": x.tolist()})])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 150e6  # 2,000 queries by 10,000 rows are 160 MB of scores
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = unit[:2_000] @ unit.T
    s[np.arange(2_000), np.arange(2_000)] = -np.inf
    wanted = np.argsort(-s, axis=1)[:, :5]
    assert {q: set(g["id"]) for q, g in found.groupby("query")} == {q: set(w) for q, w in enumerate(wanted.tolist())}


def test_equal_neighbours_come_by_key(spark):
    df = spark.createDataFrame([(i, [1.0, float(i % 3)]) for i in range(300)], "id long, v array<double>").repartition(3)
    found = V.neighbours(df.filter("id = 0"), df, "id", "v", 4).orderBy("place").collect()
    assert [r.id for r in found] == [3, 6, 9, 12]


def test_folded_texts_hold_little_besides_the_batch():
    text = pa.array(["é" * 2_000] * 10_000)
    tracemalloc.start()
    out = T.ascii_folded.func(text)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 5e6 and len(out) == 10_000 and out[0].as_py() == "e" * 2_000 and T.ascii_folded.func(pa.array([None, ""])).to_pylist() == [None, ""]
