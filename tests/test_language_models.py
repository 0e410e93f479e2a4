"""Back-off models against dictionaries, merges against the mixture's rule, sums of every history, files read back."""

import math
import random
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cantoria.functions import tokens as Tk
from cantoria.operators import language_models as L
from cantoria.sources import manifests as M


def texts(seed, n=30):
    rng = random.Random(seed)
    return [" ".join(rng.choice("a b c d e f".split()[: 3 + seed % 4]) for _ in range(rng.randint(0, 7))) for _ in range(n)]


class Plain:
    """The same model, gram by gram."""

    def __init__(self, p, order):
        self.p, self.order, self.alpha = p, order, {}
        words = [g[0] for g in p if len(g) == 1]
        for n in range(1, order):
            for h in {g[:-1] for g in p if len(g) == n + 1}:
                seen = [w for w in words if (*h, w) in p]
                left, lower = 1 - sum(p[*h, w] for w in seen), 1 - sum(self.of((*h[1:], w)) for w in seen)
                self.alpha[h] = left / lower if left > 1e-12 and lower > 1e-12 else 0.0

    def of(self, gram):
        gram = gram[-self.order :]
        if gram in self.p:
            return self.p[gram]
        return self.alpha.get(gram[:-1], 1.0) * self.of(gram[1:]) if len(gram) > 1 else 0.0


def estimate(lines, order):
    c = Counter()
    for t in lines:
        w = ["<s>", *t.split(), "</s>"]
        c.update(tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1) if w[i + n - 1] != "<s>")
    by = defaultdict(list)
    for g in c:
        by[g[:-1]].append(g)
    p = {g: c[g] / (sum(c[x] for x in by[g[:-1]]) + len(by[g[:-1]])) for g in c}
    p["<unk>",] = len(by[()]) / (sum(c[x] for x in by[()]) + len(by[()]))
    p["<s>",] = 0.0
    return Plain(p, order)


def merge(a, b, order, alpha, beta):
    p = {}
    for g in {*a.p, *b.p}:
        if len(g) == 1:
            x, y = alpha, beta
        else:
            x, y = alpha * (g[:-1] in a.alpha), beta * (g[:-1] in b.alpha)
        p[g] = (x * a.of(g) + y * b.of(g)) / (x + y) if x + y else max(a.of(g), b.of(g))
    return Plain(p, order)


def same(rows, plain):
    found = {tuple(r.ngram.split(" ")): r for r in rows}
    assert found.keys() == plain.p.keys()
    for g, r in found.items():
        assert r.order == len(g) and math.isclose(10**r.log10p if r.log10p > -99 else 0.0, plain.p[g], abs_tol=1e-9)
        assert (r.backoff is None) == (g not in plain.alpha)
        assert r.backoff is None or math.isclose(10**r.backoff if r.backoff > -99 else 0.0, plain.alpha[g], rel_tol=1e-7, abs_tol=1e-9)


def model(spark, lines, order):
    return L.estimated(Tk.ngram_counts(spark.createDataFrame([(t,) for t in lines], "text string"), "text", order), order)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_estimates_merges_and_perplexity(spark, tmp_path, order):
    a, b = texts(1), texts(2, 12)
    first, second = model(spark, a, order), model(spark, b, order)
    plain_a, plain_b = estimate(a, order), estimate(b, order)
    same(first.collect(), plain_a)
    mixed, plain = L.merged(first, second, order, 0.7, 0.3), merge(plain_a, plain_b, order, 0.7, 0.3)
    same(mixed.collect(), plain)
    same(L.merged(first, second, order, 1.0, 0.0).collect(), merge(plain_a, plain_b, order, 1.0, 0.0))
    sums = L.history_sums(mixed, order).collect()
    assert len(sums) == len(plain.alpha) and all(math.isclose(r.total, 1, abs_tol=1e-9) for r in sums)
    held = ["a b c", "zz a", "", "f f f f"]
    w = [["<s>", *(x if (x,) in plain.p else "<unk>" for x in t.split()), "</s>"] for t in held]
    log = sum(math.log10(plain.of(tuple(s[max(0, i - order + 1) : i + 1]))) for s in w for i in range(1, len(s)))
    r = L.perplexity(mixed, spark.createDataFrame([(t,) for t in held], "text string"), "text", order).first()
    assert (r.words, r.unknown) == (sum(len(s) - 1 for s in w), sum(x == "<unk>" for s in w for x in s)) and math.isclose(r.perplexity, 10 ** (-log / r.words), rel_tol=1e-6)
    L.write_arpa(mixed, f"{tmp_path}/lm")
    again = {r.ngram: r for r in M.arpa(spark, f"{tmp_path}/lm").collect()}
    assert again.keys() == {r.ngram for r in mixed.collect()} and all(abs(again[r.ngram].log10p - r.log10p) < 1e-6 and abs((again[r.ngram].backoff or 0) - (r.backoff or 0)) < 1e-6 for r in mixed.collect())
    lines = [x for f in sorted((tmp_path / "lm").glob("part-*")) for x in f.read_text().split("\n")]
    assert lines[0] == "\\data\\" and [x for x in lines if x][-1] == "\\end\\" and f"\\{order}-grams:" in lines


def counting(spark, lines):
    """Texts that count how often they are read."""
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def said(i):
        reads.add(1)
        return lines[i]

    return spark.range(len(lines)).select(said("id").alias("text")), reads


def test_texts_are_read_once_for_each_level_of_a_model(spark):
    (a, reads_a), (b, reads_b) = (counting(spark, texts(seed)) for seed in (1, 2))
    mixed = L.merged(L.estimated(Tk.ngram_counts(a, "text", 2), 2), L.estimated(Tk.ngram_counts(b, "text", 2), 2), 2, 0.7, 0.3)
    same(mixed.collect(), merge(estimate(texts(1), 2), estimate(texts(2), 2), 2, 0.7, 0.3))
    assert (reads_a.value, reads_b.value) == (60, 60)


def test_very_long_words(spark):
    lines = ["a " + "b" * 100_000 + " a b", "c " + "b" * 100_000]
    mixed, plain = model(spark, lines, 2), estimate(lines, 2)
    began = time.time()
    r = L.perplexity(mixed, spark.createDataFrame([(t,) for t in lines], "text string"), "text", 2).first()
    assert time.time() - began < 20
    w = [["<s>", *t.split(" "), "</s>"] for t in lines]
    assert r.unknown == 0 and math.isclose(r.log10p, sum(math.log10(plain.of((s[i - 1], s[i]))) for s in w for i in range(1, len(s))), rel_tol=1e-6)


def test_weights_are_checked(spark):
    m = model(spark, ["a"], 1)
    for bad in ((-1, 2), (0, 0)):
        with pytest.raises(ValueError):
            L.merged(m, m, 1, *bad)
