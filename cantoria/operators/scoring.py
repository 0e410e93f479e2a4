"""Error rates, classification, calibration, diarization and turn-taking metrics over rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..functions.errors import char_distance, operations, rate, subsequence_lengths, word_distance, words
from ..session import spread

# transcripts


def per_row(df: DataFrame, reference: str = "text", hypothesis: str = "pred_text") -> DataFrame:
    """Adds word and character errors, tokens and rates; all in the JVM."""
    r, h = F.coalesce(reference, F.lit("")), F.coalesce(hypothesis, F.lit(""))
    out = df.withColumn("word_errors", word_distance(r, h)).withColumn("ref_words", F.size(words(r)).cast("long")).withColumn("char_errors", char_distance(r, h)).withColumn("ref_chars", F.length(r).cast("long"))
    return out.withColumn("wer", rate(F.col("word_errors"), F.col("ref_words"))).withColumn("cer", rate(F.col("char_errors"), F.col("ref_chars")))


def corpus(df: DataFrame, *by: str, reference: str = "text", hypothesis: str = "pred_text") -> DataFrame:
    """sum of errors / sum of reference tokens, for each group; infinite without tokens."""
    sums = per_row(df, reference, hypothesis).groupBy(*by).agg(*(F.sum(c).alias(c) for c in ("word_errors", "ref_words", "char_errors", "ref_chars")), F.count("*").alias("n_rows"))
    return sums.withColumn("wer", rate(F.col("word_errors"), F.col("ref_words"))).withColumn("cer", rate(F.col("char_errors"), F.col("ref_chars")))


def detailed(df: DataFrame, reference: str = "text", hypothesis: str = "pred_text", characters: bool = False) -> DataFrame:
    """Adds tokens and counts and rates of insertions, deletions and substitutions."""
    tokens = (lambda c: F.filter(F.split(F.coalesce(c, F.lit("")), ""), lambda x: x != "")) if characters else words
    out = df.withColumn("ops", operations(tokens(F.col(reference)), tokens(F.col(hypothesis)))).withColumn("tokens", F.size(tokens(F.col(reference))).cast("long"))
    out = out.select("*", "ops.*").drop("ops").withColumn("error_rate", rate(F.col("insertions") + F.col("deletions") + F.col("substitutions"), F.col("tokens")))
    return out.withColumns({f"{x[:3]}_rate": rate(F.col(x), F.col("tokens")) for x in ("insertions", "deletions", "substitutions")})


def by_slots(df: DataFrame, column: str, slots: list[tuple[float, float]] | list[list[str]], **names: str) -> DataFrame:
    """Corpus rates by slots of a metadata column: [a, b) ranges or sets of values; the first slot that matches counts, rows of none are `other`."""
    out = F
    for s in slots:
        ranged = len(s) == 2 and not isinstance(s[0], str)
        out = out.when((F.col(column) >= s[0]) & (F.col(column) < s[1]) if ranged else F.col(column).isin(*s), f"{s[0]}-{s[1]}" if ranged else ",".join(s))
    return corpus(df.withColumn("slot", out.otherwise("other")), "slot", **names)


def edge_rates(df: DataFrame, k: int, reference: str = "text", hypothesis: str = "pred_text") -> DataFrame:
    """Adds wer, cer, the cer of the first and last k characters, and the relative difference in words."""
    r, h = F.coalesce(reference, F.lit("")), F.coalesce(hypothesis, F.lit(""))
    tail = lambda c: F.substring(c, F.greatest(F.length(c) - k + 1, F.lit(1)), F.lit(k))
    out = per_row(df, reference, hypothesis)
    out = out.withColumn("start_cer", rate(char_distance(F.substring(r, 1, k), F.substring(h, 1, k)), F.least(F.length(r), F.lit(k)))).withColumn("end_cer", rate(char_distance(tail(r), tail(h)), F.least(F.length(r), F.lit(k))))
    return out.withColumn("len_diff_ratio", F.abs(F.size(words(r)) - F.size(words(h))) / F.greatest(F.size(words(r)), F.lit(1)))


def mean_of_datasets(df: DataFrame, dataset: str, **names: str) -> DataFrame:
    """Rates of each dataset, and their unweighted mean as dataset null."""
    each = corpus(df, dataset, **names).select(dataset, "wer", "cer")
    return each.unionByName(each.agg(F.avg("wer").alias("wer"), F.avg("cer").alias("cer")).withColumn(dataset, F.lit(None).cast(df.schema[dataset].dataType)))


def blank_share(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg((F.trim(F.coalesce(column, F.lit(""))) == "").cast("int")).alias("blank_share"))


def exact_matches(df: DataFrame, reference: str, hypothesis: str, category: str | None = None) -> DataFrame:
    """Share of equal strings, in all (category null) and by category."""
    hit = F.avg((F.col(reference) == F.col(hypothesis)).cast("int")).alias("accuracy")
    return df.rollup(category).agg(hit) if category else df.agg(hit)


def token_f1(references: Column, hypothesis: Column) -> Column:
    """Best token F1 (multiset overlap) of the hypothesis over an array of references."""
    def one(r: Column) -> Column:
        a, b = words(F.lower(r)), words(F.lower(hypothesis))
        both = F.array_distinct(F.array_intersect(a, b))
        count = lambda x, w: F.size(F.filter(x, lambda y: y == w))
        common = F.aggregate(both, F.lit(0), lambda s, w: s + F.least(count(a, w), count(b, w)))
        return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(2.0 * common / (F.size(a) + F.size(b)))

    return F.array_max(F.transform(references, one))


def ngram_matches(df: DataFrame, by: list[str], reference: str, hypothesis: str, most: int = 4) -> DataFrame:
    """BLEU of each group from clipped n-gram counts summed over rows: score (0 to 100), brevity penalty, precisions."""
    def grams(tokens: Column, n: int) -> Column:
        return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1), lambda i: F.array_join(F.slice(tokens, i, n), "\x01"))).otherwise(F.array().cast("array<string>"))

    def clipped(a: Column, b: Column) -> Column:
        count = lambda x, g: F.size(F.filter(x, lambda y: y == g))
        return F.aggregate(F.array_intersect(a, b), F.lit(0).cast("long"), lambda s, g: s + F.least(count(a, g), count(b, g)))

    t = df.withColumn("_r", words(F.col(reference))).withColumn("_h", words(F.col(hypothesis)))
    aggs = [F.sum(F.size("_r")).alias("ref_len"), F.sum(F.size("_h")).alias("hyp_len")]
    for n in range(1, most + 1):
        aggs += [F.sum(clipped(grams(F.col("_r"), n), grams(F.col("_h"), n))).alias(f"match_{n}"), F.sum(F.greatest(F.size("_h") - n + 1, F.lit(0))).alias(f"total_{n}")]
    sums = t.groupBy(*by).agg(*aggs)
    brevity = F.when(F.col("hyp_len") == 0, 0.0).when(F.col("hyp_len") >= F.col("ref_len"), 1.0).otherwise(F.exp(1 - F.col("ref_len") / F.col("hyp_len")))
    logs = sum((F.log(F.col(f"match_{n}") / F.col(f"total_{n}")) for n in range(1, most + 1)), F.lit(0.0)) / most
    hit = F.least(*(F.col(f"match_{n}") for n in range(1, most + 1))) if most > 1 else F.col("match_1")
    return sums.withColumn("brevity", brevity).withColumn("bleu", F.when(hit > 0, 100 * F.col("brevity") * F.exp(logs)).otherwise(0.0))


def rouge_n(df: DataFrame, reference: str, hypothesis: str, n: int = 1) -> DataFrame:
    """Adds precision, recall and F1 of n-gram overlap (multisets)."""
    def grams(tokens: Column) -> Column:
        return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1), lambda i: F.array_join(F.slice(tokens, i, n), "\x01"))).otherwise(F.array().cast("array<string>"))

    a, b = grams(words(F.lower(reference))), grams(words(F.lower(hypothesis)))
    out = df.withColumn("_a", a).withColumn("_b", b)
    count = lambda x, g: F.size(F.filter(x, lambda y: y == g))
    common = F.aggregate(F.array_intersect("_a", "_b"), F.lit(0), lambda s, g: s + F.least(count(F.col("_a"), g), count(F.col("_b"), g)))
    out = out.withColumn("_c", common).withColumn("precision", F.coalesce(F.try_divide("_c", F.size("_b")), F.lit(0.0))).withColumn("recall", F.coalesce(F.try_divide("_c", F.size("_a")), F.lit(0.0)))
    return out.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))).drop("_a", "_b", "_c")


def rouge_l(df: DataFrame, reference: str, hypothesis: str) -> DataFrame:
    """Adds precision, recall and F1 of the longest common subsequence of words in small letters, and its length `common`."""
    a, b = words(F.lower(reference)), words(F.lower(hypothesis))
    out = df.withColumn("common", subsequence_lengths(a, b)).withColumns({"precision": F.coalesce(F.try_divide("common", F.size(b)), F.lit(0.0)), "recall": F.coalesce(F.try_divide("common", F.size(a)), F.lit(0.0))})
    return out.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))


def keyword_scores(df: DataFrame, keywords: list[str], reference: str = "text", hypothesis: str = "pred_text") -> DataFrame:
    """Precision, recall and F1 of each keyword or phrase by its counts in reference and hypothesis."""
    words_ = df.sparkSession.createDataFrame([(k,) for k in keywords], "keyword string")
    occur = lambda c: F.size(F.split(F.concat(F.lit(" "), F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", "  "), F.lit(" ")), F.concat(F.lit("\\Q "), F.regexp_replace("keyword", " ", "  "), F.lit(" \\E")))) - 1
    each = df.crossJoin(F.broadcast(words_)).select("keyword", occur(F.col(reference)).alias("r"), occur(F.col(hypothesis)).alias("h"))  # a stated query set
    sums = each.groupBy("keyword").agg(F.sum(F.least("r", "h")).alias("tp"), F.sum("r").alias("gt"), F.sum("h").alias("found"))
    return sums.withColumn("precision", F.coalesce(F.try_divide("tp", "found"), F.lit(0.0))).withColumn("recall", F.coalesce(F.try_divide("tp", "gt"), F.lit(0.0))).withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))


def punctuation_rates(counts: DataFrame, by: list[str], operations_: str = "marks") -> DataFrame:
    """Row counts of each mark summed, as rates over all operations."""
    each = counts.select(*by, F.explode(operations_).alias("m")).select(*by, "m.*").groupBy(*by, "mark").agg(*(F.sum(c).alias(c) for c in ("correct", "deletions", "insertions", "substitutions")))
    total = F.col("correct") + F.col("deletions") + F.col("insertions") + F.col("substitutions")
    return each.withColumns({f"{c}_rate": F.coalesce(F.try_divide(F.col(c), total), F.lit(0.0)) for c in ("correct", "deletions", "insertions", "substitutions")}).withColumn("error_rate", F.coalesce(F.try_divide(total - F.col("correct"), total), F.lit(0.0)))


def assigned(cost: np.ndarray) -> list[int]:
    """Column of each row in a least-cost one-to-one assignment of a square matrix (shortest augmenting paths)."""
    n = len(cost)
    u, v, p = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1, int)
    for i in range(1, n + 1):
        p[0], j0 = i, 0
        least, way, used = np.full(n + 1, np.inf), np.zeros(n + 1, int), np.zeros(n + 1, bool)
        while True:
            used[j0] = True
            i0 = p[j0]
            free = ~used[1:]
            now = cost[i0 - 1] - u[i0] - v[1:]
            better = free & (now < least[1:])
            least[1:][better], way[1:][better] = now[better], j0
            j1 = int(np.argmin(np.where(free, least[1:], np.inf))) + 1
            delta = least[j1]
            u[p[used]] += delta
            v[used] -= delta
            least[1:][free] -= delta
            j0 = j1
            if p[j0] == 0:
                break
        while j0:
            p[j0], j0 = p[way[j0]], way[j0]
    out = [0] * n
    for j in range(1, n + 1):
        out[p[j] - 1] = j - 1
    return out


def _distance(a: list[str], b: list[str]) -> int:
    row = np.arange(len(b) + 1)
    steps = np.arange(len(b) + 1)
    for i, x in enumerate(a, 1):
        differ = np.fromiter((y != x for y in b), np.int64, len(b))
        full = np.concatenate(([i], np.minimum(row[1:] + 1, row[:-1] + differ)))
        row = np.minimum.accumulate(full - steps) + steps
    return int(row[-1])


@F.pandas_udf(StructType([StructField("errors", LongType()), StructField("ref_words", LongType()), StructField("cpwer", DoubleType())]))
def session_errors(reference: pd.Series, hypothesis: pd.Series) -> pd.DataFrame:
    """cpWER of a session: arrays of speaker transcripts, matched one to one for the fewest word errors."""
    rows = []
    for r, h in zip(reference, hypothesis, strict=True):
        a, b = [x.split() for x in (r if r is not None else [])], [x.split() for x in (h if h is not None else [])]
        n = max(len(a), len(b))
        a, b = a + [[]] * (n - len(a)), b + [[]] * (n - len(b))
        cost = np.array([[_distance(x, y) for y in b] for x in a], float) if n else np.zeros((0, 0))
        errors = int(sum(cost[i, j] for i, j in enumerate(assigned(cost)))) if n else 0
        total = sum(map(len, a))
        rows.append((errors, total, errors / total if total else (float("inf") if errors else 0.0)))
    return pd.DataFrame(rows, columns=["errors", "ref_words", "cpwer"])


# diarization


def diarization_errors(reference: pd.DataFrame, system: pd.DataFrame, collar: float = 0.0, skip_overlap: bool = False, regions: list[tuple[float, float]] | None = None) -> tuple[float, float, float, float]:
    """(missed, false alarm, confusion, scored) seconds of one recording's (start, end, speaker) rows.

    No-score collars of +-collar stand around every reference boundary. Speakers
    map one to one by the most time together.
    """
    ref = reference[reference["end"] > reference["start"]]
    sys_ = system[system["end"] > system["start"]]
    if regions is None:
        # all that either side covers
        both = pd.concat([ref, sys_])
        regions = [(both["start"].min(), both["end"].max())] if len(both) else []
    cuts = sorted({*ref["start"], *ref["end"], *sys_["start"], *sys_["end"], *(x for r in regions for x in r), *(x + d for x in (*ref["start"], *ref["end"]) for d in ((-collar, collar) if collar else ()))})
    if len(cuts) < 2:
        return 0.0, 0.0, 0.0, 0.0
    cuts = np.array(cuts)
    mid, size = (cuts[1:] + cuts[:-1]) / 2, np.diff(cuts)
    keep = np.zeros(len(mid), bool)
    for a, z in regions:
        keep |= (mid > a) & (mid < z)
    for b in (*ref["start"], *ref["end"]) if collar else ():
        keep &= ~((mid > b - collar) & (mid < b + collar))

    def active(df: pd.DataFrame) -> tuple[list, np.ndarray]:
        names = sorted(df["speaker"].unique())
        out = np.zeros((len(names), len(mid)), bool)
        for s, a, z in zip(df["speaker"], df["start"], df["end"], strict=True):
            out[names.index(s)] |= (mid > a) & (mid < z)
        return names, out

    r_names, r = active(ref)
    s_names, s = active(sys_)
    if skip_overlap:
        keep &= r.sum(0) < 2
    size = size * keep
    together = (r.astype(float) * size) @ s.T.astype(float) if len(r_names) and len(s_names) else np.zeros((len(r_names), len(s_names)))
    n = max(together.shape)
    square = np.zeros((n, n))
    square[: together.shape[0], : together.shape[1]] = -together
    mapped = np.zeros(len(mid))
    for i, j in enumerate(assigned(square)) if n else ():
        if i < len(r_names) and j < len(s_names) and together[i, j] > 0:
            mapped += r[i] & s[j]
    n_ref, n_sys = r.sum(0), s.sum(0)
    return float((size * np.maximum(n_ref - n_sys, 0)).sum()), float((size * np.maximum(n_sys - n_ref, 0)).sum()), float((size * (np.minimum(n_ref, n_sys) - mapped)).sum()), float((size * n_ref).sum())


#: Collar and overlap rule of the named evaluations.
EVALUATIONS = {"full": (0.0, False), "fair": (0.25, False), "forgiving": (0.25, True)}


def diarization(reference: DataFrame, system: DataFrame, key: str = "file", collar: float = 0.0, skip_overlap: bool = False, uem: DataFrame | None = None) -> DataFrame:
    """(key, missed, false_alarm, confusion, scored, der) for each recording; sum the seconds for a corpus figure."""
    kind = reference.schema[key].dataType.simpleString()
    tagged = reference.select(key, "start", "end", "speaker", F.lit(0).alias("side")).unionByName(system.select(key, "start", "end", "speaker", F.lit(1).alias("side")))
    if uem is not None:
        tagged = tagged.unionByName(uem.select(key, "start", "end", F.lit("").alias("speaker"), F.lit(2).alias("side")))

    def score(k, pdf: pd.DataFrame) -> pd.DataFrame:
        zones = pdf[pdf["side"] == 2]
        found = diarization_errors(pdf[pdf["side"] == 0], pdf[pdf["side"] == 1], collar, skip_overlap, list(zip(zones["start"], zones["end"], strict=True)) or None)
        return pd.DataFrame([(k[0], *found, sum(found[:3]) / found[3] if found[3] else float("nan"))], columns=[key, "missed", "false_alarm", "confusion", "scored", "der"])

    return spread(tagged, key).groupBy(key).applyInPandas(score, f"{key} {kind}, missed double, false_alarm double, confusion double, scored double, der double")


def evaluated(reference: DataFrame, system: DataFrame, key: str = "file") -> DataFrame:
    """All of EVALUATIONS, each with its name."""
    out = None
    for name, (collar, skip) in EVALUATIONS.items():
        part = diarization(reference, system, key, collar, skip).withColumn("evaluation", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


# scores against binary labels


def ranked_auc(df: DataFrame, label: str = "y", score: str = "score", *by: str) -> DataFrame:
    """ROC AUC by summed ranks of tied scores; 0.5 where only one class is there.

    Ties are one row each after the first aggregate; ranks run over those.
    """
    from pyspark.sql import Window

    ties = df.groupBy(*by, score).agg(F.sum(label).alias("pos"), F.count("*").alias("n"))
    w = Window.partitionBy(*by).orderBy(score)
    before = F.sum(F.col("n") - F.col("pos")).over(w) - (F.col("n") - F.col("pos"))
    ranked = ties.withColumn("wins", F.col("pos") * (before + (F.col("n") - F.col("pos")) / 2.0))
    sums = ranked.groupBy(*by).agg(F.sum("wins").alias("wins"), F.sum("pos").alias("p"), F.sum(F.col("n") - F.col("pos")).alias("m"))
    return sums.select(*by, F.when((F.col("p") > 0) & (F.col("m") > 0), F.col("wins") / (F.col("p") * F.col("m"))).otherwise(0.5).alias("auc_roc"))


def average_precision(df: DataFrame, label: str = "y", score: str = "score", *by: str) -> DataFrame:
    """Average precision; 0 without positives. For the inverted figure, invert labels and scores first."""
    from pyspark.sql import Window

    ties = df.groupBy(*by, score).agg(F.sum(label).alias("pos"), F.count("*").alias("n"))
    w = Window.partitionBy(*by).orderBy(F.desc(score))
    upto = ties.withColumn("tp", F.sum("pos").over(w)).withColumn("seen", F.sum("n").over(w))
    sums = upto.groupBy(*by).agg(F.sum(F.col("pos") * F.col("tp") / F.col("seen")).alias("s"), F.sum("pos").alias("p"))
    return sums.select(*by, F.when(F.col("p") > 0, F.col("s") / F.col("p")).otherwise(0.0).alias("auc_pr"))


def normalized_cross_entropy(df: DataFrame, label: str = "y", score: str = "score", *by: str) -> DataFrame:
    """(H(p) - cross entropy) / H(p); -infinity where only one class is there."""
    eps = 2.220446049250313e-16
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    ce = F.avg(-F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1 - p)))
    share = F.avg(F.col(label).cast("double"))
    sums = df.groupBy(*by).agg(ce.alias("ce"), share.alias("q"))
    h = -(F.col("q") * F.log("q") + (1 - F.col("q")) * F.log(1 - F.col("q")))
    return sums.select(*by, F.when((F.col("q") > 0) & (F.col("q") < 1), (h - F.col("ce")) / h).otherwise(float("-inf")).alias("nce"))


def calibration_error(df: DataFrame, bins: int = 100, label: str = "y", score: str = "score", *by: str) -> DataFrame:
    """Expected calibration error over equal bins: each bin's share times |accuracy - middle|."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1))
    each = df.groupBy(*by, b.alias("bin")).agg(F.count("*").alias("n"), F.avg(F.col(label).cast("double")).alias("acc"))
    gap = F.abs(F.col("acc") - (F.col("bin") + 0.5) / bins)
    return each.groupBy(*by).agg((F.sum(F.col("n") * gap) / F.sum("n")).alias("ece"))


def youden_curve(df: DataFrame, thresholds: int = 100, label: str = "y", score: str = "score") -> DataFrame:
    """Mean, deviation and greatest of |tnr - fnr| over n + 1 thresholds, from one histogram of the scores."""
    from pyspark.sql import Window

    cell = F.least(F.greatest(F.ceil(F.col(score) * thresholds), F.lit(0)), F.lit(thresholds + 1)).cast("int")
    hist = df.groupBy(cell.alias("t")).agg(F.sum(F.col(label)).alias("pos"), F.sum(1 - F.col(label)).alias("neg"))
    grid = df.sparkSession.range(thresholds + 2).select(F.col("id").cast("int").alias("t")).join(hist, "t", "left").na.fill(0)
    w = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # thresholds + 2 rows
    below = grid.withColumn("fn", F.coalesce(F.sum("pos").over(w), F.lit(0))).withColumn("tn", F.coalesce(F.sum("neg").over(w), F.lit(0))).withColumn("p", F.sum("pos").over(whole)).withColumn("m", F.sum("neg").over(whole)).filter(F.col("t") <= thresholds)
    y = F.abs(F.coalesce(F.try_divide("tn", "m"), F.lit(0.0)) - F.coalesce(F.try_divide("fn", "p"), F.lit(0.0)))
    return below.agg(F.avg(y).alias("auc_yc"), F.stddev_pop(y).alias("std_yc"), F.max(y).alias("max_yc"))


def confidence(probabilities: Column, measure: str = "max_prob", alpha: float = 1.0, exponential: bool = False) -> Column:
    """Confidence of a distribution (array): max_prob, or gibbs, tsallis or renyi entropy of order alpha, normalised to 0..1 linearly or exponentially."""
    n = F.size(probabilities).cast("double")
    if measure == "max_prob":
        top = F.array_max(probabilities)
        return (top * n - 1) / (n - 1)
    powers = F.aggregate(probabilities, F.lit(0.0), lambda s, p: s + F.pow(p, F.lit(float(alpha))))
    plain = F.aggregate(probabilities, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log(p)).otherwise(0.0))
    if alpha == 1.0 or measure == "gibbs":
        h = plain if alpha == 1.0 else F.aggregate(probabilities, F.lit(0.0), lambda s, p: s - F.when(p > 0, F.pow(p, F.lit(alpha)) * F.log(F.pow(p, F.lit(alpha)))).otherwise(0.0))
        most = F.log(n) if alpha == 1.0 else F.pow(n, F.lit(1 - alpha)) * F.lit(alpha) * F.log(n)
    elif measure == "tsallis":
        h, most = (1 - powers) / (alpha - 1), (1 - F.pow(n, F.lit(1 - alpha))) / (alpha - 1)
    elif measure == "renyi":
        h, most = F.log(powers) / (1 - alpha), F.log(n)
    else:
        raise ValueError(measure)
    return (F.exp(-h) - F.exp(-most)) / (1 - F.exp(-most)) if exponential else 1 - h / most


def aggregated_confidence(values: Column, how: str = "mean") -> Column:
    n = F.size(values)
    total = F.aggregate(values, F.lit(0.0), lambda s, x: s + x)
    product = F.aggregate(values, F.lit(1.0), lambda s, x: s * x)
    return {"mean": total / n, "min": F.array_min(values), "max": F.array_max(values), "prod": product}[how]


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support of each label, then micro, macro and weighted as labels of those names."""
    p = df.select(F.col(label).cast("string").alias("l"), F.col(predicted).cast("string").alias("q"))
    marks = p.select(F.explode(F.array(F.struct(F.col("l").alias("label"), (F.col("l") == F.col("q")).cast("long").alias("tp"), F.lit(1).alias("n"), F.lit(0).alias("m")), F.struct(F.col("q").alias("label"), F.lit(0).cast("long").alias("tp"), F.lit(0).alias("n"), F.lit(1).alias("m")))).alias("x")).select("x.*")
    each = marks.groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("n").alias("support"), F.sum("m").alias("found"))
    z = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    rated = each.withColumn("precision", z(F.col("tp"), F.col("found"))).withColumn("recall", z(F.col("tp"), F.col("support")))
    rated = rated.withColumn("f1", z(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).select("label", "precision", "recall", "f1", "support", "tp", "found")
    cols = ("precision", "recall", "f1")
    macro = rated.agg(*(F.avg(c).alias(c) for c in cols), F.sum("support").alias("support")).withColumn("label", F.lit("macro"))
    weighted = rated.agg(*(z(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in cols), F.sum("support").alias("support")).withColumn("label", F.lit("weighted"))
    micro = rated.agg(z(F.sum("tp"), F.sum("found")).alias("precision"), z(F.sum("tp"), F.sum("support")).alias("recall"), F.sum("support").alias("support")).withColumn("f1", z(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).withColumn("label", F.lit("micro"))
    out = rated.select("label", *cols, "support")
    for extra in (micro, macro, weighted):
        out = out.unionByName(extra.select("label", *cols, "support"))
    return out


def top_k_hits(scores: Column, label: Column, k: int) -> Column:
    """1 if the label (an index) is among the k greatest scores, ties to lower indices."""
    order = F.transform(F.slice(F.array_sort(F.transform(scores, lambda s, i: F.struct((-s).alias("s"), i.alias("i")))), 1, k), lambda x: x["i"])
    return F.array_contains(order, label).cast("int")


def mean_perplexity(distributions: Column) -> Column:
    """Aggregate: the mean over rows of exp(entropy) of their distributions; null when there are none."""
    h = F.aggregate(distributions, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log(p)).otherwise(0.0))
    return F.avg(F.exp(h))


def binary_scores(df: DataFrame, predicted: str, target: str) -> DataFrame:
    """F1, precision and recall of rounded arrays (0.5 rounds to 0) summed over rows; -1 where undefined."""
    pairs = df.select(F.explode(F.arrays_zip(F.col(predicted).alias("p"), F.col(target).alias("t"))).alias("x")).select((F.col("x.p") > 0.5).alias("p"), (F.col("x.t") > 0.5).alias("t"))
    sums = pairs.agg(*(F.count_if(c).alias(n) for n, c in (("tp", F.col("p") & F.col("t")), ("fp", F.col("p") & ~F.col("t")), ("fn", ~F.col("p") & F.col("t")))))
    z = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(-1.0))
    return sums.select(z(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), z(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"), z(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def within_tolerance(target: Column, predicted: Column, token: Column, tolerance: int) -> Column:
    """Share of the target's places of a token that have it in the prediction within +-tolerance; null without any."""
    places = lambda x: F.filter(F.transform(x, lambda t, i: F.when(t == token, i)), lambda i: i.isNotNull())
    a, b = places(target), places(predicted)
    hits = F.size(F.filter(a, lambda i: F.exists(b, lambda j: F.abs(i - j) <= tolerance)))
    return F.when(F.size(a) > 0, hits / F.size(a))


# summaries


def percentiles(df: DataFrame, column: str, wanted: tuple[float, ...] = (0.5, 0.9, 0.95), *by: str) -> DataFrame:
    """Linearly interpolated percentiles, p50 and so on."""
    return df.groupBy(*by).agg(*(F.percentile(column, w).alias(f"p{round(w * 100)}") for w in wanted))


def end_of_utterance_summary(rows: DataFrame) -> DataFrame:
    """Percentiles of latency and early cutoff (0 where there are none), rates of early cutoffs and misses."""
    early = F.col("early_cutoff")
    return rows.agg(*(F.coalesce(F.percentile("latency", p), F.lit(0.0)).alias(f"latency_p{round(p * 100)}") for p in (0.5, 0.9, 0.95)), *(F.coalesce(F.percentile("early_cutoff", p), F.lit(0.0)).alias(f"early_p{round(p * 100)}") for p in (0.5, 0.9, 0.95)), F.avg(early.isNotNull().cast("int")).alias("early_rate"), F.avg(F.col("missed").cast("int")).alias("miss_rate"))


def feature_stats(df: DataFrame, columns: list[str], group: str, mask: str | None = None) -> DataFrame:
    """Mean and sample deviation of nonzero (or masked) values, over all as `default` and for each group."""
    ok = (lambda c: F.when(F.col(mask), F.col(c))) if mask else (lambda c: F.when(F.col(c) != 0, F.col(c)))
    sums = df.rollup(group).agg(F.grouping_id().alias("g"), *(f(ok(c)).alias(f"{c}_{n}") for c in columns for f, n in ((F.avg, "mean"), (F.stddev_samp, "std"))))
    return sums.withColumn(group, F.when(F.col("g") == 1, F.lit("default")).otherwise(F.col(group).cast("string"))).drop("g")


def dense_index(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their place in order, from 0."""
    from pyspark.sql import Window

    distinct = df.select(column).filter(F.col(column).isNotNull()).distinct()
    ranged = distinct.repartitionByRange(F.col(column)).withColumn("p", F.spark_partition_id())
    base = ranged.groupBy("p").agg(F.count("*").alias("n")).withColumn("base", F.sum("n").over(Window.orderBy("p")) - F.col("n")).select("p", "base")  # as many rows as partitions
    return ranged.join(F.broadcast(base), "p").select(column, (F.col("base") + F.row_number().over(Window.partitionBy("p").orderBy(column)) - 1).cast("long").alias("index"))


def vocabulary(df: DataFrame, text: str) -> DataFrame:
    return df.select(F.explode(words(F.col(text))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def word_accuracy(df: DataFrame, reference: str = "text", hypothesis: str = "pred_text") -> DataFrame:
    """For each reference word, the share of its occurrences that its row's hypothesis has too (multisets)."""
    def counts(c: str, n: str) -> DataFrame:
        return df.select("row_id", F.explode(words(F.col(c))).alias("word")).groupBy("row_id", "word").agg(F.count("*").alias(n))

    both = counts(reference, "r").join(counts(hypothesis, "h"), ["row_id", "word"], "left")
    return both.groupBy("word").agg(F.sum("r").alias("n"), (F.sum(F.least("r", F.coalesce("h", F.lit(0)))) / F.sum("r")).alias("accuracy"))


def mann_whitney(a: list[float], b: list[float]) -> tuple[float, float]:
    """(U of a, two-sided p) with the normal approximation, ties corrected."""
    import math

    x = np.array([*a, *b], float)
    order = np.argsort(x, kind="stable")
    ranks = np.empty(len(x))
    ranks[order] = np.arange(1, len(x) + 1)
    _, inverse, counts = np.unique(x, return_inverse=True, return_counts=True)
    ranks = (np.bincount(inverse, ranks) / counts)[inverse]
    n, m = len(a), len(b)
    u = ranks[:n].sum() - n * (n + 1) / 2
    var = n * m / 12 * ((n + m + 1) - (counts**3 - counts).sum() / ((n + m) * (n + m - 1)))
    if var <= 0:
        return float(u), 1.0
    z = (abs(u - n * m / 2) - 0.5) / math.sqrt(var)
    return float(u), min(1.0, math.erfc(max(z, 0.0) / math.sqrt(2)))


def compared(df: DataFrame, bucket: str, benchmark: str, value: str, baseline: str, candidate: str, lower_is_better: bool = True, level: float = 0.05) -> DataFrame:
    """(benchmark, p, winner): baseline, candidate or tie of each benchmark's measurements, which are few."""
    def test(k, pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[pdf[bucket] == baseline][value].tolist(), pdf[pdf[bucket] == candidate][value].tolist()
        if not a or not b:
            return pd.DataFrame([(k[0], float("nan"), "tie")], columns=[benchmark, "p", "winner"])
        u, p = mann_whitney(a, b)
        first = (u < len(a) * len(b) / 2) == lower_is_better
        return pd.DataFrame([(k[0], p, "tie" if p > level or u == len(a) * len(b) / 2 else baseline if first else candidate)], columns=[benchmark, "p", "winner"])

    return df.groupBy(benchmark).applyInPandas(test, f"{benchmark} string, p double, winner string")


def hyperparameters(n_rows: int, mean_chars: float, std_chars: float, max_chars: float, p995_chars: float) -> dict:
    """Fine-tuning settings from the number of rows and the lengths of prompt and completion."""
    #: Rows up to which a tier holds, then batch size, learning rate, hidden size.
    tiers = ((100, 64, 0.005, 1024), (1_000, 128, 0.001, 2048), (10_000, 128, 0.0005, 4096), (float("inf"), 128, 0.0001, 4096))
    batch, lr, hidden = next(t[1:] for t in tiers if n_rows <= t[0])
    longest = int(max(min(mean_chars + 2 * std_chars, max_chars), p995_chars) // 4 + 100)
    return {"max_batch_size": batch, "learning_rate": lr, "hidden_size": hidden, "max_seq_length": longest}


def common_suffix(texts: DataFrame, column: str) -> str:
    """The longest suffix of all rows: that of the least and greatest reversed text."""
    r = F.reverse(F.coalesce(column, F.lit("")))
    low, high = texts.agg(F.min(r), F.max(r)).first()
    if low is None:
        return ""
    n = next((i for i, (x, y) in enumerate(zip(low, high, strict=False)) if x != y), min(len(low), len(high)))
    return low[:n][::-1]


def running_average(values: list[float]) -> list[tuple[float, float]]:
    """(mean so far, greatest so far) after each value."""
    out, total, most = [], 0.0, float("-inf")
    for i, v in enumerate(values, 1):
        total, most = total + v, max(most, v)
        out.append((total / i, most))
    return out


def grid(parameters: dict[str, list]) -> list[dict]:
    """The cartesian product of the lists."""
    out: list[dict] = [{}]
    for name, values in parameters.items():
        out = [o | {name: v} for o in out for v in values]
    return out



def searched_weight(candidates: DataFrame, key: str, weights: list[float], errors: str = "errors", first: str = "score", second: str = "other_score") -> DataFrame:
    """(weight, errors): the errors of each row's best candidate by first + weight * second, summed, for each weight of a short list."""
    aggs = [F.max_by(errors, F.struct((F.col(first) + w * F.col(second)).alias("s"), (-F.col(errors)).alias("e"))).alias(f"e{i}") for i, w in enumerate(weights)]
    sums = candidates.groupBy(key).agg(*aggs).agg(*(F.sum(f"e{i}").alias(f"e{i}") for i in range(len(weights))))
    return sums.select(F.explode(F.array(*(F.struct(F.lit(float(w)).alias("weight"), F.col(f"e{i}").alias("errors")) for i, w in enumerate(weights)))).alias("x")).select("x.*")


def rows_and_hours(df: DataFrame, keys: list[str], duration: str = "duration") -> DataFrame:
    """(keys, examples, hours): what each dataset weighs by its rows and by the seconds in them."""
    return df.groupBy(*keys).agg(F.count("*").alias("examples"), (F.coalesce(F.sum(duration), F.lit(0)) / 3600).alias("hours"))


def kinds_by_split(df: DataFrame, split: str, kind: str) -> DataFrame:
    """(split, kind, n): rows of each kind in each split."""
    return df.groupBy(split, kind).agg(F.count("*").alias("n"))


def common_answers(df: DataFrame, answer: str, top: int = 5) -> DataFrame:
    """(answer, n, percent): the commonest answers of a table with fewer distinct ones than a third of its rows, else none. Equally common ones come in order of their text."""
    counts = df.groupBy(answer).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("distinct"))
    few = counts.orderBy(F.desc("n"), answer).limit(top)
    return few.join(F.broadcast(totals)).filter(F.col("distinct") < F.col("rows") / 3).select(answer, "n", F.round(100 * F.col("n") / F.col("rows"), 0).alias("percent"))
