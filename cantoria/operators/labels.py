"""Labels, frames, preferences and turn-taking: what stands between manifests and models."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# labels of manifest rows


def speech_labels(df: DataFrame, delimiter: str | None = None) -> DataFrame:
    """Adds `labels`: of command, else target, else label, cut at the delimiter or blanks; a row with none raises at run time."""
    there = [F.col(c).cast("string") for c in ("command", "target", "label") if c in df.columns]
    value = F.coalesce(*there, F.raise_error(F.lit("a row has no label")).cast("string"))
    parts = F.split(value, r"\Q" + delimiter + r"\E" if delimiter else r"\s+")
    return df.withColumn("labels", F.filter(F.transform(parts, F.trim), lambda x: x != ""))


def label_index(df: DataFrame, column: str = "labels") -> DataFrame:
    """Distinct labels in order with their index and count."""
    from .scoring import dense_index

    each = df.select(F.explode(column).alias("label"))
    return dense_index(each, "label").join(each.groupBy("label").agg(F.count("*").alias("n")), "label")


def with_enough(df: DataFrame, column: str, least: int) -> DataFrame:
    """Rows whose label at least so many rows have."""
    often = df.groupBy(column).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least).select(column)
    return df.join(often, column, "left_semi")


def relative_speakers(labels: Column) -> Column:
    """Speakers of a sequence as numbers in order of first appearance."""
    order = F.array_distinct(labels)
    return F.transform(labels, lambda x: (F.array_position(order, x) - 1).cast("int"))


# segments and frames


def contiguous(df: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping neighbours meet in the middle of their overlap, from left to right: a start that was moved counts as moved."""
    kinds = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)

    def meet(_key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["start", "end"]).reset_index(drop=True)
        starts, ends = pdf["start"].tolist(), pdf["end"].tolist()
        for i in range(len(starts) - 1):
            if ends[i] > starts[i + 1]:
                middle = (ends[i] + starts[i + 1]) / 2
                ends[i] = starts[i + 1] = middle
        return pdf.assign(start=starts, end=ends)

    return df.groupBy(*keys).applyInPandas(meet, kinds)


def truncated(reference: DataFrame, hypothesis: DataFrame, keys: list[str]) -> DataFrame:
    """The reference up to the last hypothesis end of its key."""
    last = hypothesis.groupBy(*keys).agg(F.max("end").alias("_last"))
    return reference.join(last, keys).filter(F.col("start") < F.col("_last")).withColumn("end", F.least("end", "_last")).drop("_last")


def resampled(labels: Column, n: Column) -> Column:
    """Frame labels stretched or shrunk to n frames: the greatest of those that fall together, repeats where there are too few."""
    size = F.size(labels)
    ratio = F.when(size >= n, F.round(size / n + 0.3).cast("int")).otherwise(F.round(n / size + 0.3).cast("int"))
    shrunk = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(F.array_max(F.slice(labels, F.least(i * ratio, size - 1) + 1, ratio)), F.lit(0)))
    grown = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(labels, F.least(F.floor(i / ratio).cast("int"), size - 1)))
    return F.when((size == 0) | (n <= 0), F.array().cast("array<int>")).when(size >= n, shrunk).otherwise(grown)


def soft_mask(labels: Column, stride: int, threshold: float = 0.5) -> Column:
    """0/1 by the mean of each stride of frames."""
    n = F.ceil(F.size(labels) / stride).cast("int")
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: (mean(F.slice(labels, i * stride + 1, F.lit(stride))) >= threshold).cast("int"))).otherwise(F.array().cast("array<int>"))


def speaker_grid(segments: DataFrame, key: str, frame: float, total: str) -> DataFrame:
    """(key, speaker, labels): one row of frame labels for each speaker, speakers in order of first start."""
    first = segments.groupBy(key, "speaker").agg(F.min("start").alias("first"))
    w = Window.partitionBy(key).orderBy("first", "speaker")
    numbered = first.withColumn("index", F.row_number().over(w) - 1).drop("first")
    from .intervals import frame_labels

    return frame_labels(segments, [key, "speaker"], frame, total).join(numbered, [key, "speaker"])


def lines_of(words: DataFrame, key: str, most: int) -> DataFrame:
    """Words in order re-cut into lines of at most so many characters: (key, line, start, end, text); a longer word is a line."""
    kind = words.schema[key].dataType.simpleString()

    def cut(k, pdf: pd.DataFrame) -> pd.DataFrame:
        rows, now, size = [], [], 0
        for r in pdf.sort_values(["start", "end"]).itertuples():
            if now and size + 1 + len(r.word) > most:
                rows.append(now)
                now, size = [], 0
            size += len(r.word) + (1 if now else 0)
            now.append(r)
        rows += [now] if now else []
        return pd.DataFrame([(k[0], i, x[0].start, x[-1].end, " ".join(r.word for r in x)) for i, x in enumerate(rows)], columns=[key, "line", "start", "end", "text"])

    return words.groupBy(key).applyInPandas(cut, f"{key} {kind}, line int, start double, end double, text string")


def multispeaker_stats(sessions: DataFrame) -> DataFrame:
    """(silence, overlap, speech, total seconds a session) -> pooled means, and population variances of the sessions' ratios."""
    silence, overlap = F.try_divide("silence", "total"), F.try_divide("overlap", "speech")
    return sessions.agg((F.sum("silence") / F.sum("total")).alias("silence_mean"), F.var_pop(silence).alias("silence_var"), (F.sum("overlap") / F.sum("speech")).alias("overlap_mean"), F.var_pop(overlap).alias("overlap_var"))


def chunk_by_chunk(df: DataFrame, keys: list[str], chunk: float, until: float) -> DataFrame:
    """Each segment once for every chunk end at or after its start, clipped to it: what an online score has seen by then.

    As many copies as chunks after a segment, so `until` bounds them: the figure is meant for sessions.
    """
    ends = F.sequence(F.floor(F.col("start") / chunk) + 1, F.lit(math.ceil(until / chunk)).cast("long"))
    return df.withColumn("upto", F.explode(F.transform(ends, lambda i: i * F.lit(float(chunk))))).withColumn("end", F.least("end", "upto"))


# turns


def turn_taking(pairs: DataFrame, tolerance: float) -> DataFrame:
    """(user_end, agent_start) a row, null where missing -> share of agent starts within the tolerance after the user's end, and their mean latency."""
    latency = F.col("agent_start") - F.col("user_end")
    good = F.coalesce((latency >= -tolerance) & (latency <= tolerance), F.lit(False))
    return pairs.agg(F.avg(good.cast("int")).alias("accuracy"), F.avg(F.when(good, latency)).alias("latency"), F.count("*").alias("n"))


def choice_accuracy(df: DataFrame, response: str, key: str) -> DataFrame:
    """Accuracy over all rows: no answer, no extracted choice and no key are all wrong (nothing is guessed)."""
    from ..functions.text import extracted_answer

    return df.agg(F.avg(F.coalesce(extracted_answer(F.col(response)) == F.upper(key), F.lit(False)).cast("int")).alias("accuracy"), F.count("*").alias("n"))


def backchannels(df: DataFrame, text: str, phrases: list[str]) -> DataFrame:
    from ..functions.text import is_backchannel

    return df.withColumn("is_backchannel", F.coalesce(is_backchannel(F.col(text), phrases), F.lit(False)))


# preferences


def chosen_and_rejected(fronts: DataFrame, group: str, chosen: int = 1) -> DataFrame:
    """Best and worst of each group by `place` (see batching.pareto_fronts): pairs where the best is strictly better, with the reward 1 - delta.

    fronts has cer and similarity. A group with a missing figure is left out.
    """
    whole = fronts.groupBy(group).agg(F.count_if(F.col("cer").isNull() | F.col("similarity").isNull()).alias("bad"), F.array_sort(F.collect_list(F.struct("place", "key", "cer", "similarity"))).alias("r")).filter("bad = 0")
    n = F.size("r")
    each = whole.filter(n > 1).select(group, F.posexplode(F.transform(F.sequence(F.lit(0), F.least(F.lit(chosen), F.floor(n / 2).cast("int")) - 1), lambda i: F.struct(F.col("r")[i].alias("best"), F.col("r")[n - 1 - i].alias("worst")))).alias("pair", "p"))
    better = (F.col("p.best.cer") < F.col("p.worst.cer")) & (F.col("p.best.similarity") >= F.col("p.worst.similarity")) | (F.col("p.best.cer") <= F.col("p.worst.cer")) & (F.col("p.best.similarity") > F.col("p.worst.similarity"))
    delta = F.col("p.worst.cer") - F.col("p.best.cer") + F.col("p.best.similarity") - F.col("p.worst.similarity")
    return each.filter(better).select(group, "pair", F.col("p.best.key").alias("chosen"), F.col("p.worst.key").alias("rejected"), (1 - delta).alias("reward"))


def normal_rewards(df: DataFrame, column: str) -> DataFrame:
    """The column's z-score (population deviation) through the normal distribution: a reward in 0..1, high for low values."""
    stats = df.agg(F.avg(column).alias("_mu"), F.stddev_pop(column).alias("_sd"))
    z = F.coalesce(F.try_divide(F.col(column) - F.col("_mu"), F.col("_sd")), F.lit(0.0))
    # the distribution by a fixed rational approximation of the error function, good to 1.5e-7
    t = 1 / (1 + 0.3275911 * F.abs(z) / math.sqrt(2))
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf = 1 - poly * F.exp(-z * z / 2)
    cdf = 0.5 * (1 + F.when(z < 0, -erf).otherwise(erf))
    return df.crossJoin(F.broadcast(stats)).withColumn("reward", 1 - cdf).drop("_mu", "_sd")  # one row


# contracts


def checked(df: DataFrame, contract: dict[str, str], optional: tuple[str, ...] = ()) -> DataFrame:
    """The DataFrame, if it has the contract's columns and types (a wider number is accepted for a narrower one); else TypeError."""
    wider = {"int": ("bigint", "double"), "bigint": ("double",), "float": ("double",)}
    have = dict(df.dtypes)
    for name, kind in contract.items():
        if name not in have:
            if name not in optional:
                raise TypeError(f"no column {name}")
        elif have[name] != kind and kind not in wider.get(have[name], ()):
            raise TypeError(f"{name} is {have[name]}, not {kind}")
    return df


METRICS: dict[str, object] = {}


def metric(name: str):
    """Registers a function (DataFrame) -> DataFrame as a metric."""

    def register(f):
        METRICS[name] = f
        return f

    return register


def routed(df: DataFrame, plan: list[tuple[str, str]]) -> dict[str, DataFrame]:
    """Metrics by name over the rows that meet a constraint each: (name, constraint)."""
    from .filters import constraint

    return {name: METRICS[name](df.filter(constraint(where, df.columns)) if where else df) for name, where in plan}


@metric("wer")
def _wer(df: DataFrame) -> DataFrame:
    from .scoring import corpus

    return corpus(df)


@metric("exact")
def _exact(df: DataFrame) -> DataFrame:
    from .scoring import exact_matches

    return exact_matches(df, "text", "pred_text")
