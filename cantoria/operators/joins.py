"""Keyed, range and nearest joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_of_each(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """The row of the greatest `order` of each key."""
    return df.groupBy(*key).agg(F.max_by(F.struct("*"), order).alias("row")).select("row.*")


def merged(left: DataFrame, right: DataFrame, key: str, order: str, names: tuple[str, str] = ("1", "2")) -> DataFrame:
    """Inner join of two manifests; of right rows with one key the last by `order` counts. Shared columns get the names as suffixes."""
    right = last_of_each(right, [key], order)
    shared = [c for c in left.columns if c in right.columns and c != key]
    return left.withColumnsRenamed({c: f"{c}_{names[0]}" for c in shared}).join(right.withColumnsRenamed({c: f"{c}_{names[1]}" for c in shared}), key)


def with_predictions(manifest: DataFrame, predictions: DataFrame, key: list[str], text: str = "text", prediction: str = "pred_text") -> DataFrame:
    """Left join; where there is a prediction it becomes the text and the text orig_text."""
    joined = manifest.join(predictions.select(*key, prediction), key, "left")
    had = F.col(prediction).isNotNull()
    return joined.withColumn("orig_text", F.when(had, F.col(text))).withColumn(text, F.coalesce(prediction, text)).drop(prediction)


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that stand more than once, for those who must refuse them."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Do two ranges overlap? Touching isn't overlap."""
    return (a_start < b_end) & (b_start < a_end)


def clipped(targets: DataFrame, sources: DataFrame, keys: list[str], width: float) -> DataFrame:
    """Overlap join of (keys, start, end) targets with sources, clipped to both: target_start, target_end, start, end.

    Ranges meet by the cells of `width` that they touch, so the join is an
    equi-join; a pair counts in the cell where its overlap starts.
    """
    def cells(df: DataFrame, s: str, e: str) -> DataFrame:
        return df.withColumn("cell", F.explode(F.sequence(F.floor(F.col(s) / width), F.floor(F.col(e) / width))))

    t = cells(targets.filter("end > start").select(*keys, F.col("start").alias("target_start"), F.col("end").alias("target_end")), "target_start", "target_end")
    s = cells(sources.filter("end > start"), "start", "end")
    met = t.join(s, [*keys, "cell"]).filter(overlap(F.col("target_start"), F.col("target_end"), F.col("start"), F.col("end")))
    met = met.withColumn("start", F.greatest("start", "target_start")).withColumn("end", F.least("end", "target_end"))
    return met.filter(F.floor(F.col("start") / width) == F.col("cell")).drop("cell")


def within(segments: DataFrame, start_after: float, end_before: float, rebase: bool = False, tolerance: float = 0.001) -> DataFrame:
    """Segments inside a window, up to a tolerance; rebase counts time from the window's start."""
    kept = segments.filter((F.col("start") >= start_after - tolerance) & (F.col("end") <= end_before + tolerance))
    return kept.withColumn("start", F.col("start") - start_after).withColumn("end", F.col("end") - start_after) if rebase else kept


def as_of(left: DataFrame, right: DataFrame, keys: list[str], at: str, value: list[str]) -> DataFrame:
    """Each left row with the values of the latest right row at or before it, by one shuffle: both sides in one ordered window."""
    mark = F.struct(*value)
    both = left.select("*", F.lit(None).cast(right.select(mark.alias("v")).schema["v"].dataType).alias("v"), F.lit(1).alias("side")).unionByName(right.select(*keys, F.col(at), mark.alias("v"), F.lit(0).alias("side")), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(at, "side").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("v", F.last("v", ignorenulls=True).over(w)).filter("side = 1").drop("side")
    return found.select(*left.columns, *(F.col("v").getField(c).alias(c) for c in value))


def nearest(left: DataFrame, right: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """Each left row with the value of the right row whose `at` is nearest, the earlier one at ties."""
    before = as_of(left, right.withColumn("at_before", F.col(at)), keys, at, [value, "at_before"]).withColumnRenamed(value, "v_before")
    flipped = as_of(before.withColumn(at, -F.col(at)), right.withColumn("at_after", F.col(at)).withColumn(at, -F.col(at)), keys, at, [value, "at_after"]).withColumn(at, -F.col(at))
    first = F.col("at_after").isNull() | (F.col(at) - F.col("at_before") <= F.col("at_after") - F.col(at))
    return flipped.select(*left.columns, F.when(first & F.col("at_before").isNotNull(), F.col("v_before")).otherwise(F.col(value)).alias(value))


def words_to_turns(words: DataFrame, turns: DataFrame, keys: list[str], anchor: str = "start", offset: float = 0.0) -> DataFrame:
    """Each word with the speaker of the turn that holds its anchor (start, mid or end, plus an offset), else of the last turn begun before it, else of the first.

    Words find their turns by time, however long a gap is.
    """
    at = {"start": F.col("start"), "end": F.col("end"), "mid": (F.col("start") + F.col("end")) / 2}[anchor] + offset
    begun = turns.groupBy(*keys, F.col("start").alias("_at")).agg(F.max_by("speaker", F.struct("end", "speaker")).alias("speaker"))
    found = as_of(words.withColumn("_at", at), begun, keys, "_at", ["speaker"])
    first = turns.groupBy(*keys).agg(F.min_by("speaker", F.struct("start", "end", "speaker")).alias("_first"))
    return found.join(first, keys, "left").withColumn("speaker", F.coalesce("speaker", "_first")).drop("_at", "_first")


def pairs_of(df: DataFrame, keys: list[str], member: str) -> DataFrame:
    """All 2-combinations of a key's distinct members, as member_a < member_b; members are as few as speakers of a session."""
    sets = df.groupBy(*keys).agg(F.array_sort(F.collect_set(member)).alias("m"))
    each = sets.select(*keys, "m", F.posexplode("m").alias("i", f"{member}_a"))
    return each.select(*keys, f"{member}_a", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias(f"{member}_b"))


def looked_up(words: DataFrame, lexicon: DataFrame, word: str, entry: str) -> DataFrame:
    """Left join of words with a lexicon; a word of several entries is ambiguous and keeps its letters, as does one of none."""
    one = lexicon.groupBy(word).agg(F.count_distinct(entry).alias("n"), F.min(entry).alias(entry)).filter("n = 1").drop("n")
    return words.join(one, word, "left").withColumn(entry, F.coalesce(entry, word))


def matched_ends(predicted: DataFrame, reference: DataFrame, keys: list[str], collar: float) -> DataFrame:
    """Predicted against reference utterance ends in order of time: tp, fp, fn, early (before the collar), missing, for each key."""
    import pandas as pd

    def match(key, p: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        ps = sorted(p["end"].tolist()) if len(p) else []
        rs = sorted(zip(r["ref_start"].tolist(), r["ref_end"].tolist(), strict=True)) if len(r) else []
        i = tp = fp = early = missing = 0
        for start, end in rs:
            while i < len(ps) and ps[i] < start:
                fp, i = fp + 1, i + 1
            if i < len(ps) and ps[i] < end - collar:
                early, i = early + 1, i + 1
                while i < len(ps) and ps[i] < end - collar:
                    fp, i = fp + 1, i + 1
                continue
            if i < len(ps) and ps[i] <= end + collar:
                tp, i = tp + 1, i + 1
            else:
                missing += 1
        fp += len(ps) - i
        return pd.DataFrame([(*key, tp, fp, early + missing, early, missing)], columns=[*keys, "tp", "fp", "fn", "early", "missing"])

    kinds = ", ".join(f"{k} {predicted.schema[k].dataType.simpleString()}" for k in keys)
    # names of their own: with both sides from one table, columns of one name would be lost on the right
    named = reference.select(*(F.col(k).alias(f"ref_{k}") for k in (*keys, "start", "end")))
    return predicted.groupBy(*keys).cogroup(named.groupBy(*(f"ref_{k}" for k in keys))).applyInPandas(match, f"{kinds}, tp long, fp long, fn long, early long, missing long")


def field_presence(df: DataFrame, field: str) -> DataFrame:
    """(in_any, in_all): one row, whether some row and whether every row has the field; a null is a missing field, a table without rows has it everywhere and nowhere."""
    return df.agg((F.count(field) > 0).alias("in_any"), (F.count(field) == F.count("*")).alias("in_all"))
