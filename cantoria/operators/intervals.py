"""Interval algebra and segmentation over (keys, start, end) rows.

Unions, gaps and runs are window functions over one shuffle by key. A key's
rows pass a task in order; only the hysteresis and alignment folds hold a key's
frames in memory, and those are one recording's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union(df: DataFrame, keys: list[str], touching: bool = True) -> DataFrame:
    """Merged intervals by a running maximum of ends; touching ones merge, unless told otherwise."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    apart = (F.col("start") > reach) if touching else (F.col("start") >= reach)
    marked = df.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("island", F.sum("new").over(w))
    return marked.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def union_scaled(df: DataFrame, keys: list[str], decimals: int = 5, margin: int = 2) -> DataFrame:
    """Union over integers of 10**-decimals whose starts are moved by a margin, so that touching ranges stay apart; empty ranges go."""
    unit = 10**decimals
    whole = df.filter("end > start").select(*keys, (F.round(F.col("start") * unit).cast("long") + margin).alias("start"), F.round(F.col("end") * unit).cast("long").alias("end"))
    return union(whole, keys).select(*keys, ((F.col("start") - margin) / unit).alias("start"), (F.col("end") / unit).alias("end"))


def merged_neighbours(df: DataFrame, keys: list[str]) -> DataFrame:
    """Sorted segments merge with the one before if it ends at or after their start; only neighbours are compared."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    marked = df.withColumn("new", F.coalesce(F.lag("end").over(w) < F.col("start"), F.lit(True)).cast("int")).withColumn("island", F.sum("new").over(w))
    return marked.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max_by("end", F.struct("start", "end")).alias("end")).drop("island")


def joined_stamps(df: DataFrame, keys: list[str], speaker: str = "speaker") -> DataFrame:
    """Neighbours of one speaker become one segment where the first ends as the next starts."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    same = (F.lag(speaker).over(w) == F.col(speaker)) & (F.lag("end").over(w) == F.col("start"))
    marked = df.withColumn("new", (~F.coalesce(same, F.lit(False))).cast("int")).withColumn("run", F.sum("new").over(w))
    return marked.groupBy(*keys, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.first(speaker).alias(speaker)).drop("run")


def gaps(df: DataFrame, keys: list[str]) -> DataFrame:
    """Gaps between sorted neighbours."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    return df.select(*keys, F.lag("end").over(w).alias("start"), F.col("start").alias("end")).filter("start < end")


def nonspeech(df: DataFrame, keys: list[str], total: str) -> DataFrame:
    """The gap before each segment and after the last, up to the duration in column `total`."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    before = df.select(*keys, F.coalesce(F.lag("end").over(w), F.lit(0.0)).alias("start"), F.col("start").alias("end"))
    after = df.groupBy(*keys).agg(F.max("end").alias("start"), F.max(total).alias("end"))
    return before.unionByName(after.filter("start < end"))


def overlaps(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row [start, min(running end, end)] for each segment that starts before, or as, the ones so far end."""
    w = Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("end").over(w)
    return df.withColumn("reach", reach).filter("start <= reach").select(*keys, "start", F.least("reach", "end").alias("end"))


def long_enough(df: DataFrame, least: float) -> DataFrame:
    return df.filter(F.col("end") - F.col("start") >= least)


def filled(df: DataFrame, keys: list[str], least_off: float) -> DataFrame:
    """Segments joined over gaps shorter than least_off."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    marked = df.withColumn("new", F.coalesce(F.col("start") - F.lag("end").over(w) >= least_off, F.lit(True)).cast("int")).withColumn("island", F.sum("new").over(w))
    return marked.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def cleaned(df: DataFrame, keys: list[str], least_on: float, least_off: float, speech_first: bool = True) -> DataFrame:
    """Short speech dropped and short gaps filled, in either order."""
    return filled(long_enough(df, least_on), keys, least_off) if speech_first else long_enough(filled(df, keys, least_off), least_on)


def without(df: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that aren't exactly in the other table."""
    return df.join(gone.select(*keys, "start", "end").distinct(), [*keys, "start", "end"], "left_anti")


def sliding(start: Column, duration: Column, window: float, shift: float, least: float = 0.0, decimals: int = 5) -> Column:
    """array<struct<start,duration>>: windows over a segment; the last ones are shortened, those not longer than `least` go."""
    n = F.when(duration <= window, 1).otherwise(F.ceil((duration - window) / shift) + 1).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.round(start + i * shift, decimals).alias("start"), F.round(F.least(F.lit(window), duration - i * shift), decimals).alias("duration")))
    return F.filter(pieces, lambda p: p["duration"] > least)


def fixed_windows(tokens: Column, size: int) -> Column:
    """array<array>: consecutive windows of `size` elements, the last one shorter."""
    n = F.ceil(F.size(tokens) / size).cast("int")
    return F.when(F.size(tokens) > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(tokens, i * size + 1, F.lit(size)))).otherwise(F.array())


def speech_segments(frames: DataFrame, keys: list[str], frame: float) -> DataFrame:
    """(keys, frame_idx, label 0/1) -> runs of ones; a run's end is the start of its last frame."""
    w = Window.partitionBy(*keys).orderBy("frame_idx")
    ones = frames.filter("label = 1").withColumn("run", F.col("frame_idx") - F.row_number().over(w))
    return ones.groupBy(*keys, "run").agg((F.min("frame_idx") * frame).alias("start"), (F.max("frame_idx") * frame).alias("end")).drop("run")


def frame_labels(segments: DataFrame, keys: list[str], frame: float, total: str) -> DataFrame:
    """Segments -> (keys, labels array<int>) on a grid over the duration in column `total`; both ends count in."""
    spans = segments.groupBy(*keys).agg(F.collect_list(F.struct(F.round(F.col("start") / frame).cast("int").alias("a"), F.round(F.col("end") / frame).cast("int").alias("z"))).alias("s"), F.max(total).alias("total"))
    grid = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("total") / frame).cast("int") - 1, F.lit(0)))
    return spans.select(*keys, F.transform(grid, lambda i: F.exists("s", lambda x: (x["a"] <= i) & (i <= x["z"])).cast("int")).alias("labels"))


def smoothed(windows: DataFrame, keys: list[str], median: bool = False) -> DataFrame:
    """Overlapping window predictions (keys, start_frame, probs) -> mean or median of each frame; frames without any take the one before."""
    each = windows.select(*keys, "start_frame", F.posexplode("probs").alias("i", "p")).withColumn("frame_idx", F.col("start_frame") + F.col("i"))
    return each.groupBy(*keys, "frame_idx").agg((F.percentile("p", 0.5) if median else F.avg("p")).alias("p"))


def hysteresis(frames: DataFrame, keys: list[str], frame: float, onset: float, offset: float, pad_onset: float = 0.0, pad_offset: float = 0.0) -> DataFrame:
    """(keys, frame_idx, p) -> segments: speech starts where p > onset and stops where p < offset; pads, then merges what overlaps."""
    w = Window.partitionBy(*keys).orderBy("frame_idx")
    # what decided last: crossing either threshold; in between the state stays
    decided = F.last(F.when(F.col("p") > onset, 1).when(F.col("p") < offset, 0), ignorenulls=True).over(w)
    on = frames.withColumn("on", F.coalesce(decided, F.lit(0))).filter("on = 1")
    runs = on.withColumn("run", F.col("frame_idx") - F.row_number().over(w)).groupBy(*keys, "run").agg(F.min("frame_idx").alias("a"), F.max("frame_idx").alias("z"))
    padded = runs.select(*keys, F.greatest(F.col("a") * frame - pad_onset, F.lit(0.0)).alias("start"), ((F.col("z") + 1) * frame + pad_offset).alias("end"))
    return union(padded.filter("end > start"), keys)


def scaled_thresholds(frames: DataFrame, keys: list[str], onset: float, offset: float, scale: str = "absolute") -> DataFrame:
    """(keys, onset, offset) as they are, or scaled to each key's least and greatest, or 1st and 99th nearest-rank, probability."""
    if scale == "absolute":
        low, high = F.lit(0.0), F.lit(1.0)
    elif scale == "relative":
        low, high = F.min("p"), F.max("p")
    elif scale == "percentile":
        low, high = nearest_rank("p", 1), nearest_rank("p", 99)
    else:
        raise ValueError(scale)
    ends = frames.groupBy(*keys).agg(low.alias("low"), high.alias("high"))
    return ends.select(*keys, (F.col("low") + onset * (F.col("high") - F.col("low"))).alias("onset"), (F.col("low") + offset * (F.col("high") - F.col("low"))).alias("offset"))


def nearest_rank(column: str, percent: float) -> Column:
    """Aggregate: the value at rank ceil(n * percent / 100)."""
    ordered = F.array_sort(F.collect_list(column))
    return F.element_at(ordered, F.greatest(F.ceil(F.size(ordered) * percent / 100), F.lit(1)).cast("int"))


def sessions(events: DataFrame, keys: list[str], at: str, gap_seconds: float) -> DataFrame:
    """Events in sessions that a gap of more than so many seconds ends: keys, session, start, end, n."""
    w = Window.partitionBy(*keys).orderBy(at)
    seconds = F.col(at).cast("timestamp").cast("double")
    marked = events.withColumn("new", F.coalesce(seconds - F.lag(seconds).over(w) > gap_seconds, F.lit(True)).cast("int")).withColumn("session", F.sum("new").over(w))
    return marked.groupBy(*keys, "session").agg(F.min(at).alias("start"), F.max(at).alias("end"), F.count("*").alias("n"))


def stitched(df: DataFrame, file: str, order: str, text: str) -> DataFrame:
    """Texts of consecutive rows of one file joined by blanks, with the segments; a file that comes again later makes another row.

    `order` is the place in the manifest: an integer without gaps, so that a run is known from rows of its file alone.
    """
    w = Window.partitionBy(file).orderBy(order)
    runs = df.withColumn("run", F.col(order) - F.row_number().over(w))
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"), "start", "end")))
    return runs.groupBy(file, "run").agg(rows.alias("r")).select(file, F.element_at("r", 1)["o"].alias("first"), F.array_join(F.transform("r", lambda x: x["t"]), " ").alias(text), F.transform("r", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("segments"))


def chunked_segments(df: DataFrame, chunk: float, words: str = "words") -> DataFrame:
    """Segments split over fixed chunks; the words go with the first piece."""
    last = F.floor(F.col("end") / chunk)
    each = df.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("start") / chunk), last)))
    first = F.col("chunk") == F.floor(F.col("start") / chunk)
    return each.withColumn(words, F.when(first, F.col(words)).otherwise("")).withColumn("start", F.greatest("start", F.col("chunk") * chunk)).withColumn("end", F.least("end", (F.col("chunk") + 1) * chunk))


def speaker_sentences(words: DataFrame, session: str = "session_id", speaker: str = "speaker") -> DataFrame:
    """Words in time order -> a row for each run of one speaker: start, end, text."""
    w = Window.partitionBy(session).orderBy("start", "end")
    marked = words.withColumn("new", (~F.coalesce(F.lag(speaker).over(w) == F.col(speaker), F.lit(False))).cast("int")).withColumn("turn", F.sum("new").over(w))
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "end", "word"))), lambda x: x["word"]), " ")
    return marked.groupBy(session, "turn", speaker).agg(F.min("start").alias("start"), F.max("end").alias("end"), said.alias("text"))


def speaker_transcripts(words: DataFrame, session: str = "session_id", speaker: str = "speaker") -> DataFrame:
    """One transcript for each speaker and a mixed one in time order (speaker null)."""
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "end", "word"))), lambda x: x["word"]), " ")
    return words.rollup(session, speaker).agg(F.grouping_id().alias("g"), said.alias("text")).filter("g < 3").drop("g")


def utterances_by_gap(words: DataFrame, keys: list[str], gap: float | None = None, delimiters: tuple[str, ...] = (".", "?", "!")) -> DataFrame:
    """Words -> segments that end at a delimiter or before a gap."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    before = F.lag("word").over(w)
    new = before.isNull() | (F.substring(before, -1, 1).isin(*delimiters) if delimiters else F.lit(False))
    if gap is not None:
        new = new | (F.col("start") - F.lag("end").over(w) >= gap)
    marked = words.withColumn("segment", F.sum(new.cast("int")).over(w))
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "end", "word"))), lambda x: x["word"]), " ")
    return marked.groupBy(*keys, "segment").agg(F.min("start").alias("start"), F.max("end").alias("end"), said.alias("text"))


def words_of_tokens(tokens: DataFrame, keys: list[str], mark: str = "▁") -> DataFrame:
    """Tokens with times -> words: a token that begins with the mark starts one; punctuation joins the word before."""
    w = Window.partitionBy(*keys).orderBy("place")
    starts = F.col("token").startswith(mark) & ~F.col("token").rlike(rf"^{mark}?[.,!?;:]$")
    numbered = tokens.withColumn("word_id", F.sum((starts | (F.row_number().over(w) == 1)).cast("int")).over(w))
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "token"))), lambda x: F.regexp_replace(x["token"], mark, "")), "")
    return numbered.groupBy(*keys, "word_id").agg(F.min("start").alias("start"), F.max("end").alias("end"), said.alias("word"))


def in_seconds(df: DataFrame, subsampling: int, stride: float, *columns: str) -> DataFrame:
    """Frame offsets as seconds."""
    return df.withColumns({c: F.round(F.col(c) * subsampling * stride, 2) for c in columns})
