"""Record-level dedup, capped acceptance, leakage and quality gates of generated data."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_of_each(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The row of least `order` for each key; partial aggregation, no window. Columns that nobody reads are not exchanged."""
    first = [F.min_by(F.col(f"`{c}`"), F.col(f"`{order}`")).alias(c) for c in df.columns]
    return df.groupBy(key.alias("_dedup_key")).agg(*first).drop("_dedup_key")


def distinct_rows(df: DataFrame, order: str) -> DataFrame:
    """Rows equal in all but `order` once, the first kept."""
    rest = [c for c in df.columns if c != order]
    return df.groupBy(*rest).agg(F.min(order).alias(order)).select(df.columns)


def repeated(df: DataFrame, order: str) -> DataFrame:
    """The places of rows that an earlier row equals."""
    rest = [c for c in df.columns if c != order]
    w = Window.partitionBy(*rest).orderBy(order)
    return df.withColumn("r", F.row_number().over(w)).filter("r > 1").select(order)


def unfinished(manifest: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return manifest.join(done.select(key).distinct(), key, "left_anti")


def duplicate_rates(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """One row: for each named key the share of rows beyond the first of it, sum(c - 1) / n."""
    parts = None
    for name, key in keys.items():
        rate = df.groupBy(key.alias("k")).agg(F.count("*").alias("c")).agg((F.sum(F.col("c") - 1) / F.sum("c")).alias("rate")).select(F.lit(name).alias("level"), "rate")
        parts = rate if parts is None else parts.unionByName(rate)
    return parts


def leakage(df: DataFrame, entity: str, split: str = "split") -> DataFrame:
    """Entities that stand in more than one split, with those splits."""
    return df.groupBy(entity).agg(F.array_sort(F.collect_set(split)).alias("splits")).filter(F.size("splits") > 1)


def weighted_leakage(leaked: DataFrame, entities: DataFrame, kind: str, weights: dict[str, float]) -> DataFrame:
    """One row: leaked over all distinct entities, each type by its weight."""
    w = F.coalesce(F.create_map(*(F.lit(x) for kv in weights.items() for x in kv))[F.col(kind)], F.lit(1.0))
    return entities.agg(F.sum(w).alias("total")).crossJoin(leaked.agg(F.coalesce(F.sum(w), F.lit(0.0)).alias("leaked"))).select((F.col("leaked") / F.col("total")).alias("ratio"))


def entity_coverage(df: DataFrame, kind: str, canonical: Column) -> DataFrame:
    return df.groupBy(kind).agg(F.count_distinct(canonical).alias("entities"))


def alternatives_flattened(df: DataFrame, text: str, alternatives: str) -> DataFrame:
    """A row for the text and one for each alternative; place 0 is the text."""
    every = F.concat(F.array(F.col(text)), F.coalesce(alternatives, F.array().cast("array<string>")))
    return df.select(*(c for c in df.columns if c not in (text, alternatives)), F.posexplode(every).alias("place", text))


def accepted(df: DataFrame, order: str, caps: dict[str, int], once: list[str], group: list[str], slots: int = 1) -> DataFrame:
    """Rows accepted in order: each column of `once` at most once, each column of `caps` at most its number of times.

    Acceptance of a row depends on all accepted before it, so it is a fold over
    ordered rows. Keys are counted within `group`; groups are independent and
    stream through their tasks in order, with the keys seen as the only state.
    """
    kinds = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)

    def fold(parts):
        now, seen, counts = None, {c: set() for c in once}, {c: {} for c in caps}
        for pdf in parts:
            keep = []
            for row in pdf.to_dict("records"):
                here = tuple(row[g] for g in group)
                if here != now:
                    now, seen, counts = here, {c: set() for c in once}, {c: {} for c in caps}
                ok = all(row[c] not in seen[c] for c in once) and all(counts[c].get(row[c], 0) < n for c, n in caps.items())
                if ok:
                    for c in once:
                        seen[c].add(row[c])
                    for c in caps:
                        counts[c][row[c]] = counts[c].get(row[c], 0) + 1
                keep.append(ok)
            yield pdf[pd.Series(keep, index=pdf.index, dtype=bool)]

    return df.repartition(*group).sortWithinPartitions(*group, order).mapInPandas(fold, kinds)


def difficulty_shares(df: DataFrame, words: Column, entities: Column, rare: Column, long_words: int = 18, many: int = 3) -> DataFrame:
    """One row: shares of long, entity-heavy and long-tail rows."""
    share = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("int"))
    return df.agg(share(words >= long_words).alias("long"), share(entities >= many).alias("entity_heavy"), share(rare).alias("long_tail"))


#: Rule -> (summary field, comparison, threshold); hard rules fail the gate, the others warn.
HARD_RULES = {
    "enough_rows": ("n_rows", ">=", 1000),
    "exact_duplicates": ("exact_dup_rate", "<=", 0.0),
    "normalized_duplicates": ("normalized_dup_rate", "<=", 0.01),
    "numeric_skeleton_duplicates": ("numeric_dup_rate", "<=", 0.3),
    "leakage": ("leakage_ratio", "<=", 0.0),
    "unique": ("unique_ratio", ">=", 0.95),
}
WARNINGS = {"template_share": ("top_template_share", "<=", 0.05), "long_rows": ("long_share", ">=", 0.05)}


def gate(summary: dict, hard: dict = HARD_RULES, warnings: dict = WARNINGS) -> dict:
    """passed, and the failed hard rules and warnings with their values; a missing field fails its rule."""

    def failed(rules: dict) -> dict:
        out = {}
        for name, (field, how, limit) in rules.items():
            x = summary.get(field)
            if x is None or not (x >= limit if how == ">=" else x <= limit):
                out[name] = x
        return out

    bad = failed(hard)
    return {"passed": not bad, "failed": bad, "warnings": failed(warnings)}


def deficits(df: DataFrame, kind: str, targets: dict[str, int]) -> DataFrame:
    """(kind, have, want, missing) where fewer rows are there than wanted, the largest first."""
    want = df.sparkSession.createDataFrame(list(targets.items()), f"{kind} string, want long")
    have = df.groupBy(kind).agg(F.count("*").alias("have"))
    return want.join(have, kind, "left").withColumn("have", F.coalesce("have", F.lit(0))).withColumn("missing", F.col("want") - F.col("have")).filter("missing > 0").orderBy(F.desc("missing"), kind)
