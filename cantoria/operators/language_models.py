"""Back-off language models as tables: (order, log10p, ngram, backoff), a row for each n-gram, as an ARPA file has them.

A level's n-grams meet their histories and suffixes by joins on text, so that a
model is never in one place. What a model says of an n-gram it doesn't have is
found by as many joins as its order: at each step the grams not found yet take
their history's back-off weight and lose their first word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, written

BEGIN, END, UNKNOWN = "<s>", "</s>", "<unk>"
#: log10 of nothing, as ARPA files write it.
NEVER = -99.0
#: A history that leaves less than this to what it hasn't seen leaves nothing.
LEAST = 1e-12


def _n(gram: Column) -> Column:
    return F.size(F.split(gram, " "))


def _history(gram: Column) -> Column:
    """All words but the last; of one word, the empty text."""
    return gram.substr(F.lit(1), F.greatest(F.length(gram) - F.length(_word(gram)) - 1, F.lit(0)))


def _word(gram: Column) -> Column:
    return F.substring_index(gram, " ", -1)


def _suffix(gram: Column) -> Column:
    """All words but the first; of one word, the empty text."""
    return F.when(F.instr(gram, " ") > 0, gram.substr(F.instr(gram, " ") + 1, F.length(gram))).otherwise("")


def _own(model: DataFrame) -> Column:
    return F.when(model["log10p"] > NEVER, F.pow(F.lit(10.0), model["log10p"])).otherwise(0.0)


def scored(model: DataFrame, grams: DataFrame, order: int) -> DataFrame:
    """Distinct `ngram`s -> (ngram, p): what the model says of the last word after the others; 0 for words it doesn't have."""
    known = model.select("order", F.col("ngram").alias("have"), _own(model).alias("own"))
    weights = model.filter(F.col("backoff").isNotNull()).select(F.col("ngram").alias("history"), F.pow(F.lit(10.0), F.col("backoff")).alias("weight"))
    open_ = grams.select("ngram").distinct().withColumns({"left": F.col("ngram"), "times": F.lit(1.0), "p": F.lit(None).cast("double")})
    for n in range(order, 0, -1):
        found = open_.join(known.filter(F.col("order") <= n).drop("order"), (F.col("left") == F.col("have")) & F.col("p").isNull(), "left").drop("have")
        found = found.withColumn("p", F.coalesce("p", F.col("times") * F.col("own"))).drop("own")
        if n == 1:
            return found.select("ngram", F.coalesce("p", F.lit(0.0)).alias("p"))
        longer = F.col("p").isNull() & (_n(F.col("left")) == n)
        # what is found meets nothing, by keys of its own: nulls would all go to one task
        open_ = found.withColumn("h", F.when(longer, _history(F.col("left"))).otherwise(F.concat(F.lit(" "), "ngram"))).join(weights, F.col("h") == F.col("history"), "left")
        open_ = open_.select("ngram", F.when(longer, _suffix(F.col("left"))).otherwise(F.col("left")).alias("left"), F.when(longer, F.col("times") * F.coalesce("weight", F.lit(1.0))).otherwise(F.col("times")).alias("times"), "p")
    raise ValueError("the order must be 1 at least")


def _with_backoff(levels: dict[int, DataFrame]) -> DataFrame:
    """(ngram, p) of each order -> the model: each history's weight is what it leaves over what the shorter one leaves of the same words."""
    model = None
    top = max(levels)
    for n in range(1, top + 1):
        own = written(levels[n].select("ngram", "p"))
        log = F.when(F.col("p") > 0, F.log10("p")).otherwise(NEVER)
        if n > 1:
            # what the levels below say of the same words without the first one
            lower = scored(model, own.select(_suffix(F.col("ngram")).alias("ngram")), n - 1).withColumnsRenamed({"ngram": "suffix", "p": "lower"})
            left = own.withColumn("suffix", _suffix(F.col("ngram"))).join(lower, "suffix").groupBy(_history(F.col("ngram")).alias("h")).agg((1 - F.sum("p")).alias("own_left"), (1 - F.sum("lower")).alias("lower_left"))
            weight = F.when((F.col("own_left") > LEAST) & (F.col("lower_left") > LEAST), F.log10(F.col("own_left") / F.col("lower_left"))).otherwise(NEVER)
            below = model.join(left.select(F.col("h").alias("ngram"), weight.alias("w")), "ngram", "left").select("order", "log10p", "ngram", F.coalesce("w", "backoff").alias("backoff"))
            model = written(below).unionByName(own.select(F.lit(n).alias("order"), log.alias("log10p"), "ngram", F.lit(None).cast("double").alias("backoff")))
        else:
            model = own.select(F.lit(1).alias("order"), log.alias("log10p"), "ngram", F.lit(None).cast("double").alias("backoff"))
    return model


def estimated(counts: DataFrame, order: int) -> DataFrame:
    """(n, ngram, count) -> a model whose histories keep, for what they haven't seen, as much as they have seen kinds of words (Witten and Bell).

    The sentence's begin is a history but never a next word; what no unigram
    has goes to <unk>. Counts must hold an n-gram's prefix and suffix with it.
    """
    levels = {}
    for n in range(1, order + 1):
        seen = written(counts.filter((F.col("n") == n) & (_word(F.col("ngram")) != BEGIN)).select("ngram", "count", _history(F.col("ngram")).alias("h")))
        of = seen.groupBy("h").agg(F.sum("count").alias("c"), F.count("*").alias("kinds"))
        # all single words have one history
        levels[n] = seen.join(F.broadcast(of) if n == 1 else of, "h").select("ngram", (F.col("count") / (F.col("c") + F.col("kinds"))).alias("p"))
        if n == 1:
            rest = of.select(F.lit(UNKNOWN).alias("ngram"), (F.col("kinds") / (F.col("c") + F.col("kinds"))).alias("p"))
            begin = counts.sparkSession.createDataFrame([(BEGIN, 0.0)], "ngram string, p double")
            levels[n] = levels[n].filter(F.col("ngram") != UNKNOWN).unionByName(rest).unionByName(begin)
    return _with_backoff(levels)


def merged(first: DataFrame, second: DataFrame, order: int, alpha: float = 1.0, beta: float = 1.0) -> DataFrame:
    """Two models mixed: of each n-gram that one has, what either says of it, weighted by alpha and beta.

    The weights are made to sum to one over the models that have the history;
    back-off weights are found anew, so every history sums to one.
    """
    if alpha < 0 or beta < 0 or alpha + beta <= 0:
        raise ValueError("weights must not be negative, nor both zero")
    levels = {}
    models = (("a", first, alpha), ("b", second, beta))
    weights = [m.filter("backoff is not null").select(F.col("ngram").alias("h"), F.pow(F.lit(10.0), F.col("backoff")).alias(f"w{x}")) for x, m, _ in models]
    histories = weights[0].join(weights[1], "h", "full")
    for n in range(1, order + 1):
        level = [m.filter(F.col("order") == n).select("ngram", *((_own(m) if y == x else F.lit(None).cast("double")).alias(f"p{y}") for y in "ab")) for x, m, _ in models]
        grams = level[0].unionByName(level[1])
        said = grams.groupBy("ngram").agg(F.max("pa").alias("pa"), F.max("pb").alias("pb"))
        if n == 1:
            said = said.na.fill(0.0, ["pa", "pb"]).withColumns({"a": F.lit(alpha), "b": F.lit(beta)})
        else:
            # a gram that a model hasn't: its history's weight times what the model says without the first word
            ends = grams.select(_suffix(F.col("ngram")).alias("ngram")).distinct()
            lower = reduce(lambda x, y: x.join(y, "ngram"), (scored(m, ends, n - 1).withColumnRenamed("p", f"l{x}") for x, m, _ in models)).withColumnRenamed("ngram", "suffix")
            said = said.withColumns({"h": _history(F.col("ngram")), "suffix": _suffix(F.col("ngram"))}).join(histories, "h", "left").join(lower, "suffix")
            said = said.select("ngram", *(F.coalesce(f"p{x}", F.coalesce(f"w{x}", F.lit(1.0)) * F.col(f"l{x}")).alias(f"p{x}") for x in "ab"), *(F.when(F.col(f"w{x}").isNotNull(), w).otherwise(0.0).alias(x) for x, _, w in models))
        whole = F.col("a") + F.col("b")
        # a history that only a model of weight zero has keeps that model's word
        mixed = F.when(whole > 0, (F.col("a") * F.col("pa") + F.col("b") * F.col("pb")) / whole).otherwise(F.greatest("pa", "pb"))
        levels[n] = said.select("ngram", mixed.alias("p"))
    return _with_backoff(levels)


def history_sums(model: DataFrame, order: int) -> DataFrame:
    """(history, total): over all words of the model, what each of its histories says of them; 1 for a proper model. For models whose words times histories fit."""
    words = model.filter((F.col("order") == 1) & (F.col("ngram") != BEGIN)).select(F.col("ngram").alias("w"))
    histories = model.filter("backoff is not null").select(F.col("ngram").alias("history"))
    every = histories.join(words).select("history", F.concat_ws(" ", "history", "w").alias("ngram"))
    return every.join(scored(model, every, order), "ngram").groupBy("history").agg(F.sum("p").alias("total"))


def perplexity(model: DataFrame, texts: DataFrame, text: str, order: int) -> DataFrame:
    """(words, unknown, log10p, perplexity) of all texts, their ends counted as words; words that the model hasn't are <unk>."""
    have = model.filter("order = 1").select(F.col("ngram").alias("w"), F.lit(True).alias("known"))
    tokens = F.concat(F.array(F.lit(BEGIN)), F.filter(F.split(F.coalesce(F.trim(F.col(text)), F.lit("")), r"\s+"), lambda w: w != ""), F.array(F.lit(END)))
    each = texts.select(F.monotonically_increasing_id().alias("id"), tokens.alias("t")).select("id", F.posexplode("t").alias("at", "w")).join(have, "w", "left")
    each = checkpointed(each.select("id", "at", F.when(F.col("known"), F.col("w")).otherwise(UNKNOWN).alias("w"), F.col("known").isNull().alias("unknown")))
    from pyspark.sql import Window

    before = [F.lag("w", k).over(Window.partitionBy("id").orderBy("at")) for k in range(order - 1, 0, -1)]
    grams = each.select("at", "unknown", F.concat_ws(" ", *before, "w").alias("ngram")).filter("at > 0")
    counted = grams.groupBy("ngram").agg(F.count("*").alias("n"), F.sum(F.col("unknown").cast("long")).alias("u"))
    sums = counted.join(scored(model, counted, order), "ngram").agg(F.sum("n").alias("words"), F.sum("u").alias("unknown"), F.sum(F.col("n") * F.log10("p")).alias("log10p"))
    return sums.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("log10p") / F.col("words")))


def write_arpa(model: DataFrame, path: str) -> None:
    """The model as text files whose parts, in order of name, are one ARPA file."""
    orders = model.groupBy("order").agg(F.count("*").alias("n")).orderBy("order").collect()  # a row for each order
    heads = [(0, "", "\\data\\\n" + "\n".join(f"ngram {r['order']}={r.n}" for r in orders) + "\n")] + [(r["order"], "", f"\\{r['order']}-grams:") for r in orders] + [(len(orders) + 1, "", "\n\\end\\")]
    number = lambda c: F.format_string("%.7f", c)
    line = F.concat_ws("\t", number(F.greatest("log10p", F.lit(NEVER))), "ngram", F.when(F.col("backoff").isNotNull(), number(F.greatest("backoff", F.lit(NEVER)))))
    rows = model.select("order", "ngram", line.alias("value")).unionByName(model.sparkSession.createDataFrame(heads, "order int, ngram string, value string"))
    rows.orderBy("order", "ngram").select("value").write.text(path)
