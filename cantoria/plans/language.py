"""Queries of language models, of numbers as they are written, and of splits with a floor."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import tokens as Tk
from ..functions import written as W
from ..operators import batching as B
from ..operators import language_models as L
from ..operators import splits as P
from ..session import spread
from .corpus import HASH
from .registered import query, table

_COUNTS = """t_{x} AS (SELECT ['<s>'] || list_filter(string_split_regex(coalesce(text, ''), '\\s+'), lambda w: w <> '') || ['</s>'] AS t FROM conversations WHERE role = '{role}'),
u_{x} AS (SELECT w, n / (sum(n) OVER () + count(*) OVER ()) AS p FROM (SELECT w, count(*) AS n FROM (SELECT unnest(t[2:]) AS w FROM t_{x}) GROUP BY w)), v_{x} AS (SELECT w, p FROM u_{x} UNION ALL SELECT '<unk>', 1 - sum(p) FROM u_{x} UNION ALL SELECT '<s>', 0),
b_{x} AS (SELECT h, w, n / (sum(n) OVER (PARTITION BY h) + count(*) OVER (PARTITION BY h)) AS p FROM (SELECT h, w, count(*) AS n FROM (SELECT unnest(t[:-2]) AS h, unnest(t[2:]) AS w FROM t_{x}) GROUP BY h, w)),
a_{x} AS (SELECT h, (1 - sum(b.p)) / (1 - sum(v.p)) AS weight FROM b_{x} b JOIN v_{x} v USING (w) GROUP BY h)"""
_BOTH = f"""WITH {_COUNTS.format(x="a", role="user")}, {_COUNTS.format(x="b", role="assistant")},
v AS (SELECT w, 0.7 * coalesce(x.p, 0) + 0.3 * coalesce(y.p, 0) AS p FROM v_a x FULL JOIN v_b y USING (w)), k AS (SELECT h, w FROM b_a UNION SELECT h, w FROM b_b),
c AS (SELECT k.h, k.w, CASE WHEN x.h IS NULL THEN 0 ELSE 0.7 END AS la, CASE WHEN y.h IS NULL THEN 0 ELSE 0.3 END AS lb, coalesce(ba.p, x.weight * va.p, 0) AS pa, coalesce(bb.p, y.weight * vb.p, 0) AS pb
  FROM k LEFT JOIN a_a x ON x.h = k.h LEFT JOIN a_b y ON y.h = k.h LEFT JOIN b_a ba ON ba.h = k.h AND ba.w = k.w LEFT JOIN b_b bb ON bb.h = k.h AND bb.w = k.w LEFT JOIN v_a va ON va.w = k.w LEFT JOIN v_b vb ON vb.w = k.w),
b AS (SELECT h, w, (la * pa + lb * pb) / (la + lb) AS p FROM c), a AS (SELECT h, (1 - sum(b.p)) / (1 - sum(v.p)) AS weight FROM b JOIN v USING (w) GROUP BY h)"""
_ROWS = """SELECT 1 AS "order", v.w AS ngram, round(v.p::DOUBLE, 9) AS p, round(a.weight::DOUBLE, 7) AS weight FROM {v} v LEFT JOIN {a} a ON a.h = v.w UNION ALL SELECT 2, h || ' ' || w, round(p::DOUBLE, 9), NULL FROM {b}"""


def _model(spark, sf_dir, role):
    said = table(spark, sf_dir, "conversations").filter(F.col("role") == role)
    return L.estimated(Tk.ngram_counts(said, "text", 2), 2)


def _rows(model):
    p = F.when(F.col("log10p") > L.NEVER, F.pow(F.lit(10.0), F.col("log10p"))).otherwise(0.0)
    return model.select("order", "ngram", F.round(p, 9).alias("p"), F.round(F.pow(F.lit(10.0), F.col("backoff")), 7).alias("weight"))


@query(f"WITH {_COUNTS.format(x='a', role='user')} {_ROWS.format(v='v_a', a='a_a', b='b_a')}")
def backoff_model(spark, sf_dir):
    """What users say, as a model of word pairs."""
    return _rows(_model(spark, sf_dir, "user"))


@query(f"{_BOTH} {_ROWS.format(v='v', a='a', b='b')}")
def merged_language_models(spark, sf_dir):
    """What users say, mixed with three tenths of what assistants say."""
    return _rows(L.merged(_model(spark, sf_dir, "user"), _model(spark, sf_dir, "assistant"), 2, 0.7, 0.3))


@query(f"""{_BOTH}, t AS (SELECT ['<s>'] || list_filter(string_split_regex(coalesce(text, ''), '\\s+'), lambda w: w <> '') || ['</s>'] AS t FROM benchmark), g AS (SELECT unnest(t[:-2]) AS h0, unnest(t[2:]) AS w0 FROM t),
n AS (SELECT coalesce(x.w, '<unk>') AS h, coalesce(y.w, '<unk>') AS w, y.w IS NULL AS unknown FROM g LEFT JOIN v x ON x.w = h0 LEFT JOIN v y ON y.w = w0)
SELECT count(*) AS words, count_if(unknown)::BIGINT AS unknown, round(pow(10, -sum(log10(coalesce(b.p, coalesce(a.weight, 1) * v.p))) / count(*)), 4) AS perplexity FROM n JOIN v USING (w) LEFT JOIN b ON b.h = n.h AND b.w = n.w LEFT JOIN a ON a.h = n.h""")
def held_out_perplexity(spark, sf_dir):
    """How the mixed model takes the texts of the benchmark."""
    mixed = L.merged(_model(spark, sf_dir, "user"), _model(spark, sf_dir, "assistant"), 2, 0.7, 0.3)
    return L.perplexity(mixed, table(spark, sf_dir, "benchmark"), "text", 2).select("words", "unknown", F.round("perplexity", 4).alias("perplexity"))


@query("""SELECT p_partkey, 'part ' || p_partkey || ' costs $' || floor(p_retailprice)::BIGINT || '.' || lpad((round(p_retailprice * 100)::BIGINT % 100)::VARCHAR, 2, '0') || ' or ' || p_size || '% more' AS written,
['word', 'cardinal', 'word', 'money', 'word', 'measure', 'word'] AS kinds, 4::BIGINT AS kept FROM part""")
def numbers_written(spark, sf_dir):
    """What cardinal_words says, written again: a part's number, price and size; kept: words that stay, each from its own place."""
    cents = F.round(F.col("p_retailprice") * 100).cast("long")
    spoken = F.concat_ws(" ", F.lit("part"), T.cardinal_words(F.col("p_partkey"), T.MOST_IN_WORDS), F.lit("costs"), T.cardinal_words(F.floor("p_retailprice"), T.MOST_IN_WORDS), F.lit("dollars and"), T.cardinal_words(cents % 100), F.lit("cents or"), T.cardinal_words(F.col("p_size")), F.lit("percent more"))
    said = spread(table(spark, sf_dir, "part"), "p_partkey").select("p_partkey", F.split(spoken, " ").alias("said"))
    done = said.withColumn("a", W.as_written(F.col("said"), least=0))
    kept = F.filter("a", lambda x: (x["kind"] == "word") & (x["first"] == x["last"]) & (F.get("said", x["first"]) == x["word"]))
    return done.select("p_partkey", F.array_join(F.transform("a", lambda x: x["word"]), " ").alias("written"), F.transform("a", lambda x: x["kind"]).alias("kinds"), F.size(kept).cast("long").alias("kept"))


_SPLIT = f"""SELECT o_custkey, CASE WHEN h < 8000 THEN 'train' WHEN h < 9000 THEN 'val' ELSE 'test' END AS split, CAST(o_orderpriority = '1-URGENT' AS BIGINT) AS tail FROM (SELECT *, {HASH.format(x="o_custkey::VARCHAR")} AS h FROM orders)"""


@query(f"""WITH s AS ({_SPLIT}), a AS (SELECT count(*) AS n, sum(tail) AS t FROM s WHERE split = 'train'), b AS (SELECT count(*) AS n, sum(tail) AS t FROM s WHERE split = 'val'), r AS (SELECT 1.25 * a.t / a.n AS required, greatest(1, floor(a.n * 0.05)) AS budget, b.n AS bn, b.t AS bt FROM a, b),
e AS (SELECT o_custkey, count(*) AS n, sum(tail) AS t FROM s WHERE split = 'train' GROUP BY o_custkey), o AS (SELECT e.*, required, budget, bn, bt, sum(n) OVER w AS nn, sum(t) OVER w AS tt FROM e, r WHERE t > required * n AND bt < required * bn WINDOW w AS (ORDER BY md5(o_custkey::VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
m AS (SELECT o_custkey FROM o WHERE nn <= budget AND bt + tt - t < required * (bn + nn - n))
SELECT s.o_custkey, CASE WHEN m.o_custkey IS NULL THEN split ELSE 'val' END AS split, count(*) AS n, sum(tail)::BIGINT AS urgent FROM s LEFT JOIN m USING (o_custkey) GROUP BY ALL""")
def split_with_floor(spark, sf_dir):
    """Orders split by customer, then customers moved to val until its share of urgent orders is a quarter above train's, or a twentieth of train has gone."""
    orders = B.split_by_entity(table(spark, sf_dir, "orders"), F.array(F.col("o_custkey").cast("string")))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    moved = P.with_floor(orders, "o_custkey", urgent, least_ratio=1.25, most_moved=0.05)
    return moved.groupBy("o_custkey", "split").agg(F.count("*").alias("n"), F.sum(urgent.cast("long")).alias("urgent"))
