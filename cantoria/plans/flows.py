"""Whole flows: a data spec to batches, a prediction manifest to a report, generated records to splits and a gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import batching as B
from ..operators import dedup as D
from ..operators import entries as N
from ..operators import filters as X
from ..operators import labels as L
from ..operators import packs as P
from ..operators import sampler as A
from ..operators import scoring as S
from ..session import checkpointed
from ..sources import manifests as M
from .corpus import HASH, KEY
from .registered import query, table


def training_batches(spark: SparkSession, spec: dict) -> DataFrame:
    """Sources of a spec, filtered, in buckets and batches: columns bucket, slot, batch beside the rows.

    spec: what sources.manifests.read takes, and min_duration, max_duration,
    bucket_bounds, batch_sizes, key and seed.
    """
    rows = X.by_duration(M.read(spark, spec), spec.get("min_duration", 0.0), spec.get("max_duration", float("inf")))
    bounds = spec.get("bucket_bounds") or [*B.equal_mass_bounds(rows, "duration", spec.get("num_buckets", 8)), spec.get("max_duration", float("inf"))]
    bucketed = rows.withColumn("bucket", B.smallest_bucket(F.col("duration"), bounds)).filter("bucket is not null")
    sizes = spec.get("batch_sizes") or dict(enumerate(B.bucket_batch_sizes(spec.get("batch_size", 8), len(bounds))))
    return B.fixed_size_batches(bucketed, "bucket", sizes, spec.get("key", "audio_filepath"), spec.get("seed", 0))


def report(predictions: DataFrame, by: str, slots: list | None = None, clean: bool = True) -> DataFrame:
    """Corpus error rates in all (null group) and by a column, or by its slots, after cleaning both texts."""
    df = predictions.withColumns({c: T.clean_label(F.coalesce(c, F.lit(""))) for c in ("text", "pred_text")}) if clean else predictions
    parts = S.by_slots(df, by, slots).withColumnRenamed("slot", "group") if slots else S.corpus(df, by).withColumn("group", F.col(by).cast("string")).drop(by)
    return parts.unionByName(S.corpus(df).withColumn("group", F.lit(None).cast("string")))


def records_flow(records: DataFrame, order: str, text: str, entity: str, template: str) -> tuple[DataFrame, dict]:
    """Generated records -> deduplicated rows with splits, and the gate's verdict.

    Texts are read twice at most, whatever the verdict asks: once for what it
    needs of each row (SHA-256 of its text and keys, its entity, template and
    length), which is written down, and once for the rows that are kept.
    """
    n = records.count()
    hashed = lambda c: F.sha2(c, 256)
    key = hashed(T.normalized_key(F.col(text)))
    facts = records.select(F.col(order).alias("order"), F.col(entity).alias("entity"), F.col(template).alias("template"), hashed(F.col(text)).alias("exact"), key.alias("normalized"), hashed(T.numeric_skeleton_key(F.col(text))).alias("numeric"), (T.length_bucket(F.col(text)) == "long").cast("int").alias("long"))
    split = lambda rows, name: B.split_by_entity(rows, F.array(T.lower_key(F.col(name)))).filter("split != 'conflict'")
    kept = split(D.first_of_each(records, key, order), entity)
    known = checkpointed(split(D.first_of_each(facts, F.col("normalized"), "order"), "entity"))
    rates = {r.level: r.rate for r in D.duplicate_rates(known, {c: F.col(c) for c in ("exact", "normalized", "numeric")}).collect()}
    leaked = D.leakage(known, "entity").count()
    top = known.groupBy("template").count().agg(F.max("count")).first()[0] or 0
    rows, long_share = known.agg(F.count("*"), F.avg("long")).first()
    total = max(1, rows)
    summary = {"n_rows": total, "exact_dup_rate": rates.get("exact"), "normalized_dup_rate": rates.get("normalized"), "numeric_dup_rate": rates.get("numeric"), "leakage_ratio": leaked / max(1, known.select("entity").distinct().count()), "unique_ratio": total / max(1, n), "top_template_share": top / total, "long_share": long_share}
    return kept, summary | D.gate(summary)


@query("SELECT count(*) AS n, count(*) FILTER (WHERE lower(role) = 'assistant') AS answers FROM conversations")
def turn_counts(spark, sf_dir):
    return table(spark, sf_dir, "conversations").agg(F.count("*").alias("n"), F.count_if(F.lower("role") == "assistant").alias("answers"))


@query("SELECT doc_id, lang FROM documents WHERE lang IN (SELECT lang FROM documents GROUP BY lang HAVING count(*) >= 130)")
def labels_with_enough_rows(spark, sf_dir):
    return L.with_enough(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", 130)


@query("SELECT p_type AS label, row_number() OVER (ORDER BY p_type) - 1 AS index, n FROM (SELECT p_type, count(*) AS n FROM part GROUP BY p_type)")
def label_index(spark, sf_dir):
    return L.label_index(L.speech_labels(table(spark, sf_dir, "part").select(F.col("p_type").alias("label"))))


@query("""WITH n AS (SELECT user_id, event_id, event_type, epoch_us(ts) / 1e6 AS t, lead(epoch_us(ts) / 1e6) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS following FROM events)
SELECT round(avg(CASE WHEN following - t BETWEEN -3600 AND 3600 THEN 1 ELSE 0 END), 6) AS accuracy, round(avg(CASE WHEN following - t BETWEEN -3600 AND 3600 THEN following - t END), 3) AS latency, count(*) AS n FROM n WHERE event_type = 'error'""")
def turn_taking(spark, sf_dir):
    """A user's error and the event after it as turn end and reply."""
    from pyspark.sql import Window

    seconds = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)") / 1e6
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").select("event_type", seconds.alias("user_end"), F.lead(seconds).over(w).alias("agent_start")).filter("event_type = 'error'")
    out = L.turn_taking(e, 3600)
    return out.select(F.round("accuracy", 6).alias("accuracy"), F.round("latency", 3).alias("latency"), "n")


@query("""WITH s AS (SELECT event_type, value, (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS z, event_id FROM events) SELECT event_id, z > 0 AS above FROM s""")
def reward_sides(spark, sf_dir):
    """Rewards from z-scores: below one half where the value is above the mean."""
    return L.normal_rewards(table(spark, sf_dir, "events"), "value").select("event_id", (F.col("reward") < 0.5).alias("above"))


@query(f"""SELECT doc_id, CASE WHEN h < 8000 THEN 'train' WHEN h < 9000 THEN 'val' ELSE 'test' END AS split FROM (SELECT doc_id, {HASH.format(x="doc_id::VARCHAR")} AS h FROM (SELECT min(doc_id) AS doc_id FROM documents GROUP BY {KEY}))""")
def record_splits(spark, sf_dir):
    kept, _ = records_flow(table(spark, sf_dir, "documents"), "doc_id", "text", "doc_id", "source")
    return kept.select("doc_id", "split")


@query()
def preference_pairs(spark, sf_dir):
    """Parts of one brand as candidates: size as error, price as similarity."""
    items = table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.col("p_partkey").alias("key"), F.col("p_size").cast("double").alias("cer"), (F.col("p_retailprice") / 1000).alias("similarity"))
    fronts = B.pareto_fronts(items, "brand", "key").join(items, ["brand", "key"])
    return L.chosen_and_rejected(fronts, "brand", 3)


SPEC = {"key": "doc_id", "min_duration": 2.0, "max_duration": 1000.0, "min_tokens": 3, "bucket_duration_bins": [20.0, 60.0, 150.0, 400.0], "slots": 4, "seed": 1}


def _measured_documents(spark, sf_dir):
    words = F.size(F.split(F.trim("text"), " "))
    return table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") / 15).alias("duration"), words.alias("n_tokens"))


_BATCHED = """WITH d AS (SELECT doc_id, n_chars / 15 AS duration, len(string_split(trim(text, ' '), ' ')) AS n_tokens FROM documents), f AS (SELECT * FROM d WHERE (duration IS NULL OR duration BETWEEN 2 AND 1000) AND (n_tokens IS NULL OR n_tokens >= 3)),
b AS (SELECT *, CASE WHEN coalesce(duration, 0) <= 20 THEN 0 WHEN duration <= 60 THEN 1 WHEN duration <= 150 THEN 2 WHEN duration <= 400 THEN 3 END AS bucket, md5(doc_id || ':1') AS h FROM f),
s AS (SELECT doc_id, bucket, h, (('0x' || substr(h, 1, 7))::BIGINT % 4)::INT AS slot FROM b WHERE bucket IS NOT NULL), n AS (SELECT *, (row_number() OVER (PARTITION BY bucket, slot ORDER BY h, doc_id) - 1) // [16, 8, 4, 2][bucket + 1] AS batch FROM s),
o AS (SELECT bucket, slot, batch, row_number() OVER (ORDER BY md5(bucket || ':' || slot || ':' || batch || ':1')) - 1 AS step FROM (SELECT DISTINCT bucket, slot, batch FROM n))"""


@query(_BATCHED + " SELECT doc_id, bucket, slot, batch, step FROM n JOIN o USING (bucket, slot, batch) WHERE step >= 10")
def bucketed_batches(spark, sf_dir):
    """Documents in batches of a size for each bucket, in shuffled steps; what a run that took ten steps has left."""
    return A.sampled(_measured_documents(spark, sf_dir), SPEC | {"bucket_batch_size": [16, 8, 4, 2]}, done=10).select("doc_id", "bucket", "slot", F.col("batch").cast("long").alias("batch"), F.col("step").cast("long").alias("step"))


@query(_BATCHED + " SELECT bucket, slot, count(*) AS n, 0 AS over, 0 AS could_have_been_one, 0 AS wrong_steps FROM s GROUP BY bucket, slot")
def batches_within_budget(spark, sf_dir):
    """By bucket and slot: rows, batches of several rows beyond the budget, neighbours that would have fitted one batch, and rows that the first ten steps and the rest don't give once."""
    spec = SPEC | {"batch_duration": 600.0, "quadratic_duration": 300.0}
    rows = A.sampled(_measured_documents(spark, sf_dir), spec)
    cost = F.col("duration_") + F.col("duration_") * F.col("duration_") / 300
    each = rows.groupBy("bucket", "slot", "batch").agg(F.count("*").alias("k"), F.max(cost).alias("longest"), F.min(cost).alias("least"), F.count_distinct("step").alias("steps"))
    from pyspark.sql import Window

    after = Window.partitionBy("bucket", "slot").orderBy("batch")
    # the next batch's first row closed this one: even its shortest row is no less than nothing
    fits = (F.col("k") + F.lead("k").over(after)) * F.greatest("longest", F.lead("longest").over(after)) <= 600
    checked = each.withColumn("fits", F.coalesce(fits, F.lit(False)))
    parts = checked.groupBy("bucket", "slot").agg(F.sum("k").alias("n"), F.sum(((F.col("k") > 1) & (F.col("k") * F.col("longest") > 600)).cast("int")).cast("int").alias("over"), F.sum(F.col("fits").cast("int")).cast("int").alias("could_have_been_one"), F.sum((F.col("steps") != 1).cast("int")).alias("split"))
    resumed = rows.filter("step < 10").select("doc_id").unionByName(A.sampled(_measured_documents(spark, sf_dir), spec, done=10).select("doc_id")).groupBy("doc_id").agg(F.count("*").alias("times"))
    wrong = rows.select("doc_id", "bucket", "slot").join(resumed, "doc_id", "left").groupBy("bucket", "slot").agg(F.sum((F.coalesce("times", F.lit(0)) != 1).cast("int")).cast("int").alias("wrong"))
    return parts.join(wrong, ["bucket", "slot"]).select("bucket", "slot", "n", "over", "could_have_been_one", (F.col("wrong") + F.col("split")).cast("int").alias("wrong_steps"))


@query("SELECT doc_id, len(w)::INT AS n, md5(array_to_string(list_transform(w, lambda x: length(x)), ' ')) AS ids, CASE WHEN len(w) = 0 THEN 0 ELSE greatest(len(w) - 4, 0) END::INT AS labels FROM (SELECT doc_id, string_split(coalesce(text, ''), ' ') AS w FROM documents)")
def rows_out_of_packs(spark, sf_dir):
    """Documents as ids, the lengths of their words, packed, filled and taken apart again: every row with its ids and mask."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.transform(F.split(F.coalesce("text", F.lit("")), " "), F.length).alias("input_ids"))
    docs = docs.withColumn("loss_mask", P.label_mask(F.col("input_ids"), answer_start=F.lit(5))).withColumn("n", F.size("input_ids"))
    packs = P.filled(B.packed(docs, "doc_id", "n", 4096), docs, "doc_id")
    return P.unfilled(packs, "doc_id").select("doc_id", F.size("input_ids").alias("n"), F.md5(F.array_join("input_ids", " ")).alias("ids"), F.size(F.filter("loss_mask", lambda x: x)).alias("labels"))


@query("""SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS place, left(text, 20) AS said FROM documents""")
def outputs_in_old_order(spark, sf_dir):
    """A run over documents from the longest on, its outputs joined with the documents by their old number."""
    docs = table(spark, sf_dir, "documents")
    order = P.presorted(docs, "doc_id", "n_chars")
    said = order.select("order", F.col("order").alias("place"), F.substring("text", 1, 20).alias("said"))
    return P.restored(said, order, "doc_id").select("doc_id", "place", "said")


@query("""SELECT doc_id, 'a/' || doc_id || '.wav' AS audio_file, n_chars / 15.0 AS duration, CASE doc_id % 4 WHEN 0 THEN 'own context' ELSE ['say it', 'write it', 'what is it'][(('0x' || substr(md5(doc_id || ':3'), 1, 7))::BIGINT % 3) + 1] END AS context,
coalesce(CASE WHEN doc_id % 5 = 0 THEN lang END, CASE WHEN doc_id % 7 <> 0 THEN text END, 'na') AS answer, lang FROM documents""")
def context_rows(spark, sf_dir):
    """Documents as manifest rows, some with a context or an answer of their own, the others with one drawn, their text, or the default."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", F.concat(F.lit("a/"), "doc_id", F.lit(".wav")).alias("audio_filepath"), (F.col("n_chars") / 15).alias("duration"), F.when(F.col("doc_id") % 4 == 0, "own context").alias("context"), F.when(F.col("doc_id") % 5 == 0, F.col("lang")).alias("answer"), F.when(F.col("doc_id") % 7 != 0, F.col("text")).alias("text"), F.lit("why?").alias("question"), "lang")
    return N.context_rows(rows, "doc_id", ["say it", " ", "write it\n", "what is it"], seed=3).select("doc_id", "audio_file", "duration", "context", "answer", "lang")


@query("""WITH f AS (SELECT user_id, event_type, min(ts) AS t FROM events GROUP BY ALL), s AS (SELECT user_id, list(event_type ORDER BY t, event_type) AS speakers FROM f GROUP BY user_id)
SELECT 'u' || user_id AS uniq_id, array_to_string(speakers, ',') AS speakers, CASE WHEN len(speakers) = 1 THEN 1 ELSE len(speakers) * (len(speakers) - 1) // 2 END::INT AS n_targets, 0.0::DOUBLE AS "offset" FROM s""")
def sessions_to_diarize(spark, sf_dir):
    """Users as sessions: their event types as speakers in order of appearance, with all pairs of these."""
    e = table(spark, sf_dir, "events")
    sessions = N.session_rows(e.select(F.concat(F.lit("in/u"), "user_id", F.lit(".wav")).alias("audio_filepath"), F.lit(1.0).alias("duration")).distinct())
    out = N.session_targets(sessions, e.select(F.concat(F.lit("u"), "user_id").alias("uniq_id"), F.col("ts").alias("start"), F.col("event_type").alias("speaker")))
    return out.select("uniq_id", F.array_join("speakers", ",").alias("speakers"), F.size("targets").alias("n_targets"), "offset")
