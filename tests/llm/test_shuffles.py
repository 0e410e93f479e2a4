"""Files of exchanges that a later step doesn't need are gone before it."""

import os
import random

from cantoria.llm import suffix_dedup as S


def shuffle_bytes(spark) -> int:
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [found.apply(i).getPath() for i in range(found.size())]
    return sum(os.path.getsize(f) for f in files if os.path.basename(f).startswith("shuffle_") and os.path.exists(f))


def test_anchors_leave_no_shuffle_files(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(0, 200), x -> sha2(concat(id % 300, '-', x), 256))) AS text")
    before = shuffle_bytes(spark)
    dedup = S.SuffixDedup(docs, chunk_bytes=1 << 20)
    spans = dedup._fragments()
    assert shuffle_bytes(spark) - before < 1 << 20  # of 5 MB of text
    assert spans.filter("kind = 0").count() and spark.conf.get(S.CLEANUP, None) in (None, "false")


def test_rounds_change_nothing(spark):
    docs = spark.range(60).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(0, 20), x -> sha2(cast(x * (id % 7) AS string), 256))) AS text")
    one, three = (sorted(map(tuple, S.SuffixDedup(docs, chunk_bytes=20_000, rounds=r).digests().collect())) for r in (1, 3))
    assert one == three and any(r[2] for r in one)


def test_text_is_exchanged_compressed(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=400))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2).persist()
    size = sum(len(t) for _, t in rows)
    docs.count()
    before = shuffle_bytes(spark)
    S.SuffixDedup(docs, chunk_bytes=1 << 18).chunks.write.format("noop").mode("overwrite").save()
    assert shuffle_bytes(spark) - before < 0.5 * size
