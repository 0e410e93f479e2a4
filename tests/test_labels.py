import pytest
from pyspark.sql import functions as F

from cantoria.functions import dates as Dt
from cantoria.operators import dedup as D
from cantoria.operators import labels as L
from cantoria.plans import flows


def test_labels(spark):
    df = spark.createDataFrame([(None, "a b"), ("go", "x")], "command string, label string")
    assert [r.labels for r in L.speech_labels(df).collect()] == [["a", "b"], ["go"]]
    with pytest.raises(Exception, match="no label"):
        L.speech_labels(spark.createDataFrame([(None,)], "label string")).collect()
    assert spark.range(1).select(L.relative_speakers(F.array(*map(F.lit, "babc")))).first()[0] == [0, 1, 0, 2]


def test_segments_and_frames(spark):
    df = spark.createDataFrame([("f", 0.0, 4.0), ("f", 2.0, 5.0), ("f", 8.0, 9.0)], "f string, start double, end double")
    assert [(r.start, r.end) for r in L.contiguous(df, ["f"]).orderBy("start").collect()] == [(0.0, 3.0), (3.0, 5.0), (8.0, 9.0)]
    cut = L.truncated(df, spark.createDataFrame([("f", 3.0)], "f string, end double"), ["f"])
    assert sorted((r.start, r.end) for r in cut.collect()) == [(0.0, 3.0), (2.0, 3.0)]
    one = spark.range(1)
    a = F.array(*map(F.lit, [0, 1, 0, 0, 1, 1]))
    assert one.select(L.resampled(a, F.lit(3))).first()[0] == [1, 0, 1]
    assert one.select(L.resampled(F.array(F.lit(1), F.lit(0)), F.lit(4))).first()[0] == [1, 1, 0, 0]
    assert one.select(L.soft_mask(a, 2)).first()[0] == [1, 0, 1]
    words = spark.createDataFrame([("s", float(i), i + 1.0, w) for i, w in enumerate(["aaa", "bbb", "cc"])], "k string, start double, end double, word string")
    assert [r.text for r in L.lines_of(words, "k", 7).orderBy("line").collect()] == ["aaa bbb", "cc"]
    seen = L.chunk_by_chunk(df, ["f"], 4.0, 9.0)
    assert sorted((r.upto, r.start, r.end) for r in seen.collect())[:2] == [(4.0, 0.0, 4.0), (4.0, 2.0, 4.0)]


def test_choices_and_turns(spark):
    df = spark.createDataFrame([("The answer is B", "b"), ("", "a"), ("(C)", None)], "r string, k string")
    assert L.choice_accuracy(df, "r", "k").first()[:] == (pytest.approx(1 / 3), 3)
    t = spark.createDataFrame([(1.0, 1.5), (1.0, 9.0), (1.0, None)], "user_end double, agent_start double")
    assert L.turn_taking(t, 1.0).first()[:] == (pytest.approx(1 / 3), 0.5, 3)
    assert [r.is_backchannel for r in L.backchannels(spark.createDataFrame([("Uh-huh.",), ("No way",)], "t string"), "t", ["uhhuh"]).collect()] == [True, False]


def test_rewards_and_contracts(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (1.0,)], "x double")
    out = [r.reward for r in L.normal_rewards(df, "x").orderBy("x").collect()]
    assert out[1] == pytest.approx(0.5) and out[0] == pytest.approx(0.8897, abs=1e-3) and out[0] + out[2] == pytest.approx(1)
    assert L.checked(df, {"x": "double"}) is df
    for bad in ({"x": "string"}, {"y": "int"}):
        with pytest.raises(TypeError):
            L.checked(df, bad)
    rows = spark.createDataFrame([("a b", "a c", "en"), ("x", "x", "de")], "text string, pred_text string, lang string")
    found = L.routed(rows, [("wer", ".lang == en"), ("exact", "")])
    assert found["wer"].first().wer == 0.5 and found["exact"].first().accuracy == 0.5


def test_dates(spark):
    df = spark.createDataFrame([("on 2024-03-05 or 12/25/1905, not 13/45/2020",)], "t string")
    assert df.select(Dt.dates_in_words("t")).first()[0] == "on March fifth, twenty twenty four or December twenty fifth, nineteen oh five, not 13/45/2020"
    assert df.select(Dt.expanded_abbreviations(F.lit("Dr. Smith of St. Paul"))).first()[0] == "doctor Smith of saint Paul"
    assert df.select(Dt.expanded_by_role(F.lit("main st"), F.lit("road"))).first()[0] == "main street"
    assert df.select(Dt.role_of(F.create_map(F.lit("city"), F.lit("x")))).first()[0] == "place"


def test_flows(spark, tmp_path):
    import json

    (tmp_path / "m.jsonl").write_text("".join(json.dumps({"audio_filepath": f"a{i}", "duration": float(i % 20), "text": "t"}) + "\n" for i in range(200)))
    out = flows.training_batches(spark, {"manifest_filepath": f"{tmp_path}/m.jsonl", "min_duration": 1, "max_duration": 18, "bucket_bounds": [5, 10, 18], "batch_sizes": {0: 4, 1: 2, 2: 1}})
    assert out.count() == 180 and out.groupBy("bucket", "slot", "batch").count().filter("count > 4").count() == 0
    pred = spark.createDataFrame([("a b", "a b", "x"), ("c d", "c e", "y")], "text string, pred_text string, g string")
    assert {r.group: r.wer for r in flows.report(pred, "g").collect()} == {"x": 0.0, "y": 0.5, None: 0.25}
    records = spark.createDataFrame([(i, f"take the {i % 50} road", f"e{i % 50}", "t1") for i in range(100)], "id long, text string, entity string, template string")
    kept, verdict = flows.records_flow(records, "id", "text", "entity", "template")
    assert kept.count() == 50 and not verdict["passed"] and verdict["exact_dup_rate"] == 0


def test_records_flow_reads_texts_twice(spark):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def said(i):
        reads.add(1)
        return f"Take  the {'second' if i % 2 else i % 30} road{'.' * (i % 3)}"

    texts = [f"Take  the {'second' if i % 2 else i % 30} road{'.' * (i % 3)}" for i in range(120)]
    rows = spark.range(120).select("id", said("id").alias("text"), F.concat(F.lit("e"), F.col("id") % 7).alias("entity"), F.when(F.col("id") % 2 == 0, "t1").alias("template"))
    kept, verdict = flows.records_flow(rows, "id", "text", "entity", "template")
    found = {r.id: r for r in kept.collect()}
    assert reads.value <= 240
    first = {}
    for i, t in enumerate(texts):
        first.setdefault(" ".join(t.lower().replace(".", "").split()), i)
    assert set(found) == set(first.values()) and all((r.text, r.entity, r.template) == (texts[i], f"e{i % 7}", None if i % 2 else "t1") for i, r in found.items())
    n = len(first)
    assert (verdict["n_rows"], verdict["unique_ratio"], verdict["exact_dup_rate"], verdict["normalized_dup_rate"], verdict["leakage_ratio"], verdict["long_share"]) == (n, n / 120, 0.0, 0.0, 0.0, 0.0)
    assert verdict["numeric_dup_rate"] == (n - 1) / n and verdict["top_template_share"] == max(sum(i % 2 == x for i in found) for x in (0, 1)) / n


def test_first_of_each_gives_whole_rows_of_tied_order(spark):
    rows = [(i % 5, i % 2, i, f"x{i}") for i in range(400)]
    out = D.first_of_each(spark.createDataFrame(rows, "k int, o int, a int, b string").repartition(7), F.col("k"), "o").collect()
    assert len(out) == 5 and all(r.o == 0 and tuple(r) in rows for r in out)


def test_words_of_turns(spark):
    from cantoria.operators import joins as J

    turns = spark.createDataFrame([("s", 1.0, 3.0, "A"), ("s", 10.0, 12.0, "B"), ("s", 20.0, 21.0, "A")], "k string, start double, end double, speaker string")
    words = spark.createDataFrame([("s", 0.5, 0.9, "um"), ("s", 1.5, 2.0, "hi"), ("s", 20.5, 20.9, "far"), ("t", 0.0, 1.0, "x")], "k string, start double, end double, word string")
    out = {r.word: r.speaker for r in J.words_to_turns(words, turns, ["k"], "mid").collect()}
    assert out == {"um": "A", "hi": "A", "far": "A", "x": None}


def test_language_model_files(spark, tmp_path):
    from cantoria.operators import scoring as S
    from cantoria.sources import manifests as M

    (tmp_path / "a.arpa").write_text("\\data\\\nngram 1=3\n\n\\1-grams:\n-1.0\t<s>\t-0.3\n-0.7\tHi\t-0.2\n-0.9\tyou\n\n\\2-grams:\n-0.4\tHi you\n\n\\end\\\n")
    assert {(r.order, r.ngram) for r in M.arpa(spark, f"{tmp_path}/a.arpa").collect()} == {(1, "<s>"), (1, "Hi"), (1, "you"), (2, "Hi you")}
    assert {(r.word, r.spelling) for r in M.arpa_lexicon(spark, f"{tmp_path}/a.arpa", lower=True).collect()} == {("hi", "h i"), ("you", "y o u")}
    df = spark.createDataFrame([(1, 0, -1.0, -5.0), (1, 3, -2.0, -1.0), (2, 1, -1.0, -1.0)], "id int, errors int, score double, other_score double")
    assert {r.weight: r.errors for r in S.searched_weight(df, "id", [0.0, 1.0]).collect()} == {0.0: 1, 1.0: 4}
