"""The pipeline's stages on a small corpus: each works on what the one before kept, and its decisions take effect."""

import random

import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline
from cantoria.llm.decontaminate import Decontaminate
from cantoria.llm.line_dedup import LineDedup
from cantoria.llm.minhash import NearDuplicates
from cantoria.llm.quality_rules import QualityRules

from . import corpus as C


def tables(spark, folder):
    rng = random.Random(6)
    rows = [(i, C.text(rng, 90)) for i in range(40)]
    item = C.text(rng, 30).replace("\n", " ")
    rows += [(50, " ".join("X#" + C.word(rng) for _ in range(80))), (51, "la la la " * 40), (52, f"{C.text(rng, 60)} {item} {C.text(rng, 9)}")]
    near = rows[7][1].replace("\n", " ").split(" ")
    near[5] = "otherword"
    rows += [(60, rows[7][1].replace("\n", " ")), (61, " ".join(near))]
    rows.append((62, f"{C.text(rng, 60)}\n" + "\n".join(rows[3][1].split("\n")[:3])))
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(50, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows


def test_stages(spark, tmp_path):
    tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet")
    kept, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs_before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "bpe":
            assert docs.columns == columns
        if name == "quality_rules":
            judged = QualityRules(docs_before, labels.selectExpr("doc_id", "quality = 1 as trusted")).judged()
            assert kept[name] == {r.doc_id for r in judged.filter("kept").collect()}
        if name == "line_dedup":
            texts = {r.doc_id: r.text for r in LineDedup(docs_before, 2, 50).texts().collect()}
            assert all(r.text == texts[r.doc_id] and r.n_chars == len(r.text) for r in docs.collect())
        if name == "minhash_near_dedup":
            assert kept[name] == {r.doc_id for r in NearDuplicates(docs_before).components().filter("kept").collect()}
        if name == "decontamination":
            d = Decontaminate(docs_before, spark.read.parquet(f"{tmp_path}/benchmark.parquet")).documents()
            assert kept[name] == {r.doc_id for r in d.filter("kept").collect()}
    assert 50 not in kept["quality_rules"] and 51 not in kept["quality_rules"]
    assert set(range(40)) <= kept["bpe"]
    assert 61 not in kept["minhash_near_dedup"]
    assert 52 in kept["minhash_near_dedup"] and 52 not in kept["decontamination"]
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tmp_path}/decontamination").collect()}
    for r in docs.collect():
        ids = tok.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == tok.decode(ids, skip_special_tokens=False)


def test_run_is_the_stages_in_turn(spark, tmp_path):
    tables(spark, str(tmp_path))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.collect()} >= set(range(40))
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
