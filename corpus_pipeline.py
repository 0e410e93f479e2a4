"""A corpus made ready for training: quality rules, line dedup, near-dedup, decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantoria.llm.bpe import WordTableBpe
from cantoria.llm.chunks import table
from cantoria.llm.decontaminate import Decontaminate
from cantoria.llm.line_dedup import LineDedup
from cantoria.llm.minhash import NearDuplicates
from cantoria.llm.quality_rules import QualityRules
from cantoria.session import shared_folder, shipped


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped(spark)
    trusted = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("trusted"))
    return QualityRules(docs, trusted).kept()


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped(spark)
    return LineDedup(docs, least_lines=2, least_chars=50).apply()


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped(spark)
    return NearDuplicates(docs, k=5, percent=80).one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped(spark)
    return Decontaminate(docs, table(spark, sf_dir, "benchmark"), least=5, percent=50).clean()


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped(spark)
    return WordTableBpe(docs, public_tokenizers.path("word_bpe_49k.json")).encoded()


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("minhash_near_dedup", minhash_near_dedup), ("decontamination", decontamination), ("bpe", bpe)]
#: Likelihood ratios, components and BPE are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage before it returns is written to the folder that all executors share."""
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        to = f"{folder}/pipeline-{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(to)
        docs = spark.read.parquet(to)
    return STAGES[-1][1](spark, docs, sf_dir)
