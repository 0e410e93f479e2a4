"""The subpackage's queries opN_<name>, each over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from ..session import checkpointed
from . import chat, hard_negatives, lexical_search, line_dedup, token_files
from .bpe import WordTableBpe
from .chunks import table
from .decontaminate import Decontaminate
from .hard_negatives import HardNegatives
from .language_id import LanguageId
from .lexical_search import LexicalSearch
from .line_dedup import LineDedup
from .minhash import NearDuplicates
from .pii import Surrogates
from .quality_classifier import QualityClassifier
from .quality_rules import QualityRules
from .suffix_dedup import SuffixDedup


def op1_line_dedup(spark, sf_dir):
    return LineDedup(table(spark, sf_dir, "documents"), least_lines=2, least_chars=50).texts()


def op2_bpe(spark, sf_dir):
    return WordTableBpe(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).digests()


def op3_suffix_dedup(spark, sf_dir):
    return SuffixDedup(table(spark, sf_dir, "documents"), length=50).digests()


def op4_token_files(spark, sf_dir):
    folder = token_files.shared_folder(spark)
    manifest = token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder, ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return token_files.read(checkpointed(manifest), folder)


def op5_minhash(spark, sf_dir):
    return NearDuplicates(table(spark, sf_dir, "documents"), k=3, percent=85, bands=32, rows=6).components()


def op6_quality_classifier(spark, sf_dir):
    return QualityClassifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).scores()


def op7_decontaminate(spark, sf_dir):
    return Decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), least=5, percent=50).documents()


def op8_pii(spark, sf_dir):
    return Surrogates(table(spark, sf_dir, "documents"), key="cantoria").texts()


def op9_quality_rules(spark, sf_dir):
    trusted = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("trusted"))
    return QualityRules(table(spark, sf_dir, "documents"), trusted).judged()


def op10_chat(spark, sf_dir):
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return chat.read_back(chat.segments(rows, ranks), ranks).drop("n_tokens")


def op11_hard_negatives(spark, sf_dir):
    return HardNegatives(table(spark, sf_dir, "embeddings")).mined()


def op12_language_id(spark, sf_dir):
    return LanguageId(table(spark, sf_dir, "documents")).predicted()


def op13_lexical_search(spark, sf_dir):
    return LexicalSearch(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=20).ranked()


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.ORACLE_SQL.format(docs="documents", chars=50), "op10_chat": chat.ORACLE_SQL, "op11_hard_negatives": hard_negatives.ORACLE_SQL, "op13_lexical_search": lexical_search.ORACLE_SQL.format(top=20)}
