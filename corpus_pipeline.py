"""The corpus pipeline: documents to token files in five stages, each stored before the next.

Every stage takes null and empty texts, texts of any length, repeated rows, tables without rows and
further columns as its operator does; all but the last return the columns they get, and an empty table
gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stationlab.llm import decontamination, mixing, near_duplicates, token_files, toxicity
from stationlab.llm.common import stored, table
from stationlab.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; learns from the labels of those it gets. Null and empty texts are
    scored as texts without words, copies alike; without labels of both kinds all stay."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of least doc_id; of equal rows one. Empty
    texts are one class; null texts are no duplicates and all stay."""
    return near_duplicates.without_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, edits counted in. Null and empty texts hold none and
    stay; copies stay or go together; without items all stay."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or repeated. Null and
    empty texts have no words and are taken with the rest; a null source is a source."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, and one row per document as read back from them. Null and empty
    texts hold the end id alone; every repeated row is a document."""
    folder = scratch_path(spark, "pipeline-tokens")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(docs, folder, tokenizer)
    return token_files.read_token_files(spark, folder)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

# Classifier, alignment and tokenizer are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
