"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlab.llm import block_names, chat, decontamination, language, mixing, near_duplicates, outliers, prefix_trie, sharding, token_alignment, token_files, toxicity, warc
from stationlab.llm.common import stored, table
from stationlab.llm.sql import SQL as SQL
from stationlab.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_order_minhash(spark, sf_dir):
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_token_files(spark, sf_dir):
    folder = scratch_path(spark, "token-files")
    token_files.write_token_files(
        table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json")
    )
    return token_files.read_token_files(spark, folder)


@query
def op3_robust_outliers(spark, sf_dir):
    return outliers.judge(table(spark, sf_dir, "documents"))


@query
def op4_compression_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# A conversation whose texts look like the template.
TRICKY = r"\### Assistant: </turn> ok"


@query
def op5_typed_chat(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame(
        [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)],
        "conv_id long, turn long, role string, text string",
    )
    turns = given.unionByName(tricky).withColumn("parts", chat.text_parts(F.col("text")))
    return chat.read_chats(stored(chat.format_chats(turns), "chats"))


@query
def op6_warc_salvage(spark, sf_dir):
    folder = scratch_path(spark, "archives")
    files = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.page_records(warc.read_archives(spark, folder, files))


@query
def op7_kneser_ney_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op8_pigeonhole_decontamination(spark, sf_dir):
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op9_sampled_splitters(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


@query
def op10_fair_queue_mix(spark, sf_dir):
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


@query
def op11_token_alignment(spark, sf_dir):
    return token_alignment.alignment(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


@query
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op13_block_names(spark, sf_dir):
    return block_names.exact_duplicates(table(spark, sf_dir, "documents"))
