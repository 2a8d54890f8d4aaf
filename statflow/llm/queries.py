"""Queries ``opN_<name>`` of the training-data operators over the test tables.

Each applies its operator to the whole table and derives the digest columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from statflow.llm.common import table
from statflow.llm.oracles import oracles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = oracles()


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statflow.llm.sharding import shard_digest
    return shard_digest(table(spark, sf_dir, "documents"))


@query
def op7_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statflow.llm.packing import pack_documents
    from statflow.llm.tokens import default_tokenizer
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer(), 2048, 0)


@query
def op10_seekable_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statflow.llm.token_store import read_token_files, write_token_files
    from statflow.llm.tokens import default_tokenizer
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"),
                                              default_tokenizer(), 2))


@query
def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statflow.llm.language import identify
    return identify(table(spark, sf_dir, "documents"))


@query
def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statflow.llm.warc import read_archives, write_archives
    return read_archives(write_archives(table(spark, sf_dir, "pages")))


@query
def op3_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statflow.llm.ngram_lm import score_documents
    return score_documents(table(spark, sf_dir, "documents"))


@query
def op8_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statflow.llm.near_join import jaccard_join
    return jaccard_join(table(spark, sf_dir, "documents"))


@query
def op5_posting_list_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statflow.llm.ann import search_self
    return search_self(table(spark, sf_dir, "embeddings"))


@query
def op6_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statflow.llm.mixing import mix_documents
    return mix_documents(table(spark, sf_dir, "documents"))


@query
def op2_block_max_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statflow.llm.bm25 import search_self
    return search_self(table(spark, sf_dir, "documents"))


@query
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statflow.llm.licenses import licence_digest
    return licence_digest(table(spark, sf_dir, "documents"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statflow.llm.merkle import manifest_digest
    return manifest_digest(table(spark, sf_dir, "documents"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statflow.llm.prefix_trie import conversation_trie
    return conversation_trie(table(spark, sf_dir, "conversations"))
