"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airstrata.llm import (
    bpe,
    cap_filter,
    class_lm,
    conversation_trie,
    exact_dedup,
    langid,
    line_dedup,
    packing,
    sharding,
    signature_search,
    simhash,
    topk_search,
    url_filter,
)
from airstrata.llm.common import id_remainder, read_table

Query = Callable[[SparkSession, str], DataFrame]

RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors.filter("vec_id % 20 = 0"), vectors)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    remainder = id_remainder("doc_id", 4)
    found = langid.identify(documents.select("doc_id", "text"), documents.filter(remainder != 2))
    held_out = F.coalesce(remainder == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", hexed, "component_id")


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    coded = bpe.encode_documents(documents, public_tokenizers.path("word_bpe_49k.json"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, url_filter.rules_table(spark, RULES))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filter.near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


def op7_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    remainder = id_remainder("doc_id", 10)
    held_out = F.coalesce(remainder == 0, F.lit(True)).alias("held_out")
    return class_lm.score_documents(
        documents.select("doc_id", held_out, "text"), documents.filter(remainder != 0)
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents"))


def op9_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    pieces = packing.pack_documents(documents, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read_table(spark, sf_dir, "benchmark")
    return signature_search.search(items, read_table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    return conversation_trie.conversation_trie(conversations, rebuilt=True)


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    name: function for name, function in list(globals().items()) if name.startswith("op")
}
