"""Registered queries of the operators: each applies one to its whole table and returns its whole result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.bpe_codec import digests, encode_texts
from feedlake.llm.host_rules import COUNTS, quality_rules
from feedlake.llm.host_reputation import url_filter, url_parts
from feedlake.llm.jaccard_forest import jaccard_join
from feedlake.llm.layout_text import extract_text
from feedlake.llm.license_rules import license_scan
from feedlake.llm.merge_automaton import round_trip_digests
from feedlake.llm.orchard import centroid_clusters
from feedlake.llm.phrase_index import SLOP, contamination, item_digest
from feedlake.llm.rows import table
from feedlake.llm.skip_chain import personal_data, span_digest
from feedlake.llm.simple8b import read_ids, write_ids
from feedlake.llm.token_counts import count_tokens
from feedlake.llm.turn_alignment import damaged, repair_summary
from feedlake.workspace import new_dir

TOKEN_LIMIT = 1024


#: The hand rules.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op1_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page outcomes come from `labels`: a page's url ends in the id of its document; low quality or toxic is bad."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    doc = F.regexp_extract(url_parts(F.col("url"))[1], r"/([0-9]{1,18})[^/]*/?$", 1)
    bad = labels.groupBy("doc_id").agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    outcomes = pages.select("url", F.when(doc != "", doc).cast("bigint").alias("doc_id")).join(bad, "doc_id", "left")
    out = url_filter(pages, outcomes.select("url", "bad"), URL_RULES)
    return out.withColumn("rate", F.round("rate", 6))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), TOKEN_LIMIT)


def op3_simple8b_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = write_ids(docs, new_dir(spark, "token-ids"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_ids(spark, path, ids=False)


def op4_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).documents.select("doc_id", "class_id", "copy_of", "n_links")


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = encode_texts(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), decoded=True)
    return coded.select("doc_id", *digests(coded))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=SLOP)
    return found.select("doc_id", "n_words", "n_hit", *item_digest(found))


def op7_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents")).select("doc_id", *span_digest())


def op8_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan(table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *COUNTS, "base_failed", "kept", F.round("host_rate", 9).alias("host_rate"))


def op10_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_text(table(spark, sf_dir, "pages"))
    return out.select("page_id", F.length("text").cast("bigint").alias("n_chars"), "text")


def op11_turn_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_summary(damaged(conversations), ids=conversations)


def op12_orchard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(table(spark, sf_dir, "embeddings"), k=8, rounds=10, size=64, salt="3")


def op13_merge_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


_ALL = [
    op1_host_reputation,
    op2_token_counts,
    op3_simple8b_ids,
    op4_jaccard_forest,
    op5_bpe_codec,
    op6_decontamination,
    op7_skip_chain_pii,
    op8_license_rules,
    op9_quality_rules,
    op10_layout_text,
    op11_turn_alignment,
    op12_orchard_clusters,
    op13_merge_automaton,
]
QUERIES = {f.__name__: f for f in _ALL}
ORACLE: dict[str, str] = {}
