"""Stages of corpus_pipeline.py: (spark, docs, sf_dir) -> DataFrame, each with the production parameters of its operator.

All but the last return the columns of documents and keep a row whole or drop it; PII rewrites the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.bpe_codec import encode_texts
from feedlake.llm.host_rules import quality_rules
from feedlake.llm.jaccard_forest import jaccard_join
from feedlake.llm.phrase_index import contamination
from feedlake.llm.rows import table
from feedlake.llm.skip_chain import personal_data as personal_spans
from feedlake.workspace import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the host-level quality rules keep."""
    return quality_rules(docs, keep=docs.columns).where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the class representative, once."""
    kept = jaccard_join(docs, list_links=False).documents.where("representative").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    kept = materialize(kept.distinct(), "near-duplicates-kept")
    rows = docs.withColumn("__hash_of", F.xxhash64("text"))
    same = rows["doc_id"].cast("bigint").eqNullSafe(kept["__id"]) & (rows["__hash_of"] == kept["__hash"])
    # both sides grow with the data: no broadcast; the join has dealt repeated rows together for the last step
    rows = rows.join(kept.hint("shuffle_merge"), same, "left_semi")
    return rows.dropDuplicates(["doc_id", "__hash_of"]).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark passage; a row is known by a hash of its id and text."""
    keyed = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    found = contamination(keyed, table(spark, sf_dir, "benchmark"), id_col="__row")
    hit = materialize(found.where("n_hit > 0").select(F.col("doc_id").alias("__row")).distinct(), "contaminated")
    return keyed.join(hit, "__row", "left_anti").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced by the kind in brackets and n_chars measured anew."""
    rest = [c for c in docs.columns if c != "text"]
    out = personal_spans(docs, keep=rest, redacted="text").withColumn("n_chars", F.length("text").cast("bigint"))
    return out.select(docs.columns)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the bytes that these ids decode to, of every document."""
    coded = encode_texts(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), decoded=True)
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded")
