"""The training-data pipeline: STAGES run in order, each on all rows its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlake.llm.stages import bpe_codec, decontamination, near_duplicates, personal_data, quality
from feedlake.workspace import materialize

STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("byte-level BPE encoding and decoding", bpe_codec),
]

#: The stages use trained and hashed methods that SQL cannot express; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through every stage; each stage's rows are written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
