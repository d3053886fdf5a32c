"""SRC-1, SRC-2, SRC-9: catalog scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.columns import check_batch_date
from feedlake.spec import BATCH_COLUMN


#: Fixed value: the partition Spark gives rows whose partition column is null.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC-1: full scan; column pruning and pushdown apply to whatever is selected downstream."""
    return spark.table(name)


def scan_batch(spark: SparkSession, name: str, batch_date: str) -> DataFrame:
    """SRC-2: one batchdate partition (static partition pruning on the literal)."""
    return spark.table(name).where(F.col(BATCH_COLUMN) == F.lit(check_batch_date(batch_date)))


def batch_partitions(spark: SparkSession, name: str) -> list[str] | None:
    """The table's batchdate partition values from catalog metadata (no file is opened).

    None when the table is not partitioned by batchdate in the catalog; the list has one entry per batch.
    """
    cols = [c for c in spark.catalog.listColumns(name) if c.isPartition]
    if [c.name for c in cols] != [BATCH_COLUMN]:
        return None
    prefix = f"{BATCH_COLUMN}="
    try:
        listed = spark.sql(f"SHOW PARTITIONS {name}").collect()
    except AnalysisException:  # partitions not tracked by this catalog: callers use the scalar subquery
        return None
    # rows without a batch date lie in a partition of their own, which is no batch
    return sorted(p for p in (r[0][len(prefix):] for r in listed) if p != NULL_PARTITION)


def latest_partition(spark: SparkSession, name: str, before: str | None = None) -> str | None:
    """Max batchdate partition (below `before` when given) from the catalog; None when there is none."""
    parts = batch_partitions(spark, name)
    if parts is None:
        raise ValueError(f"{name} is not partitioned by {BATCH_COLUMN}")
    if before is not None:
        parts = [p for p in parts if p < check_batch_date(before)]
    return parts[-1] if parts else None


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    """SRC-9: the table's columns as (col_name, data_type) rows in table order, from catalog metadata only."""
    fields = spark.table(name).schema.fields
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)]
    return spark.createDataFrame(rows, "ordinal int, col_name string, data_type string")
