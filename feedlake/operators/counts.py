"""Counts (AGG-1/2/3/6). Global counts are partial aggregates per task plus one tiny final merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions.columns import check_batch_date
from feedlake.spec import BATCH_COLUMN


def count_rows(df: DataFrame) -> DataFrame:
    """AGG-1: one row, cnt."""
    return df.agg(F.count(F.lit(1)).alias("cnt"))


def count_batch(df: DataFrame, batch_date: str) -> DataFrame:
    """AGG-2: one row, cnt of one batch (0 when the batch is absent)."""
    return df.where(F.col(BATCH_COLUMN) == F.lit(check_batch_date(batch_date))).agg(
        F.count(F.lit(1)).alias("cnt")
    )


def count_by_batch(df: DataFrame) -> DataFrame:
    """AGG-3: rows per batchdate."""
    return df.groupBy(BATCH_COLUMN).agg(F.count(F.lit(1)).alias("cnt"))


def is_empty(df: DataFrame) -> DataFrame:
    """AGG-6 as a lazy one-row frame; every task stops after its first row."""
    return df.select(F.lit(1).alias("one")).limit(1).agg((F.count(F.lit(1)) == 0).alias("is_empty"))
