"""SRC-7, SRC-8: control-table lookups (FLT-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def access_zone_lookup(zones: DataFrame, zone_id: str) -> DataFrame:
    """SRC-7: location and database of one access zone."""
    return zones.where(F.col("accesszone_id") == F.lit(zone_id)).select("s3_location", "database_name")


def requested_columns(columns: DataFrame, request_id: str) -> DataFrame:
    """SRC-8: requested columns and their types for one request."""
    return columns.where(F.col("requestid") == F.lit(request_id)).select(
        "requestecol", F.col("data_type").alias("dtype")
    )
