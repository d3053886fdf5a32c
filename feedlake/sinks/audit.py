"""SNK-10: audit events (message + argument map) appended to an audit table, built on the executors."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = (
    "process string, job string, stream string, message string, args map<string,string>, event_time timestamp"
)
AUDIT_COLUMNS = [c.split(" ")[0] for c in AUDIT_SCHEMA.split(", ")]


def audit_events(
    rows: DataFrame, process: str, job: str, stream: str, message: str | Column, args: Mapping[str, Column]
) -> DataFrame:
    """One audit event per row of `rows` (e.g. one per batch of a grouped count)."""
    kv = []
    for k, v in args.items():
        kv += [F.lit(k), v.cast("string")]
    return rows.select(
        F.lit(process).alias("process"),
        F.lit(job).alias("job"),
        F.lit(stream).alias("stream"),
        (message if isinstance(message, Column) else F.lit(message)).alias("message"),
        F.create_map(*kv).alias("args"),
        F.current_timestamp().alias("event_time"),
    )


def record_audit(spark: SparkSession, path: str, events: DataFrame) -> None:
    """Append audit events to the Parquet audit table at `path`."""
    events.select(*AUDIT_COLUMNS).write.mode("append").parquet(path)


def replace_audit(path: str, events: DataFrame, key: str) -> None:
    """The events of one step of one batch, in the place of those written under the same key before: a rerun leaves one
    copy. Other keys' events are kept. A table takes events either by key or by `record_audit`, not both."""
    kept = events.select(*AUDIT_COLUMNS).withColumn("event_key", F.lit(key))
    (kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_key").parquet(path))


def record_values(
    spark: SparkSession, path: str, job: str, stream: str, batch_date: str | None, values: Mapping[str, object],
    key: str | None = None,
) -> None:
    """One event for each message and value a job has found (counts and outcomes, a handful a run); with a key they
    replace that key's events."""
    rows = spark.createDataFrame([(m, str(v)) for m, v in values.items()], "message string, value string")
    args = {"value": F.col("value"), "batchdate": F.lit(batch_date)}
    events = audit_events(rows, "landing_to_raw", job, stream, F.col("message"), args)
    if key is None:
        record_audit(spark, path, events)
    else:
        replace_audit(path, events, key)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(path).select(*AUDIT_COLUMNS)
