"""Ingest pipelines (PIP-1..5): raw image, history snapshot, one-partition ingest, post-batch audit.

Job shape of an incremental load at scale (two writes, each one plan):
1. raw := delta stamped with the run's date  UNION  latest history batch (before the run's date)
   anti-joined with the delta's keys. The delta keys are the only thing that may be broadcast, and only
   when AQE has measured them small; otherwise both sides shuffle on the key and hot keys are split.
2. history[batchdate = d] := raw without batchdate, read back from the written raw table (the raw table
   is the materialised cut of lineage, so the join is never recomputed and a lost executor only re-reads
   raw files).
Both steps read history strictly before the run's date, so rerunning a batch repairs either table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.columns import check_batch_date, drop_batchdate, resolve_columns
from feedlake.operators.counts import count_batch
from feedlake.operators.snapshot import full_refresh, incremental_snapshot, snapshot_date
from feedlake.sinks.audit import audit_events, record_audit, record_values
from feedlake.sinks.tables import overwrite_partition, overwrite_raw, table_buckets
from feedlake.sources.tables import batch_partitions, latest_partition
from feedlake.spec import BATCH_COLUMN, DEFAULT_SNAPSHOT_DATE, PROVENANCE, REJECTED, FeedSpec
from feedlake.workspace import new_name, observed_metrics


def staged_batch(spark: SparkSession, spec: FeedSpec, batch_date: str) -> DataFrame:
    """The pre-raw rows of one batch. A pre-raw table with a batchdate column holds several batches, of which this one's
    partition is read; any other table is one batch."""
    rows = spark.table(spec.pre_raw_table)
    if BATCH_COLUMN not in rows.columns:
        return rows
    return rows.where(F.col(BATCH_COLUMN) == F.lit(check_batch_date(batch_date))).drop(BATCH_COLUMN)


def feed_rows(staged: DataFrame) -> DataFrame:
    """Staged rows without rejected lines and without the columns that staging adds."""
    if REJECTED in staged.columns:
        staged = staged.where(F.col(REJECTED).isNull())
    return staged.drop(*PROVENANCE)


def build_raw(spark: SparkSession, spec: FeedSpec, batch_date: str) -> DataFrame:
    """The raw image for one batch as a lazy plan (PIP-1 when incremental, else PIP-2)."""
    delta = feed_rows(staged_batch(spark, spec, batch_date))
    layout = table_buckets(spark, spec.raw_table)
    if spec.buckets is not None and (layout is None or layout[0] != spec.buckets):
        raise ValueError(f"{spec.raw_table} is not bucketed into {spec.buckets}: {layout}")
    if layout is not None:
        # hash the delta into the target's buckets, so a write task holds one bucket; REBALANCE (unlike
        # repartition) lets AQE split a bucket made hot by one key into several tasks
        delta = delta.hint("rebalance", layout[0], *resolve_columns(delta, layout[1]))
    if spec.incremental and spec.history_table:
        history = spark.table(spec.history_table)
        keys = resolve_columns(delta, spec.primary_key)
        how = {"bucketed": layout is not None, "filter_bits": spec.key_filter_bits}
        if batch_partitions(spark, spec.history_table) is None:
            return incremental_snapshot(delta, history, keys, batch_date, before=batch_date, **how)
        latest = latest_partition(spark, spec.history_table, before=batch_date)
        if latest is None:  # no earlier snapshot: the image is the delta alone
            return full_refresh(delta, batch_date)
        return incremental_snapshot(delta, history, keys, batch_date, latest=latest, **how)
    return full_refresh(delta, batch_date)


def load_raw(spark: SparkSession, spec: FeedSpec, batch_date: str) -> dict:
    """Write the raw image for the batch; returns delta and carried-forward row counts."""
    check_batch_date(batch_date)
    obs = Observation(new_name("raw_counts"))
    raw = build_raw(spark, spec, batch_date).observe(
        obs,
        F.count(F.when(F.col(BATCH_COLUMN) == batch_date, 1)).alias("delta"),
        F.count(F.when(F.col(BATCH_COLUMN) != batch_date, 1)).alias("unchanged"),
    )
    # counted while writing: no second pass over the snapshot
    overwrite_raw(raw, spec.raw_table, num_partitions=spec.num_partitions)
    counts = observed_metrics(obs)
    if counts is None:  # AQE may replace an empty plan, and with it the metrics node: count what was written
        counts = (
            spark.table(spec.raw_table)
            .agg(
                F.count(F.when(F.col(BATCH_COLUMN) == batch_date, 1)).alias("delta"),
                F.count(F.when(F.col(BATCH_COLUMN) != batch_date, 1)).alias("unchanged"),
            )
            .first()
            .asDict()
        )
    return {"delta": counts["delta"], "unchanged": counts["unchanged"]}


def history_snapshot(
    spark: SparkSession, raw_table: str, history_table: str, partition_date: str | None = None,
    num_partitions: int | None = None,
) -> str:
    """PIP-3: copy raw, minus batchdate, into history partition `partition_date`.

    Without a date the partition is raw's max batchdate (default 2001-01-31 when raw is empty), as in the
    reference: an empty delta then rewrites the previous snapshot and a backfill rewrites the latest one.
    """
    raw = spark.table(raw_table)
    if partition_date is None:
        if batch_partitions(spark, raw_table) is not None:
            partition_date = latest_partition(spark, raw_table) or DEFAULT_SNAPSHOT_DATE
        else:
            partition_date = snapshot_date(raw, DEFAULT_SNAPSHOT_DATE).first()[0]
    overwrite_partition(drop_batchdate(raw), history_table, partition_date, num_partitions)
    return partition_date


def ingest_partition(
    spark: SparkSession, df: DataFrame, table: str, batch_date: str, num_partitions: int | None = None,
    audit_path: str | None = None, stream: str = "",
) -> int:
    """PIP-4: no-history ingest: replace one batchdate partition with the staged rows, then count it; the count is an
    audit event too when audit_path is given.

    The reference fixed the output at 20 files (a COALESCE hint), which would also run the whole ingest in
    20 tasks; pass num_partitions=20 for that layout, the default keeps one file per input split.
    """
    overwrite_partition(df, table, batch_date, num_partitions)
    n = count_batch(spark.table(table), batch_date).first()["cnt"]
    if audit_path is not None:
        record_values(spark, audit_path, "ingest_partition", stream or table, batch_date, {"batch count": n})
    return n


def post_batch_audit(
    spark: SparkSession, raw_table: str, batch_date: str, audit_path: str | None = None, stream: str = ""
) -> int:
    """PIP-5: count of the batch's own (delta) rows in raw, recorded as an audit event."""
    n = count_batch(spark.table(raw_table), batch_date).first()["cnt"]  # partition-pruned count
    if audit_path is not None:
        one = spark.createDataFrame([(n,)], "cnt bigint")  # the single event row, from the one count
        ev = audit_events(
            one, "landing_to_raw", "post_batch_audit", stream, "Delta Count Raw",
            {"count": F.col("cnt"), "batchdate": F.lit(batch_date)},
        )
        record_audit(spark, audit_path, ev)
    return n
