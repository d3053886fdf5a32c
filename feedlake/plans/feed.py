"""run_feed: schema gate -> raw -> history -> audit for one staged batch (a thin convenience, design)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feedlake.operators.counts import count_batch, count_rows
from feedlake.plans.ingest import history_snapshot, load_raw, post_batch_audit, staged_batch
from feedlake.plans.ledger import BatchLedger
from feedlake.plans.validate import ValidationError, validate_schema
from feedlake.sinks.arrivals import stage_arrivals
from feedlake.sinks.audit import record_values
from feedlake.sinks.files import stage_feed
from feedlake.spec import BATCH_COLUMN, FeedSpec


def _gate(spark: SparkSession, spec: FeedSpec, batch_date: str) -> None:
    raw_schema = spark.table(spec.raw_table).schema
    target = [(f.name, f.dataType.simpleString()) for f in raw_schema.fields if f.name != BATCH_COLUMN]
    ok, report = validate_schema(staged_batch(spark, spec, batch_date), target, spec.primary_key)
    if not ok:
        bad = report.where(F.col("violations") > 0).collect()  # at most a few rows a column
        raise ValidationError(f"schema validation failed: {[tuple(v for v in r if v is not None) for r in bad]}")


def run_feed(
    spark: SparkSession, spec: FeedSpec, batch_date: str, audit_path: str | None = None, check_schema: bool = True,
    ledger_path: str | None = None, run_id: str = "1",
) -> dict:
    """Load one batch: schema gate on the pre-raw table, raw image, history partition, audit count.

    With ledger_path each step is journalled (`plans.ledger`): calling again with the same run id after a stop takes the
    run up where it stood, and a finished run is not loaded again; its audit events are then kept by batch, once.
    """
    if ledger_path is not None:
        return _run_journalled(spark, spec, batch_date, audit_path, check_schema, BatchLedger(spark, ledger_path, spec.raw_table, batch_date, run_id))
    result: dict = {"batch_date": batch_date}
    if check_schema:
        _gate(spark, spec, batch_date)
    prior = count_rows(spark.table(spec.raw_table)).first()["cnt"]
    result.update(load_raw(spark, spec, batch_date))
    if spec.history_table:
        result["history_partition"] = history_snapshot(
            spark, spec.raw_table, spec.history_table, batch_date, spec.num_partitions
        )
    if audit_path is not None:
        record_values(spark, audit_path, "ingest_into_raw", spec.pre_raw_table, batch_date, {
            "base table count": prior,
            "unchanged rec count": result["unchanged"],
            "Partition Date": result.get("history_partition", batch_date),
        })
    result["audit_count"] = post_batch_audit(spark, spec.raw_table, batch_date, audit_path, spec.pre_raw_table)
    return result


def _run_journalled(
    spark: SparkSession, spec: FeedSpec, batch_date: str, audit_path: str | None, check_schema: bool, ledger: BatchLedger
) -> dict:
    def gate() -> dict:
        if check_schema:
            _gate(spark, spec, batch_date)
        return {"checked": check_schema}

    def audit() -> dict:
        n = post_batch_audit(spark, spec.raw_table, batch_date)
        if audit_path is not None:
            record_values(spark, audit_path, "ingest_into_raw", spec.pre_raw_table, batch_date, {
                "base table count": raw["prior"], "unchanged rec count": raw["unchanged"],
                "Partition Date": history.get("partition", batch_date), "Delta Count Raw": n,
            }, key=f"{spec.raw_table} {batch_date} ingest_into_raw")
        return {"count": n}

    ledger.step("gate", gate)
    # the count before the load belongs to the entry made before it: a repeated load would count its own rows
    raw = ledger.step("raw", lambda: load_raw(spark, spec, batch_date),
                      before=lambda: {"prior": count_rows(spark.table(spec.raw_table)).first()["cnt"]})
    history: dict = {}
    if spec.history_table:
        history = ledger.step("history", lambda: {"partition": history_snapshot(
            spark, spec.raw_table, spec.history_table, batch_date, spec.num_partitions)})
    count = ledger.step("audit", audit)["count"]
    result = {"batch_date": batch_date, "delta": int(raw["delta"]), "unchanged": int(raw["unchanged"])}
    if history:
        result["history_partition"] = history["partition"]
    return {**result, "audit_count": int(count)}


def run_landing(
    spark: SparkSession,
    spec: FeedSpec,
    batch_date: str,
    landing_path: str,
    quarantine_table: str,
    location: str,
    sep: str = ",",
    data_extension: str = "csv",
    max_rejected: float | None = None,
    audit_path: str | None = None,
    ledger_path: str | None = None,
    run_id: str = "1",
    file_ledger: str | None = None,
) -> dict:
    """One batch from its landing files to history: stage (good lines and bad ones apart), schema gate, raw, history, audit.

    The feed's schema is raw's. Bad lines lie in the quarantine table with their file's name and do not stop the load,
    unless their share of the batch is over `max_rejected`; then, as when the gate fails, raw and history stay as they are.
    With ledger_path staging is a journalled step like the others of `run_feed`. With file_ledger only files that are new or
    changed since they were staged are parsed (`sinks.stage_arrivals`); the counts are still those of the whole batch.
    """
    schema = StructType([f for f in spark.table(spec.raw_table).schema.fields if f.name != BATCH_COLUMN])
    folders = StructType([*schema.fields, StructField(BATCH_COLUMN, StringType())]) if _by_folder(spark, landing_path) else schema

    def stage() -> dict:
        if file_ledger is None:
            found = stage_feed(spark, landing_path, spec.pre_raw_table, quarantine_table, location, folders, sep, data_extension, batch_date)[batch_date]
        else:
            stage_arrivals(spark, landing_path, spec.pre_raw_table, quarantine_table, location, file_ledger, folders, sep, data_extension, batch_date)
            found = {kind: count_batch(spark.table(t), batch_date).first()["cnt"] for kind, t in (("good", spec.pre_raw_table), ("bad", quarantine_table))}
        if audit_path is not None:
            record_values(spark, audit_path, "stage_landing", spec.pre_raw_table, batch_date,
                          {"staged rows": found["good"], "quarantined lines": found["bad"]},
                          key=f"{spec.raw_table} {batch_date} stage_landing" if ledger_path is not None else None)
        return found

    if ledger_path is None:
        staged = stage()
    else:
        done = BatchLedger(spark, ledger_path, spec.raw_table, batch_date, run_id).step("stage", stage)
        staged = {k: int(done[k]) for k in ("good", "bad")}
    lines = staged["good"] + staged["bad"]
    if max_rejected is not None and staged["bad"] > max_rejected * lines:
        raise ValidationError(f"{staged['bad']} of {lines} lines do not fit the schema")
    return {**staged, **run_feed(spark, spec, batch_date, audit_path, ledger_path=ledger_path, run_id=run_id)}


def _by_folder(spark: SparkSession, landing_path: str) -> bool:
    """Whether the landing folder has batchdate=<d> folders, from Spark's own listing (no file is opened)."""
    listing = spark.read.format("binaryFile").load(landing_path)
    return BATCH_COLUMN in listing.columns
