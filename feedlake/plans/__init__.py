"""Composite pipelines (the user-level operators): ingest, reconcile, validate, deliver, run_feed."""

from feedlake.plans.delivery import deliver_request, render_request_sql, run_request_sql
from feedlake.plans.feed import run_feed, run_landing
from feedlake.plans.ingest import build_raw, history_snapshot, ingest_partition, load_raw, post_batch_audit
from feedlake.plans.ledger import BatchLedger, committed_batches, read_ledger
from feedlake.plans.recon import after_load, align_source, prepare_raw, recon_difference, reconcile
from feedlake.plans.validate import (
    ValidationError,
    schema_checks,
    validate_files,
    validate_landing,
    validate_schema,
)

__all__ = [
    "BatchLedger",
    "ValidationError",
    "after_load",
    "align_source",
    "build_raw",
    "committed_batches",
    "deliver_request",
    "history_snapshot",
    "ingest_partition",
    "load_raw",
    "post_batch_audit",
    "prepare_raw",
    "recon_difference",
    "read_ledger",
    "reconcile",
    "render_request_sql",
    "run_feed",
    "run_landing",
    "run_request_sql",
    "schema_checks",
    "validate_files",
    "validate_landing",
    "validate_schema",
]
