"""feedlake: batch feed pipelines (stage, validate, snapshot, reconcile, deliver) on Spark DataFrames.

Every operator is a DataFrame -> DataFrame function built from Spark's own relational primitives, so
Catalyst plans it and the work runs on the executors. Sinks and pipelines are the only places that act.
"""

from feedlake.spec import FeedSpec, ReconSpec, RequestSpec
from feedlake.plans import (
    deliver_request,
    history_snapshot,
    ingest_partition,
    load_raw,
    post_batch_audit,
    reconcile,
    run_feed,
    validate_landing,
    validate_schema,
)
from feedlake.sinks import create_feed_table, publish_fanout, stage_landing
from feedlake.sources import landing_manifest

__all__ = [
    "FeedSpec",
    "ReconSpec",
    "RequestSpec",
    "create_feed_table",
    "deliver_request",
    "history_snapshot",
    "ingest_partition",
    "landing_manifest",
    "load_raw",
    "post_batch_audit",
    "publish_fanout",
    "reconcile",
    "run_feed",
    "stage_landing",
    "validate_landing",
    "validate_schema",
]
