"""Sinks: table writes, reports, fan-out publication, landing staging, audit events."""

from feedlake.sinks.arrivals import new_arrivals, read_file_ledger, stage_arrivals
from feedlake.sinks.audit import audit_events, read_audit, record_audit, record_values
from feedlake.sinks.files import overwrite_batch, publish_fanout, stage_feed, stage_landing, write_diff_json, write_info_csv
from feedlake.sinks.tables import (
    append_raw,
    coalesce_output,
    create_feed_table,
    create_target,
    load_target,
    overwrite_partition,
    overwrite_raw,
    point_partitions,
    replace_target,
    swap_table,
)

__all__ = [
    "append_raw",
    "audit_events",
    "coalesce_output",
    "create_feed_table",
    "create_target",
    "load_target",
    "new_arrivals",
    "overwrite_batch",
    "overwrite_partition",
    "overwrite_raw",
    "point_partitions",
    "publish_fanout",
    "read_audit",
    "read_file_ledger",
    "record_audit",
    "record_values",
    "replace_target",
    "stage_arrivals",
    "stage_feed",
    "stage_landing",
    "swap_table",
    "write_diff_json",
    "write_info_csv",
]
