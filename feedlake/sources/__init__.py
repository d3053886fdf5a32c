"""Scans: catalog tables, batch partitions, delimited/JSON files with a borrowed schema, landing listings."""

from feedlake.sources.control import access_zone_lookup, requested_columns
from feedlake.sources.files import (
    TEXT_OPTIONS,
    landing_manifest,
    scan_delimited,
    scan_json,
    scan_recon_source,
)
from feedlake.sources.tables import batch_partitions, latest_partition, scan_batch, scan_table, table_columns

__all__ = [
    "TEXT_OPTIONS",
    "access_zone_lookup",
    "batch_partitions",
    "latest_partition",
    "landing_manifest",
    "requested_columns",
    "scan_batch",
    "scan_delimited",
    "scan_json",
    "scan_recon_source",
    "scan_table",
    "table_columns",
]
