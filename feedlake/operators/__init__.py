"""Relational operators of the feed pipeline, each a lazy DataFrame -> DataFrame function."""

from feedlake.operators.compare import (
    anti_join_keys,
    has_duplicate_keys,
    key_profile,
    keyed_difference_report,
    mismatch_flags,
    mismatch_report,
    pair_on_keys,
    recon_mismatch,
    recon_new_records,
)
from feedlake.operators.counts import count_batch, count_by_batch, count_rows, is_empty
from feedlake.operators.keyfilter import key_bitmap, split_by_keys
from feedlake.operators.setops import bucket_digests, concat, difference, pruned_difference
from feedlake.operators.snapshot import (
    count_unchanged,
    full_refresh,
    incremental_snapshot,
    latest_batch,
    snapshot_date,
    unchanged_records,
    unmatched_rows,
    where_batch,
)

__all__ = [
    "anti_join_keys",
    "bucket_digests",
    "concat",
    "count_batch",
    "count_by_batch",
    "count_rows",
    "count_unchanged",
    "difference",
    "full_refresh",
    "has_duplicate_keys",
    "incremental_snapshot",
    "is_empty",
    "key_profile",
    "keyed_difference_report",
    "key_bitmap",
    "latest_batch",
    "mismatch_flags",
    "mismatch_report",
    "pair_on_keys",
    "pruned_difference",
    "recon_mismatch",
    "recon_new_records",
    "snapshot_date",
    "split_by_keys",
    "unchanged_records",
    "unmatched_rows",
    "where_batch",
]
