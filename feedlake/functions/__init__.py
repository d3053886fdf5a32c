"""Projections and scalar column functions (JVM-side built-ins only)."""

from feedlake.functions.columns import (
    array_to_string,
    cast_to_schema,
    drop_batchdate,
    drop_columns,
    fill_empty_strings,
    keys_with_label,
    mismatch_array,
    mismatch_flag,
    prefix_nonkey,
    rename_columns,
    resolve_columns,
    try_cast,
    with_batchdate,
)

__all__ = [
    "array_to_string",
    "cast_to_schema",
    "drop_batchdate",
    "drop_columns",
    "fill_empty_strings",
    "keys_with_label",
    "mismatch_array",
    "mismatch_flag",
    "prefix_nonkey",
    "rename_columns",
    "resolve_columns",
    "try_cast",
    "with_batchdate",
]
