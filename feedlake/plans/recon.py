"""Reconciliation (PIP-6..9): source extract vs one stored batch of raw.

At scale the difference (EXCEPT DISTINCT) shuffles both sides once on the whole row. It is then cut from
its lineage by writing it as Parquet into the shared folder (spark.checkpoint.dir): the emptiness test, the
count, the JSON report and the column report all read those files instead of re-running the EXCEPT (the
reference ran it four times). The column report is one left join of the difference with a per-key profile of raw
restricted to the difference's keys (see operators.compare).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from feedlake.functions.columns import (
    check_batch_date,
    drop_batchdate,
    drop_columns,
    fill_empty_strings,
    rename_columns,
    resolve_columns,
    split_list,
)
from feedlake.operators.compare import has_duplicate_keys, keyed_difference_report, mismatch_report
from feedlake.operators.setops import difference, pruned_difference
from feedlake.plans.ingest import post_batch_audit
from feedlake.sinks.audit import record_values
from feedlake.sinks.files import write_diff_json, write_info_csv
from feedlake.sources.files import scan_recon_source
from feedlake.spec import BATCH_COLUMN, ReconSpec
from feedlake.workspace import materialize


def prepare_raw(raw_batch: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Raw side: drop the partition column, apply the rename mapping."""
    return rename_columns(drop_batchdate(raw_batch), mapping)


def align_source(source: DataFrame, raw: DataFrame, drop: str | Iterable[str] = ()) -> DataFrame:
    """EXCEPT compares by position: when the source has every raw column (a table or JSON source), put them in
    raw's order by name, case-insensitively. Otherwise (delimited text read with raw's schema) keep it. A source column
    that raw lacks must be in the drop list: it could not be compared."""
    by_lower = {c.lower(): c for c in source.columns}
    dropped = {c.lower() for c in split_list(drop)} if isinstance(drop, str) else {c.lower() for c in drop}
    extra = [c for c in source.columns if c.lower() not in {r.lower() for r in raw.columns} | dropped]
    if extra:
        raise ValueError(f"source columns that raw lacks and the drop list does not name: {extra}")
    if all(c.lower() in by_lower for c in raw.columns):
        return source.select(*[by_lower[c.lower()] for c in raw.columns])
    return source


def recon_difference(
    source: DataFrame,
    raw: DataFrame,
    drop: str | Iterable[str] = (),
    fill_both: bool = False,
    pruned_by: str | Iterable[str] = (),
) -> DataFrame:
    """PIP-6: rows of the source (after the drop list) that are not in raw. Raw must be prepared. With `pruned_by` (key
    columns) only key buckets whose digests differ are compared (`operators.pruned_difference`)."""
    r = drop_columns(raw, drop)
    if fill_both:
        r = fill_empty_strings(r)
    if pruned_by:
        return pruned_difference(drop_columns(source, drop), r, pruned_by)
    return difference(drop_columns(source, drop), r)


def reconcile(spark: SparkSession, spec: ReconSpec, batch_date: str, audit_path: str | None = None) -> dict:
    """PIP-9: difference JSON under difference/batchdate=<d>/ and, with the column check, the mismatch and
    new-record report as CSV under additional_info/batchdate=<d>/. Returns counts (raw, input, difference) and paths;
    with audit_path the counts are audit events too."""
    check_batch_date(batch_date)
    raw_all = spark.table(spec.raw_table)
    raw_batch = raw_all.where(raw_all[BATCH_COLUMN] == batch_date)
    raw = prepare_raw(raw_batch, spec.mapping)
    source = align_source(scan_recon_source(spark, spec, raw.schema), raw, spec.drop_columns)
    if spec.keyed:
        r = drop_columns(raw, spec.drop_columns)
        if has_duplicate_keys(r, spec.primary_key):
            raise ValueError("keyed reconciliation needs keys unique in the raw batch")
        labelled = materialize(
            keyed_difference_report(drop_columns(source, spec.drop_columns),
                                    fill_empty_strings(r) if spec.fill_both else r, spec.primary_key,
                                    spec.null_safe, repeated=has_duplicate_keys(source, spec.primary_key)),
            "recon_keyed",
        )
        diff = labelled.drop("column_name")
    else:
        labelled = None
        by = spec.primary_key if spec.pruned else ()
        diff = materialize(recon_difference(source, raw, spec.drop_columns, spec.fill_both, by), "recon_difference")
    n_diff = diff.count()
    out = spec.output_path.rstrip("/")
    result = {
        "raw_count": raw_batch.count(),  # partition-pruned: Parquet footers only
        "input_count": source.count(),
        "difference": n_diff,
        "difference_path": None,
        "info_path": None,
    }
    if audit_path is not None:
        record_values(spark, audit_path, "reconciliation", spec.raw_table, batch_date,
                      {k: result[k] for k in ("raw_count", "input_count", "difference")})
    if n_diff == 0:
        return result
    diff_path = f"{out}/difference/{BATCH_COLUMN}={batch_date}"
    write_diff_json(diff, diff_path)
    result["difference_path"] = diff_path
    if spec.do_column_check:
        info_path = f"{out}/additional_info/{BATCH_COLUMN}={batch_date}"
        if labelled is not None:
            report = labelled.select(*resolve_columns(labelled, spec.primary_key), "column_name")
        else:
            r = drop_columns(raw, spec.drop_columns)
            report = mismatch_report(fill_empty_strings(r) if spec.fill_both else r, diff, spec.primary_key, spec.null_safe)
        write_info_csv(report, info_path)
        result["info_path"] = info_path
    return result


def after_load(
    spark: SparkSession, mode: str, raw_table: str, batch_date: str, spec: ReconSpec | None = None,
    audit_path: str | None = None, stream: str = "",
) -> dict | None:
    """The job that follows a load, by its flag as configured: exactly 'true' counts the batch (PIP-5), exactly 'false'
    reconciles it (PIP-9, which needs a spec); any other value does nothing and gives None."""
    if mode == "true":
        return {"audit_count": post_batch_audit(spark, raw_table, batch_date, audit_path, stream)}
    if mode == "false":
        if spec is None:
            raise ValueError("reconciliation needs a spec")
        return reconcile(spark, spec, batch_date, audit_path)
    return None
