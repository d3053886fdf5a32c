"""Validation (PIP-10, PIP-11): staged files vs the pre-raw table, and the schema gate.

The schema gate's data rules run as one global aggregate (partial per task, one tiny merge) plus one
grouped count for duplicate keys, whose map-side combine collapses hot keys before the shuffle.
"""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from feedlake.functions.columns import ddl_type, fill_empty_strings, try_cast
from feedlake.operators.setops import difference
from feedlake.sinks.audit import record_values
from feedlake.sinks.files import write_diff_json
from feedlake.sources.files import scan_delimited
from feedlake.spec import BATCH_COLUMN, PROVENANCE, REJECTED, SOURCE_FILE, split_list
from feedlake.workspace import materialize

CHECK_SCHEMA = "check string, column_name string, violations bigint"


class ValidationError(RuntimeError):
    pass


def validate_files(
    spark: SparkSession,
    files_path: str,
    table: DataFrame,
    sep: str,
    output_path: str | None = None,
    fail_on_diff: bool = False,
) -> tuple[int, DataFrame]:
    """PIP-10: staged files (read with the table's schema, string nulls filled with '') minus the table.

    Differences are counted and written as JSON; the load goes on unless fail_on_diff is set.
    """
    files = fill_empty_strings(scan_delimited(spark, files_path, table.schema, sep))
    diff = materialize(difference(files, table), "file_difference")
    n = diff.count()
    if n and output_path:
        write_diff_json(diff, output_path)
    if n and fail_on_diff:
        raise ValidationError(f"{n} staged rows differ from the table")
    return n, diff


def _target_fields(target: StructType | Iterable[tuple[str, str]]) -> list[StructField]:
    if isinstance(target, StructType):
        return list(target.fields)
    return [StructField(n, ddl_type(t), True) for n, t in target]


def schema_checks(
    df: DataFrame, target: StructType | Iterable[tuple[str, str]], keys: str | Iterable[str], evidence: bool = False
) -> DataFrame:
    """PIP-11 report: (check, column_name, violations) for
    missing_column, extra_column, column_order (metadata), uncastable, null_key, duplicate_key (data).

    Columns that staging adds (`spec.PROVENANCE`) are known and no extra columns; rejected lines are counted.
    With `evidence` two more columns, first_example and last_example, show the violating rows whose JSON text (keys, value,
    source file) sorts first and last: a minimum and a maximum in the same aggregates, so two rows a rule whatever
    their number, and no further scan. They are null for rules about columns and where nothing is wrong.
    """
    spark = df.sparkSession
    fields = _target_fields(target)
    tnames = [f.name.lower() for f in fields]
    dnames = {c.lower(): c for c in df.columns}
    meta = [("missing_column", f.name, 1) for f in fields if f.name.lower() not in dnames]
    meta += [("extra_column", c, 1) for c in df.columns if c.lower() not in tnames and c not in PROVENANCE]
    common_t = [n for n in tnames if n in dnames]
    common_d = [c.lower() for c in df.columns if c.lower() in tnames]
    meta += [("column_order", dnames[a], 1) for a, b in zip(common_t, common_d) if a != b]

    types = {f.name: f.dataType for f in df.schema.fields}
    named = split_list(keys) if isinstance(keys, str) else list(keys)
    meta += [("missing_column", k, 1) for k in named if k.lower() not in dnames and k.lower() not in tnames]
    key_cols = [dnames[k.lower()] for k in named if k.lower() in dnames]
    row = [F.col(k) for k in key_cols]
    origin = [F.col(SOURCE_FILE)] if SOURCE_FILE in df.columns else []

    def found(check: str, column: str, violations: Column, bad: Column | None = None, shown: list[Column] = ()) -> Column:
        parts = [F.lit(check).alias("check"), F.lit(column).alias("column_name"), violations.alias("violations")]
        if evidence:
            example = F.lit(None).cast("string") if bad is None else F.when(bad, F.to_json(F.struct(*row, *shown, *origin)))
            parts += [F.min(example).alias("first_example"), F.max(example).alias("last_example")]
        return F.struct(*parts)

    checks: list[Column] = []
    for f in fields:
        c = dnames.get(f.name.lower())
        if c is None:
            continue
        if types[c] == f.dataType:  # nothing to cast: no per-row work
            checks.append(found("uncastable", f.name, F.lit(0).cast("bigint")))
        else:
            bad = F.col(c).isNotNull() & try_cast(F.col(c), types[c], f.dataType).isNull()
            checks.append(found("uncastable", f.name, F.count(F.when(bad, 1)), bad, [F.col(c).cast("string").alias("value")]))
    if REJECTED in df.columns:
        bad = F.col(REJECTED).isNotNull()
        checks.append(found("rejected_line", REJECTED, F.count(REJECTED), bad, [F.col(REJECTED).alias("value")]))
    for k in key_cols:
        bad = F.col(k).isNull()
        checks.append(found("null_key", k, F.count(F.when(bad, 1)), bad, [F.lit(None).cast("string").alias("value")]))
    columns = ["check", "column_name", F.col("violations").cast("bigint")]
    if evidence:
        columns += ["first_example", "last_example"]
    start = spark.createDataFrame(meta, CHECK_SCHEMA)
    if evidence:
        start = start.withColumns({c: F.lit(None).cast("string") for c in ("first_example", "last_example")})
    parts = [start]
    if checks:
        parts.append(df.agg(F.array(*checks).alias("r")).select(F.inline("r")))
    if key_cols:
        repeated = F.when(F.col("n") > 1, F.to_json(F.struct(*row, F.col("n"))))
        shown = [F.min(repeated).alias("first_example"), F.max(repeated).alias("last_example")] if evidence else []
        dup = (
            df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("violations"), *shown)
            .withColumns({"check": F.lit("duplicate_key"), "column_name": F.lit(",".join(key_cols))})
        )
        parts.append(dup)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p.select(*columns))
    return out


def validate_schema(
    df: DataFrame, target: StructType | Iterable[tuple[str, str]], keys: str | Iterable[str]
) -> tuple[bool, DataFrame]:
    """PIP-11 gate: passes when no check has violations. Returns (passed, report); the report is computed once and read
    from the shared folder (some rows a column)."""
    report = materialize(schema_checks(df, target, keys, evidence=True), "schema-report")
    failed = report.where(F.col("violations") > 0).limit(1).count()
    return failed == 0, report


def validate_landing(
    spark: SparkSession,
    pre_raw_table: str,
    target_table: str,
    keys: str | Iterable[str],
    files_path: str | None = None,
    sep: str = ",",
    output_path: str | None = None,
    output_prefix: str | None = None,
    audit_path: str | None = None,
) -> dict:
    """The validation job: staged files vs the pre-raw table (skipped without files_path), then the schema
    gate against the target table's columns (batchdate excluded). A failed gate raises ValidationError;
    file differences are reported and do not stop the load (reference behaviour). Differences go to
    output_path, or to <output_prefix>/<UTC run time yyyyMMddHHmmss>. With audit_path both outcomes are audit events,
    recorded before a failed gate raises."""
    table = spark.table(pre_raw_table)
    # the files hold the feed's columns alone: without what staging adds, and the batch column that folders supply
    fed = table.drop(*PROVENANCE) if REJECTED not in table.columns else table.where(F.col(REJECTED).isNull()).drop(*PROVENANCE)
    if SOURCE_FILE in table.columns:
        table, fed = table.drop(BATCH_COLUMN), fed.drop(BATCH_COLUMN)
    result: dict = {"file_differences": None}
    if output_path is None and output_prefix is not None:
        output_path = f"{output_prefix.rstrip('/')}/{time.strftime('%Y%m%d%H%M%S', time.gmtime())}"
    if files_path is not None:
        result["file_differences"], _ = validate_files(spark, files_path, fed, sep, output_path)
        result["output_path"] = output_path
    target = [(f.name, f.dataType.simpleString()) for f in spark.table(target_table).schema.fields
              if f.name != "batchdate"]
    ok, report = validate_schema(table, target, keys)
    if audit_path is not None:
        found = result["file_differences"]
        record_values(spark, audit_path, "validation", pre_raw_table, None,
                      {"file differences": "skipped" if found is None else found, "schema result": str(ok).lower()})
    if not ok:
        bad = report.where(F.col("violations") > 0).collect()  # at most a few rows a column
        raise ValidationError(f"schema validation failed: {[tuple(v for v in r if v is not None) for r in bad]}")
    result["schema_ok"] = True
    return result
