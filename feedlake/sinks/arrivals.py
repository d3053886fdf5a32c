"""Staging of what is new in a landing folder (SRC-6, SNK-9): a ledger of the files that were staged before.

A file is known by its path, length and modification time. The ledger is a Parquet dataset, one row for each time a file
was staged, appended to after the staged rows are in the tables: a run that stops in between stages the same files again,
with the same result.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedlake.functions.columns import check_batch_date
from feedlake.sinks.files import create_staging, landing_rows, swap_in_staged
from feedlake.sources.files import landing_manifest
from feedlake.spec import BATCH_COLUMN, SOURCE_FILE
from feedlake.workspace import materialize

FILE_LEDGER_SCHEMA = f"path string, length bigint, modification_time timestamp, {SOURCE_FILE} string, {BATCH_COLUMN} string, staged_at timestamp"
VERSION = ["path", "length", "modification_time"]


def read_file_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All entries; no rows before the first."""
    try:
        return spark.read.schema(FILE_LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILE_LEDGER_SCHEMA)


def new_arrivals(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files of the listing that the ledger does not hold, or holds in another version: length or time differ from those of
    the file's latest entry. Files that are gone from the listing are no arrivals."""
    latest = ledger.groupBy("path").agg(F.max_by(F.struct("length", "modification_time"), "staged_at").alias("v"))
    return listing.join(latest.select("path", "v.length", "v.modification_time"), VERSION, "left_anti")


def stage_arrivals(
    spark: SparkSession,
    landing_path: str,
    pre_raw_table: str,
    quarantine_table: str,
    location: str,
    ledger_path: str,
    schema: StructType,
    sep: str,
    data_extension: str,
    batch_date: str | None = None,
    **options,
) -> dict[str, dict[str, int]]:
    """`stage_feed` that parses only files that are new or have changed since they were staged. Returns {batch: {good, bad}}
    for the batches that had such files, counting all their lines.

    Folders batchdate=<d> (the schema then contains batchdate) name a file's batch, and batch_date picks one of them.
    Otherwise the files that have arrived since the last call are the batch `batch_date`. A batch's rows from other files
    are carried over from the tables, as Parquet and without parsing; rows of a changed file take the place of its old
    ones in that batch, in both tables. A file that is gone, or of no bytes (Spark lists none such), stays staged, so landing
    folders may be cleaned. Within a batch files are told apart by name: two of one name raise ValueError. Batches without arrivals are not touched.

    The driver gets one path for each new file, as Spark's own listing does, and never a row of one.
    """
    by_folder = BATCH_COLUMN in schema.names
    if not by_folder and batch_date is None:
        raise ValueError("without batchdate folders a batch date is needed")
    listing = landing_manifest(spark, landing_path, data_extension).drop("file_class", "compressed")
    if by_folder:
        folder = F.regexp_extract("path", f"/{BATCH_COLUMN}=([^/]+)/[^/]+$", 1)
        listing = listing.withColumn(BATCH_COLUMN, folder).where(folder != "")
        if batch_date is not None:
            listing = listing.where(F.col(BATCH_COLUMN) == check_batch_date(batch_date))
    else:
        listing = listing.withColumn(BATCH_COLUMN, F.lit(check_batch_date(batch_date)))
    create_staging(spark, pre_raw_table, quarantine_table, location, schema)
    new = materialize(new_arrivals(listing, read_file_ledger(spark, ledger_path)), "arrivals")
    name = [BATCH_COLUMN, SOURCE_FILE]
    twice = new.groupBy(*name).count().where("count > 1").select(*name).take(1)
    if twice:
        raise ValueError(f"two files of one name in a batch: {twice[0][SOURCE_FILE]} in {twice[0][BATCH_COLUMN]}")
    files = new.select("path", BATCH_COLUMN).collect()
    if not files:
        return {}
    counts = {f[BATCH_COLUMN]: {"good": 0, "bad": 0} for f in files}
    root = {"basePath": landing_path} if by_folder else {}
    fresh = landing_rows(spark, [_literal(f["path"]) for f in files], schema, sep, data_extension, None, {**root, **options})
    fresh = fresh.withColumn(BATCH_COLUMN, F.col(BATCH_COLUMN).cast("string") if by_folder else F.lit(batch_date))
    for table in (pre_raw_table, quarantine_table):
        held = spark.table(table).where(F.col(BATCH_COLUMN).isin(sorted(counts)))
        fresh = fresh.unionByName(held.join(new.select(*name), name, "left_anti"), allowMissingColumns=True)
    swap_in_staged(fresh, pre_raw_table, quarantine_table, location, counts)
    new.withColumn("staged_at", F.current_timestamp()).select(*spark.createDataFrame([], FILE_LEDGER_SCHEMA).columns).write.mode("append").parquet(ledger_path)
    return counts


def _literal(path: str) -> str:
    """A path without a character that Spark would take as a pattern's."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)
