"""File sinks (SNK-4/5/8/9): reports, fan-out publication, landing staging."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feedlake.functions.columns import check_batch_date
from feedlake.sources.files import TEXT_OPTIONS, scan_delimited
from feedlake.sinks.tables import create_feed_table, point_partitions
from feedlake.spec import BATCH_COLUMN, REJECTED, SOURCE_FILE
from feedlake.workspace import new_name, observed_metrics


def write_diff_json(df: DataFrame, path: str) -> None:
    """SNK-4: difference rows as JSON lines (null fields omitted); a rerun replaces the batch's folder."""
    df.write.mode("overwrite").options(**TEXT_OPTIONS).json(path)


def write_info_csv(df: DataFrame, path: str) -> None:
    """SNK-5: mismatch information as CSV with a header line."""
    df.write.mode("overwrite").options(**TEXT_OPTIONS).csv(path, header=True)


def overwrite_batch(df: DataFrame, path: str, batch_date: str) -> str:
    """Replace the folder <path>/batchdate=<d> by the frame's rows; returns it.

    The rows are staged and swapped in at commit (dynamic overwrite), so a failed write leaves the old batch. An empty
    frame would leave it too, so then, and only then, the folder is overwritten by itself.
    """
    out, root = f"{path.rstrip('/')}/{BATCH_COLUMN}={check_batch_date(batch_date)}", path.rstrip("/")
    seen = Observation(new_name("batch_rows"))
    rows = df.drop(BATCH_COLUMN)
    stamped = rows.observe(seen, F.count(F.lit(1)).alias("n")).withColumn(BATCH_COLUMN, F.lit(batch_date))
    (stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COLUMN).parquet(root))
    written = observed_metrics(seen)
    if (written["n"] == 0) if written else rows.isEmpty():
        df.sparkSession.createDataFrame([], rows.schema).write.mode("overwrite").parquet(out)
    return out


def publish_fanout(df: DataFrame, targets: Iterable[str], batch_date: str | None = None) -> list[str]:
    """SNK-8: publish one feed to several targets as Parquet under batchdate=<d>/.

    With batch_date the frame is one batch, evaluated once: it replaces the first target's
    <target>/batchdate=<d>/ folder, and the other targets copy that folder's Parquet files through Spark, so
    an expensive source plan never runs twice. Without batch_date the frame carries a batchdate column and
    every batch is written to every target (other batches of a target are kept); the frame should then be a
    materialised table, since each target scans it. Either way rows are staged and swapped in at commit: a failed
    publication leaves each target's old batch.
    """
    written: list[str] = []
    source = df.drop(BATCH_COLUMN) if batch_date is not None else df
    for t in targets:
        t = t.rstrip("/")
        if batch_date is not None:
            out = overwrite_batch(source, t, batch_date)
            if not written:  # the folder holds exactly this batch: copy it for the other targets
                source = df.sparkSession.read.schema(source.schema).parquet(out)
        else:
            out = t
            (source.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(BATCH_COLUMN).parquet(out))
        written.append(out)
    return written


def landing_rows(
    spark: SparkSession, landing_path: str | list[str], schema: StructType, sep: str, data_extension: str, batch_date: str | None, options: dict
) -> DataFrame:
    """Lines of the selected landing files in the feed's schema, with rejected_line and source_file; a batchdate column only
    without batch_date, by which the rows are picked if the schema has the column."""
    ext = data_extension.lstrip(".")
    opts = {"pathGlobFilter": f"*.{{{ext},{ext}.gz}}", "columnNameOfCorruptRecord": REJECTED, **options}
    df = scan_delimited(spark, landing_path, StructType(schema.fields + [StructField(REJECTED, StringType())]),
                        sep, **opts).withColumn(SOURCE_FILE, F.col("_metadata.file_name"))
    if batch_date is None:
        return df
    if BATCH_COLUMN in schema.names:
        df = df.where(F.col(BATCH_COLUMN).cast("string") == batch_date)
    return df.drop(BATCH_COLUMN)


def stage_landing(
    spark: SparkSession,
    landing_path: str,
    staged_path: str,
    schema: StructType,
    sep: str,
    data_extension: str,
    batch_date: str | None = None,
    **options,
) -> DataFrame:
    """SNK-9: stage landing files (plain or .gz, chosen by extension) into Parquet pre-raw files.

    Reads every selected file in parallel with the feed's schema, tags each row with its source file
    name, and writes Parquet. A line that does not fit the schema (a value that does not parse, a field too many or
    too few) keeps its whole text in `rejected_line`, which the schema gate counts; it is null for good lines.
    Without batch_date the landing folders' batchdate=<d> directories supply it (the schema must then contain
    batchdate) and one folder per batch is written; batches staged before are kept. With batch_date and a schema
    that contains batchdate only that batch's rows are staged; without it every row is stamped with the date.
    A failed staging leaves every batch staged before. `stage_feed` stages into tables and keeps bad lines apart.
    """
    df = landing_rows(spark, landing_path, schema, sep, data_extension, batch_date, options)
    out = staged_path.rstrip("/")
    if batch_date is not None:
        overwrite_batch(df, out, batch_date)
    else:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_COLUMN).parquet(out))
    staged = StructType([f for f in df.schema.fields if f.name != BATCH_COLUMN]).add(BATCH_COLUMN, "string")
    result = spark.read.schema(staged).parquet(out)
    return result if batch_date is None else result.where(F.col(BATCH_COLUMN) == batch_date)


def stage_feed(
    spark: SparkSession,
    landing_path: str,
    pre_raw_table: str,
    quarantine_table: str,
    location: str,
    schema: StructType,
    sep: str,
    data_extension: str,
    batch_date: str | None = None,
    **options,
) -> dict[str, dict[str, int]]:
    """SNK-9 into tables that the gate and the load take as they are: good lines to the pre-raw table, lines that do not fit
    the schema to the quarantine table (rejected_line, source_file), both by batchdate. Returns {batch: {good, bad}}.

    One pass over the files writes both, parted by a flag, into a fresh folder below `location`. Only when all is written
    do the tables' partitions of the staged batches move to the new folders (or go, where a batch now has no such line);
    until then, and after a failure, both tables show what they showed. The tables are created if they do not exist.
    Batches come from batch_date or from the landing folders, as in `stage_landing`.
    """
    df = landing_rows(spark, landing_path, schema, sep, data_extension, batch_date, options)
    if batch_date is not None:
        df = df.withColumn(BATCH_COLUMN, F.lit(check_batch_date(batch_date)))
    create_staging(spark, pre_raw_table, quarantine_table, location, schema)
    counts: dict[str, dict[str, int]] = {} if batch_date is None else {batch_date: {"good": 0, "bad": 0}}
    return swap_in_staged(df, pre_raw_table, quarantine_table, location, counts)


def create_staging(spark: SparkSession, pre_raw_table: str, quarantine_table: str, location: str, schema: StructType) -> None:
    """The pre-raw and the quarantine table of a feed, if they do not exist."""
    body = [f for f in schema.fields if f.name != BATCH_COLUMN]
    for name, fields in ((pre_raw_table, body), (quarantine_table, [StructField(REJECTED, StringType())])):
        layout = StructType([*fields, StructField(SOURCE_FILE, StringType()), StructField(BATCH_COLUMN, StringType())])
        create_feed_table(spark, name, layout, f"{location.rstrip('/')}/{name.rpartition('.')[2]}")


def swap_in_staged(
    df: DataFrame, pre_raw_table: str, quarantine_table: str, location: str, counts: dict[str, dict[str, int]]
) -> dict[str, dict[str, int]]:
    """Write lines parted into good and bad ones into a fresh folder, then move both tables' partitions there; returns
    {batch: {good, bad}}. Batches of `counts` without a line are emptied."""
    spark, flag, fresh = df.sparkSession, "quarantined", f"{location.rstrip('/')}/{new_name('staging')}"
    day = F.col(BATCH_COLUMN).cast("string")
    out = df.withColumn(BATCH_COLUMN, day).withColumn(flag, F.col(REJECTED).isNotNull())
    out.write.partitionBy(flag, BATCH_COLUMN).parquet(fresh)
    # partition values and row counts from the folders and footers: one row a batch and kind
    found = spark.read.schema(StructType().add(flag, "boolean").add(BATCH_COLUMN, "string")).parquet(fresh)
    for r in found.groupBy(flag, BATCH_COLUMN).count().collect():
        counts.setdefault(r[BATCH_COLUMN], {"good": 0, "bad": 0})["bad" if r[flag] else "good"] = r["count"]
    for name, kind in ((quarantine_table, "bad"), (pre_raw_table, "good")):
        at = f"{fresh}/{flag}={str(kind == 'bad').lower()}/{BATCH_COLUMN}="
        point_partitions(spark, name, {d: at + d if n[kind] else None for d, n in counts.items()})
    return counts
