"""SRC-3..6: file scans with a borrowed schema (never inferred) and the landing listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedlake.spec import SOURCE_FILE

# Text formats carry timestamps at full microsecond precision so that a write/read round trip is exact.
TEXT_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def scan_delimited(
    spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ",", header: bool = False, **options
) -> DataFrame:
    """SRC-3: delimited text with the target's schema. No header by default (a header line is data)."""
    opts = {**TEXT_OPTIONS, **options}
    return spark.read.schema(schema).options(**opts).csv(path, sep=sep, header=header)


def scan_json(spark: SparkSession, path: str | list[str], schema: StructType, **options) -> DataFrame:
    """SRC-4: JSON lines with the target's schema."""
    opts = {**TEXT_OPTIONS, **options}
    return spark.read.schema(schema).options(**opts).json(path)


def scan_recon_source(spark: SparkSession, spec, schema: StructType) -> DataFrame:
    """SRC-5: the reconciliation extract: a table if configured, else JSON, else delimited text.

    Only the delimited source has its string nulls filled with '' (reference behaviour).
    """
    from feedlake.functions.columns import fill_empty_strings

    if spec.input_table:
        return spark.table(spec.input_table)
    if spec.file_type == "json":
        return scan_json(spark, spec.input_path, schema)
    if spec.file_type == "csv":
        return fill_empty_strings(scan_delimited(spark, spec.input_path, schema, spec.delimiter, spec.header))
    raise ValueError(f"unknown reconciliation file type {spec.file_type!r}")


def landing_manifest(
    spark: SparkSession, path: str, extension: str, control_extension: str | None = None
) -> DataFrame:
    """SRC-6: files below `path` whose name ends in `.<extension>` or `.<extension>.gz` (and, with
    control_extension, the control files too, in the same listing).

    A distributed listing: the binary-file source with a glob filter, selecting metadata only, so no file
    content is read. Full paths are kept (no flattening to base names). file_class is 'data' or 'control'; source_file is
    the name as staged rows carry it (Spark's metadata column, which encodes blanks and the like).
    """
    exts = [extension.lstrip(".")] + ([control_extension.lstrip(".")] if control_extension else [])
    pattern = ",".join(f"{e},{e}.gz" for e in exts)
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{{{pattern}}}")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    data = name.endswith(f".{exts[0]}") | name.endswith(f".{exts[0]}.gz")
    return listing.select(
        F.col("path"),
        name.alias("file_name"),
        F.col("length"),
        F.col("modificationTime").alias("modification_time"),
        F.col("path").endswith(".gz").alias("compressed"),
        F.when(data, F.lit("data")).otherwise(F.lit("control")).alias("file_class"),
        F.col("_metadata.file_name").alias(SOURCE_FILE),
    )
