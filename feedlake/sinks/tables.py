"""Table sinks (SNK-1/2/3/6/7/11). Writes align columns by name, then insert in the table's order.

Partition overwrite stamps the rows with the one batch date and writes in dynamic mode, so sibling
partitions always survive and the replaced partition is swapped in at commit. Full overwrite of a
partitioned table sets the session mode to static for the one statement. Either way the session's own
partitionOverwriteMode is restored afterwards.
"""

from __future__ import annotations

import contextlib
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from feedlake.functions.columns import check_batch_date, ddl_type, has_map, resolve_columns
from feedlake.sources.tables import NULL_PARTITION, batch_partitions
from feedlake.spec import BATCH_COLUMN
from feedlake.workspace import new_name, observed_metrics

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")
_MODE = "spark.sql.sources.partitionOverwriteMode"


def _check_location(location: str) -> str:
    if "'" in location or "\\" in location:
        raise ValueError(f"unsupported character in location {location!r}")
    return location


def _check_ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"not a table name: {name!r}")
    return name


@contextlib.contextmanager
def overwrite_mode(spark: SparkSession, mode: str):
    """Set the session's partitionOverwriteMode for one write and restore it (the writer option is ignored
    by insertInto). The setting is session-wide: concurrent writes from one session are not isolated."""
    old = spark.conf.get(_MODE, None)
    spark.conf.set(_MODE, mode)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_MODE)
        else:
            spark.conf.set(_MODE, old)


def create_feed_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    location: str,
    partitioned: bool = True,
    buckets: int | None = None,
    bucket_keys: tuple[str, ...] | list[str] = (),
) -> None:
    """An external Parquet table at `location`, partitioned by batchdate when asked (schema includes it).

    With `buckets`, rows are also bucketed by the primary key. Raw and history tables bucketed alike let
    the daily anti-join read history in place: only the delta is shuffled, never the full snapshot.
    """
    if partitioned and BATCH_COLUMN not in schema.fieldNames():
        raise ValueError(f"a partitioned feed table needs a {BATCH_COLUMN} column")
    nullable = StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
    ddl = f"CREATE TABLE IF NOT EXISTS {_check_ident(name)} ({nullable.toDDL()}) USING parquet"
    if partitioned:
        ddl += f" PARTITIONED BY ({BATCH_COLUMN})"
    if buckets:
        if not bucket_keys:
            raise ValueError("bucketing needs the key columns")
        cols = ", ".join(f"`{k}`" for k in bucket_keys)
        ddl += f" CLUSTERED BY ({cols}) INTO {int(buckets)} BUCKETS"
    spark.sql(ddl + f" LOCATION '{_check_location(location)}'")


def table_buckets(spark: SparkSession, name: str) -> tuple[int, list[str]] | None:
    """(number of buckets, bucket columns) of a catalog table, None when it is not bucketed."""
    info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_check_ident(name)}").collect()}
    if "Num Buckets" not in info:
        return None
    cols = [c.strip().strip("`") for c in info.get("Bucket Columns", "").strip("[]").split(",") if c.strip()]
    return int(info["Num Buckets"]), cols


def align_to_table(df: DataFrame, spark: SparkSession, table: str) -> DataFrame:
    """Select the frame's columns in the table's column order (by name, case-insensitive).

    A column that the table lacks raises, as Spark's own insert does: no value is dropped without a word.
    """
    target = spark.table(table).columns
    known = {c.lower() for c in target}
    extra = [c for c in df.columns if c.lower() not in known]
    if extra:
        raise ValueError(f"{table} has no columns {extra}")
    return df.select(*resolve_columns(df, target))


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_check_ident(name)}").collect()
    return next(r["data_type"] for r in reversed(rows) if r["col_name"] == "Location")


def swap_table(df: DataFrame, table: str) -> None:
    """Replace all rows of a table without partitions: a twin of the table (columns, buckets) is filled in a fresh folder
    beside the old one, then the table's location moves there. A failed write leaves the table as it was; the old
    folder is left to storage administration."""
    spark = df.sparkSession
    old = table_location(spark, table)
    fresh = _check_location(f"{_base_folder(old)}-{new_name('v')}")
    twin = f"{_check_ident(table)}_{new_name('twin')}"
    spark.sql(f"CREATE TABLE {twin} LIKE {table} LOCATION '{fresh}'")
    try:
        df.write.insertInto(twin)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{fresh}'")
        spark.catalog.refreshTable(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {twin}")  # external: the files stay


def _base_folder(location: str) -> str:
    """A table's first folder: without the mark of an earlier swap."""
    return re.sub(r"(-v_[0-9a-f]{12})+$", "", location.rstrip("/"))


def coalesce_output(df: DataFrame, n: int | None) -> DataFrame:
    """SNK-11: bound the output file count. None keeps the natural split-sized partitions.

    coalesce merges partitions without a shuffle, so it also narrows the stage that produces them; use
    it for the file count of scan-fed writes, not after a wide join at scale.
    """
    return df if n is None else df.coalesce(int(n))


def spread_output(df: DataFrame, n: int | None, buckets: tuple[int, list[str]] | None = None) -> DataFrame:
    """At most n output files a folder behind one more shuffle, so that the joins before it keep their tasks.

    A bucketed table writes one file a bucket and task. Rows are dealt by the table's own bucket number then, so that a
    bucket lies in one task; with more files than buckets each bucket is dealt over n // buckets tasks by a salt, which
    also cuts a bucket made hot by one key. A bucket then has at most max(1, n // buckets) files.
    """
    if n is None:
        return df
    if buckets is None:
        return df.repartition(int(n))
    count, columns = buckets
    cols = [F.col("`" + c.replace("`", "``") + "`") for c in resolve_columns(df, columns)]
    salts = max(1, int(n) // count)
    bucket = F.pmod(F.hash(*cols), F.lit(count))  # Spark's own bucket number
    if salts == 1:
        return df.repartition(int(n), bucket)
    whole = [F.col("`" + f.name.replace("`", "``") + "`") for f in df.schema.fields if not has_map(f.dataType)]
    return df.repartition(int(n), bucket, F.pmod(F.xxhash64(*whole), F.lit(salts)))


def overwrite_raw(df: DataFrame, table: str, batch_date: str | None = None, num_partitions: int | None = None) -> None:
    """SNK-1: replace the whole table; with batch_date the frame is stamped with it first (PRJ-1).

    On a table partitioned by batchdate the image's partitions are written in dynamic mode, which swaps them in at
    commit, and only then are partitions that the image lacks emptied: a failed write leaves every old row. Should the
    job stop between the two steps, running the batch again finishes it. Other tables are swapped (`swap_table`).
    """
    from feedlake.functions.columns import with_batchdate

    spark = df.sparkSession
    out = with_batchdate(df, batch_date) if batch_date is not None else df
    out = spread_output(align_to_table(out, spark, table), num_partitions, table_buckets(spark, table))
    if batch_partitions(spark, table) is None:
        swap_table(out, table)
        return
    before = _all_partitions(spark, table)
    seen = Observation(new_name("raw_batches"))
    date = F.coalesce(F.col(BATCH_COLUMN).cast("string"), F.lit(NULL_PARTITION))
    # one value a batch
    observed = out.observe(seen, F.collect_set(date).alias("batches"), F.count(F.lit(1)).alias("n"))
    with overwrite_mode(spark, "dynamic"):
        observed.write.insertInto(_check_ident(table), overwrite=True)
    written = observed_metrics(seen)
    if written is None:  # AQE took the metrics away with an empty plan
        if not out.isEmpty():
            raise RuntimeError(f"{table}: the image is written, but its batches are not known; older ones are kept")
        written = {"batches": []}
    stale = before - set(written["batches"])
    if stale:
        none = spark.createDataFrame([], spark.table(table).drop(BATCH_COLUMN).schema)
        none.createOrReplaceTempView(view := new_name("no_rows"))
        for day in sorted(stale):
            part = f"{table} PARTITION ({BATCH_COLUMN} = " + ("NULL)" if day == NULL_PARTITION else f"'{day}')")
            spark.sql(f"INSERT OVERWRITE {part} SELECT * FROM {view}")  # dropping one leaves an external table's files
            spark.sql("ALTER TABLE " + part.replace(" PARTITION", " DROP IF EXISTS PARTITION", 1))
        spark.catalog.dropTempView(view)


def _all_partitions(spark: SparkSession, table: str) -> set[str]:
    """Batch dates of the table's partitions and, if it has one, the partition of rows without a date."""
    prefix = f"{BATCH_COLUMN}="
    return {r[0][len(prefix):] for r in spark.sql(f"SHOW PARTITIONS {_check_ident(table)}").collect()}


def append_raw(df: DataFrame, table: str, num_partitions: int | None = None) -> None:
    """SNK-2: append rows (carried-forward rows keep their own batchdate)."""
    spark = df.sparkSession
    coalesce_output(align_to_table(df, spark, table), num_partitions).write.insertInto(_check_ident(table))


def overwrite_partition(df: DataFrame, table: str, batch_date: str, num_partitions: int | None = None) -> None:
    """SNK-3: replace exactly the partition batchdate=batch_date; all other partitions are kept.

    The rows are stamped with the date and written in dynamic overwrite mode (set for this statement
    only): Spark stages the files and swaps the partition in at job commit, so a failed job leaves the
    old partition in place, and only the stamped partition can be replaced.
    """
    from feedlake.functions.columns import with_batchdate

    spark = df.sparkSession
    out = with_batchdate(df.drop(BATCH_COLUMN), batch_date)
    out = spread_output(align_to_table(out, spark, table), num_partitions, table_buckets(spark, table))
    with overwrite_mode(spark, "dynamic"):
        out.write.insertInto(_check_ident(table), overwrite=True)


def create_target(spark: SparkSession, name: str, columns: list[tuple[str, str]], location: str) -> None:
    """SNK-6: drop and recreate an external Parquet table from (column, type) pairs."""
    if not columns:
        raise ValueError(f"no columns requested for {name}")
    schema = StructType([StructField(c, ddl_type(t), True) for c, t in columns])
    spark.sql(f"DROP TABLE IF EXISTS {_check_ident(name)}")
    spark.catalog.createTable(name, path=location, source="parquet", schema=schema)


def _as_declared(df: DataFrame, target: StructType, name: str) -> DataFrame:
    """The request's columns by position, each cast to the declared type under its declared name."""
    if len(target.fields) != len(df.columns):
        raise ValueError(f"{name} has {len(target.fields)} columns, the request returns {len(df.columns)}")
    places = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # a request may return one name twice
    return places.select(*[F.col(f"c{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(target.fields)])


def load_target(df: DataFrame, table: str) -> None:
    """SNK-7: overwrite the target with the result of a request (positional, like INSERT ... SELECT *).

    The rows are written beside the old ones, and the table moves to them when all are there (`swap_table`)."""
    spark = df.sparkSession
    swap_table(_as_declared(df, spark.table(table).schema, table), table)


def replace_target(df: DataFrame, name: str, columns: list[tuple[str, str]], location: str) -> None:
    """SNK-6 and SNK-7 as one safe step: the target with the requested columns, holding the request's result.

    The new table is created under another name in a fresh folder at `location` and filled; only then do the names change
    hands. Until the last row is written the old target, its columns and its rows stay as they are.
    """
    if not columns:
        raise ValueError(f"no columns requested for {name}")
    spark = df.sparkSession
    schema = StructType([StructField(c, ddl_type(t), True) for c, t in columns])
    out = _as_declared(df, schema, name)
    fresh, old = f"{_check_ident(name)}_{new_name('new')}", f"{name}_{new_name('old')}"
    folder = _check_location(f"{_base_folder(location)}-{new_name('v')}")
    spark.catalog.createTable(fresh, path=folder, source="parquet", schema=schema)
    try:
        out.write.insertInto(fresh)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    had = spark.catalog.tableExists(name)
    if had:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    if had:
        spark.sql(f"DROP TABLE IF EXISTS {old}")  # external: the files stay


def point_partitions(spark: SparkSession, table: str, folders: dict[str, str | None]) -> None:
    """Move batchdate partitions of an external table: each batch to its folder, or out of the table for None.
    Metadata only: files are neither moved nor deleted."""
    held = set(batch_partitions(spark, _check_ident(table)) or [])
    part = {day: f"PARTITION ({BATCH_COLUMN} = '{check_batch_date(day)}')" for day in sorted(folders)}
    at = {day: f"{part[day]} LOCATION '{_check_location(f)}'" for day, f in sorted(folders.items()) if f is not None}
    for day in at:
        if day in held:
            spark.sql(f"ALTER TABLE {table} {at[day].replace(' LOCATION', ' SET LOCATION', 1)}")
    new = [at[day] for day in at if day not in held]
    gone = [part[day] for day in part if day not in at and day in held]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(new)}")
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(gone)}")
    spark.catalog.refreshTable(table)
