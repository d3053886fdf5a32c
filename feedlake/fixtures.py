"""Feeds derived by Spark from the driver's tables (see FIXTURES.md); DuckDB builds the same rows.

`k` is o_orderkey. The modulo rules decide which orders are updated, inserted or changed in a feed;
every fixture covers the whole `orders` / `events` table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.sources.files import TEXT_OPTIONS
from feedlake.spec import BATCH_COLUMN
from feedlake.workspace import new_dir, new_name, shared_dir

# Fixed fixture values (FIXTURES.md section 3).
HISTORY_LATEST = "2024-01-01"
HISTORY_OLDER = "2023-12-01"
DELTA_DATE = "2024-01-02"
AUDIT_DAY = "2024-01-15"
ORDER_KEY = "o_orderkey"
LANDING_SEP = "|"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> F.Column:
    return F.col(ORDER_KEY)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots: 2024-01-01 (latest, k % 10 <> 9) and 2023-12-01 (older, k % 10 < 5, status 'X')."""
    o = table(spark, sf_dir, "orders")
    latest = o.where(_k() % 10 != 9).withColumn(BATCH_COLUMN, F.lit(HISTORY_LATEST))
    older = (
        o.where(_k() % 10 < 5).withColumn("o_orderstatus", F.lit("X")).withColumn(BATCH_COLUMN, F.lit(HISTORY_OLDER))
    )
    return latest.unionByName(older)


def delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delta of 2024-01-02: k % 10 >= 7 with status 'U' (7, 8 update; 9 inserts)."""
    return table(spark, sf_dir, "orders").where(_k() % 10 >= 7).withColumn("o_orderstatus", F.lit("U"))


def recon_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def recon_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source extract: orders without k % 13 = 0, with changed priority/status, plus 1 in 50 new keys."""
    o = table(spark, sf_dir, "orders")
    m = _k() % 10
    changed = o.where(_k() % 13 != 0).select(
        ORDER_KEY,
        "o_custkey",
        F.when(m == 2, F.lit("Z")).when(m == 3, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus"))
        .alias("o_orderstatus"),
        "o_totalprice",
        "o_orderdate",
        F.when(m.isin(1, 2), F.lit("CHANGED")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    new = o.where(_k() % 50 == 0).withColumn(ORDER_KEY, _k() + 1000000)
    return changed.unionByName(new)


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with batchdate = the day of ts."""
    return table(spark, sf_dir, "events").withColumn(BATCH_COLUMN, F.date_format("ts", "yyyy-MM-dd"))


def null_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with o_orderstatus null where k % 7 = 0."""
    o = table(spark, sf_dir, "orders")
    return o.withColumn(
        "o_orderstatus", F.when(_k() % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus"))
    )


def write_delimited(df: DataFrame, path: str, sep: str = LANDING_SEP, compression: str | None = None) -> str:
    w = df.write.mode("overwrite").options(**TEXT_OPTIONS).option("sep", sep)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


def write_days(rows: DataFrame, root: str, codec: str | None = None) -> None:
    """Add the rows to the landing folder's batchdate=<d> folders. Every task writes its own rows per day: no shuffle by
    day, so a day with a third of the rows does not end up in one task."""
    w = rows.write.mode("append").options(**TEXT_OPTIONS).option("sep", LANDING_SEP).partitionBy(BATCH_COLUMN)
    (w.option("compression", codec) if codec else w).csv(root)


def write_landing(spark: SparkSession, sf_dir: str) -> str:
    """Landing folder: one batchdate=<d> directory per day holding '|'-delimited data files (gzip on even
    days of the month) and one control file (.txt) with the day's row count."""
    root = new_dir(spark, "landing")
    ev = daily_events(spark, sf_dir)
    even = F.dayofmonth("ts") % 2 == 0
    for cond, codec in ((~even, None), (even, "gzip")):
        write_days(ev.where(cond), root, codec)
    counts = ev.groupBy(BATCH_COLUMN).agg(F.count(F.lit(1)).cast("string").alias("value"))
    counts.write.mode("append").partitionBy(BATCH_COLUMN).text(root)  # one row, one file per day
    return root


def add_damaged_lines(df: DataFrame, root: str, key: str) -> None:
    """One line of too few fields, `<key>|broken`, for every 50th key of each batch, in files of their own."""
    bad = df.where(F.col(key) % 50 == 0).select(F.concat(F.col(key).cast("string"), F.lit(f"{LANDING_SEP}broken")).alias("line"), BATCH_COLUMN)
    # a one-column CSV with a separator and quote that the line does not hold is the line itself
    bad.write.mode("append").option("sep", "\t").partitionBy(BATCH_COLUMN).csv(root)


def write_damaged_landing(spark: SparkSession, sf_dir: str) -> str:
    """`write_landing` plus damaged lines."""
    root = write_landing(spark, sf_dir)
    add_damaged_lines(daily_events(spark, sf_dir), root, "event_id")
    return root


def add_landing_batch(batch: DataFrame, root: str, key: str) -> None:
    """One batch's rows as delimited landing files, with damaged lines."""
    batch.write.mode("append").options(**TEXT_OPTIONS).option("sep", LANDING_SEP).partitionBy(BATCH_COLUMN).csv(root)
    add_damaged_lines(batch, root, key)


def source_database(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    """A database of external tables over the driver's Parquet files (no data is copied)."""
    shared_dir(spark)
    db = new_name("feedlake_src")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{new_dir(spark, db)}'")
    for n in names:
        spark.sql(f"CREATE TABLE {db}.{n} USING parquet LOCATION '{sf_dir.rstrip('/')}/{n}.parquet'")
    return db


def work_database(spark: SparkSession) -> str:
    shared_dir(spark)
    db = new_name("feedlake_work")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{new_dir(spark, db)}'")
    return db


def access_zones(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """Access-zone registry, one zone per nation."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.lower("n_name").alias("accesszone_id"),
        F.concat(F.lit(base.rstrip("/") + "/zone_"), F.col("n_nationkey").cast("string")).alias("s3_location"),
        F.concat(F.lit("zone_db_"), F.col("n_regionkey").cast("string")).alias("database_name"),
    )


# Fixed request definition: the columns every request of the fixture asks for, in order.
REQUEST_COLUMNS = [("c_custkey", "bigint"), ("c_name", "string"), ("n_orders", "bigint"), ("max_price", "double")]

REQUEST_SQL = """
SELECT c.c_custkey, c.c_name, count(*) AS n_orders, max(o.o_totalprice) AS max_price
FROM {athena_raw_db}.customer c
JOIN {athena_raw_db}.orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_custkey, c.c_name
"""


def request_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested-column registry, one request per region: req-<region name>."""
    r = table(spark, sf_dir, "region")
    cols = F.array(*[F.struct(F.lit(c).alias("requestecol"), F.lit(t).alias("data_type")) for c, t in REQUEST_COLUMNS])
    rid = F.concat(F.lit("req-"), F.regexp_replace(F.lower("r_name"), " ", "_"))
    return r.select(rid.alias("requestid"), F.inline(cols))
