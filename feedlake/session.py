"""Session settings for feed jobs.

On a cluster the job inherits the cluster's session; these are the settings the library is designed for.
`local_session` is for tests and the local benchmark only.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the plans rely on at scale: AQE re-plans joins from runtime sizes (broadcast only what was
# measured small), splits skewed join partitions, and coalesces small shuffle partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when the join feeds a keyed aggregate (the mismatch profile's semi-join):
    # AQE then adds one shuffle after the split pieces have been partially aggregated
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # partitioned writes keep up to 16 open files per task instead of sorting every task's rows by
    # batchdate first (a snapshot task holds one or two batch dates); past 16 Spark falls back to sorting
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "feedlake") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(largest_shuffle_bytes: int, partition_bytes: int = 256 << 20, min_partitions: int = 200) -> dict:
    """SCALE_CONF plus shuffle partition counts sized so one shuffle partition holds ~partition_bytes.

    AQE starts from this many partitions and coalesces small ones, so the number is an upper bound that keeps
    every task's share of the largest shuffle (e.g. the latest history batch, when it cannot stay in place)
    within executor memory instead of spilling.
    """
    n = max(min_partitions, -(-int(largest_shuffle_bytes) // int(partition_bytes)))
    return {
        **SCALE_CONF,
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
    }
