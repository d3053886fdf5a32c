"""Where jobs materialise intermediate results: the shared folder named by `spark.checkpoint.dir`.

The folder comes from the session. Only when the session names none (local tests) a folder of our own is
set, so nothing on a cluster lands in a machine-local temporary directory.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (remote clients): the conf is all there is
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
        return base.rstrip("/")
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        current = sc.getCheckpointDir()
        if current:
            # getCheckpointDir adds a per-application folder; its parent is the shared one
            base = current.rsplit("/", 1)[0]
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder: executors do not see this machine's own")
        base = tempfile.mkdtemp(prefix="feedlake-")
        sc.setCheckpointDir(base)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the shared one; never reused, never cleared."""
    return f"{shared_dir(spark)}/feedlake/{label}-{uuid.uuid4().hex[:12]}"


def new_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


#: Of one task, in Parquet bytes read or compressed bytes shuffled; and rows shuffled, from which partitions are counted.
TASK_BYTES = 8 << 20
TASK_ROWS = 100_000


@contextmanager
def small_tasks(spark: SparkSession, rows: int) -> Iterator[None]:
    """For actions inside: tasks whose sorts and hash tables stay as small however large the input of `rows` rows. Files are
    read in splits of TASK_BYTES, shuffles start with a partition per TASK_ROWS, and AQE merges them up to TASK_BYTES (and
    still splits skewed ones). Settings that are tighter already stay."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = {
        "spark.sql.files.maxPartitionBytes": f"{TASK_BYTES}b",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{TASK_BYTES}b",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(partitions, -(-rows // TASK_ROWS))),
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k in list(wanted)[:2]:
        if before[k] and _bytes(before[k]) <= TASK_BYTES:
            del wanted[k]
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in wanted:
            spark.conf.unset(k) if before[k] is None else spark.conf.set(k, before[k])


def _bytes(setting: str) -> int:
    digits = setting.lower().rstrip("bkmgtp")
    unit = setting.lower()[len(digits) :].rstrip("b")
    return int(digits) << 10 * ("", "k", "m", "g", "t", "p").index(unit)


def materialize(df, label: str):
    """Cut lineage: write `df` as Parquet into a fresh folder below the shared one and read it back.

    Columnar and compressed (unlike an RDD checkpoint), so re-reads prune columns and push filters; a lost
    executor re-reads files instead of recomputing the plan.
    """
    spark = df.sparkSession
    path = new_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def observed_metrics(observation) -> dict | None:
    """The metrics of a finished write; None if the plan had no metrics node left."""
    try:
        got = observation.get
    except (PySparkException, Py4JError):
        return None
    return got or None
