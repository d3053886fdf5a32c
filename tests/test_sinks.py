from pyspark.sql import functions as F

from feedlake import fixtures as fx
from feedlake.sinks import (
    append_raw,
    coalesce_output,
    create_feed_table,
    overwrite_partition,
    overwrite_raw,
    publish_fanout,
    stage_landing,
)
from feedlake.sinks.tables import overwrite_mode
from feedlake.sources import landing_manifest
from feedlake.workspace import new_dir, new_name
from tests.conftest import rows

S = "k int, v string, batchdate string"


def _table(spark, data):
    db = new_name("sink_db")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{new_dir(spark, db)}'")
    name = f"{db}.t"
    df = spark.createDataFrame(data, S)
    create_feed_table(spark, name, df.schema, new_dir(spark, "t"))
    append_raw(df, name)
    return name


def test_overwrite_partition_keeps_siblings_in_any_session_mode(spark):
    for mode in ("static", "dynamic"):
        name = _table(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-02")])
        with overwrite_mode(spark, mode):
            overwrite_partition(spark.createDataFrame([(3, "c")], "k int, v string"), name, "2024-01-02")
        assert rows(spark.table(name)) == [(1, "a", "2024-01-01"), (3, "c", "2024-01-02")]


def test_overwrite_raw_replaces_every_partition_even_if_session_is_dynamic(spark):
    name = _table(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-02")])
    with overwrite_mode(spark, "dynamic"):
        overwrite_raw(spark.createDataFrame([(9, "z")], "k int, v string"), name, "2024-01-03")
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"  # restored
    assert rows(spark.table(name)) == [(9, "z", "2024-01-03")]


def test_writes_align_by_name(spark):
    name = _table(spark, [(1, "a", "2024-01-01")])
    append_raw(spark.createDataFrame([("2024-01-05", "q", 7)], "batchdate string, v string, k int"), name)
    assert (7, "q", "2024-01-05") in rows(spark.table(name))


def test_coalesce_output_bounds_file_count(spark):
    path = new_dir(spark, "co")
    coalesce_output(spark.range(0, 1000, 1, 8), 3).write.parquet(path)
    files = spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    assert files == 3
    assert coalesce_output(spark.range(10), None).count() == 10


def test_landing_manifest_and_staging(spark, sf):
    landing = fx.write_landing(spark, sf)
    m = landing_manifest(spark, landing, "csv")
    names = [r["file_name"] for r in m.collect()]
    assert names and all(n.endswith(".csv") or n.endswith(".csv.gz") for n in names)
    assert m.where("compressed").count() > 0 and m.where("not compressed").count() > 0
    days = fx.daily_events(spark, sf).select("batchdate").distinct().count()
    control = landing_manifest(spark, landing, "txt")
    assert control.count() == days
    both = landing_manifest(spark, landing, "csv", "txt")
    assert both.where("file_class = 'control'").count() == days
    assert both.where("file_class = 'data'").count() == len(names)
    schema = fx.daily_events(spark, sf).schema
    staged = stage_landing(spark, landing, new_dir(spark, "pre_raw"), schema, "|", "csv")
    assert staged.count() == fx.table(spark, sf, "events").count()
    assert staged.where(F.col("source_file").endswith(".gz")).count() > 0
    assert dict(staged.dtypes)["batchdate"] == "string"
    dest = new_dir(spark, "pre_raw_one")
    one = stage_landing(spark, landing, dest, schema, "|", "csv", batch_date="2024-01-09")
    assert [r[0] for r in one.select("batchdate").distinct().collect()] == ["2024-01-09"]
    two = stage_landing(spark, landing, dest, schema, "|", "csv", batch_date="2024-01-10")
    assert [r[0] for r in two.select("batchdate").distinct().collect()] == ["2024-01-10"]


def test_publish_fanout_one_batch(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    targets = [new_dir(spark, "za"), new_dir(spark, "zb")]
    out = publish_fanout(df, targets, "2024-01-02")
    assert all(p.endswith("/batchdate=2024-01-02") for p in out)
    for t in targets:
        assert spark.read.parquet(t).count() == 2


def test_publish_fanout_evaluates_the_batch_once(spark):
    acc = spark.sparkContext.accumulator(0)

    def count_rows(it):
        for pdf in it:
            acc.add(len(pdf))
            yield pdf

    df = spark.range(100).selectExpr("id AS k").mapInPandas(count_rows, "k long")
    targets = [new_dir(spark, "fa"), new_dir(spark, "fb"), new_dir(spark, "fc")]
    publish_fanout(df, targets, "2024-01-02")
    assert acc.value == 100  # the source ran once for three targets
    for t in targets:
        assert spark.read.parquet(t).count() == 100


def test_publish_fanout_all_batches_keeps_other_batches(spark):
    t = new_dir(spark, "fd")
    spark.createDataFrame([(0, "2024-01-01")], "k int, batchdate string").write.partitionBy("batchdate").parquet(t)
    publish_fanout(spark.createDataFrame([(1, "2024-01-02")], "k int, batchdate string"), [t])
    assert rows(spark.read.parquet(t).selectExpr("k", "CAST(batchdate AS STRING) AS batchdate")) == [
        (0, "2024-01-01"), (1, "2024-01-02")]
