"""A failed overwrite keeps the old image; audit events of every job; bucketed loads with many null keys."""

import pytest
from pyspark.sql import functions as F

from feedlake.operators import incremental_snapshot, unmatched_rows
from feedlake.plans import ingest_partition, load_raw, reconcile, validate_landing
from feedlake.plans.validate import ValidationError
from feedlake.sinks import create_feed_table, overwrite_raw, read_audit
from feedlake.sources.tables import batch_partitions
from feedlake.spec import FeedSpec, ReconSpec
from feedlake.workspace import new_dir, new_name


def feed_table(spark, rows, **options):
    name = new_name("safe")
    df = spark.createDataFrame(rows, "k int, v string, batchdate string")
    create_feed_table(spark, name, df.schema, new_dir(spark, name), **options)
    df.write.insertInto(name)
    return name


OLD = [(1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", None)]


def rows(spark, name):
    return sorted(map(tuple, spark.table(name).select("k", "v", "batchdate").collect()), key=repr)


@pytest.mark.parametrize("partitioned", [True, False])
def test_a_failed_overwrite_leaves_the_old_rows(spark, partitioned):
    name = feed_table(spark, OLD, partitioned=partitioned)
    bad = spark.range(4).select(
        F.col("id").cast("int").alias("k"),
        F.when(F.col("id") == 3, F.raise_error(F.lit("stop")).cast("string")).otherwise("z").alias("v"),
        F.lit("2024-01-02").alias("batchdate"),
    )
    with pytest.raises(Exception, match="stop"):
        overwrite_raw(bad, name)
    assert rows(spark, name) == OLD


@pytest.mark.parametrize("partitioned", [True, False])
@pytest.mark.parametrize("new", [[], [(9, "z", "2024-01-02")], [(9, "z", "2024-01-05"), (8, "y", None)]])
def test_an_overwrite_leaves_nothing_else(spark, partitioned, new):
    name = feed_table(spark, OLD, partitioned=partitioned)
    overwrite_raw(spark.createDataFrame(new, "k int, v string, batchdate string"), name)
    assert rows(spark, name) == sorted(new, key=repr)
    if partitioned:
        assert batch_partitions(spark, name) == sorted({r[2] for r in new if r[2]})


def test_jobs_record_their_counts(spark):
    path, day = new_dir(spark, "audit"), "2024-01-02"
    name = feed_table(spark, [])
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert ingest_partition(spark, df, name, day, audit_path=path) == 2
    source = new_name("source")
    spark.createDataFrame([(1, "a"), (2, "x"), (3, "c")], "k int, v string").createOrReplaceTempView(source)
    spec = ReconSpec(raw_table=name, primary_key=("k",), output_path=new_dir(spark, "out"), input_table=source)
    got = reconcile(spark, spec, day, audit_path=path)
    assert (got["raw_count"], got["input_count"], got["difference"]) == (2, 3, 2)
    validate_landing(spark, source, name, "k", audit_path=path)
    with pytest.raises(ValidationError):
        validate_landing(spark, source, name, "nokey", audit_path=path)
    events = sorted((r.job, r.message, r.args["value"]) for r in read_audit(spark, path).collect())
    assert events == sorted([
        ("ingest_partition", "batch count", "2"),
        ("reconciliation", "raw_count", "2"), ("reconciliation", "input_count", "3"), ("reconciliation", "difference", "2"),
        ("validation", "file differences", "skipped"), ("validation", "schema result", "true"),
        ("validation", "file differences", "skipped"), ("validation", "schema result", "false"),
    ])


def test_null_keys_go_past_a_bucketed_join(spark):
    left = spark.createDataFrame([(None, k) for k in range(300)] + [(k, k) for k in range(20)], "k int, n int")
    right = spark.createDataFrame([(k,) for k in range(0, 20, 2)] + [(None,)], "k int")
    plain, apart = unmatched_rows(left, right, "k"), unmatched_rows(left, right, "k", bucketed=True)
    assert plain.exceptAll(apart).isEmpty() and apart.exceptAll(plain).isEmpty() and apart.count() == 310
    tree = apart._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in tree and "isnotnull(k" in tree
    delta = spark.createDataFrame([(1, 7)], "k int, n int")
    history = left.withColumn("batchdate", F.lit("2024-01-01"))
    assert incremental_snapshot(delta, history, ["k"], "2024-01-02", latest="2024-01-01", bucketed=True).count() == 320


def test_a_load_checks_the_bucket_count(spark):
    name, pre = feed_table(spark, OLD, buckets=4, bucket_keys=["k"]), new_name("pre")
    spark.createDataFrame([(5, "e")], "k int, v string").createOrReplaceTempView(pre)
    with pytest.raises(ValueError, match="bucketed"):
        load_raw(spark, FeedSpec(pre, name, ("k",), buckets=8), "2024-01-03")
    assert load_raw(spark, FeedSpec(pre, name, ("k",), buckets=4), "2024-01-03") == {"delta": 1, "unchanged": 0}
    assert rows(spark, name) == [(5, "e", "2024-01-03")]
