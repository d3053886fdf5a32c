from pyspark.sql import functions as F

from feedlake import fixtures as fx
from feedlake.plans import history_snapshot, ingest_partition, run_feed
from feedlake.sinks import append_raw, create_feed_table, overwrite_raw
from feedlake.spec import FeedSpec
from feedlake.workspace import new_dir, new_name
from tests.conftest import rows


def _db(spark):
    db = new_name("feed_db")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{new_dir(spark, db)}'")
    return db


def test_three_batches(spark, sf):
    db = _db(spark)
    orders = fx.table(spark, sf, "orders")
    stamped = orders.withColumn("batchdate", F.lit("2001-01-31"))
    create_feed_table(spark, f"{db}.raw", stamped.schema, new_dir(spark, "raw"))
    create_feed_table(spark, f"{db}.history", stamped.schema, new_dir(spark, "hist"))
    spec = FeedSpec(pre_raw_table=f"{db}.pre_raw", raw_table=f"{db}.raw", history_table=f"{db}.history",
                    primary_key=("o_orderkey",))
    k = F.col("o_orderkey")
    batches = [
        ("2024-01-01", orders),  # first load: everything
        ("2024-01-02", orders.where(k % 10 >= 7).withColumn("o_orderstatus", F.lit("U"))),
        ("2024-01-03", orders.where(k % 10 == 0).withColumn("o_orderstatus", F.lit("V"))),
    ]
    audit = new_dir(spark, "audit")
    results = []
    for d, delta in batches:
        pre = new_dir(spark, "pre_raw")
        delta.write.parquet(pre)
        spark.sql(f"DROP TABLE IF EXISTS {spec.pre_raw_table}")
        spark.catalog.createTable(spec.pre_raw_table, path=pre, source="parquet")
        results.append(run_feed(spark, spec, d, audit))
    n = orders.count()
    assert [r["delta"] for r in results] == [n, batches[1][1].count(), batches[2][1].count()]
    assert all(r["delta"] + r["unchanged"] == n for r in results)
    hist = spark.table(spec.history_table)
    assert rows(hist.groupBy("batchdate").count()) == [("2024-01-01", n), ("2024-01-02", n), ("2024-01-03", n)]
    final = spark.table(spec.raw_table)
    status = {r["o_orderkey"]: (r["o_orderstatus"], r["batchdate"]) for r in final.collect()}
    assert status[10] == ("V", "2024-01-03") and status[17] == ("U", "2024-01-02")
    assert status[11][1] == "2024-01-02"  # carried rows show the last snapshot date
    # rerun of the second batch: result is the same image, history repaired in place
    pre = new_dir(spark, "pre_raw")
    batches[1][1].write.parquet(pre)
    spark.sql(f"DROP TABLE IF EXISTS {spec.pre_raw_table}")
    spark.catalog.createTable(spec.pre_raw_table, path=pre, source="parquet")
    again = run_feed(spark, spec, "2024-01-02", audit)
    assert again["delta"] == results[1]["delta"] and again["unchanged"] == n - results[1]["delta"]
    events = spark.read.parquet(audit)
    assert events.count() == 16  # per run: prior count, unchanged count, partition date, delta count
    msgs = {r["message"] for r in events.collect()}
    assert msgs == {"base table count", "unchanged rec count", "Partition Date", "Delta Count Raw"}


def test_history_snapshot_uses_max_raw_date_and_default(spark):
    db = _db(spark)
    df = spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-05")], "k int, v string, batchdate string")
    create_feed_table(spark, f"{db}.raw", df.schema, new_dir(spark, "raw"))
    create_feed_table(spark, f"{db}.hist", df.schema, new_dir(spark, "hist"))
    overwrite_raw(df, f"{db}.raw")
    assert history_snapshot(spark, f"{db}.raw", f"{db}.hist") == "2024-01-05"
    overwrite_raw(spark.createDataFrame([], df.schema), f"{db}.raw")
    assert history_snapshot(spark, f"{db}.raw", f"{db}.hist") == "2001-01-31"
    assert rows(spark.table(f"{db}.hist"), "k", "batchdate") == [(1, "2024-01-05"), (2, "2024-01-05")]


def test_ingest_partition_counts_the_batch(spark):
    db = _db(spark)
    df = spark.createDataFrame([(1, "a", "2024-01-01")], "k int, v string, batchdate string")
    create_feed_table(spark, f"{db}.nohist", df.schema, new_dir(spark, "nh"))
    overwrite_raw(df, f"{db}.nohist")
    new = spark.createDataFrame([(i, "x") for i in range(7)], "k int, v string")
    assert ingest_partition(spark, new, f"{db}.nohist", "2024-01-02") == 7
    assert ingest_partition(spark, new.limit(3), f"{db}.nohist", "2024-01-02") == 3
    assert spark.table(f"{db}.nohist").count() == 4


def test_bucketed_feed_shuffles_only_the_delta(spark, sf):
    from feedlake.plans import build_raw

    db = _db(spark)
    orders = fx.table(spark, sf, "orders")
    stamped = orders.withColumn("batchdate", F.lit("2001-01-31"))
    for t in ("raw", "history"):
        create_feed_table(spark, f"{db}.{t}", stamped.schema, new_dir(spark, t), buckets=4, bucket_keys=["o_orderkey"])
    spec = FeedSpec(pre_raw_table=f"{db}.pre_raw", raw_table=f"{db}.raw", history_table=f"{db}.history",
                    primary_key=("o_orderkey",), buckets=4)
    k = F.col("o_orderkey")
    counts = []
    for d, delta in [("2024-01-01", orders), ("2024-01-02", orders.where(k % 10 >= 7).withColumn("o_orderstatus", F.lit("U")))]:
        pre = new_dir(spark, "pre_raw")
        delta.write.parquet(pre)
        spark.sql(f"DROP TABLE IF EXISTS {spec.pre_raw_table}")
        spark.catalog.createTable(spec.pre_raw_table, path=pre, source="parquet")
        counts.append(run_feed(spark, spec, d))
    assert counts[1]["delta"] + counts[1]["unchanged"] == orders.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = build_raw(spark, spec, "2024-01-03")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    history_scan = [line for line in plan.splitlines() if ".history[" in line]
    assert history_scan and "Bucketed: true" in history_scan[0]
    # the only exchanges are on the delta side (repartition to the buckets)
    assert plan.count("Exchange hashpartitioning(o_orderkey") == plan.count("Exchange")


def test_full_refresh_and_no_history_feeds(spark, sf):
    db = _db(spark)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    stamped = df.withColumn("batchdate", F.lit("2001-01-31"))
    create_feed_table(spark, f"{db}.raw", stamped.schema, new_dir(spark, "raw"))
    create_feed_table(spark, f"{db}.history", stamped.schema, new_dir(spark, "hist"))
    pre = new_dir(spark, "pre")
    df.write.parquet(pre)
    spark.catalog.createTable(f"{db}.pre_raw", path=pre, source="parquet")
    full = FeedSpec(pre_raw_table=f"{db}.pre_raw", raw_table=f"{db}.raw", history_table=f"{db}.history",
                    primary_key=("k",), incremental=False)
    run_feed(spark, full, "2024-01-01")
    pre2 = new_dir(spark, "pre")
    spark.createDataFrame([(3, "c")], "k int, v string").write.parquet(pre2)
    spark.sql(f"DROP TABLE {db}.pre_raw")
    spark.catalog.createTable(f"{db}.pre_raw", path=pre2, source="parquet")
    res = run_feed(spark, full, "2024-01-02")
    assert res == {"batch_date": "2024-01-02", "delta": 1, "unchanged": 0, "history_partition": "2024-01-02",
                   "audit_count": 1}
    assert rows(spark.table(f"{db}.raw")) == [(3, "c", "2024-01-02")]
    nohist = FeedSpec(pre_raw_table=f"{db}.pre_raw", raw_table=f"{db}.raw", primary_key=("k",))
    res = run_feed(spark, nohist, "2024-01-03")
    assert res["delta"] == 1 and "history_partition" not in res


def test_empty_delta_run(spark):
    db = _db(spark)
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    stamped = df.withColumn("batchdate", F.lit("2001-01-31"))
    create_feed_table(spark, f"{db}.raw", stamped.schema, new_dir(spark, "raw"))
    create_feed_table(spark, f"{db}.history", stamped.schema, new_dir(spark, "hist"))
    spec = FeedSpec(pre_raw_table=f"{db}.pre_raw", raw_table=f"{db}.raw", history_table=f"{db}.history",
                    primary_key=("k",))
    for d, data in (("2024-01-01", [(1, "a")]), ("2024-01-02", [])):
        pre = new_dir(spark, "pre")
        spark.createDataFrame(data, "k int, v string").write.parquet(pre)
        spark.sql(f"DROP TABLE IF EXISTS {db}.pre_raw")
        spark.catalog.createTable(f"{db}.pre_raw", path=pre, source="parquet")
        res = run_feed(spark, spec, d)
    assert res["delta"] == 0 and res["unchanged"] == 1
    assert rows(spark.table(f"{db}.raw")) == [(1, "a", "2024-01-01")]
    # nothing at all: an empty delta over an empty history
    db2 = _db(spark)
    create_feed_table(spark, f"{db2}.raw", stamped.schema, new_dir(spark, "raw"))
    create_feed_table(spark, f"{db2}.history", stamped.schema, new_dir(spark, "hist"))
    pre = new_dir(spark, "pre")
    spark.createDataFrame([], "k int, v string").write.parquet(pre)
    spark.catalog.createTable(f"{db2}.pre_raw", path=pre, source="parquet")
    spec2 = FeedSpec(pre_raw_table=f"{db2}.pre_raw", raw_table=f"{db2}.raw", history_table=f"{db2}.history",
                     primary_key=("k",))
    res = run_feed(spark, spec2, "2024-01-03")
    assert res["delta"] == 0 and res["unchanged"] == 0


def test_num_partitions_bounds_raw_files(spark, sf):
    db = _db(spark)
    orders = fx.table(spark, sf, "orders").repartition(8)
    stamped = orders.withColumn("batchdate", F.lit("2001-01-31"))
    create_feed_table(spark, f"{db}.raw", stamped.schema, new_dir(spark, "raw"))
    pre = new_dir(spark, "pre")
    orders.write.parquet(pre)
    spark.catalog.createTable(f"{db}.pre_raw", path=pre, source="parquet")
    spec = FeedSpec(pre_raw_table=f"{db}.pre_raw", raw_table=f"{db}.raw", primary_key=("o_orderkey",),
                    num_partitions=2)
    run_feed(spark, spec, "2024-01-01")
    files = spark.table(f"{db}.raw").inputFiles()
    assert 1 <= len(files) <= 2


def test_bucketed_feed_with_a_hot_delta_key(spark):
    from feedlake.plans import build_raw

    db = _db(spark)
    schema = "k long, v string, batchdate string"
    for t in ("raw", "history"):
        create_feed_table(spark, f"{db}.{t}", spark.createDataFrame([], schema).schema, new_dir(spark, t),
                          buckets=4, bucket_keys=["k"])
    hist = spark.range(0, 3000).selectExpr("id AS k", "'h' AS v", "'2024-01-01' AS batchdate")
    append_raw(hist, f"{db}.history")
    # a third of the delta shares key 7; the rest updates keys 1000..2999
    delta = spark.range(0, 3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "'d' AS v")
    pre = new_dir(spark, "pre")
    delta.write.parquet(pre)
    spark.catalog.createTable(f"{db}.pre_raw", path=pre, source="parquet")
    spec = FeedSpec(pre_raw_table=f"{db}.pre_raw", raw_table=f"{db}.raw", history_table=f"{db}.history",
                    primary_key=("k",), buckets=4)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")  # force AQE to split
    try:
        snap = build_raw(spark, spec, "2024-01-02")
        got = snap.groupBy("v").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    delta_keys = {7} | {i for i in range(3000) if i % 3 != 0}
    carried = len([k for k in range(3000) if k not in delta_keys])
    assert dict((r["v"], r["count"]) for r in got) == {"d": 3000, "h": carried}
