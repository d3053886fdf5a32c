"""A load that stops is taken up where it stood; audit events by key; string settings; files of bucketed tables."""

import os

import pytest
from pyspark.sql import functions as F

from feedlake.plans import after_load, committed_batches, feed, ingest, load_raw, read_ledger, run_feed, run_landing
from feedlake.plans.validate import ValidationError
from feedlake.sinks import create_feed_table, overwrite_partition, overwrite_raw, read_audit
from feedlake.sinks.audit import record_values
from feedlake.spec import FeedSpec, ReconSpec, fanout_targets
from feedlake.workspace import new_dir, new_name

SCHEMA = "id int, v string, batchdate string"
DAY1, DAY2 = "2024-01-01", "2024-01-02"


def rows(spark, name):
    return sorted(map(tuple, spark.table(name).select("id", "v", "batchdate").collect()))


@pytest.fixture
def loaded(spark):
    """A feed with one day loaded and the next day staged; its ledger and audit folders."""
    names = {t: new_name(t) for t in ("pre", "raw", "hist")}
    empty = spark.createDataFrame([], SCHEMA)
    for t in ("raw", "hist"):
        create_feed_table(spark, names[t], empty.schema, new_dir(spark, t))
    spec = FeedSpec(names["pre"], names["raw"], ("id",), names["hist"])
    ledger, audit = new_dir(spark, "ledger"), new_dir(spark, "audit")
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").createOrReplaceTempView(names["pre"])
    run_feed(spark, spec, DAY1, audit, ledger_path=ledger)
    spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string").createOrReplaceTempView(names["pre"])
    return spec, ledger, audit


IMAGE = [(1, "a", DAY1), (2, "B", DAY2), (3, "c", DAY2)]
HISTORY = [(1, "a", DAY1), (1, "a", DAY2), (2, "B", DAY2), (2, "b", DAY1), (3, "c", DAY2)]
EVENTS = {"base table count": "2", "unchanged rec count": "1", "Partition Date": DAY2, "Delta Count Raw": "2"}


def stop(*_a, **_k):
    raise RuntimeError("killed")


def after(work):
    """The step does its work, and the run is killed before its entry says so."""

    def run(*a, **k):
        work(*a, **k)
        raise RuntimeError("killed")

    return run


# each: the step to stop at, and whether its work is done before the stop
@pytest.mark.parametrize("step, late", [("load_raw", False), ("load_raw", True), ("history_snapshot", False), ("history_snapshot", True),
                                        ("post_batch_audit", False), ("record_values", True)])
def test_a_stopped_run_is_taken_up_where_it_stood(spark, loaded, monkeypatch, step, late):
    spec, ledger, audit = loaded
    with monkeypatch.context() as m:
        m.setattr(feed, step, after(getattr(feed, step)) if late else stop)
        with pytest.raises(RuntimeError, match="killed"):
            run_feed(spark, spec, DAY2, audit, ledger_path=ledger)
    assert [r.batchdate for r in committed_batches(spark, ledger, spec.raw_table).collect()] == [DAY1]
    with monkeypatch.context() as m:
        if step != "load_raw":
            m.setattr(feed, "load_raw", stop)  # done: must not run again
            m.setattr(feed, "validate_schema", stop)
        got = run_feed(spark, spec, DAY2, audit, ledger_path=ledger)
    assert (got["delta"], got["unchanged"], got["audit_count"], got["history_partition"]) == (2, 1, 2, DAY2)
    assert rows(spark, spec.raw_table) == IMAGE and rows(spark, spec.history_table) == HISTORY
    events = [(r.message, r.args["value"]) for r in read_audit(spark, audit).collect() if r.args["batchdate"] == DAY2]
    assert sorted(events) == sorted(EVENTS.items())
    assert sorted(r.batchdate for r in committed_batches(spark, ledger, spec.raw_table).collect()) == [DAY1, DAY2]


def test_a_finished_run_is_not_loaded_again_and_a_new_run_is(spark, loaded, monkeypatch):
    spec, ledger, audit = loaded
    first = run_feed(spark, spec, DAY2, audit, ledger_path=ledger)
    with monkeypatch.context() as m:
        for step in ("load_raw", "history_snapshot", "post_batch_audit", "validate_schema"):
            m.setattr(feed, step, stop)
        assert run_feed(spark, spec, DAY2, audit, ledger_path=ledger) == first
    spark.createDataFrame([(2, "BB")], "id int, v string").createOrReplaceTempView(spec.pre_raw_table)
    again = run_feed(spark, spec, DAY2, audit, ledger_path=ledger, run_id="2")
    assert (again["delta"], again["unchanged"]) == (1, 1) and rows(spark, spec.raw_table) == [(1, "a", DAY1), (2, "BB", DAY2)]
    events = {(r.message, r.args["value"]) for r in read_audit(spark, audit).collect() if r.args["batchdate"] == DAY2}
    assert len(events) == 4 and ("Delta Count Raw", "1") in events  # the batch's events, once
    assert {(r.run, r.step, r.state) for r in read_ledger(spark, ledger).where(F.col("batchdate") == DAY2).collect()} == {
        (run, step, "done") for run in "12" for step in ("gate", "raw", "history", "audit")}


def test_a_failed_gate_is_tried_again(spark, loaded):
    spec, ledger, audit = loaded
    spark.createDataFrame([(2, "x"), (2, "y")], "id int, v string").createOrReplaceTempView(spec.pre_raw_table)
    with pytest.raises(ValidationError):
        run_feed(spark, spec, DAY2, audit, ledger_path=ledger)
    spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string").createOrReplaceTempView(spec.pre_raw_table)
    run_feed(spark, spec, DAY2, audit, ledger_path=ledger)
    assert rows(spark, spec.raw_table) == IMAGE


def test_landing_is_a_step_too(spark, monkeypatch):
    names = {t: new_name(t) for t in ("pre", "bad", "raw")}
    create_feed_table(spark, names["raw"], spark.createDataFrame([], SCHEMA).schema, new_dir(spark, "raw"))
    spec, ledger, audit = FeedSpec(names["pre"], names["raw"], ("id",)), new_dir(spark, "ledger"), new_dir(spark, "audit")
    landing = new_dir(spark, "landing")
    os.makedirs(landing.removeprefix("file:"))
    with open(f"{landing.removeprefix('file:')}/a.csv", "w") as f:
        f.write("1,a\nbad\n")
    run = lambda: run_landing(spark, spec, DAY1, landing, names["bad"], new_dir(spark, "staged"), audit_path=audit, ledger_path=ledger)
    with monkeypatch.context() as m:
        m.setattr(feed, "load_raw", stop)
        with pytest.raises(RuntimeError):
            run()
    with monkeypatch.context() as m:
        m.setattr(feed, "stage_feed", stop)  # staged already
        got = run()
    assert (got["good"], got["bad"], got["delta"]) == (1, 1, 1) and rows(spark, names["raw"]) == [(1, "a", DAY1)]
    assert sum(r.job == "stage_landing" for r in read_audit(spark, audit).collect()) == 2


def test_events_under_a_key_replace_each_other(spark):
    path = new_dir(spark, "audit")
    for value in (1, 2):
        record_values(spark, path, "job", "s", DAY1, {"n": value}, key="s job 1")
        record_values(spark, path, "job", "s", DAY2, {"n": value, "m": 0}, key="s job 2")
    assert sorted((r.message, r.args["value"]) for r in read_audit(spark, path).collect()) == [("m", "0"), ("n", "2"), ("n", "2")]


def test_feed_settings_as_strings():
    options = {"source_table": "pre", "target_table": "raw", "history_table": "hist", "primary_key": "a, b ,", "incrementalload": "true"}
    spec = FeedSpec.from_options(options, "db")
    assert spec == FeedSpec("db.pre", "db.raw", ("a", "b"), "db.hist", True, 30)
    for flag in ("True", "TRUE", " true", "1", "yes", "", "false"):
        assert not FeedSpec.from_options({**options, "incrementalload": flag}).incremental
    assert [FeedSpec.from_options(options, num_partitions=n).num_partitions for n in (None, "", "  ", "7", "0")] == [30, 30, 30, 7, None]
    del options["incrementalload"], options["history_table"]
    assert FeedSpec.from_options(options) == FeedSpec("pre", "raw", ("a", "b"), None, False, 30)


def test_fanout_settings_as_strings():
    options = {"sotapp": "one, two", "one_access_bucket": "/zone/1/", "one_access_file_prefix": "feeds/x/", "two_access_bucket": "/zone/2", "two_access_file_prefix": "y"}
    assert fanout_targets(options) == ["/zone/1/feeds/x", "/zone/2/y"]
    with pytest.raises(KeyError):
        fanout_targets({**options, "sotapp": "three"})


def test_the_job_after_a_load_follows_its_flag(spark, loaded):
    spec, *_ = loaded
    source = new_name("source")
    spark.createDataFrame([(1, "a"), (2, "x")], "id int, v string").createOrReplaceTempView(source)
    recon = ReconSpec(raw_table=spec.raw_table, primary_key=("id",), output_path=new_dir(spark, "out"), input_table=source)
    assert after_load(spark, "true", spec.raw_table, DAY1) == {"audit_count": 2}
    assert after_load(spark, "false", spec.raw_table, DAY1, recon)["difference"] == 1
    assert [after_load(spark, m, spec.raw_table, DAY1, recon) for m in ("True", "", "no", "TRUE")] == [None] * 4
    with pytest.raises(ValueError):
        after_load(spark, "false", spec.raw_table, DAY1)


def bucket_files(spark, name, day):
    """{bucket: files} of one batch, by the bucket number in Spark's file names."""
    out = {}
    for f in spark.table(name).where(F.col("batchdate") == day).inputFiles():
        b = os.path.basename(f).split("_")[-1].split(".")[0]
        out[b] = out.get(b, 0) + 1
    return out


@pytest.mark.parametrize("n, most", [(None, 99), (3, 1), (8, 1), (32, 4)])
def test_files_of_a_bucketed_table_with_a_hot_key(spark, n, most):
    name = new_name("bucketed")
    df = spark.range(0, 6000, 1, 10).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("id"),
                                            F.col("id").cast("string").alias("v"), F.create_map(F.lit("k"), "id").alias("m"))
    create_feed_table(spark, name, df.withColumn("batchdate", F.lit("x")).schema, new_dir(spark, name), buckets=8, bucket_keys=["id"])
    for write in (lambda: overwrite_raw(df, name, DAY1, n), lambda: overwrite_partition(df, name, DAY2, n)):
        write()
    for day in (DAY1, DAY2):
        files = bucket_files(spark, name, day)
        assert len(files) == 8 and max(files.values()) <= most
        if n == 32:
            assert max(files.values()) > 1  # the hot bucket is dealt over several tasks
    assert spark.table(name).groupBy("batchdate").count().orderBy("batchdate").collect() == [(DAY1, 6000), (DAY2, 6000)]


def test_a_bucketed_load_with_a_file_count_still_reads_history_in_place(spark):
    names = {t: new_name(t) for t in ("pre", "raw", "hist")}
    for t in ("raw", "hist"):
        create_feed_table(spark, names[t], spark.createDataFrame([], SCHEMA).schema, new_dir(spark, t), buckets=4, bucket_keys=["id"])
    spec = FeedSpec(names["pre"], names["raw"], ("id",), names["hist"], num_partitions=8, buckets=4)
    spark.range(200).select(F.col("id").cast("int"), F.lit("a").alias("v")).createOrReplaceTempView(names["pre"])
    run_feed(spark, spec, DAY1)
    assert max(bucket_files(spark, names["raw"], DAY1).values()) <= 2 and max(bucket_files(spark, names["hist"], DAY1).values()) <= 2
    spark.range(100, 110).select(F.col("id").cast("int"), F.lit("b").alias("v")).createOrReplaceTempView(names["pre"])
    assert load_raw(spark, spec, DAY2) == {"delta": 10, "unchanged": 190}
    assert ingest.staged_batch(spark, spec, DAY2).count() == 10
