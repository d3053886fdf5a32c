"""Plan properties that matter at scale, checked on the physical plans Spark builds."""

import pytest

import __spark_entry__ as e
from feedlake import fixtures as fx
from feedlake.operators import latest_batch, unchanged_records
from feedlake.sinks import append_raw, create_feed_table
from feedlake.sources import scan_batch
from feedlake.workspace import new_dir

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(e.queries()))
def test_no_pairs_no_python_in_any_query(spark, sf, name):
    plan = _plan(e.queries()[name](spark, sf))
    assert not [f for f in FORBIDDEN if f in plan], plan


def _daily(spark, sf):
    ev = fx.daily_events(spark, sf)
    db = fx.work_database(spark)
    create_feed_table(spark, f"{db}.daily", ev.schema, new_dir(spark, "daily"))
    append_raw(ev, f"{db}.daily")
    return f"{db}.daily"


def test_batch_scan_prunes_partitions(spark, sf):
    name = _daily(spark, sf)
    df = scan_batch(spark, name, "2024-01-15")
    scan = [line for line in _plan(df).splitlines() if "FileScan" in line][0]
    assert "PartitionFilters: [isnotnull(batchdate" in scan and "(batchdate#" in scan and "= 2024-01-15)" in scan
    files = df.inputFiles()
    assert files and all("batchdate=2024-01-15" in f for f in files)


def test_known_latest_batch_is_pruned_while_planning(spark, sf):
    name = _daily(spark, sf)
    df = latest_batch(spark.table(name), latest="2024-01-30")
    assert all("batchdate=2024-01-30" in f for f in df.inputFiles())
    sub = latest_batch(spark.table(name))
    scan = [line for line in _plan(sub).splitlines() if "FileScan" in line and "daily[" in line][0]
    assert "Subquery" in scan  # run-time pruning from the scalar subquery


def test_anti_join_reads_only_the_delta_keys(spark, sf):
    plan = _plan(unchanged_records(fx.history(spark, sf), fx.delta(spark, sf), ["o_orderkey"]))
    schemas = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line]
    assert "struct<o_orderkey:bigint>" in schemas
