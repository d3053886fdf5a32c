from pyspark.sql import functions as F

from feedlake.operators import (
    count_unchanged,
    full_refresh,
    incremental_snapshot,
    latest_batch,
    snapshot_date,
    unchanged_records,
    unmatched_rows,
)
from tests.conftest import rows

H = "a int, b int, v string, batchdate string"
D = "a int, b int, v string"


def test_null_key_parts_are_always_carried(spark):
    hist = spark.createDataFrame([(1, 2, "h1", "2024-01-01"), (None, 3, "h2", "2024-01-01"), (4, None, "h3", "2024-01-01")], H)
    delta = spark.createDataFrame([(1, 1, "d1"), (None, 3, "d2"), (4, None, "d3")], D)
    carried = unchanged_records(hist, delta, ["a", "b"])
    assert rows(carried, "v") == [("h1",), ("h2",), ("h3",)]
    snap = incremental_snapshot(delta, hist, "a,b", "2024-01-02")
    assert snap.count() == 6


def test_duplicate_delta_keys_are_kept(spark):
    hist = spark.createDataFrame([(1, 1, "h", "2024-01-01"), (2, 2, "h", "2024-01-01")], H)
    delta = spark.createDataFrame([(1, 1, "x"), (1, 1, "y")], D)
    snap = incremental_snapshot(delta, hist, ["a", "b"], "2024-01-02")
    assert rows(snap, "a", "v", "batchdate") == [(1, "x", "2024-01-02"), (1, "y", "2024-01-02"), (2, "h", "2024-01-01")]


def test_only_latest_batch_is_carried(spark):
    hist = spark.createDataFrame(
        [(1, 1, "old", "2023-12-01"), (2, 2, "old", "2023-12-01"), (1, 1, "new", "2024-01-01")], H
    )
    delta = spark.createDataFrame([(3, 3, "d")], D)
    assert rows(latest_batch(hist), "v") == [("new",)]
    assert rows(incremental_snapshot(delta, hist, ["a", "b"], "2024-01-02"), "a", "v") == [(1, "new"), (3, "d")]


def test_empty_delta_and_empty_history(spark):
    hist = spark.createDataFrame([(1, 1, "h", "2024-01-01")], H)
    empty_d = spark.createDataFrame([], D)
    empty_h = spark.createDataFrame([], H)
    delta = spark.createDataFrame([(2, 2, "d")], D)
    assert rows(incremental_snapshot(empty_d, hist, ["a"], "2024-01-02"), "v") == [("h",)]
    assert rows(incremental_snapshot(delta, empty_h, ["a"], "2024-01-02"), "v") == [("d",)]
    both = incremental_snapshot(empty_d, empty_h, ["a"], "2024-01-02")
    assert both.count() == 0
    assert snapshot_date(both).first()[0] == "2001-01-31"
    assert latest_batch(empty_h).count() == 0


def test_rerun_reads_the_previous_snapshot_with_before(spark):
    # the run of 2024-01-02 already wrote its own snapshot; a rerun must not treat it as history
    hist = spark.createDataFrame(
        [(1, 1, "jan1", "2024-01-01"), (1, 1, "jan2", "2024-01-02"), (5, 5, "only-jan2", "2024-01-02")], H
    )
    delta = spark.createDataFrame([(2, 2, "d")], D)
    quirk = incremental_snapshot(delta, hist, ["a"], "2024-01-02")
    assert rows(quirk, "v") == [("d",), ("jan2",), ("only-jan2",)]
    fixed = incremental_snapshot(delta, hist, ["a"], "2024-01-02", before="2024-01-02")
    assert rows(fixed, "v", "batchdate") == [("d", "2024-01-02"), ("jan1", "2024-01-01")]


def test_counts_and_full_refresh(spark):
    hist = spark.createDataFrame([(i, i, "h", "2024-01-01") for i in range(10)], H)
    delta = spark.createDataFrame([(i, i, "d") for i in range(5, 15)], D)
    assert count_unchanged(hist, delta, ["a"]).first()["unchangedcnt"] == 5
    assert unmatched_rows(hist, delta, ["A"]).count() == 5  # keys resolve case-insensitively
    fr = full_refresh(delta, "2024-01-03")
    assert fr.columns[-1] == "batchdate" and fr.where(F.col("batchdate") == "2024-01-03").count() == 10


def test_bad_batch_date_is_rejected(spark):
    import pytest

    delta = spark.createDataFrame([(1, 1, "d")], D)
    with pytest.raises(ValueError):
        full_refresh(delta, "2024-1-2' OR 1=1")
