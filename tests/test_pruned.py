"""The difference of nearly equal sides by digests of key buckets."""

import pytest
from pyspark.sql import functions as F

from feedlake.operators import bucket_digests, difference, pruned_difference
from feedlake.plans import reconcile
from feedlake.sinks import create_feed_table, overwrite_raw
from feedlake.spec import ReconSpec
from feedlake.workspace import materialize, new_dir, new_name


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def sides(spark):
    base = spark.range(0, 20_000, 1, 6).select(
        F.when(F.col("id") % 997 == 0, None).otherwise(F.col("id")).alias("K"),
        F.concat(F.lit("v"), F.col("id") % 7).alias("v"), (F.col("id") / 3).alias("bucket"), F.lit(None).cast("string").alias("w"),
        F.array(F.col("id"), F.lit(None).cast("bigint")).alias("xs"), F.struct(F.col("id").alias("p"), F.lit(None).cast("int").alias("q")).alias("s"),
    )
    base = base.unionByName(base.limit(300)).unionByName(base.where("K is null"))  # repeated rows, hot null key
    k = F.col("K")
    changed = base.where(k.isNull() | (k != 77)).withColumns({
        "v": F.when(k == 5, "new").when(k == 6, None).otherwise(F.col("v")),
        "w": F.when(k == 6, F.col("v")).otherwise(F.col("w")),  # a value moves to a null's place
        "xs": F.when(k == 9, F.array(F.lit(None).cast("bigint"), k)).otherwise(F.col("xs")),
        "s": F.when(k == 12, F.struct(F.lit(None).cast("bigint").alias("p"), F.lit(12).alias("q"))).otherwise(F.col("s")),
    })
    more = changed.where("K = 40").withColumn("K", F.lit(10**9))
    return materialize(changed.unionByName(more), "changed"), materialize(base, "base")


@pytest.mark.parametrize("buckets", [1, 64, 1 << 16])
def test_same_rows_as_the_whole_difference(sides, buckets):
    for left, right in (sides, sides[::-1], (sides[0], sides[0]), (sides[0], sides[1].limit(0)), (sides[0].limit(0), sides[1])):
        got = pruned_difference(left, right, "k", buckets)
        assert same_rows(got, difference(left, right)) and got.columns == left.columns


def test_only_unlike_buckets_reach_the_shuffle(sides):
    left, right = sides
    a, b = bucket_digests(left, ["K"], 1 << 16), bucket_digests(right, ["K"], 1 << 16)
    unlike = a.exceptAll(b).select("bucket")
    assert 4 <= unlike.count() <= 7  # 5, 6, 9, 12, the new key, and 77's bucket if another key shares it
    plan = pruned_difference(left, right, "k")._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("LeftSemi, BuildRight") == 2 and plan.count("Exchange hashpartitioning") == 1
    # below the one row shuffle, both sides pass the broadcast semi join
    assert plan.index("Exchange hashpartitioning") < plan.index("LeftSemi, BuildRight")


def test_columns_are_matched_by_position_and_counted(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "a")], "id int, name string")
    assert [tuple(r) for r in pruned_difference(left, right, "K").collect()] == [(2, "b")]
    with pytest.raises(ValueError, match="columns"):
        pruned_difference(left, right.select("id"), "k")


def test_reconciliation_by_digests_gives_the_same_reports(spark):
    name, source = new_name("raw"), new_name("source")
    raw = spark.range(500).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"))
    create_feed_table(spark, name, raw.withColumn("batchdate", F.lit("x")).schema, new_dir(spark, name))
    overwrite_raw(raw, name, "2024-01-02")
    raw.withColumn("v", F.when(F.col("k") < 3, "z").otherwise(F.col("v"))).unionByName(spark.createDataFrame([(900, "n")], "k int, v string")).createOrReplaceTempView(source)
    reports = []
    for pruned in (False, True):
        out = reconcile(spark, ReconSpec(name, ("k",), new_dir(spark, "out"), input_table=source, pruned=pruned), "2024-01-02")
        assert out["difference"] == 4
        reports.append(sorted(tuple(r) for r in spark.read.csv(out["info_path"], header=True).collect()))
    assert reports[0] == reports[1] == [("0", "[v]"), ("1", "[v]"), ("2", "[v]"), ("900", "new record")]
