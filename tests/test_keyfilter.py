"""The anti-join behind a bitmap of the delta's keys."""

import pytest
from pyspark.sql import functions as F

from feedlake.operators import split_by_keys, unmatched_rows
from feedlake.plans import load_raw
from feedlake.sinks import append_raw, create_feed_table
from feedlake.spec import FeedSpec
from feedlake.workspace import materialize, new_dir, new_name
from tests.conftest import rows

BITS = 1 << 15


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n in names:
        spark.conf.unset(n)


@pytest.fixture(scope="module")
def sides(spark):
    """Composite keys with null parts, repeats, a key with a third of the rows on both sides, and clashing column names."""
    n = F.col("id")
    left = spark.range(0, 30_000, 1, 6).select(
        F.when(n % 3 == 0, F.lit(7)).when(n % 101 == 0, None).otherwise(n).alias("a"),
        F.when(n % 3 == 0, F.lit("hot")).when(n % 103 == 0, None).otherwise(F.concat(F.lit("k"), n % 11)).alias("B"),
        n.alias("key_part"), F.lit("w").alias("key_words"),
    )
    right = left.where((n % 3 == 0) | (n % 50 < 2)).select("b", "a").withColumn("key_part", F.lit(1))
    return materialize(left, "left"), materialize(right, "right")


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("bits", [BITS, 3 * BITS, 1 << 24])
def test_same_rows_as_the_plain_anti_join(sides, bits):
    left, right = sides
    for r in (right, right.limit(0), right.where("a is null or b is null"), left.select("a", "b")):
        got = unmatched_rows(left, r, ["A", "b"], filter_bits=bits)
        assert got.columns == left.columns and same_rows(got, unmatched_rows(left, r, ["A", "b"]))
    assert unmatched_rows(left.limit(0), right, ["a", "b"], filter_bits=bits).isEmpty()


def test_rows_without_a_match_pass_the_join_only_by_chance(sides):
    left, right = sides
    maybe, past = split_by_keys(left, right, ["a", "B"], ["a", "b"], 1 << 24)
    matched = left.count() - unmatched_rows(left, right, ["a", "b"]).count()
    assert matched > 10_000 and matched <= maybe.count() <= matched + 10
    assert maybe.count() + past.count() == left.count()
    crowded, _ = split_by_keys(left, left.select("a", "b"), ["a", "B"], ["a", "b"], BITS)
    assert crowded.count() == left.where("a is not null and b is not null").count()


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "decimal(20,3)", "date", "timestamp", "boolean", "binary", "string"])
def test_every_bit_is_found_again(spark, kind):
    values = {"date": "date_add(date'1990-01-01', cast(id as int))", "timestamp": "timestamp_seconds(id * 977)", "boolean": "id % 2 = 0",
              "binary": "cast(cast(id as string) as binary)"}.get(kind, f"cast(id % 120 - 60 as {kind})" if kind == "tinyint" else f"cast(id as {kind})")
    df = spark.range(4_000).selectExpr(f"{values} as k")
    assert unmatched_rows(df, df, "k", filter_bits=BITS).isEmpty()
    maybe, past = split_by_keys(df, df, ["k"], ["k"], BITS)
    assert past.isEmpty() and maybe.count() == 4_000


def test_keys_that_a_hash_cannot_tell_take_the_plain_join(spark):
    for a, b in (("int", "bigint"), ("double", "double"), ("decimal(10,2)", "decimal(12,2)"), ("array<int>", "array<int>")):
        left, right = (spark.range(3).selectExpr(f"{'array(int(id))' if 'array' in t else f'cast(id as {t})'} as k") for t in (a, b))
        assert split_by_keys(left, right.where("true"), ["k"], ["k"], BITS) is None
        assert unmatched_rows(left, right, "k", filter_bits=BITS).isEmpty()
    with pytest.raises(ValueError, match="multiple"):
        unmatched_rows(left.select(F.lit(1).alias("k")), left.select(F.lit(1).alias("k")), "k", filter_bits=1000)


def _exchanges(node, out):
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return _exchanges(node.executedPlan(), out)
    if "QueryStage" in name:
        return _exchanges(node.plan(), out)
    if name == "Exchange":
        out.append((node.outputPartitioning().toString(), node.metrics().apply("dataSize").value()))
    for i in range(node.children().size()):
        _exchanges(node.children().apply(i), out)
    return out


def shuffled(df, key):
    """Bytes shuffled by `key` once the frame has been read."""
    df.collect()
    found = [(p, n) for p, n in _exchanges(df._jdf.queryExecution().executedPlan(), []) if f"({key}#" in p]
    return sum(n for _, n in found)


def test_history_past_the_filter_is_not_shuffled(spark, no_broadcast):
    history = materialize(spark.range(0, 200_000, 1, 8).selectExpr("id as k", "repeat('x', 100) as v"), "history")
    delta = materialize(spark.range(0, 400_000, 100).selectExpr("id as k"), "delta")
    plain, filtered = (unmatched_rows(history, delta, "k", filter_bits=b) for b in (None, 1 << 20))
    assert same_rows(plain, filtered)
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and plan.count("LeftAnti") >= 1 and "BroadcastExchange" in plan
    whole, part = shuffled(plain, "k"), shuffled(filtered, "k")
    assert whole > 20_000_000 and part < whole / 20, (whole, part)


def test_a_load_by_the_filter_writes_the_same_image(spark, no_broadcast):
    images = []
    for bits in (None, BITS):
        pre, raw, history = (new_name(n) for n in ("pre", "raw", "history"))
        schema = "k int, v string, batchdate string"
        for t in (raw, history):
            create_feed_table(spark, t, spark.createDataFrame([], schema).schema, new_dir(spark, t))
        append_raw(spark.createDataFrame([(1, "h", "2024-01-01"), (2, "h", "2024-01-01"), (None, "h", "2024-01-01")], schema), history)
        spark.createDataFrame([(2, "d"), (3, "d"), (None, "d")], "k int, v string").createOrReplaceTempView(pre)
        spec = FeedSpec(pre_raw_table=pre, raw_table=raw, history_table=history, primary_key=("k",), key_filter_bits=bits)
        assert load_raw(spark, spec, "2024-01-02") == {"delta": 3, "unchanged": 2}
        images.append(rows(spark.table(raw), "k", "v", "batchdate"))
    assert images[0] == images[1]
