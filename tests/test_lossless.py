"""Nothing is lost without a word: staging, key names, source columns, repeated rows, control characters."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from feedlake.functions.columns import try_cast
from feedlake.operators import difference
from feedlake.plans import validate_schema
from feedlake.plans.recon import align_source
from feedlake.sinks import stage_landing
from feedlake.workspace import new_dir

SCHEMA = StructType().add("id", "integer").add("v", "string").add("batchdate", "string")


def landing(spark, days):
    path = new_dir(spark, "landing")
    for day, lines in days.items():
        folder = f"{path.removeprefix('file:')}/batchdate={day}"
        os.makedirs(folder)
        with open(f"{folder}/a.csv", "w") as f:
            f.write("\n".join(lines) + "\n")
    return path


def stage(spark, src, dst, **k):
    return stage_landing(spark, src, dst, SCHEMA, "|", "csv", **k)


def test_a_second_staging_keeps_the_first(spark):
    out = new_dir(spark, "staged")
    stage(spark, landing(spark, {"2024-01-01": ["1|a"]}), out)
    both = stage(spark, landing(spark, {"2024-01-02": ["2|b"]}), out)
    assert sorted((r.id, r.batchdate) for r in both.collect()) == [(1, "2024-01-01"), (2, "2024-01-02")]


def test_a_batch_date_picks_its_folder(spark):
    src = landing(spark, {"2024-01-02": ["2|b"], "2024-01-03": ["3|c"]})
    got = stage(spark, src, new_dir(spark, "staged"), batch_date="2024-01-02").collect()
    assert [(r.id, r.v, r.batchdate) for r in got] == [(2, "b", "2024-01-02")]


def test_lines_that_do_not_fit_keep_their_text_and_fail_the_gate(spark):
    src = landing(spark, {"2024-01-01": ["1|a", "x|b", "3|c|extra"]})
    got = stage(spark, src, new_dir(spark, "staged"))
    assert {r.rejected_line for r in got.collect()} == {None, "x|b", "3|c|extra"}
    ok, report = validate_schema(got.drop("source_file", "batchdate"), [("id", "int"), ("v", "string")], "id")
    assert not ok
    assert {(r.check, r.violations) for r in report.where("violations > 0").collect()} >= {("rejected_line", 2)}


def test_a_misspelt_key_fails_the_gate(spark):
    df = spark.createDataFrame([(1,)], "id int")
    ok, report = validate_schema(df, [("id", "int")], "nokey")
    assert not ok and [(r.check, r.column_name) for r in report.where("violations > 0").collect()] == [("missing_column", "nokey")]


def test_source_columns_raw_lacks_are_refused_unless_dropped(spark):
    raw, source = spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([(1, 2)], "id int, extra int")
    with pytest.raises(ValueError, match="extra"):
        align_source(source, raw)
    assert align_source(source, raw, "extra").columns == ["id"]


def test_difference_has_one_shuffle_and_no_join_and_takes_repeated_rows(spark):
    left = spark.range(9000).select((F.col("id") % 30).alias("k"), F.when(F.col("id") % 3 == 0, None).otherwise("x").alias("v"))
    right = spark.range(6000).select(F.lit(1).cast("bigint").alias("a"), F.lit("x").alias("b"))
    got = difference(left, right)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, left.subtract(right).collect()), key=repr)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan
    fresh = difference(left, right)._jdf.queryExecution().executedPlan().toString()
    assert fresh.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("text", ["\x015", "\x085", "5\x7f", "\t5 \n", "5\x00", "a5", "5 5", "", " "])
def test_try_cast_trims_as_spark_does(spark, text):
    df = spark.createDataFrame([(text,)], "s string")
    c = F.col("s")
    source, target = df.schema["s"].dataType, IntegerType()
    row = df.select(try_cast(c, source, target).alias("a"), c.try_cast("int").alias("b")).first()
    assert row.a == row.b
