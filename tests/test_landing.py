"""From landing files to raw without a hand-made step; failed writes of every sink leave the old rows."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedlake.operators import difference
from feedlake.plans import deliver_request, run_feed, run_landing, validate_landing
from feedlake.plans.validate import ValidationError
from feedlake.sinks import append_raw, create_feed_table, load_target, overwrite_partition, overwrite_raw, publish_fanout, read_audit, stage_feed, stage_landing
from feedlake.spec import FeedSpec, RequestSpec
from feedlake.workspace import new_dir, new_name

SCHEMA = StructType().add("id", "integer").add("v", "string").add("batchdate", "string")


def land(path, days, name="a.csv"):
    for day, lines in days.items():
        folder = f"{path.removeprefix('file:')}/batchdate={day}"
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{name}", "w") as f:
            f.write("".join(line + "\n" for line in lines))
    return path


def feed(spark, history=True):
    names = {t: new_name(t) for t in ("pre", "bad", "raw", "hist")}
    for t in ("raw", "hist"):
        create_feed_table(spark, names[t], SCHEMA, new_dir(spark, t))
    return names, FeedSpec(names["pre"], names["raw"], ("id",), names["hist"] if history else None)


def rows(spark, name, *cols):
    return sorted(map(tuple, spark.table(name).select(*(cols or ("*",))).collect()), key=repr)


def test_two_batches_from_landing_to_history(spark):
    names, spec = feed(spark)
    src, at, audit = new_dir(spark, "landing"), new_dir(spark, "staged"), new_dir(spark, "audit")
    land(src, {"2024-01-01": ["1|a", "2|b", "x|bad", "3|c|extra"]})
    got = run_landing(spark, spec, "2024-01-01", src, names["bad"], at, "|", audit_path=audit)
    assert (got["good"], got["bad"], got["delta"]) == (2, 2, 2)
    assert rows(spark, names["raw"]) == [(1, "a", "2024-01-01"), (2, "b", "2024-01-01")]
    land(src, {"2024-01-02": ["2|B", "4|d", "nine"]}, "b.csv")
    got = run_landing(spark, spec, "2024-01-02", src, names["bad"], at, "|", audit_path=audit)
    assert (got["good"], got["bad"], got["unchanged"]) == (2, 1, 1)
    assert rows(spark, names["raw"], "id", "v") == [(1, "a"), (2, "B"), (4, "d")]
    assert rows(spark, names["hist"], "id", "batchdate") == [(1, "2024-01-01"), (1, "2024-01-02"), (2, "2024-01-01"), (2, "2024-01-02"), (4, "2024-01-02")]
    assert rows(spark, names["bad"]) == [("3|c|extra", "a.csv", "2024-01-01"), ("nine", "b.csv", "2024-01-02"), ("x|bad", "a.csv", "2024-01-01")]
    events = {(r.message, r.args["batchdate"]): r.args["value"] for r in read_audit(spark, audit).where("job = 'stage_landing'").collect()}
    assert events[("quarantined lines", "2024-01-01")] == "2" and events[("staged rows", "2024-01-02")] == "2"


def test_restaging_a_mended_batch_empties_its_quarantine_and_keeps_the_others(spark):
    names, _ = feed(spark)
    at = new_dir(spark, "staged")
    first = land(new_dir(spark, "landing"), {"2024-01-01": ["1|a", "x"], "2024-01-02": ["y", "2|b"]})
    assert stage_feed(spark, first, names["pre"], names["bad"], at, SCHEMA, "|", "csv") == {
        "2024-01-01": {"good": 1, "bad": 1}, "2024-01-02": {"good": 1, "bad": 1}}
    mended = land(new_dir(spark, "landing"), {"2024-01-01": ["1|a", "7|x"]})
    stage_feed(spark, mended, names["pre"], names["bad"], at, SCHEMA, "|", "csv")
    assert rows(spark, names["pre"], "id", "batchdate") == [(1, "2024-01-01"), (2, "2024-01-02"), (7, "2024-01-01")]
    assert rows(spark, names["bad"]) == [("y", "a.csv", "2024-01-02")]
    nothing = land(new_dir(spark, "landing"), {"2024-01-02": []})
    stage_feed(spark, nothing, names["pre"], names["bad"], at, SCHEMA, "|", "csv", batch_date="2024-01-02")
    assert rows(spark, names["pre"], "id") == [(1,), (7,)] and rows(spark, names["bad"]) == []


def test_a_failed_staging_leaves_the_tables(spark):
    names, _ = feed(spark)
    at = new_dir(spark, "staged")
    stage_feed(spark, land(new_dir(spark, "landing"), {"2024-01-01": ["1|a", "x"]}), names["pre"], names["bad"], at, SCHEMA, "|", "csv")
    with pytest.raises(Exception):
        stage_feed(spark, land(new_dir(spark, "landing"), {"2024-01-01": ["2|b", "x"]}), names["pre"], names["bad"], at, SCHEMA, "|", "csv", mode="FAILFAST")
    assert rows(spark, names["pre"], "id") == [(1,)] and len(rows(spark, names["bad"])) == 1


def test_too_many_bad_lines_and_a_failed_gate_stop_before_raw(spark):
    names, spec = feed(spark)
    src = land(new_dir(spark, "landing"), {"2024-01-01": ["1|a", "x", "y"], "2024-01-02": ["5|a", "5|b"]})
    with pytest.raises(ValidationError, match="2 of 3"):
        run_landing(spark, spec, "2024-01-01", src, names["bad"], new_dir(spark, "staged"), "|", max_rejected=0.5)
    assert rows(spark, names["raw"]) == [] and len(rows(spark, names["bad"])) == 2
    with pytest.raises(ValidationError, match="duplicate_key"):
        run_landing(spark, spec, "2024-01-02", src, names["bad"], new_dir(spark, "staged"), "|")
    assert rows(spark, names["raw"]) == []


def test_a_table_over_plainly_staged_files_loads_without_its_rejected_lines(spark):
    names, spec = feed(spark)
    src = land(new_dir(spark, "landing"), {"2024-01-01": ["1|a", "2|b"], "2024-01-02": ["3|c", "x|y"]})
    staged = new_dir(spark, "staged")
    df = stage_landing(spark, src, staged, SCHEMA, "|", "csv")
    create_feed_table(spark, names["pre"], df.schema, staged)
    spark.catalog.recoverPartitions(names["pre"])
    run_feed(spark, spec, "2024-01-01")
    assert rows(spark, names["raw"]) == [(1, "a", "2024-01-01"), (2, "b", "2024-01-01")]
    with pytest.raises(ValidationError, match="rejected_line"):
        run_feed(spark, spec, "2024-01-02")
    run_feed(spark, spec, "2024-01-02", check_schema=False)
    assert rows(spark, names["raw"], "id") == [(1,), (2,), (3,)]


def test_the_validation_job_takes_staged_tables(spark):
    names, _ = feed(spark)
    src = land(new_dir(spark, "landing"), {"2024-01-01": ["1|a", "2|b"]})
    stage_feed(spark, src, names["pre"], names["bad"], new_dir(spark, "staged"), SCHEMA, "|", "csv")
    got = validate_landing(spark, names["pre"], names["raw"], "id", files_path=f"{src}/batchdate=2024-01-01", sep="|")
    assert got["schema_ok"] and got["file_differences"] == 0


# ---- failing writes -------------------------------------------------------------------------------------


def failing(spark, **columns):
    """Rows of which the last fails in the executors."""
    df = spark.range(0, 8, 1, 4)
    for name, value in columns.items():
        df = df.withColumn(name, value)
    first = next(iter(columns))
    bad = F.when(F.col("id") == 7, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col(first))
    return df.withColumn(first, bad).select(*columns)


def test_a_failed_load_leaves_the_target(spark):
    name = new_name("target")
    spark.catalog.createTable(name, path=new_dir(spark, "target"), source="parquet", schema=StructType.fromDDL("k int, v string"))
    load_target(spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string"), name)
    with pytest.raises(Exception, match="stop"):
        load_target(failing(spark, k=F.lit(1), v=F.lit("z")), name)
    assert rows(spark, name) == [(1, "a"), (2, "b")]
    load_target(spark.createDataFrame([(3, "c")], "k int, k string"), name)  # one name twice: by position
    load_target(spark.table(name).union(spark.createDataFrame([(4, "d")], "k int, v string")), name)  # reads the target itself
    assert rows(spark, name) == [(3, "c"), (4, "d")]
    load_target(spark.createDataFrame([], "k int, v string"), name)
    assert rows(spark, name) == []


def test_a_failed_request_leaves_the_delivered_table_and_its_columns(spark):
    db = new_name("src")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{new_dir(spark, db)}'")
    spark.catalog.createTable(f"{db}.t", path=new_dir(spark, "t"), source="parquet", schema=StructType.fromDDL("k int"))
    spark.createDataFrame([(1,), (2,)], "k int").write.insertInto(f"{db}.t")
    zone = new_name("zone")
    zones = spark.createDataFrame([("z", new_dir(spark, "z"), zone)], "accesszone_id string, s3_location string, database_name string")
    ask = lambda *cols: spark.createDataFrame([("r", c, t) for c, t in cols], "requestid string, requestecol string, data_type string")
    good = RequestSpec("z", "r", db, "SELECT k, k * 10 AS ten FROM {athena_raw_db}.t")
    two = ask(("k", "int"), ("ten", "bigint"))
    target = deliver_request(spark, good, zones, two)
    assert rows(spark, target) == [(1, 10), (2, 20)]
    bad = RequestSpec("z", "r", db, "SELECT k, raise_error('stop') AS ten FROM {athena_raw_db}.t")
    for spec, columns, error in ((bad, two, "stop"), (good, ask(("k", "int")), "columns"), (good, ask(), "no columns")):
        with pytest.raises(Exception, match=error):
            deliver_request(spark, spec, zones, columns)
        assert rows(spark, target) == [(1, 10), (2, 20)] and spark.table(target).columns == ["k", "ten"]
    one = RequestSpec("z", "r", db, "SELECT cast(k AS string) FROM {athena_raw_db}.t")
    assert deliver_request(spark, one, zones, ask(("name", "string"))) == target
    assert rows(spark, target) == [("1",), ("2",)]
    left = [t.name for t in spark.catalog.listTables(zone)]
    assert left == [target.rpartition(".")[2]]


@pytest.mark.parametrize("one_batch", [True, False])
def test_a_failed_publication_leaves_the_batch_in_every_target(spark, one_batch):
    targets, day = [new_dir(spark, "za"), new_dir(spark, "zb")], "2024-01-01"
    batch = day if one_batch else None
    old = spark.createDataFrame([(1, "a", day)], "k int, v string, batchdate string")
    publish_fanout(old, targets, batch)
    publish_fanout(old.withColumn("batchdate", F.lit("2024-01-02")), targets, "2024-01-02" if one_batch else None)
    with pytest.raises(Exception, match="stop"):
        publish_fanout(failing(spark, k=F.lit(1), v=F.lit("z"), batchdate=F.lit(day)), targets, batch)
    for t in targets:
        got = spark.read.schema(old.schema).parquet(t)
        assert sorted(map(tuple, got.collect())) == [(1, "a", day), (1, "a", "2024-01-02")]
    if one_batch:  # an empty batch replaces the old one
        publish_fanout(old.limit(0), targets, day)
        assert [r.batchdate for t in targets for r in spark.read.schema(old.schema).parquet(t).collect()] == ["2024-01-02"] * 2


@pytest.mark.parametrize("batch_date", [None, "2024-01-01"])
def test_a_failed_plain_staging_leaves_the_batch(spark, batch_date):
    out = new_dir(spark, "staged")
    stage_landing(spark, land(new_dir(spark, "landing"), {"2024-01-01": ["1|a"]}), out, SCHEMA, "|", "csv", batch_date)
    with pytest.raises(Exception):
        stage_landing(spark, land(new_dir(spark, "landing"), {"2024-01-01": ["2|a", "x"]}), out, SCHEMA, "|", "csv", batch_date, mode="FAILFAST")
    assert [r.id for r in spark.read.parquet(out).collect()] == [1]


@pytest.mark.parametrize("write", [overwrite_raw, append_raw, lambda df, t: overwrite_partition(df, t, "2024-01-01")])
def test_unknown_columns_are_refused(spark, write):
    name = new_name("known")
    create_feed_table(spark, name, StructType.fromDDL("k int, batchdate string"), new_dir(spark, name))
    with pytest.raises(ValueError, match="extra"):
        write(spark.createDataFrame([(1, 2, "2024-01-01")], "k int, extra int, batchdate string"), name)


def test_difference_takes_any_column_name(spark):
    left = spark.createDataFrame([(1, 2), (3, 4)], "in_right int, __in_right int")
    right = spark.createDataFrame([(1, 2)], "in_right_ int, IN_RIGHT__ int")
    assert [tuple(r) for r in difference(left, right).collect()] == [(3, 4)]
