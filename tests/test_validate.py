import pytest

from feedlake.plans import ValidationError, schema_checks, validate_files, validate_schema
from feedlake.workspace import new_dir
from tests.conftest import rows


def _report(df):
    return {(r["check"], r["column_name"]): r["violations"] for r in df.collect()}


def test_schema_gate_rules(spark):
    df = spark.createDataFrame(
        [("1", 10, "x", 1), ("2", None, "y", 1), ("2", 20, "z", 1), (None, 30, "w", 1), ("bad", 40, "v", 1)],
        "id string, amount int, name string, extra int",
    )
    target = [("ID", "bigint"), ("name", "string"), ("amount", "int"), ("missing", "date")]
    rep = _report(schema_checks(df, target, "id"))
    assert rep[("missing_column", "missing")] == 1
    assert rep[("extra_column", "extra")] == 1
    assert rep[("column_order", "amount")] == 1 and rep[("column_order", "name")] == 1
    assert rep[("uncastable", "ID")] == 1  # 'bad'
    assert rep[("uncastable", "amount")] == 0
    assert rep[("null_key", "id")] == 1
    assert rep[("duplicate_key", "id")] == 2
    ok, _ = validate_schema(df, target, "id")
    assert not ok


def test_schema_gate_passes_on_clean_data(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string")
    ok, rep = validate_schema(df, df.schema, ["id"])
    assert ok and all(r["violations"] == 0 for r in rep.collect())


def test_file_vs_table_validation(spark):
    table = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, s string")
    files = new_dir(spark, "files")
    table.write.option("sep", "|").csv(files)
    n, diff = validate_files(spark, files, table, "|", new_dir(spark, "out"))
    assert n == 1 and rows(diff) == [(2, "")]  # table nulls show as differences (file side filled)
    with pytest.raises(ValidationError):
        validate_files(spark, files, table, "|", fail_on_diff=True)


def test_validate_landing_job(spark):
    from feedlake.plans import validate_landing
    from feedlake.sinks import create_feed_table
    from feedlake.workspace import new_name

    db = new_name("val_db")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{new_dir(spark, db)}'")
    pre = spark.createDataFrame([(1, "a"), (2, None)], "k int, s string")
    pre_path = new_dir(spark, "pre")
    pre.write.parquet(pre_path)
    spark.catalog.createTable(f"{db}.pre_raw", path=pre_path, source="parquet")
    create_feed_table(spark, f"{db}.raw", spark.createDataFrame([], "k int, s string, batchdate string").schema,
                      new_dir(spark, "raw"))
    files = new_dir(spark, "files")
    pre.write.option("sep", "|").csv(files)
    prefix = new_dir(spark, "out")
    res = validate_landing(spark, f"{db}.pre_raw", f"{db}.raw", "k", files, "|", output_prefix=prefix)
    assert res["file_differences"] == 1 and res["schema_ok"]
    assert res["output_path"].startswith(prefix + "/") and spark.read.json(res["output_path"]).count() == 1
    assert validate_landing(spark, f"{db}.pre_raw", f"{db}.raw", "k")["file_differences"] is None
    dup = spark.createDataFrame([(1, "a"), (1, "b")], "k int, s string")
    dup_path = new_dir(spark, "dup")
    dup.write.parquet(dup_path)
    spark.catalog.createTable(f"{db}.dup", path=dup_path, source="parquet")
    with pytest.raises(ValidationError):
        validate_landing(spark, f"{db}.dup", f"{db}.raw", "k")


def test_the_gate_shows_the_first_and_last_bad_row_of_each_rule(spark):
    df = spark.createDataFrame(
        [(1, "7", None, "a.csv"), (2, "x", None, "a.csv"), (None, "y", None, "b.csv"), (3, None, "3|q|w", "b.csv"), (1, "8", None, "c.csv")],
        "id int, n string, rejected_line string, source_file string",
    )
    report = schema_checks(df, [("id", "int"), ("n", "int"), ("gone", "int")], "id", evidence=True)
    got = {(r.check, r.column_name): (r.violations, r.first_example, r.last_example) for r in report.collect()}
    assert got == {
        ("missing_column", "gone"): (1, None, None),
        ("uncastable", "id"): (0, None, None),
        ("uncastable", "n"): (2, '{"id":2,"value":"x","source_file":"a.csv"}', '{"value":"y","source_file":"b.csv"}'),
        ("rejected_line", "rejected_line"): (1, *['{"id":3,"value":"3|q|w","source_file":"b.csv"}'] * 2),
        ("null_key", "id"): (1, *['{"source_file":"b.csv"}'] * 2),
        ("duplicate_key", "id"): (2, *['{"id":1,"n":2}'] * 2),
    }
    ok, report = validate_schema(df.drop("rejected_line"), [("id", "int"), ("n", "int")], "id")
    assert not ok and report.where("first_example is not null").count() == 3
    plain = schema_checks(df, [("id", "int")], "id")
    assert plain.columns == ["check", "column_name", "violations"]
