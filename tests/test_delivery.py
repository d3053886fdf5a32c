import pytest

from feedlake import fixtures as fx
from feedlake.plans import deliver_request, render_request_sql, run_request_sql
from feedlake.plans.delivery import resolve_zone
from feedlake.spec import RequestSpec
from feedlake.workspace import new_dir


def test_render_substitutes_and_leaves_the_rest():
    assert render_request_sql("SELECT *\n\tFROM {athena_raw_db}.t\r", "db1") == "SELECT *\n\tFROM db1.t\r"


def test_a_comment_in_a_template_ends_with_its_line(spark):
    df = run_request_sql(spark, "SELECT 1 AS a -- note\nUNION ALL SELECT 2 AS a", "db1")
    assert sorted(r["a"] for r in df.collect()) == [1, 2]
    with pytest.raises(ValueError):
        render_request_sql("x", "db; DROP")


def test_zone_lookup_requires_exactly_one_row(spark):
    zones = spark.createDataFrame(
        [("z1", "/a", "db_a"), ("z2", "/b", "db_b"), ("z2", "/c", "db_c")],
        "accesszone_id string, s3_location string, database_name string",
    )
    assert resolve_zone(zones, "z1") == ("/a", "db_a")
    with pytest.raises(ValueError):
        resolve_zone(zones, "z2")
    with pytest.raises(ValueError):
        resolve_zone(zones, "none")


def test_deliver_request_end_to_end(spark, sf):
    src = fx.source_database(spark, sf, ["customer", "orders"])
    zones = fx.access_zones(spark, sf, new_dir(spark, "zones"))
    spec = RequestSpec("nation_3", "req-asia", src, fx.REQUEST_SQL)
    target = deliver_request(spark, spec, zones, fx.request_columns(spark, sf))
    assert target == "zone_db_3.nation_3_req_asia_delivery"
    out = spark.table(target)
    assert out.columns == ["c_custkey", "c_name", "n_orders", "max_price"]
    assert dict(out.dtypes)["n_orders"] == "bigint"
    expected = spark.sql(f"SELECT count(DISTINCT o_custkey) FROM {src}.orders o JOIN {src}.customer c "
                         "ON c.c_custkey = o.o_custkey").first()[0]
    assert out.count() == expected
    # a second delivery replaces the target
    deliver_request(spark, spec, zones, fx.request_columns(spark, sf))
    assert spark.table(target).count() == expected
