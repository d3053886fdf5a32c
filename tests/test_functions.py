import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
)

from feedlake.functions import (
    array_to_string,
    cast_to_schema,
    drop_columns,
    keys_with_label,
    mismatch_array,
    mismatch_flag,
    prefix_nonkey,
    rename_columns,
    with_batchdate,
)
from feedlake.functions.columns import try_cast
from tests.conftest import rows

ODD = [" 12 ", "+3", "-0", "1.5", "1e3", "abc", "", " ", "99999999999", "9223372036854775808", "0x1F", "１２",
       "\t7\n", "NaN", "nan", "Infinity", "-inf", "1.", ".5", "1d", "2F", "1e", "e5", "--1", "1 2", "true", None,
       "12abc", "٣"]


@pytest.mark.parametrize("target", [ByteType(), ShortType(), IntegerType(), LongType(), FloatType(), DoubleType(),
                                    DecimalType(10, 2), DecimalType(38, 0)])
def test_shape_tested_try_cast_equals_try_cast(spark, target):
    df = spark.createDataFrame([(v,) for v in ODD], "s string")
    got = df.select(F.col("s").try_cast(target).alias("a"), try_cast(F.col("s"), StringType(), target).alias("b"))
    assert all(repr(r.a) == repr(r.b) for r in got.collect())


def test_projections(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "K int, v string, w double")
    assert with_batchdate(df, "2024-01-02").columns == ["K", "v", "w", "batchdate"]
    assert drop_columns(df, "").columns == ["K", "v", "w"]
    assert drop_columns(df, " w , nope").columns == ["K", "v"]
    assert rename_columns(df, {"v": "vv", "nope": "x"}).columns == ["K", "vv", "w"]
    assert prefix_nonkey(df, "k", "p_").columns == ["K", "p_v", "p_w"]
    assert keys_with_label(df, ["k"], "new record").collect()[0] == (1, "new record")
    with pytest.raises(ValueError):
        prefix_nonkey(df, "missing", "p_")


def test_cast_to_schema_by_name_with_nulls_for_bad_values(spark):
    df = spark.createDataFrame([("1", "x", "2024-01-05"), ("y", "2.5", "bad")], "a string, b string, c string")
    out = cast_to_schema(df, "c date, A bigint, b double")
    assert out.columns == ["c", "A", "b"]
    assert {(r["A"], r["b"]) for r in out.collect()} == {(1, None), (None, 2.5)}
    assert {str(r["c"]) for r in out.collect()} == {"2024-01-05", "None"}


def test_flags_array_and_string(spark):
    df = spark.createDataFrame([(1, 1, "a", "b"), (2, 2, None, "c"), (3, 4, "x", "x")], "l int, r int, s string, t string")
    arr = mismatch_array([mismatch_flag(F.col("l"), F.col("r"), "n"), mismatch_flag(F.col("s"), F.col("t"), "s")])
    got = [r[0] for r in df.orderBy("l").select(array_to_string(arr)).collect()]
    assert got == ["[s]", "[]", "[n]"]


def test_scale_conf_sizes_shuffle_partitions():
    from feedlake.session import scale_conf

    conf = scale_conf(100 * (1 << 40))  # a 100 TB shuffle at 256 MB per partition
    assert conf["spark.sql.shuffle.partitions"] == str(409600)
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert scale_conf(1 << 20)["spark.sql.shuffle.partitions"] == "200"
