import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellforge.functions.codecs import decode_value, encode_value
from cellforge.operators import tuples


def test_store_rows_ts_field_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, "a", "123"), (2, None, "abc"), (None, "z", "5")], "k long, v string, stamp string"
    )
    out = sorted(tuple(r) for r in tuples.store_rows(df, "f:v f:stamp", timestamp_field=2, now=99).collect())
    assert out == [("1", "f", "stamp", 123, "123"), ("1", "f", "v", 123, "a"), ("2", "f", "stamp", 99, "abc")]


def test_store_rows_checks_names(spark):
    df = spark.createDataFrame([("k", "a", 1)], "k string, a string, b int")
    with pytest.raises(ValueError):
        tuples.store_rows(df, "f:a")


def test_store_dynamic(spark):
    five = spark.createDataFrame([("r", "f", "q", "v", "7"), ("r", "f", "q2", None, "8")], "a string, b string, c string, d string, e string")
    assert [tuple(x) for x in tuples.store_dynamic(five, now=1).collect()] == [("r", "f", "q", 7, "v")]
    six = spark.createDataFrame([("r", "f", "q", "v", "abc", "x")], "a string, b string, c string, d string, e string, g string")
    assert [tuple(x) for x in tuples.store_dynamic(six, now=1).collect()] == [("r", "f", "q", 1, "v")]
    bad = spark.createDataFrame([("r", "f", "q", "v", "abc")], "a string, b string, c string, d string, e string")
    with pytest.raises(Exception):
        tuples.store_dynamic(bad, now=1).collect()


def test_store_bag(spark):
    df = spark.createDataFrame([("k1", ["k1", "b", "a"]), ("k2", ["k2", None, "x"]), (None, ["z", "y", "x"])],
                               "key string, bag array<string>")
    out = [tuple(r) for r in tuples.store_bag(df, "key", "bag", "id,zeta,alpha", "f", now=3).collect()]
    assert out == [("k1", "f", "alpha", 3, "a"), ("k1", "f", "zeta", 3, "b")]
    dup = spark.createDataFrame([("k", ["k", "first", "second"])], "key string, bag array<string>")
    out = [tuple(r) for r in tuples.store_bag(dup, "key", "bag", "id,n,n", "f", now=3).collect()]
    assert out == [("k", "f", "n", 3, "first")]
    long = spark.createDataFrame([("k", ["k", "a", "b"])], "key string, bag array<string>")
    with pytest.raises(Exception):
        tuples.store_bag(long, "key", "bag", "id,a", "f", now=3).collect()


def test_binary_int_minus_five(spark):
    df = spark.createDataFrame([(-5,)], "x int")
    b = df.select(encode_value(F.col("x"), T.IntegerType(), "binary").alias("b")).first().b
    assert bytes(b) == bytes.fromhex("FFFFFFFB")


@pytest.mark.parametrize(
    "dtype,values",
    [
        (T.IntegerType(), [0, 1, -1, 2147483647, -2147483648, None]),
        (T.LongType(), [0, -5, 9223372036854775807, -9223372036854775808, None]),
        (T.DoubleType(), [0.0, -1.5, 3.141592653589793, 1e300, None]),
        (T.FloatType(), [0.0, -1.5, 2.5, None]),
        (T.StringType(), ["", "abc", "é√", None]),
    ],
)
def test_binary_round_trip(spark, dtype, values):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", dtype)]))
    enc = df.select("x", encode_value(F.col("x"), dtype, "binary").alias("b"))
    dec = enc.select("x", decode_value(F.col("b"), dtype, "binary").alias("y")).collect()
    for r in dec:
        assert r.x == r.y


def test_binary_double_bits(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    b = df.select(encode_value(F.col("x"), T.DoubleType(), "binary").alias("b")).first().b
    assert bytes(b) == bytes.fromhex("3FF0000000000000")


def test_text_decode_bad_is_null(spark):
    df = spark.createDataFrame([("12",), ("bad",)], "v string")
    got = [r.y for r in df.select(decode_value(F.col("v"), T.IntegerType(), "text").alias("y")).collect()]
    assert got == [12, None]


def test_per_column_casters(spark):
    from cellforge.operators import scan

    df = spark.createDataFrame([("k", 7, "12"), ("j", -1, "x")], "k string, n int, s string")
    stored = tuples.store_rows(df, "f:n f:s", caster=["binary", "text"], now=1)
    assert stored.schema["value"].dataType == T.BinaryType()
    back = scan.scan_typed(stored, "f:n f:s", ["int", "bigint"], caster=["binary", "text"])
    assert sorted(tuple(r) for r in back.collect()) == [("j", -1, None), ("k", 7, 12)]


def test_record_without_values_writes_nothing_and_short_records_fail(spark):
    df = spark.createDataFrame([("k", None, None)], "k string, a string, b int")
    assert tuples.store_rows(df, "f:a f:b", now=1).count() == 0  # F11
    three = spark.createDataFrame([("r", "f", "q")], "a string, b string, c string")
    with pytest.raises(ValueError):  # F12
        tuples.store_dynamic(three)
