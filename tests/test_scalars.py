from pyspark.sql import functions as F

from cellforge.functions.scalars import flat_from_millis, flat_to_millis, ntz_to_millis, row_json


def test_flat_to_millis(spark):
    df = spark.createDataFrame([("20240102030405",), ("0",), (None,), ("bad",)], "s string")
    got = [r.m for r in df.select(flat_to_millis("s").alias("m")).collect()]
    assert got == [1704164645000, None, None, None]
    back = df.limit(1).select(flat_from_millis(flat_to_millis("s")).alias("f")).first().f
    assert back == "20240102030405"


def test_flat_to_millis_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("20240102030405",)], "s string")
        assert df.select(flat_to_millis("s").alias("m")).first().m == 1704164645000
        ntz = spark.sql("select timestamp_ntz'2024-01-02 03:04:05.678901' as t")
        assert ntz.select(ntz_to_millis("t").alias("m")).first().m == 1704164645678
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_row_json(spark):
    df = spark.createDataFrame([("a", None, 5)], "x string, y string, z int")
    assert df.select(row_json(["x", "y", "z"], "x,y,z").alias("j")).first().j == '{"x":"a","z":5}'
    assert df.select(row_json(["x", "y", "z"], "x,y").alias("j")).first().j is None
    quoted = spark.createDataFrame([('say "hi"',)], "x string")
    assert quoted.select(row_json([F.col("x")], ["x"]).alias("j")).first().j == '{"x":"say \\"hi\\""}'


def test_tuple_json_leaves_out_nested(spark):
    from cellforge.functions.scalars import tuple_json

    df = spark.createDataFrame([("a", [1, 2], 5)], "x string, y array<int>, z int")
    assert tuple_json(df, ["x", "y", "z"], "x,y,z").first().json == '{"x":"a","z":5}'
