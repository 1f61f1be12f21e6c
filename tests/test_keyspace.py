import math

import pytest
from pyspark.sql import functions as F

from cellforge.operators import keyspace
from cellforge.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_benford_shipped_values(spark):
    cdf = {r.prefix: r.cdf for r in keyspace.benford_cdf(spark, 3).collect()}
    assert len(cdf) == 900
    assert cdf[100] == 0.0
    assert abs(cdf[200] - 0.3010300) < 5e-8
    assert abs(cdf[999] - 0.9995655) < 5e-8
    assert abs(cdf[101] - 0.0043214) < 5e-8


def test_partition_ids_n10(spark):
    df = spark.createDataFrame([("999",), ("9990",), ("abcd",), ("2000",), ("1000",)], "key string")
    got = {r.key: r.partition for r in keyspace.assign_partition(df, "key", 10).collect()}
    assert got == {"999": 0, "9990": 9, "abcd": 0, "2000": 3, "1000": 0}
    one = {r.partition for r in keyspace.assign_partition(df, "key", 1).collect()}
    assert one == {0}


def test_partition_float32_rule(spark):
    # n=220, prefix 276: float32 arithmetic differs from a plain double floor.
    df = spark.createDataFrame([("2760",)], "key string")
    pid = keyspace.assign_partition(df, "key", 220).first().partition
    import numpy as np

    cdf = round(math.log10(2.76), 7)
    assert pid == int(np.float32(cdf) * np.float32(220))


def test_sampled_cdf_properties(spark):
    kc = fx.line_input(spark, SF_SMALL, "key_counts")
    rows = sorted(keyspace.sampled_cdf(kc, "key", "cnt").collect())
    assert len(rows) == 900 and rows[0].cdf == 0.0
    assert all(a.cdf <= b.cdf for a, b in zip(rows, rows[1:]))
    assert rows[-1].cdf < 1.0
    total = sum(r.n for r in rows)
    assert total == kc.agg(F.sum("cnt")).first()[0]


def test_sampled_cdf_lumps_small_prefixes(spark):
    df = spark.createDataFrame([("5", 1), ("abc", 1), ("150", 2), (" +99x", 1)], "key string, cnt long")
    m = {r.prefix: r.n for r in keyspace.prefix_mass(df, "key", "cnt").collect()}
    assert m == {100: 3.0, 150: 2.0}


def test_sampled_cdf_as_partitioner(spark):
    kc = fx.line_input(spark, SF_SMALL, "key_counts")
    cdf = keyspace.sampled_cdf(kc, "key", "cnt")
    parts = keyspace.assign_partition(kc, "key", 8, cdf=cdf)
    ids = {r.partition for r in parts.collect()}
    assert ids <= set(range(8))
    placed = keyspace.place_by_partition(parts, 8)
    assert placed.rdd.getNumPartitions() == 8
    assert placed.select((F.spark_partition_id() == F.col("partition")).alias("ok")).where("not ok").count() == 0


def test_histogram_null_bin(spark):
    df = spark.createDataFrame([("100",), ("999",), ("99",), ("x12",)], "key string")
    got = {r.bin: r.n for r in keyspace.partition_histogram(df, "key", bins=10).collect()}
    assert got == {0: 1, 9: 1, None: 2}


def test_sampled_cdf_without_samples(spark):
    empty = spark.createDataFrame([], "key string, cnt long")
    rows = keyspace.sampled_cdf(empty, "key", "cnt").collect()
    assert len(rows) == 900 and all(r.cdf is None for r in rows)


def test_multibyte_short_key_goes_to_partition_zero(spark):
    # 4 or more bytes but fewer than 3 characters
    df = spark.createDataFrame([("é√",), ("ü1",)], "key string")
    assert {r.partition for r in keyspace.assign_partition(df, "key", 10).collect()} == {0}


def test_region_starts_of_a_hot_prefix(spark):
    """A third of the keys under one prefix cannot be cut into regions at it; more characters can."""
    keys = spark.range(0, 9000).selectExpr("cast(if(id % 3 = 0, 500000 + id % 1000, 100000 + id * 97 % 900000) as string) as key")
    with pytest.raises(ValueError, match="use more characters"):
        keyspace.region_starts(keyspace.sampled_cdf(keys, "key", chars=3), 8, chars=3)
    starts = keyspace.region_starts(keyspace.sampled_cdf(keys, "key", chars=5), 8, chars=5)
    assert len(starts) == 7 and starts == sorted(set(starts))
    assert keyspace.region_starts(keyspace.sampled_cdf(keys.limit(0), "key"), 8) == []
