"""Cases that once lost data or failed: floats, nested values, blank records, names, regions."""

import bisect
import math
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellforge.functions.codecs import decode_value, encode_value
from cellforge.operators import keyspace, scan, tuples
from cellforge.session import shared_path
from cellforge.sources.text import key_window, read_key_list, read_typed_tsv
from tests.conftest import cells_df, lines_df

BOTH = [0.0, -0.0, 1.5, float("inf"), float("-inf"), float("nan"), None]
DOUBLES, FLOATS = [*BOTH, -0.1, 1e-310, 1.7e308], [*BOTH, 0.25, -1024.0, 2.0**-149]


@pytest.mark.parametrize("kind,code", [("double", ">d"), ("float", ">f")])
def test_floats_round_trip_with_nan(spark, kind, code):
    values = DOUBLES if kind == "double" else FLOATS
    dtype = T.DoubleType() if kind == "double" else T.FloatType()
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    stored = frame.withColumn("b", encode_value(F.col("v"), dtype, "binary"))
    rows = stored.withColumn("back", decode_value(F.col("b"), dtype, "binary")).orderBy("i").collect()
    for r, v in zip(rows, values):
        if v is None:
            assert r["b"] is None and r["back"] is None
        elif math.isnan(v):
            assert len(r["b"]) == struct.calcsize(code) and math.isnan(r["back"])
        else:
            assert bytes(r["b"]) == struct.pack(code, v)
            assert struct.pack(code, r["back"]) == struct.pack(code, v)
    short = spark.createDataFrame([(bytearray(b"abc"),)], "b binary").select(decode_value(F.col("b"), dtype, "binary"))
    assert short.first()[0] is None


def test_nested_values_come_back(spark):
    kinds = {"a": "array<int>", "m": "map<string,int>", "s": "struct<x:int,y:string>"}
    frame = spark.sql("select array(1, 2) a, map('k', 3) m, named_struct('x', 4, 'y', 'z') s")
    for name, kind in kinds.items():
        dtype = frame.schema[name].dataType
        back = frame.select(decode_value(encode_value(F.col(name), dtype, "text"), dtype, "text").alias("v"), F.col(name))
        row = back.first()
        assert row["v"] == row[name], kind


def test_blank_and_tab_lines_are_records(spark):
    path = shared_path(spark, "blank")
    lines_df(spark, ["a\t1", "", "\t", "  ", "b\tx", "c"]).select(F.col("line").alias("value")).coalesce(1).write.text(path)
    got = [tuple(r) for r in read_typed_tsv(spark, path, "k string, n int").collect()]
    assert got == [("a", 1), (None, None), (None, None), ("  ", None), ("b", None), ("c", None)]


def test_key_window_is_in_file_order(spark):
    base = shared_path(spark, "keyfiles")
    for name, keys in (("a", ["z1", "z0", ""]), ("b", [f"k{i}" for i in range(2000)])):
        lines_df(spark, keys).select(F.col("line").alias("value")).coalesce(1).write.text(f"{base}/{name}")
    keys = read_key_list(spark, [f"{base}/a", f"{base}/b"], with_position=True)
    assert [r["key"] for r in key_window(keys, 0, 5, order_col="pos").orderBy("pos").collect()] == ["z1", "z0", "", "k0", "k1"]
    window = key_window(keys, 1000, None, order_col="pos")
    assert window.count() == 1003
    assert "CollectLimit" not in window._jdf.queryExecution().executedPlan().toString()


def test_names_with_dots_repeats_and_row(spark):
    rows = [("1", "f", "a.b", 1, "x"), ("1", "f", "row", 1, ""), ("1", "f", "c", 2, "y")]
    got = scan.scan_columns(cells_df(spark, rows), "f:a.b f:row f:c f:c")
    assert got.columns == ["row", "a.b", "row", "f_c", "f_c"] and tuple(got.first()) == ("1", "x", "1", "y", "y")
    mixed = scan.scan_cells(cells_df(spark, rows), "f:a.b f: f:row")
    assert mixed.first()[1] == "x" and len(mixed.first()[2]) == 3 and mixed.first()[3] == "1"


@pytest.mark.parametrize("n", [0, 1, 2, 3, 512, 10_000])
def test_region_of_many_bounds(spark, n):
    bounds = sorted(f"k{(i * 7919) % 100_003:06d}" for i in range(n))
    keys = ["", "a", "z", *bounds[:20], *(f"k{i:06d}x" for i in range(0, 100_000, 9973))]
    got = spark.createDataFrame([(k,) for k in keys], "row string").select("row", scan.region_of("row", bounds)).collect()
    assert [r[1] for r in got] == [bisect.bisect_right(bounds, k) for k in keys]


def test_too_many_regions_are_refused(spark):
    cdf = keyspace.benford_cdf(spark, 1)
    with pytest.raises(ValueError):
        keyspace.region_starts(cdf, 10, chars=1)


def test_cells_need_family_and_qualifier(spark):
    rows = [("r", None, "q", "v"), ("r", "f", None, "v"), ("r", "f", "q", "v")]
    got = tuples.store_dynamic(spark.createDataFrame(rows, "row string, family string, qualifier string, value string"), now=1)
    assert [(r["family"], r["qualifier"]) for r in got.collect()] == [("f", "q")]
