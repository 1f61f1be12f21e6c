from cellforge.operators import files, tables
from cellforge.session import shared_path
from cellforge.sources.cells import read_cells
from cellforge.sources.text import read_typed_tsv, write_lines
from tests.conftest import cells_df, lines_df


def test_typed_tsv_rules(spark):
    lines = lines_df(spark, ["a\t1", "b\tbad", "c", 'd"q\t4\textra'])
    path = write_lines(lines, shared_path(spark, "typed"))
    got = sorted(tuple(r) for r in read_typed_tsv(spark, path, "name string, n int").collect())
    assert got == [("a", 1), ("b", None), ("c", None), ('d"q', 4)]


def test_read_cells_by_name_or_path(spark):
    df = cells_df(spark, [("r", "f", "q", 1, "v")])
    name = tables.load_cell_table(df, 2)
    path = files.write_sorted_cells(df, shared_path(spark, "cells"), 1)
    assert [tuple(r) for r in read_cells(spark, name).collect()] == [("r", "f", "q", 1, "v")]
    assert [tuple(r) for r in read_cells(spark, path).collect()] == [("r", "f", "q", 1, "v")]


def test_sample_counts_source_feeds_the_cdf(spark):
    from cellforge.operators.keyspace import sampled_cdf
    from cellforge.sources.text import read_sample_counts

    path = write_lines(lines_df(spark, ["150\t3", "1\t1", "999x\t2", "abc\tnot-a-number"]), shared_path(spark, "samples"))
    samples = read_sample_counts(spark, path)
    cdf = {r.prefix: (r.n, r.cdf) for r in sampled_cdf(samples, "key", "cnt").collect()}
    assert cdf[100] == (1.0, 0.0)
    assert cdf[150] == (3.0, 1 / 6)
    assert cdf[999] == (2.0, 4 / 6)


def test_leading_number(spark):
    from pyspark.sql import functions as F

    from cellforge.functions.scalars import leading_number

    df = spark.createDataFrame([("12abc",), (" 1.5e3x",), ("x",), (None,), ("-2",)], "s string")
    assert [r.v for r in df.select(leading_number(F.col("s")).alias("v")).collect()] == [12.0, 1500.0, 0.0, 0.0, -2.0]


def test_published_example_flow(spark):
    """Typed TSV load, then store: field 0 is the row key, the rest are named columns."""
    import pytest

    from cellforge.operators import scan, tuples

    path = write_lines(lines_df(spark, ["alice\t3", "bob\tx", "carol\t5"]), shared_path(spark, "example"))
    data = read_typed_tsv(spark, path, "field_1 string, field_2 int")
    cells = tuples.store_rows(data, "cf:field_2", now=1)
    assert sorted(tuple(r) for r in cells.collect()) == [("alice", "cf", "field_2", 1, "3"), ("carol", "cf", "field_2", 1, "5")]
    back = scan.scan_typed(cells, "cf:field_2", ["int"])
    assert sorted(tuple(r) for r in back.collect()) == [("alice", 3), ("carol", 5)]
    with pytest.raises(ValueError):  # D14: two names for one value field
        tuples.store_rows(data, "cf:field_1 cf:field_2", now=1)
