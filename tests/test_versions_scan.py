from cellforge.operators import scan, versions
from cellforge.sources import fixtures as fx
from tests.conftest import SF_SMALL, cells_df


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_tie_rule(spark):
    df = cells_df(spark, [("r", "f", "q", 1, "a"), ("r", "f", "q", 2, "b"), ("r", "f", "q", 2, "c"), ("r", "f", "p", 1, "x")])
    expected = [("r", "f", "p", 1, "x"), ("r", "f", "q", 2, "c")]
    assert rows(versions.latest_cells(df)) == expected
    assert rows(versions.latest_cells(df, method="window")) == expected
    assert rows(versions.latest_versions(df, 2)) == [("r", "f", "p", 1, "x"), ("r", "f", "q", 2, "b"), ("r", "f", "q", 2, "c")]


def test_latest_idempotent_and_upsert_halves(spark):
    ev = fx.event_cells(spark, SF_SMALL)
    latest = versions.latest_cells(ev)
    assert rows(versions.latest_cells(latest)) == rows(latest)
    a, b = ev.where("cast(value as int) % 2 = 0"), ev.where("cast(value as int) % 2 = 1")
    assert rows(versions.upsert_cells(versions.latest_cells(a), b)) == rows(latest)


def test_scan_empty_value_rule(spark):
    df = cells_df(spark, [("r1", "f", "a", 1, ""), ("r1", "f", "b", 1, "v"), ("r2", "g", "c", 1, "w")])
    assert rows(scan.scan_columns(df, "f:a f:b")) == [("r1", "1", "v")]
    assert rows(scan.scan_columns(df, "f:a", load_key=False)) == [("1",)]
    assert rows(scan.scan_family(df, "f")) == [("r1", "f", "a", ""), ("r1", "f", "b", "v")]
    bags = scan.family_bags(scan.scan_family(df, "f")).first()
    assert [tuple(x) for x in bags.bag] == [("a", ""), ("b", "v")]


def test_scan_range_bounds(spark):
    df = cells_df(spark, [(k, "f", "a", 1, k) for k in ["1", "10", "2", "20", "3", "\x01"]])
    assert [r.row for r in sorted(scan.scan_columns(df, "f:a", gte="10", lt="3").collect())] == ["10", "2", "20"]
    assert {r.row for r in scan.scan_columns(df, "f:a", gt="2", lte="3").collect()} == {"20", "3"}
    assert {r.row for r in scan.scan_columns(df, "f:a", lt="\\x02").collect()} == {"\x01"}


def test_region_limit(spark):
    df = cells_df(spark, [(f"{i:02d}", "f", "a", 1, "v") for i in range(30)])
    rows_ = scan.scan_columns(df, "f:a").withColumn("region", scan.region_of("row", ["10", "20"]))
    got = sorted((r.region, r.row) for r in scan.limit_per_region(rows_, "region", 3).collect())
    assert got == [(0, "00"), (0, "01"), (0, "02"), (1, "10"), (1, "11"), (1, "12"), (2, "20"), (2, "21"), (2, "22")]


def test_scan_cells_mixed_spec(spark):
    df = cells_df(spark, [("r1", "f", "a", 1, ""), ("r1", "f", "a", 0, "old"), ("r1", "g", "y", 1, "gy"), ("r1", "g", "x", 2, "gx"),
                          ("r2", "g", "x", 1, "only"), ("r3", "h", "z", 1, "none")])
    out = {r.row: r for r in scan.scan_cells(df, "f:a g:").collect()}
    assert set(out) == {"r1", "r2"}
    assert out["r1"].a == "1" and [tuple(x) for x in out["r1"].g] == [("x", "gx"), ("y", "gy")]
    assert out["r2"].a is None and [tuple(x) for x in out["r2"].g] == [("x", "only")]


def test_upsert_of_two_bucketed_tables(spark):
    """Regression: a union of two tables bucketed alike, read by columnar scans, must
    not be merged partition by partition (Spark concatenates its partitions)."""
    from cellforge.operators import tables

    ev = fx.event_table(spark, SF_SMALL)
    expected = rows(versions.latest_cells(ev))
    a = tables.load_cell_table(ev.where("ts < 1705363200000"), 4)
    b = tables.load_cell_table(ev.where("ts >= 1705363200000"), 4)
    assert rows(versions.upsert_cells(spark.table(a), spark.table(b))) == expected
    merged = tables.upsert_table(spark, a, spark.table(b), 4)
    assert rows(spark.table(merged)) == expected


def test_family_specs_without_colon(spark):
    from cellforge.operators import tuples

    assert scan.parse_spec("cf:a g: h") == [("cf", "a"), ("g", None), ("h", None)]
    df = cells_df(spark, [("r", "h", "x", 1, "v")])
    assert rows(scan.scan_family(df, "h")) == [("r", "h", "x", "v")]
    stored = tuples.store_rows(spark.createDataFrame([("k", "v")], "k string, v string"), "fam", now=1)
    assert rows(stored) == [("k", "fam", "", 1, "v")]
