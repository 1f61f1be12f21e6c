from pyspark.sql import functions as F

from cellforge.operators import files
from cellforge.session import shared_path
from cellforge.sources import fixtures as fx
from tests.conftest import SF_SMALL, cells_df


def _ordered(ranges):
    return sorted(ranges, key=lambda r: (r.first_row, r.last_row))


def test_whole_rows_files_are_disjoint(spark):
    ev = fx.event_cells(spark, SF_SMALL).unionByName(fx.prop_cells(spark, SF_SMALL))
    path = files.write_sorted_cells(ev, shared_path(spark, "t_sorted_rows"), 4, whole_rows=True)
    ranges = _ordered(files.file_ranges(spark, path).collect())
    assert sum(r.cells for r in ranges) == ev.dropDuplicates(["row", "family", "qualifier", "ts"]).count()
    for a, b in zip(ranges, ranges[1:]):
        assert a.last_row < b.first_row


def test_full_order_files_follow_each_other(spark):
    ev = fx.event_cells(spark, SF_SMALL).unionByName(fx.prop_cells(spark, SF_SMALL))
    path = files.write_sorted_cells(ev, shared_path(spark, "t_sorted_cells"), 4)
    ranges = _ordered(files.file_ranges(spark, path).collect())
    for a, b in zip(ranges, ranges[1:]):
        assert a.last_row <= b.first_row
    # within each file cells are in (row, family, qualifier, ts desc) order
    df = spark.read.parquet(path).withColumn("file", F.input_file_name())
    for fname in [r.file for r in df.select("file").distinct().collect()]:
        part = [tuple(r) for r in df.where(F.col("file") == fname).drop("file").collect()]
        assert part == sorted(part, key=lambda c: (c[0], c[1], c[2], -c[3]))


def test_same_coordinate_collapse(spark):
    df = cells_df(spark, [("r", "f", "q", 2, "a"), ("r", "f", "q", 2, "b"), ("r", "f", "q", 1, "c")])
    out = [tuple(r) for r in files.sorted_cell_partitions(df, 2).collect()]
    assert sorted(out) == [("r", "f", "q", 1, "c"), ("r", "f", "q", 2, "b")]


def test_partitioned_files_follow_the_partitioner(spark):
    from cellforge.operators import keyspace

    keys = [str(k) for k in range(1000, 10000, 37)] + ["12", "abcd"]
    cells = cells_df(spark, [(k, "f", "q", 1, k) for k in keys])
    path = files.write_partitioned_cells(cells, shared_path(spark, "t_partitioned"), 10)
    written = spark.read.parquet(path).withColumn("file", F.input_file_name())
    expected = {r.row: r.partition for r in keyspace.assign_partition(cells, "row", 10).collect()}
    by_file = {}
    for r in written.collect():
        by_file.setdefault(r.file, set()).add(expected[r.row])
    assert all(len(parts) == 1 for parts in by_file.values())
    assert sum(1 for _ in written.collect()) == len(keys)


def test_region_files_prune_by_range(spark):
    from cellforge.operators import keyspace, scan
    from cellforge.plans.inspect import physical_plan

    kc = fx.line_input(spark, SF_SMALL, "key_counts")
    starts = keyspace.region_starts(keyspace.sampled_cdf(kc, "key", "cnt"), 4)
    assert starts == sorted(starts) and len(starts) == 3
    cells = kc.select(F.col("key").alias("row"), F.lit("k").alias("family"), F.lit("n").alias("qualifier"),
                      F.lit(1).cast("bigint").alias("ts"), F.col("cnt").cast("string").alias("value"))
    path = files.write_region_cells(cells, shared_path(spark, "t_regions"), starts, 4)
    stored = spark.read.parquet(path)
    lo, hi = starts[0], starts[1]
    pruned = scan.scan_regions(stored, starts, gte=lo, lt=hi)
    expected = sorted(r.row for r in cells.where((F.col("row") >= lo) & (F.col("row") < hi)).collect())
    assert sorted(r.row for r in pruned.collect()) == expected
    plan = physical_plan(pruned, "formatted")
    import re

    assert re.search(r"PartitionFilters: \[[^\]]*region", plan)
    assert scan.regions_in_range(starts, gte=lo, lt=hi) == [1]
    # within every file the cells keep their order
    for fname in [r.f for r in stored.select(F.input_file_name().alias("f")).distinct().collect()]:
        part = [r.row for r in stored.where(F.input_file_name() == fname).collect()]
        assert part == sorted(part)


def test_materialized_sorted_write(spark):
    from cellforge.operators import relations

    lines = fx.line_input(spark, SF_SMALL, "follow_lines")
    path = files.write_sorted_cells(relations.follow_cells(lines, ts=1), shared_path(spark, "t_mat"), 4, materialize=True)
    got = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    want = sorted(tuple(r) for r in files.sorted_cell_partitions(relations.follow_cells(lines, ts=1), 2).collect())
    assert got == want


def test_follow_load_to_partitioner_files(spark):
    """The follow-load job: lines -> two cells per line -> distribution-aware partitions
    (a CDF sampled from the row keys themselves) -> per-partition sorted files."""
    from cellforge.operators import keyspace, relations

    lines = fx.line_input(spark, SF_SMALL, "follow_lines")
    cells = relations.follow_cells(lines, ts=1)
    cdf = keyspace.sampled_cdf(cells.select("row"), "row")
    path = files.write_partitioned_cells(cells, shared_path(spark, "t_follow_files"), 16, cdf=cdf)
    written = spark.read.parquet(path)
    assert written.count() == cells.dropDuplicates(["row", "family", "qualifier", "ts"]).count()
    expected = {r.row: r.partition for r in keyspace.assign_partition(cells.select("row").distinct(), "row", 16, cdf=cdf).collect()}
    per_file = {}
    for r in written.select("row", F.input_file_name().alias("f")).collect():
        per_file.setdefault(r.f, set()).add(expected[r.row])
    assert all(len(p) == 1 for p in per_file.values())


def test_limit_per_physical_region(spark):
    from cellforge.operators import scan

    starts = ["3", "6"]
    cells = cells_df(spark, [(f"{i:03d}", "f", "a", 1, str(i)) for i in range(0, 900, 7)])
    path = files.write_region_cells(cells, shared_path(spark, "t_region_limit"), starts, 3)
    stored = spark.read.parquet(path)
    rows = scan.scan_columns(stored, "f:a", carry=["region"])
    got = sorted((r.region, r.row) for r in scan.limit_per_region(rows, "region", 2).collect())
    assert got == [(0, "000"), (0, "007"), (1, "301"), (1, "308"), (2, "602"), (2, "609")]


def test_cell_files_carry_a_row_bloom_filter(spark):
    import glob
    import os

    df = cells_df(spark, [(f"{i:09d}", "f", "q", 1, "v") for i in range(5000)]).coalesce(1)
    sizes = {}
    for bloom in (False, True):
        path = shared_path(spark, f"t_bloom_{bloom}")
        files.cell_writer(df, bloom=bloom).parquet(path)
        local = path.replace("file:", "")
        sizes[bloom] = sum(os.path.getsize(f) for f in glob.glob(local + "/*.parquet"))
    assert sizes[True] > sizes[False]  # the filter's bytes
    assert spark.read.parquet(path).where(F.col("row") == "000001234").count() == 1


def test_get_row_pushes_an_equality(spark):
    from cellforge.operators import scan
    from cellforge.plans.inspect import physical_plan

    ev = fx.event_table(spark, SF_SMALL)
    path = files.write_sorted_cells(ev, shared_path(spark, "t_get"), 2)
    stored = spark.read.parquet(path)
    got = scan.get_row(stored, "7", "ev:click props:").collect()
    assert [r.row for r in got] == ["7"]
    assert "EqualTo(row,7)" in physical_plan(scan.get_row(stored, "7", "ev:click"), "formatted")
