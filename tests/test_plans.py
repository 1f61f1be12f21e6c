"""Plan shapes: where the shuffles are, and that the expensive parts run once."""

import pytest
from pyspark.sql import functions as F

from cellforge.operators import files, keyspace, scan, tables, versions
from cellforge.plans import queries as Q
from cellforge.plans.inspect import count, physical_plan, shuffles
from cellforge.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_loaders_are_one_narrow_stage(spark):
    for name in ["bulk_cells", "table_cells", "composite_key_cells", "file_cells", "edge_cells",
                 "follow_cells", "mention_cells", "store_row_cells", "store_bag_cells"]:
        df = Q.QUERIES[name](spark, SF_SMALL)
        assert shuffles(df) == [], name


def test_split_runs_once_per_line(spark):
    for name in ["mention_cells", "follow_cells", "table_cells"]:
        plan = physical_plan(Q.QUERIES[name](spark, SF_SMALL))
        assert plan.count("split(rtrim(") == 1, name


def test_latest_and_named_scan_use_one_shuffle(spark):
    ev = fx.event_cells(spark, SF_SMALL).unionByName(fx.prop_cells(spark, SF_SMALL))
    assert shuffles(versions.latest_cells(ev)) == ["hashpartitioning"]
    assert shuffles(scan.scan_columns(ev, "ev:click props:view")) == ["hashpartitioning"]


def test_range_bounds_reach_the_scan(spark):
    path = files.write_sorted_cells(fx.event_cells(spark, SF_SMALL), Q.shared_path(spark, "t_push"), 2)
    df = scan.scan_columns(spark.read.parquet(path), "ev:click", gte="12", lt="5")
    plan = physical_plan(df, "formatted")
    assert "GreaterThanOrEqual(row,12)" in plan and "LessThan(row,5)" in plan
    assert "EqualTo(family,ev)" in plan
    assert "ReadSchema: struct<row:string,family:string,qualifier:string,ts:bigint,value:string>" in plan


def test_region_limit_is_partial_before_the_shuffle(spark):
    df = Q.scan_region_limit(spark, SF_SMALL)
    assert count(df, "WindowGroupLimit") == 2


LOADED = ["bulk_cells", "table_cells", "composite_key_cells", "file_cells", "edge_cells", "follow_cells", "mention_cells",
          "store_row_cells", "store_dynamic_cells", "store_bag_cells"]


@pytest.mark.parametrize("name", LOADED)
def test_sorted_files_one_range_exchange(spark, name):
    cells = Q.QUERIES[name](spark, SF_SMALL)
    assert shuffles(files.sorted_cell_partitions(cells, 4)) == ["rangepartitioning"]
    assert shuffles(files.sorted_cell_partitions(cells, 4, whole_rows=True)) == ["rangepartitioning"]


@pytest.mark.parametrize("name", LOADED)
def test_upsert_never_shuffles_the_snapshot(spark, name):
    cells = Q.QUERIES[name](spark, SF_SMALL)
    base = tables.load_cell_table(cells, 4)
    plan = tables.upsert_plan(spark.table(base), cells, 4)
    # both exchanges belong to the incoming side: the merge by coordinate, then the buckets
    assert len(shuffles(plan)) == 2 and not _above_scan(plan, base, "Exchange")
    assert len([f for f in spark.table(base).inputFiles()]) <= 4  # a file a bucket
    assert sorted(map(tuple, plan.collect())) == sorted(map(tuple, versions.latest_cells(cells).collect()))
    tables.drop_cell_table(spark, base)


def _above_scan(df, table, node):
    """Plan lines that name ``node`` between the scan of ``table`` and the join or union above."""
    lines = physical_plan(df).splitlines()
    at = next(i for i, line in enumerate(lines) if table in line)
    top = max(i for i, line in enumerate(lines[:at]) if "Union" in line or "SortMergeJoin" in line)
    return [line for line in lines[top : at + 1] if node in line]


def test_snapshot_is_registered_again_by_path(spark):
    cells = Q.QUERIES["edge_cells"](spark, SF_SMALL)
    base = tables.load_cell_table(cells, 4)
    again = tables.register_cell_table(spark, tables.new_table_name(), tables.table_path(spark, base), 4)
    assert sorted(map(tuple, spark.table(again).collect())) == sorted(map(tuple, spark.table(base).collect()))
    assert not _above_scan(tables.upsert_plan(spark.table(again), cells, 4), again, "Exchange")


def test_partitioner_lookup_is_broadcast_or_closed_form(spark):
    kc = fx.line_input(spark, SF_SMALL, "key_counts")
    theory = keyspace.assign_partition(kc, "key", 360)
    assert count(theory, "BroadcastHashJoin") == 0 and count(theory, "SortMergeJoin") == 0
    sampled = keyspace.assign_partition(kc, "key", 360, cdf=keyspace.sampled_cdf(kc, "key", "cnt"))
    assert count(sampled, "SortMergeJoin") == 0
    placed = keyspace.place_by_partition(sampled.withColumn("partition", F.col("partition")), 360)
    assert shuffles(placed)[0].lower() == "shufflepartitionidpassthrough"


def test_partitioner_placement_is_the_only_exchange(spark):
    from cellforge.operators.files import COORD

    ev = fx.event_cells(spark, SF_SMALL).unionByName(fx.prop_cells(spark, SF_SMALL))
    placed = keyspace.place_by_partition(keyspace.assign_partition(ev, "row", 10, out="_part"), 10, "_part")
    collapsed = placed.groupBy(*COORD, (-F.col("ts")).alias("_nts"), "_part").agg(F.max("value").alias("value"))
    assert [s.lower() for s in shuffles(collapsed)] == ["shufflepartitionidpassthrough"]


def test_two_family_table_scans_events_once(spark):
    df = fx.event_table(spark, SF_SMALL)
    assert physical_plan(df).count("FileScan parquet") == 1
    path = files.write_sorted_cells(df, Q.shared_path(spark, "t_once"), 2)
    assert spark.read.parquet(path).count() > 0
    assert shuffles(files.sorted_cell_partitions(df, 4)) == ["rangepartitioning"]


def test_scans_read_only_the_columns_they_use(spark):
    import re

    expected = {
        "follow_cells": {"o_orderkey", "o_custkey"},
        "latest_cells": {"event_id", "ts", "user_id", "event_type"},
        "partition_histogram": {"l_orderkey"},
        "flat_ts_millis": {"o_orderkey", "o_orderdate"},
    }
    for name, cols in expected.items():
        plan = physical_plan(Q.QUERIES[name](spark, SF_SMALL), "formatted")
        schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
        assert {c.split(":")[0] for c in schema.split(",")} == cols, name


def test_merged_read_of_snapshot_and_deltas(spark):
    ev = fx.event_table(spark, SF_SMALL)
    base = tables.load_cell_table(ev.where("ts < 1705000000000"), 4)
    d1 = tables.append_delta(ev.where("ts >= 1705000000000 and ts < 1706000000000"))
    d2 = tables.append_delta(ev.where("ts >= 1706000000000"))
    merged = tables.read_merged(spark, base, [d1, d2], 4)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, versions.latest_cells(ev).collect()))
    assert "Bucketed: true" in physical_plan(merged)
    assert not _above_scan(merged, base, "Exchange") and not _above_scan(merged, base, "Sort ")
    compacted = tables.compact(spark, base, [d1, d2], 4)
    assert sorted(map(tuple, spark.table(compacted).collect())) == sorted(map(tuple, merged.collect()))
