import random

import pytest
from pyspark.sql import functions as F

from cellforge.operators import files, keyspace, scan
from cellforge.session import shared_path
from cellforge.sources import fixtures as fx
from tests.conftest import cells_df


@pytest.mark.parametrize("size", [1, 7, 100])
def test_pages_are_the_family(spark, size):
    rng = random.Random(size)
    rows = [("wide", "f", f"q{i:04d}", 1, str(i)) for i in range(300)] + [(f"r{rng.randrange(40)}", "f", f"q{rng.randrange(50)}", rng.randrange(5), "v") for _ in range(300)]
    rows += [("wide", "g", "other", 1, "x"), ("one", "f", "q", 1, "")]
    cells = cells_df(spark, rows).repartition(6)
    pages = scan.scan_pages(cells, "f", size).collect()
    assert all(0 < len(p["bag"]) <= size and p["cursor"] == p["bag"][-1]["qualifier"] for p in pages)
    found = {}
    for p in sorted(pages, key=lambda p: (p["row"], p["page"])):
        assert p["page"] == len(found.get(p["row"], [])) // size  # every page but the last is full
        found.setdefault(p["row"], []).extend((c["qualifier"], c["value"]) for c in p["bag"])
    want = {}
    for r in scan.scan_family(cells, "f").collect():
        want.setdefault(r["row"], []).append((r["qualifier"], r["value"]))
    assert found == {row: sorted(pairs) for row, pairs in want.items()}
    with pytest.raises(ValueError):
        scan.scan_pages(cells, "f", 0)


@pytest.mark.parametrize("partitions", [4, 36])
def test_hot_partitions_are_cut_into_runs(spark, partitions):
    rng = random.Random(partitions)
    keys = {str(rng.randrange(1, 10**6)) for _ in range(3000)} | {f"555{rng.randrange(10**8)}" for _ in range(2500)} | {"7", "x", "123"}
    cells = cells_df(spark, [(k, "f", "q", 1, k) for k in sorted(keys)]).repartition(5)
    path = shared_path(spark, "runs")
    starts = files.write_partition_runs(cells, path, partitions)
    stored = spark.read.parquet(path).select("row", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int").alias("file"))
    told = keyspace.assign_run(stored, "row", partitions, starts).toPandas()
    assert (told["file"] == told["run_id"]).all() and set(told["row"]) == keys
    sizes = told.groupby("file").size()
    assert sizes.max() <= 2 * sizes.mean()
    # Within a partition the runs follow each other in key order.
    for _, part in told.groupby("partition"):
        ends = part.groupby("file")["row"].agg(lambda r: (min(r), max(r))).tolist()
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    plain = keyspace.assign_partition(stored.select("row"), "row", partitions).toPandas()
    assert dict(zip(plain["row"], plain["partition"])) == dict(zip(told["row"], told["partition"]))


def test_sketches_of_loads_merge(spark):
    rng = random.Random(2)
    loads = [[str(rng.randrange(10, 10**5)) for _ in range(2000)] for _ in range(3)]
    path = shared_path(spark, "sketches")
    for load in loads:
        keyspace.key_sketch(spark.createDataFrame([(k,) for k in load], "key string"), "key").write.mode("append").parquet(path)
    keyspace.key_sketch(spark.createDataFrame([], "key string"), "key").write.mode("append").parquet(path)
    told = {r["prefix"]: r["cdf"] for r in keyspace.sketch_cdf(spark.read.parquet(path)).collect()}
    every = spark.createDataFrame([(k,) for load in loads for k in load], "key string")
    exact = {r["prefix"]: r["cdf"] for r in keyspace.sampled_cdf(every, "key").collect()}
    assert told.keys() == exact.keys() and max(abs(told[p] - exact[p]) for p in exact) <= keyspace.SKETCH_ERROR
    assert keyspace.sketch_cdf(keyspace.key_sketch(every.limit(0), "key")).count() == 0


@pytest.mark.parametrize("stretch", [1, 7, 50])
def test_pages_of_rows_over_several_stretches(spark, monkeypatch, stretch):
    monkeypatch.setattr(scan, "STRETCH", stretch)
    rows = [(row, "f", f"q{i:03d}", 1, str(i)) for row, n in (("a", 1), ("b", 50), ("c", 49), ("d", 7), ("e", 120)) for i in range(n)]
    pages = scan.scan_pages(cells_df(spark, [*rows, (None, "f", "q", 1, "v")]).repartition(5), "f", 8).collect()
    found = sorted((p["row"], 8 * p["page"] + i, c["qualifier"], c["value"]) for p in pages for i, c in enumerate(p["bag"]))
    assert found == [(row, int(value), qualifier, value) for row, _, qualifier, _, value in rows]


def test_a_wide_row_is_no_one_tasks(spark, monkeypatch):
    monkeypatch.setattr(scan, "STRETCH", 50, raising=False)
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        cells = cells_df(spark, [("wide", "f", f"q{i:05d}", 1, "v") for i in range(4000)]).repartition(5)
        pages = scan.scan_pages(cells, "f", 10).groupBy(F.spark_partition_id().alias("at")).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(p["count"] for p in pages) == 400 and len(pages) == 8 and max(p["count"] for p in pages) < 100


def test_line_items_are_dealt_out_before_they_are_cells(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(fx, "LINES_A_TASK", 50, raising=False)
    lines = [(i // 3, i % 3 + 1, "ANR"[i % 3], i * 7) for i in range(2000)] * 2
    lines += [(None, 1, "A", 1), (1, None, None, 2), (5, 5, "N", None)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_returnflag string, l_partkey bigint").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    cells = fx.line_item_cells(spark, str(tmp_path))
    sizes = cells.groupBy(F.spark_partition_id().alias("at")).count().collect()
    assert len(sizes) > 70 and max(s["count"] for s in sizes) <= 2 * 2 * 50

    def text(x):
        return None if x is None else str(x)

    found = sorted(map(tuple, cells.select("row", "qualifier", "value").collect()), key=str)
    name = lambda k, n: "-".join(str(x) for x in (k, n) if x is not None)
    want = [(row, name(k, n), text(v)) for k, n, flag, v in lines for row in (None if flag is None else f"flag-{flag}", text(k))]
    assert found == sorted(want, key=str)
