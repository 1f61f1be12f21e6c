import random

import pytest
from pyspark.sql import functions as F

from cellforge.operators import audit, scan, splits, store, tables, versions
from cellforge.plans.inspect import physical_plan, shuffles
from cellforge.session import shared_path
from cellforge.sources import fixtures as fx
from tests.conftest import SF_SMALL, cells_df


def rows_of(df, *more):
    return sorted(map(tuple, df.select("row", "family", "qualifier", "ts", "value", *more).collect()))


# --- starts -------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 8, 50])
def test_starts_cut_a_hot_prefix(spark, n):
    rng = random.Random(n)
    keys = [f"{rng.randrange(10**6)}" for _ in range(1000)] + [f"55500{rng.randrange(10**7):07d}" for _ in range(700)] + ["é" * 3, "", "5"]
    frame = spark.createDataFrame([(k,) for k in keys] + [(None,)], "key string").repartition(5)
    starts = splits.key_starts(frame, "key", n)
    assert len(starts) == n - 1 and starts == sorted(set(starts))
    counts = frame.where("key is not null").groupBy(scan.region_of("key", starts).alias("r")).count().collect()
    assert len(counts) == n and max(c["count"] for c in counts) <= (1 + 1 / splits.FINE) * len(keys) / n + 1


def test_starts_by_weight_and_of_few_keys(spark):
    frame = spark.createDataFrame([("a", 90.0), ("b", 5.0), ("c", 5.0)], "key string, w double")
    assert splits.key_starts(frame, "key", 3, "w") == ["b", "c"]
    assert splits.key_starts(frame, "key", 9, "w") == ["b", "c"]
    assert splits.key_starts(frame.limit(0), "key", 4) == []


def test_starts_of_binary_keys(spark):
    rng = random.Random(1)
    keys = [bytes([rng.choice([0, 127, 128, 255])] * rng.randrange(1, 4) + [rng.randrange(256)]) for _ in range(600)]
    frame = spark.createDataFrame([(bytearray(k),) for k in keys], "key binary")
    starts = splits.key_starts(frame, "key", 6)
    assert len(starts) == 5 and starts == sorted(starts) and all(isinstance(s, bytes) for s in starts)
    got = {bytes(r["key"]): r["r"] for r in frame.select("key", scan.region_of("key", starts).alias("r")).collect()}
    assert all(r == sum(s <= k for s in starts) for k, r in got.items())


# --- byte keys ----------------------------------------------------------------------


def test_unescaped_keys_and_bounds(spark):
    texts = ["plain", r"a\x80\xffb", r"\x00", r"\xzz", "é\\x41", "", r"tail\x7"]
    got = [bytes(r[0]) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(scan.unescape_key("t")).collect()]
    assert got == [b"plain", b"a\x80\xffb", b"\x00", rb"\xzz", "é".encode() + b"A", b"", rb"tail\x7"]
    assert [scan.unescape_bytes(t) for t in texts] == got
    rows = [bytearray([b]) for b in (0, 65, 127, 128, 200, 255)]
    frame = spark.createDataFrame([(r, "f", "q", 1, "v") for r in rows], "row binary, family string, qualifier string, ts long, value string")
    inside = scan.row_range(frame, gte=r"\x80", lt=r"\xff")
    assert sorted(bytes(r["row"]) for r in inside.collect()) == [b"\x80", b"\xc8"]
    text = spark.createDataFrame([("a",), ("z",), ("é",)], "row string")  # a bound that is no text
    assert [r[0] for r in scan.row_range(text, gte=rb"\x80".decode()).collect()] == ["é"]


def test_byte_bounds_are_pushed_down(spark):
    frame = scan.byte_keys(cells_df(spark, [(f"\\x{b:02x}k", "f", "q", 1, str(b)) for b in range(256)]))
    path = shared_path(spark, "byte_rows")
    frame.write.parquet(path)
    found = scan.row_range(spark.read.parquet(path), gt=r"\x80", lte=r"\xfe")
    assert "PushedFilters: [IsNotNull(row), GreaterThan(row," in physical_plan(found, "formatted")
    assert found.count() == 0xFE - 0x80


# --- store --------------------------------------------------------------------------


def batch(rng, rows, ts):
    return [(f"{rng.choice(rows)}", rng.choice("fg"), rng.choice("pq"), ts, str(rng.random())) for _ in range(80)]


@pytest.fixture()
def made(spark):
    rng = random.Random(5)
    first = batch(rng, range(1000), 1) + batch(rng, range(1000), 2)
    return store.create_store(cells_df(spark, first), shared_path(spark, "store"), ["2", "4", "6", "8"], 5), first


def test_upsert_rewrites_touched_regions_only(spark, made):
    old, first = made
    more = batch(random.Random(6), range(400, 600), 3) + batch(random.Random(7), range(700, 800), 0)
    new = store.upsert_store(old, cells_df(spark, more), 4)
    assert rows_of(store.read_store(new)) == rows_of(versions.latest_cells(cells_df(spark, first + more)))
    assert rows_of(store.read_store(old)) == rows_of(versions.latest_cells(cells_df(spark, first)))
    before, after = ({r["file"]: r for r in s.files.collect()} for s in (old, new))
    assert {r["region"] for r in after.values() if r["version"] == 1} == {2, 3}
    assert {f for f, r in before.items() if r["region"] not in (2, 3)} == {f for f, r in after.items() if r["version"] == 0}
    with pytest.raises(RuntimeError, match="another writer"):
        store.upsert_store(old, cells_df(spark, more), 4)
    again = store.open_store(spark, old.path)
    assert (again.version, again.starts) == (1, ("2", "4", "6", "8")) and rows_of(store.read_store(again)) == rows_of(store.read_store(new))
    gone = store.vacuum(spark, old.path)
    assert set(gone) == set(before) - set(after) and rows_of(store.read_store(new)) == rows_of(store.read_store(again))


def test_range_reads_open_files_of_the_range(spark, made):
    s, first = made
    want = versions.latest_cells(cells_df(spark, first))
    for bounds in ({"gte": "25", "lt": "5"}, {"gt": "9"}, {"lte": "1"}, {"gte": "x"}):
        found = store.read_store(s, **bounds)
        assert rows_of(found) == rows_of(scan.row_range(want, **bounds))
    assert len(store.read_store(s, gte="81").inputFiles()) < s.files.count()


def test_multi_get_opens_files_that_may_hold_a_key(spark, made):
    s, first = made
    there = sorted({r[0] for r in first})
    keys = [k for k in there if k.startswith("3")][:5] + [f"{k}x" for k in there] + ["", None]
    listed = spark.createDataFrame([(k,) for k in keys], "key string")
    cells, opened = store.multi_get(s, listed)
    want = versions.latest_cells(cells_df(spark, first)).where(F.col("row").isin(*[k for k in keys if k]))
    assert rows_of(cells) == rows_of(want) and opened <= 2 < s.files.count()
    files = dict(map(tuple, store.files_of_keys(s, spark.createDataFrame([(k,) for k in there], "key string")).collect()))
    assert set(files) == set(there)  # no false negatives
    assert store.multi_get(s, spark.createDataFrame([("nope",)], "key string")) [1] == 0


def test_first_rows_reads_from_the_front(spark):
    rows = [(f"{i:06d}", "f", q, 1, str(i)) for i in range(4000) for q in "ab"]
    rows += [(f"{i:06d}", "f", "rare", 1, "r") for i in range(0, 4000, 100)]
    s = store.create_store(cells_df(spark, rows), shared_path(spark, "front"), ["001", "002", "0035"], 6)
    for columns, factor in (("f:a", 40), ("f:a f:rare", 40), ("f:rare", 2000)):
        look = lambda cells: scan.scan_columns(cells, columns)  # noqa: E731, B023
        found, read = store.first_rows(s, look, 5)
        every = look(store.read_store(s)).withColumn("region", scan.region_of("row", s.starts))
        want = scan.limit_per_region(every, "region", 5)
        assert sorted(map(tuple, found.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
        assert read <= 4 * 5 * factor
    found, read = store.first_rows(s, lambda cells: scan.scan_columns(cells, "f:none"), 5)
    assert found.count() == 0


def test_binary_store(spark):
    cells = scan.byte_keys(cells_df(spark, [(f"\\x{b:02x}k", "f", "q", 1, str(b)) for b in range(256)]))
    s = store.create_store(cells, shared_path(spark, "binary"), splits.key_starts(cells, "row", 4), 4)
    s = store.open_store(spark, s.path)
    assert s.files.select("region").distinct().count() == 4
    assert store.read_store(s, gte=r"\x80", lt=r"\xff").count() == 127
    cells, opened = store.multi_get(s, spark.createDataFrame([(bytearray(b"\x90k"),), (bytearray(b"\x90"),)], "key binary"))
    assert [r["value"] for r in cells.collect()] == ["144"] and opened == 1
    found, _ = store.first_rows(s, lambda c: scan.scan_columns(c, "f:q"), 2)
    assert found.count() == 8


# --- sorted runs --------------------------------------------------------------------


def test_merge_of_sorted_runs_neither_shuffles_nor_sorts(spark):
    ev = fx.event_table(spark, SF_SMALL)
    base = tables.load_cell_table(ev.where("ts < 1705000000000"), 4)
    run = tables.append_delta(ev.where("ts >= 1705000000000"), buckets=4)
    merged = tables.read_merged(spark, base, [run], 4)
    plan = physical_plan(merged)
    assert not shuffles(merged) and "Sort " not in plan and "SortMergeJoin" in plan
    assert rows_of(merged) == rows_of(versions.latest_cells(ev))
    several = tables.read_merged(spark, base, [run, tables.append_delta(ev.where("ts >= 1706000000000"))], 4)
    assert rows_of(several) == rows_of(versions.latest_cells(ev))


def test_runs_are_compacted_by_tiers(spark):
    assert [tables.tier_of(s) for s in (0, 3, 4, 15, 16, 64)] == [0, 0, 1, 1, 2, 3]
    ev = fx.event_cells(spark, SF_SMALL).checkpoint()
    cuts = [1704000000000 + 150_000_000 * i for i in range(9)]
    runs, base = [], tables.load_cell_table(ev.where(F.col("ts") < cuts[0]), 2)
    for lo, hi in zip(cuts, cuts[1:] + [1 << 60]):
        runs = tables.compact_runs(spark, [*runs, tables.append_delta(ev.where((F.col("ts") >= lo) & (F.col("ts") < hi)), buckets=2)], 2)
        sizes = [tables.tier_of(tables.run_bytes(spark, r)) for r in runs]
        assert all(sizes.count(t) < tables.RUN_FANOUT for t in sizes)
    assert len(runs) < 9
    assert rows_of(tables.read_merged(spark, base, runs, 2)) == rows_of(versions.latest_cells(ev))


def test_indexed_audit_is_the_lookup_audit(spark, made):
    s, first = made
    there = sorted({r[0] for r in first})
    listed = spark.createDataFrame([(k,) for k in there[:7] + ["zz", "", "3x"]], "key string")
    cells, _ = store.multi_get(s, listed)
    one = audit.lookup_audit(listed, cells)
    two = audit.lookup_audit(listed, cells_df(spark, first))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_filters_are_combined_without_a_sort(spark):
    keys = [("one", str(i), 3) for i in range(4000)] * 2 + [("two", f"k{i}", 1) for i in range(20)] + [("two", None, 1)]
    sized = spark.createDataFrame(keys, "file string, row string, blocks int").repartition(4)
    told = store._bitmaps(sized)
    plan = physical_plan(told)
    assert "SortAggregate" not in plan and "Sort " not in plan
    bit = sized.select("file", store._block(F.col("blocks")).alias("block"), F.explode(store._bits()).alias("bit"))
    want = bit.groupBy("file", "block").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bits"))
    found = [{(r["file"], r["block"]): bytes(r["bits"]) for r in df.collect()} for df in (told, want)]
    assert found[0] == found[1] and len(found[0]) == 4
