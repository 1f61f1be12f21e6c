
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellforge.operators import relations, scan, tables, tuples, versions
from tests.conftest import cells_df, lines_df

FIELD = st.sampled_from(["", "1", "22", "x", "333"])


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(FIELD, min_size=1, max_size=5), min_size=1, max_size=40))
def test_follow_counts(spark, records):
    lines = ["\t".join(r) for r in records]
    df = lines_df(spark, lines)
    rejected = {r.reason: r.n for r in relations.follow_rejects(df).collect()}["BAD_RECORD"]
    cells = relations.follow_cells(df, ts=1).count()
    assert cells == 2 * (len(lines) - rejected)


COORD = st.tuples(st.sampled_from(["a", "b", "hot"]), st.sampled_from(["f", "g"]), st.sampled_from(["q", "r"]))
CELL = st.tuples(COORD, st.integers(0, 5), st.sampled_from(["", "v", "w"]))


@settings(max_examples=5, deadline=None)
@given(st.lists(CELL, min_size=1, max_size=40), st.integers(0, 3))
def test_upsert_of_parts_equals_load_of_whole(spark, raw, seed):
    rows = [(c[0], c[1], c[2], ts, v) for c, ts, v in raw]
    cells = cells_df(spark, rows)
    whole = sorted(tuple(r) for r in versions.latest_cells(cells).collect())
    part = F.pmod(F.hash("ts", "value", F.lit(seed)), F.lit(2)) == 0
    base = tables.load_cell_table(cells.where(part), 3)
    merged = tables.upsert_table(spark, base, cells.where(~part), 3)
    assert sorted(tuple(r) for r in spark.table(merged).collect()) == whole
    assert sorted(tuple(r) for r in versions.upsert_cells(cells.where(part), cells.where(~part)).collect()) == whole


def test_store_then_scan_gives_rows_back(spark):
    df = spark.createDataFrame([("k1", "a", 1), ("k2", None, 2), ("k3", "c", None)], "k string, s string, n int")
    stored = tuples.store_rows(df, "f:s f:n", now=7)
    back = scan.scan_typed(stored, "f:s f:n", ["string", "int"])
    assert sorted(tuple(r) for r in back.collect()) == [("k1", "a", 1), ("k2", None, 2), ("k3", "c", None)]
    binary = tuples.store_rows(df, "f:s f:n", caster="binary", now=7)
    back = scan.scan_typed(binary, "f:s f:n", ["string", "int"], caster="binary")
    assert sorted(tuple(r) for r in back.collect()) == [("k1", "a", 1), ("k2", None, 2), ("k3", "c", None)]
