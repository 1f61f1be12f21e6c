from cellforge.operators import cells, rejects
from cellforge.schema import BAD_FIELD_COUNT, EMPTY_KEY, MISSING_KEY
from tests.conftest import lines_df

TS = 5


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_bulk_exactly_four_fields(spark):
    df = lines_df(spark, ["r\tf\tq\t", "r\tf\tq\tv\t", "r\tf\tq\tv\tx", "\tf\tq\tv"])
    assert rows(cells.bulk_cells(df, ts=TS)) == [("r", "f", "q", TS, "v")]
    counts = dict(rejects.count_rejects(cells.bulk_parsed(df), [BAD_FIELD_COUNT, EMPTY_KEY], total=None).collect())
    assert counts == {BAD_FIELD_COUNT: 2, EMPTY_KEY: 1}


def test_table_and_file_key_rules(spark):
    df = lines_df(spark, ["x\t7\t"])
    names = ["-", "k", "v"]
    assert rows(cells.table_cells(df, names, "f", key_index=1, ts=TS)) == [("7", "f", "k", TS, "7")]
    assert rows(cells.file_cells(df, names, "f", key_index=1, ts=TS)) == [("7", "f", "-", TS, "x")]


def test_table_missing_and_empty_key(spark):
    df = lines_df(spark, ["x", "x\t\tv", "x\tk\tv"])
    out = rows(cells.table_cells(df, ["-", "k", "v"], "f", key_index=1, ts=TS))
    assert out == [("k", "f", "k", TS, "k"), ("k", "f", "v", TS, "v")]
    reasons = {r.reason for r in cells.table_parsed(df, 1).collect()}
    assert reasons == {MISSING_KEY, EMPTY_KEY, None}


def test_composite_key(spark):
    df = lines_df(spark, ["x\t7\t\tz", "x\t7\t8\tz"])
    out = rows(cells.composite_key_cells(df, ["-", "a", "b", "c"], "f", key_indexes=[1, 2], ts=TS))
    assert {r[0] for r in out} == {"7:8"}
    assert [r[2] for r in out] == ["a", "b", "c"]


def test_edge_cells(spark):
    df = lines_df(spark, ["e\ta\tb", "e\ta", "e\t\tb", "e\ta\tb\tc"])
    assert rows(cells.edge_cells(df, "g", ts=TS)) == [("a", "g", "b", TS, ""), ("a", "g", "b", TS, "")]


def test_adjacency_cells(spark):
    df = lines_df(spark, ["n\ta\t\tb", "n", "\t\t"])
    out = rows(cells.adjacency_cells(df, "adj", ts=TS))
    assert [r[2] for r in out] == ["", "a", "b"]
    assert {r[0] for r in out} == {"n"}


def test_loader_counters_in_the_load_pass(spark):
    from pyspark.sql import Observation

    from tests.conftest import SF_MID
    from cellforge.sources import fixtures as fx

    obs = Observation("user_table")
    loaded = cells.table_cells(fx.line_input(spark, SF_MID, "user_lines"), fx.USER_NAMES, "base", key_index=1, ts=TS,
                               observation=obs)
    loaded.write.format("noop").mode("overwrite").save()
    assert obs.get == {MISSING_KEY: 37, EMPTY_KEY: 40, "BAD_RECORD": 77}


def test_null_line_is_rejected_everywhere(spark):
    from cellforge.operators import relations

    df = spark.createDataFrame([(None,), ("r\tf\tq\tv",)], "line string")
    assert [r.row for r in cells.bulk_cells(df, ts=TS).collect()] == ["r"]
    assert cells.table_cells(df, ["k", "v"], "f", key_index=0, ts=TS).where("row is null").count() == 0
    assert cells.edge_cells(df, "g", ts=TS).where("row is null").count() == 0
    assert cells.adjacency_cells(df, "a", ts=TS).where("row is null").count() == 0
    assert relations.follow_cells(df, ts=TS).where("row is null or row = ''").count() == 0
    assert relations.mention_cells(df, ts=TS).count() == 0
