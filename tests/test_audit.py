from cellforge.operators import audit
from cellforge.sources.text import key_window, read_key_list, write_lines
from cellforge.session import shared_path
from tests.conftest import cells_df


def test_row_number_is_consecutive(spark):
    df = spark.range(0, 5000).selectExpr("cast(id * 7 % 5000 as string) as k")
    got = audit.with_row_number(df, ["k"], partitions=6).collect()
    ns = sorted(r.n for r in got)
    assert ns == list(range(1, 5001))
    by_key = sorted(got, key=lambda r: r.k)
    assert [r.n for r in by_key] == list(range(1, 5001))


def test_lookup_audit(spark):
    rows = cells_df(spark, [("100000031", "f", "q", 1, "v"), ("100000101", "f", "q", 1, "v")])
    keys = spark.createDataFrame([("100000031",), ("100000071",), ("100000101",)], "key string")
    got = [tuple(r) for r in audit.lookup_audit(keys, rows).orderBy("n").collect()]
    assert got == [(1, "100000031", 0), (2, "100000071", 1), (3, "100000101", 0)]
    assert audit.miss_rate(audit.lookup_audit(keys, rows)).first().misses == 1
    assert audit.missed_keys(keys, rows).count() == 1 and audit.found_keys(keys, rows).count() == 2


def test_key_list_source(spark):
    lines = spark.createDataFrame([("100000031\t",), ("  100000071 ",), ("",), ("100000101\t",)], "line string")
    path = write_lines(lines, shared_path(spark, "keys"))
    keys = read_key_list(spark, path)
    assert sorted(r.key for r in keys.collect()) == ["", "100000031", "100000071", "100000101"]  # a blank line is a key, too
    assert [r.key for r in key_window(keys, offset=2, limit=1).collect()] == ["100000071"]


def test_row_number_splits_a_hot_key(spark):
    from pyspark.sql import functions as F

    hot = spark.range(0, 9000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    numbered = audit.with_row_number(hot, ["k"], partitions=8)
    per_task = [r[0] for r in numbered.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sorted(r.n for r in numbered.collect()) == list(range(1, 9001))
    assert max(per_task) < 3000  # the 3,000 copies of "hot" are not in one task


def test_stamped_audit_sink(spark):
    import re

    keys = spark.createDataFrame([("1",), ("2",)], "key string")
    rows = spark.createDataFrame([("1",)], "row string")
    path = audit.write_audit(audit.lookup_audit(keys, rows), shared_path(spark, "audit_stamped"), stamp=True)
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert all(re.fullmatch(r"\d\t\d{14}\t\d\t[01]", line) for line in lines)


def test_audit_of_a_whole_key_file(spark):
    """The audit reaches found, missed and blank keys, inside and outside the window of file order."""
    from cellforge.plans.queries import AUDIT_LIMIT, QUERIES
    from tests.conftest import SF_SMALL

    got = QUERIES["audit_key_list"](spark, SF_SMALL).toPandas()
    customers = spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    assert (got["key"] != "").sum() == 2 * customers and sorted(got["place"]) == sorted(got["n"]) == list(range(1, len(got) + 1))
    seen = got.groupby(["in_window", got["key"] == "", "missed"]).size()
    assert set(seen.index) == {(w, b, m) for w in (0, 1) for b, m in ((False, 0), (False, 1), (True, 1))}
    assert got["in_window"].sum() == AUDIT_LIMIT


def test_key_window_in_file_order(spark):
    lines = spark.createDataFrame([("300\t",), ("100\t",), ("200\t",)], "line string").coalesce(1)
    path = write_lines(lines, shared_path(spark, "keys_file_order"))
    keys = read_key_list(spark, path, with_position=True)
    assert [r.key for r in key_window(keys, offset=1, order_col="pos").collect()] == ["100", "200"]
    assert [r.key for r in key_window(keys, offset=1).collect()] == ["200", "300"]
