"""Expected counts of the driver-table inputs (FIXTURES.md part 2) at sf0.01."""

from pyspark.sql import functions as F

from cellforge.operators import audit, cells, keyspace, versions
from cellforge.session import shared_path
from cellforge.sources import fixtures as fx
from cellforge.schema import BAD_FIELD_COUNT, EMPTY_KEY, MISSING_KEY
from cellforge.operators.rejects import count_rejects
from tests.conftest import SF_MID


def test_user_lines_field_counts(spark):
    split = cells.split_lines(fx.line_input(spark, SF_MID, "user_lines"))
    sizes = {r[0]: r[1] for r in split.groupBy(F.size("fields")).count().collect()}
    assert sizes == {6: 1220, 5: 243, 1: 37}
    reasons = {r.reason: r.n for r in count_rejects(cells.table_parsed(fx.line_input(spark, SF_MID, "user_lines"), 1),
                                                     [MISSING_KEY, EMPTY_KEY], total=None).collect()}
    assert reasons == {MISSING_KEY: 37, EMPTY_KEY: 40}


def test_cell_lines(spark):
    parsed = cells.bulk_parsed(fx.line_input(spark, SF_MID, "cell_lines"))
    sizes = {r[0]: r[1] for r in parsed.groupBy(F.size("fields")).count().collect()}
    assert sizes == {4: 178, 3: 12, 5: 10}
    c = {r.reason: r.n for r in count_rejects(parsed, [BAD_FIELD_COUNT], total=None).collect()}
    assert c == {BAD_FIELD_COUNT: 22}


def test_key_counts_and_latest_events(spark):
    assert fx.line_input(spark, SF_MID, "key_counts").count() == 14743
    assert versions.latest_cells(fx.event_cells(spark, SF_MID)).count() == 750


def test_balance_and_audit_sink(spark):
    kc = fx.line_input(spark, SF_MID, "key_counts")
    hist = keyspace.partition_histogram(kc, "key", bins=10)
    b = keyspace.balance(hist.where(F.col("bin").isNotNull())).first()
    assert b.parts == 10 and b.max_n >= b.avg_n and b.skew >= 1.0
    keys = spark.createDataFrame([("1",), ("2",)], "key string")
    rows = spark.createDataFrame([("1",)], "row string")
    path = audit.write_audit(audit.lookup_audit(keys, rows), shared_path(spark, "audit_tsv"))
    back = sorted(r.value for r in spark.read.text(path).collect())
    assert back == ["1\t1\t0", "2\t2\t1"]
