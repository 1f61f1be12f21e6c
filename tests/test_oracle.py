"""Every query of the cell engine against its DuckDB oracle on sf0.001 (the driver uses sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as entry
from cellforge.plans.oracle import ORACLE
from cellforge.plans.queries import QUERIES
from tests.conftest import SF_SMALL
from tools.compare import TABLES, digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns) == digest(orows, ocols)


SPARK_TO_DUCK = {"StringType()": "VARCHAR", "LongType()": "BIGINT", "IntegerType()": "INTEGER",
                 "DoubleType()": "DOUBLE", "BinaryType()": "BLOB", "BooleanType()": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_types_match_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    spark_types = {f.name: SPARK_TO_DUCK.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()}
    assert spark_types == duck_types


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["row", "family", "qualifier", "ts", "value"]
    assert df.count() > 0
