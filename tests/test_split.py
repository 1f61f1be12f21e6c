from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellforge.functions.split import java_split
from tests.conftest import lines_df


def java_like(s: str) -> list[str]:
    """Java's String.split("\\t") on a plain string."""
    if s == "":
        return [""]
    parts = s.split("\t")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


EDGE = ["a\tb\tc\t\t", "", "\t\t", "\ta", "r\tf\tq\t", "r\tf\tq\tv\t", "a\tb\t\t", "a\t\tb"]


def split_all(spark, lines):
    rows = lines_df(spark, lines).select("line", java_split(F.col("line")).alias("f")).collect()
    return {r.line: list(r.f) for r in rows}


def test_edge_rows(spark):
    got = split_all(spark, EDGE)
    assert got["a\tb\tc\t\t"] == ["a", "b", "c"]
    assert got[""] == [""]
    assert got["\t\t"] == []
    assert got["\ta"] == ["", "a"]
    assert len(got["r\tf\tq\t"]) == 3
    assert len(got["r\tf\tq\tv\t"]) == 4
    assert got["a\tb\t\t"] == ["a", "b"]
    assert got["a\t\tb"] == ["a", "", "b"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab\t ", max_size=8), min_size=1, max_size=30))
def test_matches_java_rule(spark, lines):
    got = split_all(spark, lines)
    for line in lines:
        assert got[line] == java_like(line)
