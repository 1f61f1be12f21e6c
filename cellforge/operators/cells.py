"""Records to cells: the line loaders (generic, wide, composite key, file output,
edge list, adjacency list).

Every loader is one narrow stage: split, derive the row key, ``inline`` an array of
(qualifier, value) structs, filter.  No shuffle, no Python.  Each loader has a
``*_parsed`` form that keeps the split fields and a ``reason`` column (NULL for an
accepted line) so rejects can be counted in the same pass (see ``rejects``).

The accept test sits inside the generator (``inline(when(reason IS NULL, cells))``)
rather than in a filter: Catalyst pushes a filter below the projection that splits
the line and inlines the split into every field reference of the test, so the split
would run once per field instead of once per line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cellforge.functions.split import java_split
from cellforge.operators.rejects import attach
from cellforge.schema import (
    BAD_FIELD_COUNT,
    CELL_COLUMNS,
    EMPTY_KEY,
    KEY_SEP,
    MISSING_KEY,
    SKIP_NAME,
    ts_column,
)

# Reasons each loader can reject a line for (for ``observation`` counters).
FIELD_COUNT_REASONS = [BAD_FIELD_COUNT, EMPTY_KEY]
KEY_REASONS = [MISSING_KEY, EMPTY_KEY]


def split_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """``(line, fields)`` with the Java tab-split rule."""
    return lines.select(F.col(line_col).alias("line"), java_split(F.col(line_col)).alias("fields"))


def _fields(lines: DataFrame, line_col: str) -> DataFrame:
    return lines.select(java_split(F.col(line_col)).alias("fields"))


def _key_reason(key: Column) -> Column:
    return F.when(key.isNull(), F.lit(MISSING_KEY)).when(key == "", F.lit(EMPTY_KEY))


def accepted(parsed: DataFrame, cells: Column, *keep: Column) -> DataFrame:
    """Rows of the struct array ``cells`` for accepted lines only (see module notes)."""
    return parsed.select(*keep, F.inline(F.when(F.col("reason").isNull(), cells)))


def _emit(parsed: DataFrame, row: Column, pairs: Sequence[Column], family: str, ts, keep_empty: bool) -> DataFrame:
    """Cells of accepted lines from (qualifier, value) struct columns."""
    out = accepted(parsed, F.array(*pairs), row.alias("row"))
    cond = F.col("value").isNotNull()
    if not keep_empty:
        cond = cond & (F.col("value") != "")
    return out.where(cond).select(
        "row", F.lit(family).alias("family"), "qualifier", ts_column(ts).alias("ts"), "value"
    )


def _pair(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("qualifier"), value.alias("value"))


# --- generic cells: row, family, qualifier, value ---------------------------------


def bulk_parsed(lines: DataFrame, line_col: str = "line") -> DataFrame:
    fields = F.col("fields")
    reason = F.when(F.size(fields) != 4, F.lit(BAD_FIELD_COUNT)).when(F.get(fields, 0) == "", F.lit(EMPTY_KEY))
    return _fields(lines, line_col).withColumn("reason", reason)


def bulk_cells(lines: DataFrame, ts=None, line_col: str = "line", observation: Observation | None = None) -> DataFrame:
    """Lines of exactly four fields ``row, family, qualifier, value`` as cells."""
    f = F.col("fields")
    cell = F.struct(
        F.get(f, 0).alias("row"),
        F.get(f, 1).alias("family"),
        F.get(f, 2).alias("qualifier"),
        ts_column(ts).alias("ts"),
        F.get(f, 3).alias("value"),
    )
    return accepted(attach(bulk_parsed(lines, line_col), observation, FIELD_COUNT_REASONS), F.array(cell))


# --- wide lines: named positions ---------------------------------------------------


def _named_pairs(names: Sequence[str], skip: set[int], skip_dash: bool) -> list[Column]:
    pairs = []
    for i, name in enumerate(names):
        if i in skip or (skip_dash and name == SKIP_NAME):
            continue
        pairs.append(_pair(name, F.get(F.col("fields"), i)))
    return pairs


def table_parsed(lines: DataFrame, key_index: int = 0, line_col: str = "line") -> DataFrame:
    return _fields(lines, line_col).withColumn("reason", _key_reason(F.get(F.col("fields"), key_index)))


def table_cells(
    lines: DataFrame,
    names: Sequence[str],
    family: str,
    key_index: int = 0,
    ts=None,
    line_col: str = "line",
    observation: Observation | None = None,
) -> DataFrame:
    """Wide line to cells: one cell per named position with a non-empty value.

    A name ``-`` skips its position; the key position is stored too when it has a
    name.  Lines without the key field, or with an empty key, are rejected.
    """
    parsed = attach(table_parsed(lines, key_index, line_col), observation, KEY_REASONS)
    row = F.get(F.col("fields"), key_index)
    return _emit(parsed, row, _named_pairs(names, set(), True), family, ts, keep_empty=False)


def composite_parsed(lines: DataFrame, key_indexes: Sequence[int], line_col: str = "line") -> DataFrame:
    reason = None
    for k in key_indexes:
        part = F.get(F.col("fields"), k)
        reason = (F if reason is None else reason).when(part.isNull(), F.lit(MISSING_KEY)).when(
            part == "", F.lit(EMPTY_KEY)
        )
    return _fields(lines, line_col).withColumn("reason", reason)


def composite_key_cells(
    lines: DataFrame,
    names: Sequence[str],
    family: str,
    key_indexes: Sequence[int],
    ts=None,
    sep: str = KEY_SEP,
    line_col: str = "line",
    observation: Observation | None = None,
) -> DataFrame:
    """As ``table_cells`` with the row key = key fields joined by ``sep`` in the given
    order; a missing or empty key part rejects the line."""
    parsed = attach(composite_parsed(lines, key_indexes, line_col), observation, KEY_REASONS)
    row = F.concat_ws(sep, *[F.get(F.col("fields"), k) for k in key_indexes])
    return _emit(parsed, row, _named_pairs(names, set(), True), family, ts, keep_empty=False)


def file_cells(
    lines: DataFrame,
    names: Sequence[str],
    family: str,
    key_index: int = 0,
    ts=None,
    line_col: str = "line",
    observation: Observation | None = None,
) -> DataFrame:
    """Wide line to cells for sorted-file output: the key position is not stored and
    ``-`` is an ordinary name."""
    parsed = attach(table_parsed(lines, key_index, line_col), observation, KEY_REASONS)
    row = F.get(F.col("fields"), key_index)
    return _emit(parsed, row, _named_pairs(names, {key_index}, False), family, ts, keep_empty=False)


# --- graphs -----------------------------------------------------------------------


def edge_parsed(lines: DataFrame, line_col: str = "line") -> DataFrame:
    fields = F.col("fields")
    reason = F.when(F.size(fields) < 3, F.lit(BAD_FIELD_COUNT)).when(F.get(fields, 1) == "", F.lit(EMPTY_KEY))
    return _fields(lines, line_col).withColumn("reason", reason)


def edge_cells(
    lines: DataFrame, family: str, value: str = "", ts=None, line_col: str = "line", observation: Observation | None = None
) -> DataFrame:
    """Edge list ``_, src, dst, ...`` to one cell (row=src, qualifier=dst)."""
    f = F.col("fields")
    cell = F.struct(
        F.get(f, 1).alias("row"),
        F.lit(family).alias("family"),
        F.get(f, 2).alias("qualifier"),
        ts_column(ts).alias("ts"),
        F.lit(value).alias("value"),
    )
    return accepted(attach(edge_parsed(lines, line_col), observation, FIELD_COUNT_REASONS), F.array(cell))


def adjacency_parsed(lines: DataFrame, line_col: str = "line") -> DataFrame:
    return _fields(lines, line_col).withColumn("reason", _key_reason(F.get(F.col("fields"), 0)))


def adjacency_cells(
    lines: DataFrame, family: str, value: str = "", ts=None, line_col: str = "line", observation: Observation | None = None
) -> DataFrame:
    """Adjacency line ``node, n1, n2, ...`` to one cell per neighbour (qualifier);
    an inner empty field is an empty qualifier.  A line with only the node has no cells."""
    f = F.col("fields")
    neighbours = F.when(F.col("reason").isNull() & (F.size(f) > 1), F.slice(f, 2, F.size(f) - 1))
    return (
        attach(adjacency_parsed(lines, line_col), observation, KEY_REASONS)
        .select(F.get(f, 0).alias("row"), F.explode(neighbours).alias("col"))
        .select(
            "row",
            F.lit(family).alias("family"),
            F.col("col").alias("qualifier"),
            ts_column(ts).alias("ts"),
            F.lit(value).alias("value"),
        )
    )


__all__ = [
    "CELL_COLUMNS",
    "split_lines",
    "bulk_parsed",
    "bulk_cells",
    "table_parsed",
    "table_cells",
    "composite_parsed",
    "composite_key_cells",
    "file_cells",
    "edge_parsed",
    "edge_cells",
    "adjacency_parsed",
    "adjacency_cells",
]
