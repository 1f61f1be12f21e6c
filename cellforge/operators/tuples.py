"""Typed rows to cells: the three store functions.

* ``store_rows``: field 0 is the row key, field i goes to the i-th ``family:qualifier``;
  NULL values are not stored, a NULL key stores nothing; an optional timestamp field
  (still stored as a value too) falls back to ``now`` when it is not an integer.
* ``store_dynamic``: ``(row, family, qualifier, value[, ts])`` per record; ``ts`` is
  read only when there are exactly five fields and must be an integer.
* ``store_bag``: ``(key, bag)``; bag position i > 0 goes under ``names[i]``, one shared
  ts; a NULL key, bag or element drops the whole record; a name repeated in the list
  keeps its first position; more values than names is an error.

All are single narrow stages (``inline``/``posexplode`` + filters).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellforge.functions.codecs import Caster, encode_value
from cellforge.operators.files import sort_cells
from cellforge.operators.scan import parse_spec
from cellforge.schema import ts_column

_INTEGER_TEXT = r"^[+-]?[0-9]+$"


def _integer_or_null(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.rlike(_INTEGER_TEXT), s.try_cast("bigint"))


def store_rows(
    df: DataFrame,
    columns: str | Sequence[str],
    caster: Caster | Sequence[Caster] = "text",
    timestamp_field: int | None = None,
    now=None,
) -> DataFrame:
    """Rows ``(key, v1, ..., vn)`` with a spec of n ``family:qualifier`` columns to cells.

    ``caster`` is one caster for all columns or one per column; when any column is
    binary the value column is binary and text values are stored as UTF-8 bytes."""
    # a family-only name stores under the empty qualifier
    specs = [(f, q or "") for f, q in parse_spec(columns)]
    fields = df.schema.fields
    if len(specs) != len(fields) - 1:
        raise ValueError(f"{len(specs)} column names for {len(fields) - 1} value fields")
    ts = ts_column(now)
    if timestamp_field is not None:
        ts = F.coalesce(_integer_or_null(F.col(fields[timestamp_field].name)), ts)
    casters = list(caster) if isinstance(caster, (list, tuple)) else [caster] * len(specs)
    if len(casters) != len(specs):
        raise ValueError("one caster per column")
    as_bytes = any(c == "binary" for c in casters)
    key = encode_value(F.col(fields[0].name), fields[0].dataType, "text")

    def value(fld, c):
        v = encode_value(F.col(fld.name), fld.dataType, c)
        return F.encode(v, "UTF-8") if as_bytes and c == "text" else v

    pairs = [
        F.struct(F.lit(f).alias("family"), F.lit(q).alias("qualifier"), value(fld, c).alias("value"))
        for (f, q), fld, c in zip(specs, fields[1:], casters)
    ]
    return (
        df.select(key.alias("row"), ts.alias("ts"), F.inline(F.array(*pairs)))
        .where(F.col("row").isNotNull() & F.col("value").isNotNull())
        .select("row", "family", "qualifier", "ts", "value")
    )


def store_dynamic(df: DataFrame, caster: Caster = "text", now=None) -> DataFrame:
    """Records ``(row, family, qualifier, value[, ts])`` to one cell each."""
    fields = df.schema.fields
    if len(fields) < 4:
        raise ValueError("store_dynamic needs at least 4 fields: row, family, qualifier, value")
    row, fam, qual, val = (F.col(f.name) for f in fields[:4])
    ts = ts_column(now)
    if len(fields) == 5:
        raw = F.col(fields[4].name)
        parsed = _integer_or_null(raw)
        ts = F.when(parsed.isNull(), F.raise_error(F.concat(F.lit("bad timestamp: "), raw.cast("string")))).otherwise(
            parsed
        )
        ts = F.when(row.isNotNull(), ts)
    return (
        df.select(
            encode_value(row, fields[0].dataType, "text").alias("row"),
            encode_value(fam, fields[1].dataType, "text").alias("family"),
            encode_value(qual, fields[2].dataType, "text").alias("qualifier"),
            ts.alias("ts"),
            encode_value(val, fields[3].dataType, caster).alias("value"),
        )
        .where(F.col("row").isNotNull() & F.col("value").isNotNull())
        .where(F.col("family").isNotNull() & F.col("qualifier").isNotNull())  # no cell has none
    )


def store_bag(
    df: DataFrame, key_col: str, bag_col: str, names: str | Sequence[str], family: str, now=None
) -> DataFrame:
    """``(key, array<string>)`` records to cells sorted within each partition."""
    names = names.split(",") if isinstance(names, str) else list(names)
    keep = [i for i in range(1, len(names)) if names[i] not in names[1:i]]
    bag = F.col(bag_col)
    complete = F.col(key_col).isNotNull() & bag.isNotNull() & F.forall(bag, lambda x: x.isNotNull())
    checked = F.when(
        F.size(bag) > len(names), F.raise_error(F.lit(f"bag has more values than the {len(names)} names"))
    ).otherwise(bag)
    cells = (
        df.where(complete)
        .select(F.col(key_col).cast("string").alias("row"), ts_column(now).alias("ts"), F.posexplode(checked))
        .where(F.col("pos").isin(*keep))
        .select(
            "row",
            F.lit(family).alias("family"),
            F.element_at(F.array(*[F.lit(n) for n in names]), F.col("pos") + 1).alias("qualifier"),
            "ts",
            F.col("col").cast("string").alias("value"),
        )
    )
    return sort_cells(cells)

