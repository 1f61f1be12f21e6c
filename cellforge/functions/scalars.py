"""Scalar column functions of the loaders and the two text UDFs.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellforge.schema import KEY_SEP, MENTION_CREATED_AT, MENTION_REL_TW_ID

# The flat date layout, and relation code of a mention line -> family.
FLAT_FORMAT = "yyyyMMddHHmmss"
RELATION_FAMILIES = {"re": "reply", "rt": "retweet", "me": "mention"}


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def join_key(*parts: Column | str, sep: str = KEY_SEP) -> Column:
    """Row key of several fields joined by ``sep`` (NULL parts are skipped)."""
    return F.concat_ws(sep, *[_col(p) for p in parts])


def relation_family(code: Column | str) -> Column:
    """Family name of a relation code; NULL for an unknown code."""
    mapping = F.create_map(*[F.lit(x) for kv in RELATION_FAMILIES.items() for x in kv])
    return F.try_element_at(mapping, _col(code))


def mention_json(created_at: Column | str, rel_tw_id: Column | str | None = None) -> Column:
    """``{"created_at":"..."[,"rel_tw_id":"..."]}``; a NULL ``rel_tw_id`` is left out."""
    parts = [_col(created_at).alias(MENTION_CREATED_AT)]
    if rel_tw_id is not None:
        parts.append(_col(rel_tw_id).alias(MENTION_REL_TW_ID))
    return F.to_json(F.struct(*parts))


def row_json(cols: list[Column | str], names: str | list[str]) -> Column:
    """JSON object of values under the given names; NULL values are left out.

    ``names`` is a comma-separated string or a list.  Fewer names than values gives
    NULL, as does an empty value list; surplus names are ignored.  Values are written
    as JSON: numbers bare, text quoted and escaped.
    """
    if isinstance(names, str):
        names = names.split(",")
    if not cols or len(names) < len(cols):
        return F.lit(None).cast("string")
    return F.to_json(F.struct(*[_col(c).alias(n) for c, n in zip(cols, names)]))


def tuple_json(df, cols: list[str], names: str | list[str], out: str = "json"):
    """``row_json`` over named columns of ``df``; map, array and struct values are left
    out of the object (their names still count by position)."""
    from pyspark.sql import types as T

    if isinstance(names, str):
        names = names.split(",")
    if not cols or len(names) < len(cols):
        return df.withColumn(out, F.lit(None).cast("string"))
    nested = (T.MapType, T.ArrayType, T.StructType)
    kept = [(c, n) for c, n in zip(cols, names) if not isinstance(df.schema[c].dataType, nested)]
    if not kept:
        return df.withColumn(out, F.lit("{}"))
    return df.withColumn(out, F.to_json(F.struct(*[F.col(c).alias(n) for c, n in kept])))


def flat_to_millis(s: Column | str, strict: bool = False) -> Column:
    """Epoch milliseconds of a 14-digit ``yyyyMMddHHmmss`` UTC text.

    NULL and ``"0"`` give NULL.  Unparsable text gives NULL, or raises with
    ``strict=True``.  The text is read as UTC whatever the session time zone is.
    """
    s = F.nullif(_col(s).cast("string"), F.lit("0"))
    utc = F.concat(s, F.lit("Z"))
    fmt = F.lit(FLAT_FORMAT + "X")
    parsed = F.to_timestamp(utc, fmt) if strict else F.try_to_timestamp(utc, fmt)
    return F.unix_millis(parsed)


def ntz_to_millis(ts: Column | str) -> Column:
    """Epoch milliseconds (floor) of a ``timestamp_ntz`` wall-clock value read as UTC."""
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), _col(ts).cast("timestamp_ntz"))


def flat_from_ntz(ts: Column | str) -> Column:
    """14-digit flat text of a ``timestamp_ntz`` value."""
    return F.date_format(_col(ts), FLAT_FORMAT)


def flat_from_millis(ms: Column | str) -> Column:
    """14-digit UTC flat text of epoch milliseconds (inverse of ``flat_to_millis``)."""
    return F.date_format(F.timestamp_add("MILLISECOND", _col(ms), _epoch_ntz()), FLAT_FORMAT)


def key_prefix(key: Column | str, chars: int = 3) -> Column:
    """First ``chars`` characters of a key (shorter keys are returned whole)."""
    return F.substring(_col(key), 1, chars)


def leading_number(s: Column | str) -> Column:
    """Double value of the number a text starts with (after blanks): ``"12abc"`` -> 12.0,
    ``"1.5e3x"`` -> 1500.0; no leading number -> 0.0.  Numeric columns pass through."""
    text = _col(s).cast("string")
    head = F.regexp_extract(text, r"^\s*([+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?)", 1)
    return F.coalesce(F.nullif(head, F.lit("")).try_cast("double"), F.lit(0.0))


def numeric_prefix(s: Column | str, chars: int) -> Column:
    """Integer value of the first ``chars`` characters, as a sample prefix.

    Leading blanks and a sign are allowed, a non-numeric tail is ignored, no digits
    gives 0; values under ``10**(chars-1)`` are lumped into that first prefix.
    """
    head = F.substring(_col(s).cast("string"), 1, chars)
    digits = F.regexp_extract(head, r"^\s*([+-]?\d+)", 1)
    value = F.coalesce(F.nullif(digits, F.lit("")).try_cast("int"), F.lit(0))
    return F.greatest(value, F.lit(10 ** (chars - 1)))

