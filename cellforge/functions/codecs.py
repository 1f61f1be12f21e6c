"""Value codecs ("casters"): typed values to cell bytes and back.

``text`` writes a value as its string form (nested values as JSON) and reads with a
``try_cast``.  ``binary`` writes strings as UTF-8 and numbers big-endian: int as 4
bytes, long as 8, float as IEEE 4, double as IEEE 8, NaN included.  All are built-in
functions: integers go through hex (Spark refuses integer-to-binary casts under ANSI),
floats through the JVM's own bit views (``java_method``).
A caster may also be any callable ``(Column, DataType) -> Column``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Caster = str | Callable[[Column, T.DataType], Column]

_NESTED = (T.MapType, T.ArrayType, T.StructType)


def _raise_type(dtype: T.DataType) -> None:
    raise TypeError(f"no cell encoding for type {dtype.simpleString()}")


# --- float / double bit views -------------------------------------------------------

HEX_BYTE = 2  # hex digits of a byte


def _bits(c: Column, kind: str, method: str, width: int) -> Column:
    """Big-endian bytes of a floating value's bits; NaN has bits, NULL has none."""
    zero = F.lit(0.0).cast("float" if kind == "java.lang.Float" else "double")
    bits = F.java_method(F.lit(kind), F.lit(method), F.coalesce(c, zero)).cast("bigint")
    digits = F.right(F.lpad(F.hex(bits), F.lit(16), F.lit("0")), F.lit(HEX_BYTE * width))
    return F.when(c.isNotNull(), F.unhex(digits))


def _from_bits(v: Column, kind: str, method: str, width: int, bits: Column, to: str) -> Column:
    right = F.octet_length(v) == width
    return F.when(right, F.java_method(F.lit(kind), F.lit(method), F.when(right, bits).otherwise(F.lit(0))).cast(to))


# --- encode -----------------------------------------------------------------------


def encode_text(c: Column, dtype: T.DataType) -> Column:
    """String form of a value; nested values as JSON, NULL stays NULL."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.BinaryType):
        return c.cast("string")
    if isinstance(dtype, (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)):
        return c.cast("string")
    if isinstance(dtype, _NESTED):
        return F.to_json(c)
    _raise_type(dtype)


def encode_binary(c: Column, dtype: T.DataType) -> Column:
    """Big-endian bytes of a value, NULL stays NULL."""
    if isinstance(dtype, T.BinaryType):
        return c
    if isinstance(dtype, T.StringType):
        return F.encode(c, "UTF-8")
    if isinstance(dtype, T.IntegerType):
        return F.unhex(F.substring(F.lpad(F.hex(c.cast("bigint")), 16, "0"), 9, 8))
    if isinstance(dtype, T.LongType):
        return F.unhex(F.lpad(F.hex(c), 16, "0"))
    if isinstance(dtype, T.DoubleType):
        return _bits(c, "java.lang.Double", "doubleToRawLongBits", 8)
    if isinstance(dtype, T.FloatType):
        return _bits(c, "java.lang.Float", "floatToRawIntBits", 4)
    _raise_type(dtype)


def encode_value(c: Column, dtype: T.DataType, caster: Caster = "text") -> Column:
    if callable(caster):
        return caster(c, dtype)
    if caster == "text":
        return encode_text(c, dtype)
    if caster == "binary":
        return encode_binary(c, dtype)
    raise ValueError(f"unknown caster {caster!r}")


# --- decode -----------------------------------------------------------------------


def decode_text(v: Column, dtype: T.DataType) -> Column:
    """Typed value of a text cell (a string, or UTF-8 bytes in a binary value column);
    text that does not parse gives NULL."""
    text = v.cast("string")
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, _NESTED):
        return F.from_json(text, dtype)
    return text.try_cast(dtype)


def decode_binary(v: Column, dtype: T.DataType) -> Column:
    """Typed value of a big-endian binary cell; a wrong length gives NULL."""
    if isinstance(dtype, T.BinaryType):
        return v
    if isinstance(dtype, T.StringType):
        return F.decode(v, "UTF-8")
    h = F.hex(v)
    if isinstance(dtype, (T.IntegerType, T.FloatType)):
        sign = F.when(F.substring(h, 1, 1) >= F.lit("8"), F.lit("FFFFFFFF")).otherwise(F.lit("00000000"))
        signed = F.conv(F.concat(sign, h), 16, -10).cast("bigint").cast("int")
        if isinstance(dtype, T.FloatType):
            return _from_bits(v, "java.lang.Float", "intBitsToFloat", 4, signed, "float")
        return F.when(F.octet_length(v) == 4, signed)
    if isinstance(dtype, T.LongType):
        return F.when(F.octet_length(v) == 8, F.conv(h, 16, -10).cast("bigint"))
    if isinstance(dtype, T.DoubleType):
        return _from_bits(v, "java.lang.Double", "longBitsToDouble", 8, F.conv(h, 16, -10).cast("bigint"), "double")
    _raise_type(dtype)


def decode_value(v: Column, dtype: T.DataType, caster: Caster = "text") -> Column:
    if callable(caster):
        return caster(v, dtype)
    if caster == "text":
        return decode_text(v, dtype)
    if caster == "binary":
        return decode_binary(v, dtype)
    raise ValueError(f"unknown caster {caster!r}")
