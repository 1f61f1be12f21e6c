"""Text sources and sinks: raw lines, typed TSV, key lists, key samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per text line: ``line string``.  Splitting is ``java_split``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def write_lines(lines: DataFrame, path: str, line_col: str = "line", mode: str = "errorifexists") -> str:
    lines.select(F.col(line_col).alias("value")).write.mode(mode).text(path)
    return path


def read_typed_tsv(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """Positional, typed load of tab-separated text: fields are named and cast by the
    schema; an empty field, a missing one or one that does not parse is NULL; no quoting,
    no header.  Every line is a record, blank and tab-only ones too."""
    fields = (spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema).fields
    parts = read_lines(spark, path).select(F.split("line", "\t", -1).alias("f"))
    typed = [F.nullif(F.get("f", i), F.lit("")).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)]
    return parts.select(*typed)


def read_key_list(spark: SparkSession, path: str | list[str], with_position: bool = False) -> DataFrame:
    """``key string``: one key per line, surrounding whitespace (tabs too) stripped; a
    blank line is the empty key, which no table has.  ``with_position`` adds ``pos``, a
    struct that orders the lines by file, then by their place in it."""
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    cols = [F.regexp_replace("line", r"^[\s\x00]+|[\s\x00]+$", "").alias("key")]
    if with_position:
        file = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
        cols.append(F.struct(file[0].alias("file"), file[1].alias("start"), F.monotonically_increasing_id().alias("line")).alias("pos"))
    return lines.select(*cols)


def key_window(
    keys: DataFrame, offset: int = 0, limit: int | None = None, key_col: str = "key", order_col: str | None = None
) -> DataFrame:
    """The keys from place ``offset`` on, at most ``limit`` of them, in key order or in
    ``order_col`` order (``pos`` from ``read_key_list(with_position=True)`` is file order).
    The keys are numbered by ranges, so no task gets the whole list."""
    placed = mark_window(keys, offset, limit, key_col, order_col, "_n", "_in")
    return placed.where(F.col("_in") == 1).drop("_n", "_in")


def mark_window(
    keys: DataFrame, offset: int = 0, limit: int | None = None, key_col: str = "key", order_col: str | None = None,
    place: str = "place", name: str = "in_window",
) -> DataFrame:
    """All keys with their 1-based ``place`` in the order of ``key_window``, and 1 in ``name``
    where that window holds them, else 0."""
    from cellforge.operators.audit import with_row_number

    inside = F.col(place) > offset
    if limit is not None:
        inside &= F.col(place) <= offset + limit
    return with_row_number(keys, [order_col or key_col], place).withColumn(name, inside.cast("int"))


def read_sample_counts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(key string, cnt string)`` samples from tab-separated text; the count stays
    text so ``keyspace.prefix_mass`` can read its leading number."""
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("cnt", T.StringType())])
    return read_typed_tsv(spark, path, schema)
