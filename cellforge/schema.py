"""The cell: one Spark row per stored value of a wide-column table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELL_COLUMNS = ["row", "family", "qualifier", "ts", "value"]

CELL = T.StructType(
    [
        T.StructField("row", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("qualifier", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)

# Fixed values of the cell format and loaders, as the reference defines them:
KEY_SEP = ":"  # joins composite and pair row keys
SKIP_NAME = "-"  # a column name that means "do not store this position"
EMPTY_CELL_MARKER = "1"  # what a named-column read returns for a stored empty value
MIN_KEY_BYTES = 4  # shorter keys go to partition 0
CDF_DIGITS = 7  # CDF values are kept to 7 decimal digits (and multiplied as float32)
MENTION_CREATED_AT, MENTION_REL_TW_ID = "created_at", "rel_tw_id"  # mention JSON fields

# Reason codes of rejected input records.  The first five are the
# counter names the relation loaders report; the last three are this engine's names for
# records that the other loaders drop.
MISSING_A_ID = "MISSING_A_ID"
MISSING_B_ID = "MISSING_B_ID"
MISSING_RELATIONSHIP = "MISSING_RELATIONSHIP"
MISSING_TWEET_ID = "MISSING_TWEET_ID"
BAD_RECORD = "BAD_RECORD"
BAD_FIELD_COUNT = "BAD_FIELD_COUNT"
MISSING_KEY = "MISSING_KEY"
EMPTY_KEY = "EMPTY_KEY"


def ts_column(ts) -> Column:
    """Cell timestamp in epoch milliseconds.

    ``None`` means "now": one ``current_timestamp()`` per query, so every cell of a
    load shares it.  An ``int`` is a literal; a ``Column`` is used as is.
    """
    if ts is None:
        return F.unix_millis(F.current_timestamp())
    if isinstance(ts, Column):
        return ts.cast("bigint")
    return F.lit(int(ts)).cast("bigint")


def as_cells(df: DataFrame) -> DataFrame:
    """Project to the cell columns in their canonical order."""
    return df.select(*CELL_COLUMNS)
