"""Pair relations between users: follows and mentions.

Follow line ``_, a, b``: two cells per line, ``a:b`` (qualifier ``ab``) and ``b:a``
(qualifier ``ba``), emitted in one pass with ``inline`` (no self-union).

Mention line ``_, a, b, code, tweet_id, created_at, _, rel_tw_id?``: row ``a:b``,
family from the code, qualifier = tweet id, value = JSON.

Rejected lines get the counter name of the first failed check; every rejected line
also counts as ``BAD_RECORD``.  A field that is absent (the line is too short) is not
"missing": it rejects the line as ``BAD_RECORD`` only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cellforge.functions.scalars import RELATION_FAMILIES, mention_json, relation_family
from cellforge.functions.split import java_split
from cellforge.operators.cells import accepted
from cellforge.operators.rejects import attach, count_rejects
from cellforge.schema import (
    BAD_RECORD,
    KEY_SEP,
    MISSING_A_ID,
    MISSING_B_ID,
    MISSING_RELATIONSHIP,
    MISSING_TWEET_ID,
    ts_column,
)

# Follow cells' family and the two qualifiers (a->b, b->a).
FOLLOW_FAMILY = "follow"
FOLLOW_AB, FOLLOW_BA = "ab", "ba"

FOLLOW_REASONS = [MISSING_A_ID, MISSING_B_ID]
MENTION_REASONS = [MISSING_A_ID, MISSING_B_ID, MISSING_RELATIONSHIP, MISSING_TWEET_ID]


def _check(chain, field, empty_reason):
    """Absent field -> BAD_RECORD; empty field -> its own counter."""
    chain = (F if chain is None else chain).when(field.isNull(), F.lit(BAD_RECORD))
    return chain.when(field == "", F.lit(empty_reason))


def follow_parsed(lines: DataFrame, line_col: str = "line") -> DataFrame:
    fields = java_split(F.col(line_col))
    out = lines.select(fields.alias("fields"))
    a, b = F.get(F.col("fields"), 1), F.get(F.col("fields"), 2)
    reason = _check(_check(None, a, MISSING_A_ID), b, MISSING_B_ID)
    return out.withColumn("reason", reason)


def follow_cells(
    lines: DataFrame,
    family: str = FOLLOW_FAMILY,
    ts=None,
    line_col: str = "line",
    observation: Observation | None = None,
) -> DataFrame:
    """Two cells per accepted follow line: (a:b, ab) and (b:a, ba), value empty.
    With ``observation``, the reject counters are collected by the same pass."""
    a, b = F.get(F.col("fields"), 1), F.get(F.col("fields"), 2)
    both = F.array(
        F.struct(F.concat_ws(KEY_SEP, a, b).alias("row"), F.lit(FOLLOW_AB).alias("qualifier")),
        F.struct(F.concat_ws(KEY_SEP, b, a).alias("row"), F.lit(FOLLOW_BA).alias("qualifier")),
    )
    parsed = attach(follow_parsed(lines, line_col), observation, FOLLOW_REASONS)
    return accepted(parsed, both).select(
        "row", F.lit(family).alias("family"), "qualifier", ts_column(ts).alias("ts"), F.lit("").alias("value")
    )


def follow_rejects(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """``(reason, n)`` for MISSING_A_ID, MISSING_B_ID and BAD_RECORD (all rejects)."""
    return count_rejects(follow_parsed(lines, line_col), FOLLOW_REASONS)


def mention_parsed(lines: DataFrame, line_col: str = "line") -> DataFrame:
    out = lines.select(java_split(F.col(line_col)).alias("fields"))
    f = [F.get(F.col("fields"), i) for i in range(6)]
    chain = _check(_check(None, f[1], MISSING_A_ID), f[2], MISSING_B_ID)
    chain = chain.when(f[3].isNull(), F.lit(BAD_RECORD)).when(
        ~f[3].isin(*RELATION_FAMILIES), F.lit(MISSING_RELATIONSHIP)
    )
    chain = _check(chain, f[4], MISSING_TWEET_ID).when(f[5].isNull(), F.lit(BAD_RECORD))
    return out.withColumn("reason", chain)


def mention_cells(
    lines: DataFrame, ts=None, line_col: str = "line", observation: Observation | None = None
) -> DataFrame:
    """One cell per accepted mention line.  With ``observation``, the reject counters
    are collected by the same pass."""
    fields = F.col("fields")
    rel = F.when(F.size(fields) > 7, F.get(fields, 7))
    cell = F.struct(
        F.concat_ws(KEY_SEP, F.get(fields, 1), F.get(fields, 2)).alias("row"),
        relation_family(F.get(fields, 3)).alias("family"),
        F.get(fields, 4).alias("qualifier"),
        ts_column(ts).alias("ts"),
        mention_json(F.get(fields, 5), rel).alias("value"),
    )
    parsed = attach(mention_parsed(lines, line_col), observation, MENTION_REASONS)
    return accepted(parsed, F.array(cell))


def mention_rejects(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """``(reason, n)`` for the four mention counters and BAD_RECORD."""
    return count_rejects(mention_parsed(lines, line_col), MENTION_REASONS)
