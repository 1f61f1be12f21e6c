"""Reject counters: how many input records each rule rejected.

A parsed frame carries a ``reason`` column (NULL = accepted).  ``count_rejects`` is a
single global aggregate (partial per task, one tiny final merge) unpivoted to
``(reason, n)``; ``observe_rejects`` attaches the same counts as an ``Observation`` so
they are collected during the load's own write, with no second pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cellforge.schema import BAD_RECORD


def _aggs(reasons: Sequence[str], total: str | None):
    aggs = [F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in reasons]
    if total is not None:
        aggs.append(F.count("reason").alias(total))
    return aggs


def count_rejects(parsed: DataFrame, reasons: Sequence[str], total: str | None = BAD_RECORD) -> DataFrame:
    """``(reason string, n bigint)``: one row per listed reason (zero included) and,
    when ``total`` is given, one row counting every rejected record."""
    names = list(reasons) + ([total] if total is not None else [])
    counts = parsed.agg(*_aggs(reasons, total))
    pairs = [F.struct(F.lit(n).alias("reason"), F.col(n).cast("bigint").alias("n")) for n in names]
    return counts.select(F.inline(F.array(*pairs)))


def attach(parsed: DataFrame, observation: Observation | None, reasons: Sequence[str], total: str | None = BAD_RECORD) -> DataFrame:
    """``parsed`` with the reject counters attached to ``observation`` (if given): they
    are filled by whatever action runs the load, e.g. its write."""
    if observation is None:
        return parsed
    return parsed.observe(observation, *_aggs(reasons, total))


def observe_rejects(
    parsed: DataFrame, reasons: Sequence[str], total: str | None = BAD_RECORD, name: str = "rejects"
) -> tuple[DataFrame, Observation]:
    """The same counts as metrics of the next action on the returned frame."""
    obs = Observation(name)
    return parsed.observe(obs, *_aggs(reasons, total)), obs
