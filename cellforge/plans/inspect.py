"""Physical-plan inspection: the text of ``explain`` and counts of its operators."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

_SHUFFLE = re.compile(r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning|shufflepartitionidpassthrough)", re.I)


def physical_plan(df: DataFrame, mode: str = "simple") -> str:
    """The ``explain`` text of a DataFrame (captured, not printed)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def shuffles(df: DataFrame) -> list[str]:
    """Every shuffle exchange of the plan, e.g. ``hashpartitioning``."""
    return [m.group(1) for m in _SHUFFLE.finditer(physical_plan(df))]


def count(df: DataFrame, operator: str) -> int:
    """Occurrences of an operator name (e.g. ``BroadcastExchange``) in the plan."""
    return len(re.findall(rf"\b{re.escape(operator)}\b", physical_plan(df)))
