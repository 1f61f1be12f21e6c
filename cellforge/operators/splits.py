"""Region starts at weighted quantiles of whole row keys.

Keys are not sorted or shuffled.  The key space is cut into intervals by prefixes: one
aggregate, combined in the map tasks, gives the mass of every prefix that goes one
character beyond what the keys of an interval share.  Only intervals that hold more than
``1 / (FINE * n)`` of the mass and more than one key are cut again, so a hot prefix is refined as
deep as it needs, and ``n`` starts exist wherever there are ``n`` different keys.

Driver data: ``FINE * n`` intervals at most are cut in a round, into one row for each
different next character.  Keys are strings or binary, in unsigned byte order.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FINE = 8


@dataclass(frozen=True)
class Interval:
    """Keys from ``start`` up to the next interval's: their mass, least and greatest key."""

    start: str
    mass: float
    least: str
    most: str

    def cut(self, step: int) -> int:
        """Length of the prefixes that tell its keys apart; binary keys go by whole bytes."""
        shared = next((i for i, (a, b) in enumerate(zip(self.least, self.most)) if a != b), min(len(self.least), len(self.most)))
        return shared // step * step + step


def key_intervals(keys: DataFrame, key_col: str, n: int, weight_col: str | None = None) -> list[Interval]:
    """The key space in order, in intervals of ``1 / (FINE * n)`` of the mass or one key.
    Binary keys are given in hex."""
    from cellforge.operators.scan import region_of

    binary = isinstance(keys.schema[key_col].dataType, T.BinaryType)
    key = F.hex(key_col) if binary else F.col(key_col).cast("string")
    weight = F.lit(1.0) if weight_col is None else F.col(weight_col).cast("double")
    keyed = keys.select(key.alias("k"), weight.alias("w")).where("k is not null")
    found = [F.sum("w").alias("mass"), F.min("k").alias("least"), F.max("k").alias("most")]
    whole = keyed.agg(*found).first()
    if whole["mass"] is None:
        return []
    intervals = [Interval("", whole["mass"], whole["least"], whole["most"])]
    while True:
        hot = [i.least != i.most and i.mass > whole["mass"] / (FINE * n) for i in intervals]
        if not any(hot):
            return intervals
        cuts = F.split(F.lit(",".join(str(i.cut(2 if binary else 1)) if h else "0" for i, h in zip(intervals, hot))), ",")
        placed = keyed.withColumn("at", region_of("k", [i.start for i in intervals[1:]]))
        placed = placed.withColumn("cut", F.get(cuts, F.col("at")).cast("int")).where("cut > 0")
        parts = placed.groupBy("at", F.substring("k", F.lit(1), F.col("cut")).alias("start")).agg(*found).collect()
        finer: dict[int, list[Interval]] = {}
        for p in sorted(parts, key=lambda p: (p["at"], p["start"])):
            inside = finer.setdefault(p["at"], [])
            inside.append(Interval(p["start"] if inside else intervals[p["at"]].start, p["mass"], p["least"], p["most"]))
        intervals = [f for at, i in enumerate(intervals) for f in finer.get(at, [i])]


def starts_of(intervals: list[Interval], n: int) -> list[str]:
    """Starts of the regions after the first: those nearest to the quantiles, each once.
    Fewer than ``n - 1`` only if there are fewer intervals."""
    total, below, sums = sum(i.mass for i in intervals), 0.0, []
    for i in intervals:
        sums.append(below)
        below += i.mass
    picked: list[int] = []
    regions = min(n, len(intervals))
    for r in range(1, regions):
        goal = r * total / regions
        at = bisect_left(sums, goal)
        if at == len(sums) or (at and goal - sums[at - 1] < sums[at] - goal):
            at -= 1
        low = picked[-1] + 1 if picked else 1
        picked.append(min(max(at, low), len(intervals) - (regions - r)))
    return [intervals[i].start for i in picked]


def key_starts(keys: DataFrame, key_col: str, n: int, weight_col: str | None = None) -> list[str] | list[bytes]:
    """Start keys of regions 1 to n-1 at the quantiles of the keys' mass (rows, or the sum of
    ``weight_col``): no region holds over 1 + 1/FINE shares, but for one key that does."""
    if n < 1:
        raise ValueError("n must be >= 1")
    starts = starts_of(key_intervals(keys, key_col, n, weight_col), n)
    return [bytes.fromhex(s) for s in starts] if isinstance(keys.schema[key_col].dataType, T.BinaryType) else starts
