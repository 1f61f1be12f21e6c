"""Sharding by Hilbert curve: quantise metadata dimensions, sort by curve index, cut runs.

Each dimension is cut at its approximate quantiles into ``2**bits`` cells; strings at the
exact quantiles of their whole values, by bytes.  The cells' Hilbert index orders
the rows, and equal runs of that order are the shards: rows of a shard are near in every
dimension at once, so min/max statistics prune on any of them.

Law ``rows``: shard sizes differ by one row at most, whatever the values are.  Nulls lie in
cell 0.  Ties on the curve are ordered by the dimensions and then by a hash of the whole
row; repeated rows each get their own slot.  An empty table gives an empty table.  Columns
named ``shard``, ``slot`` or ``curve`` are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellforge.llm.tables import packed, ranked, stash, unstash

ACCURACY = 10_000


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of ``cells`` (n x dims, values below 2**bits)."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess rotations, from the highest bit down
        low = q - 1
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, len(x)):  # Gray code
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = (out << 1) | (((v ^ turn) >> b) & 1)
    return out


def _number(df: DataFrame, dim: str) -> Column | None:
    """The values of a dimension as doubles; None where they are strings."""
    kind, col = df.schema[dim].dataType, F.col(f"`{dim}`")
    if isinstance(kind, T.NumericType):
        return col.cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.BooleanType)):
        return col.cast("timestamp").cast("double") if not isinstance(kind, T.BooleanType) else col.cast("double")
    return None


def _string_bounds(df: DataFrame, dim: str, bits: int) -> list[bytes]:
    """The values where the rows up to them reach another ``2**-bits`` of all.  Distinct values
    are counted, sorted by ranges and summed up by partition; only bounds reach the driver."""
    values = df.select(F.col(f"`{dim}`").cast("string").cast("binary").alias("v")).where("v is not null")
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    ranged = stash(counts.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "values")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    sums = ranged.groupBy("part").agg(F.sum("n").alias("held"))
    sums = stash(sums.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0))), "values-before")
    total = sums.agg(F.sum("held")).first()[0] or 0
    cells, up_to = 1 << bits, F.col("before") + F.sum("n").over(Window.partitionBy("part").orderBy("v"))
    summed = ranged.join(F.broadcast(sums.drop("held")), "part").withColumn("up_to", up_to)
    reached = lambda c: F.floor(c * cells / F.lit(max(total, 1)))
    met = summed.where(F.least(reached(F.col("up_to")), F.lit(cells - 1)) > reached(F.col("up_to") - F.col("n")))
    bounds = sorted(bytes(r[0]) for r in met.select("v").collect())
    unstash(ranged)
    unstash(sums)
    return bounds


def quantile_bounds(df: DataFrame, dims: list[str], bits: int) -> dict[str, list]:
    """Per dimension, at most ``2**bits - 1`` increasing cell bounds (over all rows)."""
    at = [k / (1 << bits) for k in range(1, 1 << bits)]
    plain = [d for d in dims if _number(df, d) is not None]
    bounds = {d: _string_bounds(df, d, bits) for d in dims if d not in plain}
    if plain:
        row = df.agg(*[F.percentile_approx(_number(df, d), at, ACCURACY).alias(f"d{i}") for i, d in enumerate(plain)]).first()
        bounds |= {d: sorted(set(row[i] or [])) for i, d in enumerate(plain)}
    return bounds


def _cell(dim: str, bounds: list[bytes]) -> Column:
    """How many of the bounds lie below a string; null for null."""
    value = F.col(f"`{dim}`").cast("string").cast("binary")
    return sum(((value > F.lit(b)).cast("int") for b in map(bytearray, bounds)), F.lit(0)).cast("double")


def hilbert_curve(df: DataFrame, dims: list[str], bits: int = 4) -> DataFrame:
    """``df`` with ``curve``, the Hilbert index of the quantised ``dims``."""
    if not dims or bits * len(dims) > 62:
        raise ValueError("dims must be given, and bits * len(dims) fit in a long")
    bounds = quantile_bounds(df, dims, bits)
    values = [F.coalesce(_number(df, d) if _number(df, d) is not None else _cell(d, bounds[d]), F.lit(float("-inf"))) for d in dims]
    bounds = {d: list(range(len(b))) if _number(df, d) is None else b for d, b in bounds.items()}

    @F.pandas_udf("long")
    def curve(frame: pd.DataFrame) -> pd.Series:
        cells = [np.searchsorted(np.array(bounds[d], dtype=float), frame.iloc[:, i].to_numpy()) for i, d in enumerate(dims)]
        return pd.Series(hilbert_index(np.stack(cells, axis=1), bits))

    return df.withColumn("curve", curve(F.struct(*[v.alias(f"d{i}") for i, v in enumerate(values)])))


def hilbert_shards(df: DataFrame, dims: list[str], shards: int, bits: int = 4) -> DataFrame:
    """``df`` with ``curve``, ``shard`` (0 to ``shards - 1``) and ``slot`` (0 up, no gap)."""
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    places = [f"d{i}" for i in range(len(dims))]
    narrow = df.select(packed(df.drop("curve", "shard", "slot")), *[F.col(f"`{d}`").alias(p) for d, p in zip(dims, places)], whole.alias("whole"))
    rows, n = ranked(hilbert_curve(narrow, places, bits), ["curve", *places, "whole"], "hilbert")
    small, more = divmod(n, shards)
    edge, rank = F.lit(more * (small + 1)), F.col("_rank")
    late = rank - edge
    cut = rows.withColumn(
        "shard", F.when(rank < edge, F.floor(rank / F.lit(small + 1))).otherwise(more + F.floor(late / F.lit(max(small, 1)))).cast("int")
    ).withColumn("slot", F.when(rank < edge, rank % (small + 1)).otherwise(late % max(small, 1)).cast("long"))
    return cut.select("row.*", "curve", "shard", "slot")


def curve_neighbours_differ_by_one(bits: int, dims: int) -> bool:
    """The curve's defining law, for tests: successive cells differ by 1 in one dimension."""
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    order = np.argsort(hilbert_index(grid, bits))
    return bool((np.abs(np.diff(grid[order], axis=0)).sum(axis=1) == 1).all())
