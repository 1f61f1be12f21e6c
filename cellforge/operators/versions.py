"""Versions of a cell: the latest value per coordinate, and upserts.

A table is the set of its cells; a read returns, for each (row, family, qualifier),
the version with the greatest ``ts``, and on equal ``ts`` the greatest value (the
engine's fixed tie rule, so results do not depend on arrival order).

``latest_cells`` is one aggregation on the coordinate: Spark computes a partial
maximum in every map task before the exchange, so a hot coordinate or a hot row is
reduced to one record per task before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellforge.schema import CELL_COLUMNS

COORD = ["row", "family", "qualifier"]


def latest_cells(cells: DataFrame, method: str = "aggregate") -> DataFrame:
    """One cell per (row, family, qualifier): greatest (ts, value).

    ``method="aggregate"`` groups with ``max(struct(ts, value))`` (partial + final);
    ``method="window"`` ranks with ``row_number`` (Spark adds a partial window-group
    limit before the exchange).  Both give the same rows.
    """
    if method == "aggregate":
        return (
            cells.groupBy(*COORD)
            .agg(F.max(F.struct("ts", "value")).alias("v"))
            .select(*COORD, F.col("v.ts").alias("ts"), F.col("v.value").alias("value"))
        )
    if method == "window":
        w = Window.partitionBy(*COORD).orderBy(F.desc("ts"), F.desc("value"))
        return cells.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(*CELL_COLUMNS)
    raise ValueError(f"unknown method {method!r}")


def latest_versions(cells: DataFrame, versions: int) -> DataFrame:
    """Up to ``versions`` newest versions per coordinate (newest first by ts, value)."""
    w = Window.partitionBy(*COORD).orderBy(F.desc("ts"), F.desc("value"))
    return cells.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= versions).select(*CELL_COLUMNS)


def collapse_cells(cells: DataFrame) -> DataFrame:
    """Cells with equal (row, family, qualifier, ts) kept once (the greatest value);
    different timestamps stay as versions."""
    return cells.groupBy(*COORD, "ts").agg(F.max("value").alias("value")).select(*CELL_COLUMNS)


def upsert_cells(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Table state after writing ``incoming`` over ``existing``: latest of both.

    Each side is reduced to its latest cells first and the union is taken of those.
    The result is the same (latest is associative), and the union never has only
    columnar table scans below it: in Spark 4.1 such a union of two tables bucketed
    alike reports the bucket partitioning but concatenates the partitions, so an
    aggregate directly above it would merge the wrong partitions."""
    mine = latest_cells(existing.select(*CELL_COLUMNS))
    theirs = latest_cells(incoming.select(*CELL_COLUMNS))
    return latest_cells(mine.unionByName(theirs))


def table_rows(cells: DataFrame) -> DataFrame:
    """Distinct row keys present in a table (``row``)."""
    return cells.select("row").distinct()
