"""Cell tables: bucketed snapshots and upserts that never shuffle the existing table.

A snapshot holds one version per (row, family, qualifier), stored as a catalog table
bucketed and sorted on that coordinate.  An upsert

1. reduces the incoming cells to their latest: the partial aggregate in every map task
   has collapsed a hot coordinate before the exchange;
2. hash-partitions the (now small) incoming side to the snapshot's bucket layout;
3. takes the latest of the union -- both children have the same hash partitioning, so
   Spark needs no exchange for the existing table: each bucket file is merged with
   the incoming cells of the same bucket in its own task;
4. writes the result as the next bucketed snapshot (no shuffle: every task holds
   exactly one bucket).

A snapshot cannot be overwritten while it is read, so every upsert writes a new table
and returns its name.  Unbucketed inputs still work through ``versions.upsert_cells``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellforge.operators.files import cell_writer
from cellforge.operators.versions import COORD, latest_cells
from cellforge.schema import CELL_COLUMNS
from cellforge.session import remove_path, shared_path


def new_table_name(prefix: str = "cells") -> str:
    return f"{prefix}_{uuid.uuid4().hex[:16]}"


def save_cell_table(cells: DataFrame, name: str, buckets: int, path: str | None = None) -> str:
    """Writes ``cells`` (one version per coordinate) as a bucketed, sorted table."""
    spark = cells.sparkSession
    (
        cell_writer(cells.select(*CELL_COLUMNS))
        .format("parquet")
        .bucketBy(buckets, *COORD)
        .sortBy(*COORD)
        .option("path", path or shared_path(spark, name))
        .saveAsTable(name)
    )
    return name


def aligned_latest(cells: DataFrame, buckets: int) -> DataFrame:
    """The latest version of each coordinate, in the bucket layout.

    Every map task first reduces its own cells, so a hot coordinate sends one row a task.
    The coordinate is grouped as one struct: a part of it that is a literal (a loader's
    family) then stays a column of the bucket partitioning instead of being folded out."""
    coordinate = F.struct(*COORD).alias("_at")
    latest = cells.select(coordinate, "ts", "value").groupBy("_at").agg(F.max(F.struct("ts", "value")).alias("_v"))
    flat = latest.select(*[F.col(f"_at.{c}").alias(c) for c in COORD], F.col("_v.ts").alias("ts"), F.col("_v.value").alias("value"))
    return flat.repartition(buckets, *COORD)


def upsert_plan(existing: DataFrame, incoming: DataFrame, buckets: int) -> DataFrame:
    """Latest cells of a bucketed snapshot plus incoming cells (see module notes).

    The incoming side always reaches the union through an exchange, so the union runs
    row by row and keeps bucket i with bucket i.  A union of columnar bucketed scans
    alone would not (see ``versions.upsert_cells``)."""
    return latest_cells(existing.select(*CELL_COLUMNS).unionByName(aligned_latest(incoming, buckets)))


def load_cell_table(cells: DataFrame, buckets: int, name: str | None = None) -> str:
    """First load: latest version per coordinate of ``cells`` written as a bucketed
    snapshot, each task exactly one bucket."""
    return save_cell_table(aligned_latest(cells, buckets), name or new_table_name(), buckets)


def upsert_table(
    spark: SparkSession, table: str, incoming: DataFrame, buckets: int, new_name: str | None = None
) -> str:
    """Writes the snapshot after ``incoming`` as a new bucketed table; returns its name."""
    new_name = new_name or new_table_name()
    return save_cell_table(upsert_plan(spark.table(table), incoming, buckets), new_name, buckets)


def table_path(spark: SparkSession, table: str) -> str:
    """Where a snapshot's files lie, to register it again in another session."""
    found = spark.sql(f"DESCRIBE EXTENDED `{table}`").where("col_name = 'Location'").first()
    return found["data_type"]


def register_cell_table(spark: SparkSession, name: str, path: str, buckets: int) -> str:
    """Makes the files of a snapshot a table of this session's catalog again."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    by = ", ".join(COORD)
    spark.sql(
        f"CREATE TABLE `{name}` ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return name


def drop_cell_table(spark: SparkSession, table: str) -> None:
    """Drops a snapshot that an upsert has replaced, with its files."""
    remove_path(spark, table_path(spark, table))
    spark.sql(f"DROP TABLE `{table}`")


# --- deltas: upserts that write only the batch ----------------------------------------


def append_delta(cells: DataFrame, path: str | None = None, buckets: int | None = None) -> str:
    """Writes a batch of incoming cells as a delta; the cost is that of the batch, not of
    the table.  Without ``buckets`` it is plain cell files, and the path is returned; with
    them it is a run: a table in the snapshot's bucket and sort layout, one version per
    coordinate, whose name is returned."""
    spark = cells.sparkSession
    if buckets is not None:
        name = new_table_name("run")
        return save_cell_table(aligned_latest(cells, buckets), name, buckets, path)
    path = path or shared_path(spark, "delta")
    cell_writer(cells.select(*CELL_COLUMNS)).parquet(path)
    return path


def _is_table(spark: SparkSession, delta: str) -> bool:
    return "/" not in delta and spark.catalog.tableExists(delta)


def read_merged(spark: SparkSession, snapshot: str, deltas: list[str], buckets: int) -> DataFrame:
    """Table state = latest of a bucketed snapshot and its deltas.

    A merge join of sorted runs: the snapshot's buckets are one sorted file each, so it is
    neither shuffled nor sorted.  A single run of ``append_delta(buckets=)`` is not either;
    several deltas, or plain ones, are merged and aligned to the buckets first (a shuffle
    and a sort of the deltas only).  Both sides stream, so a bucket's deltas may be larger
    than a task's memory.  The session is told to trust the order of bucket files, which
    Spark does only where a bucket is one file."""
    mine = spark.table(snapshot).select(*CELL_COLUMNS)
    if not deltas:
        return mine
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    if len(deltas) == 1 and _is_table(spark, deltas[0]):
        new = spark.table(deltas[0]).select(*CELL_COLUMNS)
    else:
        new = aligned_latest(_union_of(spark, deltas), buckets)
    new = new.select(*[F.col(c).alias(f"_{c}") for c in COORD], F.struct("ts", "value").alias("_new"))
    same = [mine[c] == new[f"_{c}"] for c in COORD]
    joined = mine.join(new.hint("merge"), same, "full_outer")
    old = F.when(F.col("row").isNotNull(), F.struct("ts", "value"))
    latest = F.greatest(old, F.col("_new")).alias("_v")
    return joined.select(*[F.coalesce(c, f"_{c}").alias(c) for c in COORD], latest).select(*COORD, "_v.ts", "_v.value")


def _union_of(spark: SparkSession, deltas: list[str]) -> DataFrame:
    """All cells of the deltas; tables by their files, so that no bucketed scan is below the
    union (see ``versions.upsert_cells``)."""
    return spark.read.parquet(*[table_path(spark, d) if _is_table(spark, d) else d for d in deltas]).select(*CELL_COLUMNS)


def compact(spark: SparkSession, snapshot: str, deltas: list[str], buckets: int, new_name: str | None = None) -> str:
    """Folds the deltas into a new bucketed snapshot; returns its name."""
    return save_cell_table(read_merged(spark, snapshot, deltas, buckets), new_name or new_table_name(), buckets)


RUN_FANOUT = 4


def run_bytes(spark: SparkSession, run: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path(spark, run))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def tier_of(size: int, fanout: int = RUN_FANOUT) -> int:
    """Runs of one tier differ in size by less than ``fanout``."""
    tier = 0
    while size >= fanout:
        size, tier = size // fanout, tier + 1
    return tier


def compact_runs(spark: SparkSession, runs: list[str], buckets: int, fanout: int = RUN_FANOUT, drop: bool = True) -> list[str]:
    """Size-tiered compaction: while a tier holds ``fanout`` runs, these become one run.  So
    at most ``fanout - 1`` runs of each size are left, and a cell is rewritten once for each
    tier, whatever the size of the snapshot.  ``drop``: merged runs are deleted."""
    left = [(r, tier_of(run_bytes(spark, r), fanout)) for r in runs]
    while True:
        tiers: dict[int, list[str]] = {}
        for run, tier in left:
            tiers.setdefault(tier, []).append(run)
        full = next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= fanout), None)
        if full is None:
            return [run for run, _ in left]
        merged = save_cell_table(aligned_latest(_union_of(spark, full), buckets), new_table_name("run"), buckets)
        left = [(r, t) for r, t in left if r not in full] + [(merged, tier_of(run_bytes(spark, merged), fanout))]
        if drop:
            for run in full:
                drop_cell_table(spark, run)
