"""Key-sorted, range-partitioned cell files (the bulk-load file output).

``write_sorted_cells`` does it in one exchange and one sort:

1. ``repartitionByRange`` on the cell order -- Spark samples the keys for the split
   points, so no hand-made CDF is needed and the files have ordered, non-overlapping
   key ranges;
2. cells with equal (row, family, qualifier, ts) are kept once; the range exchange
   already clusters equal coordinates, so this adds no shuffle, whatever the loader (the
   coordinate is one struct key);
3. ``sortWithinPartitions`` on the same key, which spills to disk;
4. Parquet write; one file per range.

By default the range key is the full cell order, so a very hot row is split over
several files (files still follow each other in order; a row may continue in the next
file).  ``whole_rows=True`` ranges on the row only, so each row lands in exactly one
file, as region-bound files require; a hot row then stays in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellforge.schema import CELL_COLUMNS
from cellforge.session import ensure_checkpoint_dir

COORD = ["row", "family", "qualifier"]


def cell_writer(df: DataFrame, bloom: bool = True):
    """``df.write`` for cell files.  With ``bloom`` every file carries a Parquet bloom
    filter on ``row`` (sized to the keys it holds), so a point lookup ``row = k`` skips
    row groups that cannot contain the key -- min/max statistics only help ranges."""
    writer = df.write
    if bloom:
        writer = writer.option("parquet.bloom.filter.enabled#row", "true").option(
            "parquet.bloom.filter.adaptive.enabled", "true"
        )
    return writer


def sort_cells(cells: DataFrame) -> DataFrame:
    """Cells sorted within each partition by row, family, qualifier, newest first."""
    return cells.sortWithinPartitions(*COORD, F.desc("ts"))


def sorted_cell_partitions(cells: DataFrame, num_files: int, whole_rows: bool = False) -> DataFrame:
    """Range-partitioned, collapsed and sorted cells, ready to write.

    The coordinate is one struct column, by which the cells are exchanged, grouped and
    sorted: a part of it may be a literal (a loader's family), which Spark would fold out
    of a list of grouping keys and then exchange once more."""
    rest = [F.col("family"), F.col("qualifier"), (-F.col("ts")).alias("nts")]
    keyed = cells.select("row", F.struct(*rest).alias("_rest"), "value")
    if whole_rows:
        ranged, keys = keyed.repartitionByRange(num_files, "row"), ["row", "_rest"]
    else:
        keyed = keyed.select(F.struct("row", "_rest").alias("_key"), "value")
        ranged, keys = keyed.repartitionByRange(num_files, "_key"), ["_key"]
    collapsed = ranged.groupBy(*keys).agg(F.max("value").alias("value")).sortWithinPartitions(*keys)
    row, rest = ("row", "_rest") if whole_rows else ("_key.row", "_key._rest")
    return collapsed.select(
        F.col(row).alias("row"), F.col(f"{rest}.family").alias("family"), F.col(f"{rest}.qualifier").alias("qualifier"),
        (-F.col(f"{rest}.nts")).alias("ts"), "value",
    )


def _materialized(cells: DataFrame, materialize: bool) -> DataFrame:
    """The range partitioner runs its input once more to sample split points; with
    ``materialize`` the cells are first checkpointed to the shared folder, so an
    expensive input (e.g. text parsed by a loader) is computed once."""
    if not materialize:
        return cells
    ensure_checkpoint_dir(cells.sparkSession)
    return cells.select(*CELL_COLUMNS).checkpoint(eager=True)


def write_sorted_cells(
    cells: DataFrame,
    path: str,
    num_files: int,
    whole_rows: bool = False,
    mode: str = "errorifexists",
    materialize: bool = False,
) -> str:
    """Writes range-partitioned, key-sorted cell files to ``path``; returns ``path``."""
    cells = _materialized(cells, materialize)
    cell_writer(sorted_cell_partitions(cells, num_files, whole_rows)).mode(mode).parquet(path)
    return path


def write_region_cells(
    cells: DataFrame,
    path: str,
    boundaries: list[str],
    num_files: int,
    whole_rows: bool = False,
    mode: str = "errorifexists",
    materialize: bool = False,
) -> str:
    """Sorted cell files in one directory per key region (``region=i``), regions given by
    their start keys (e.g. ``keyspace.region_starts`` of a sampled CDF).  A range scan
    then skips whole regions by partition pruning (``scan.scan_regions``).  The range
    exchange and the sort are those of ``write_sorted_cells``; the region is monotone in
    the row key, so sorting by region first keeps the cell order and the writer adds no
    sort of its own."""
    from cellforge.operators.scan import region_of

    cells = _materialized(cells, materialize)
    ordered = sorted_cell_partitions(cells, num_files, whole_rows).withColumn("region", region_of("row", boundaries))
    ordered = ordered.sortWithinPartitions("region", *COORD, F.desc("ts"))
    cell_writer(ordered).mode(mode).partitionBy("region").parquet(path)
    return path


def write_partitioned_cells(
    cells: DataFrame, path: str, n: int, cdf: DataFrame | None = None, chars: int = 3, mode: str = "errorifexists"
) -> str:
    """Cell files placed by the key-distribution partitioner instead of sampled ranges:
    each cell goes to the partition its row key's CDF gives (``keyspace.assign_partition``),
    moved there by ``repartitionById`` with no re-hashing, then sorted and collapsed
    within the partition.  Keys under 4 bytes or off the prefix grid all land in
    partition 0, so the files are not a total order; use ``write_sorted_cells`` for the
    physical layout and this to reproduce or study the distribution-aware placement."""
    from cellforge.operators.keyspace import assign_partition, place_by_partition

    placed = place_by_partition(assign_partition(cells.select(*CELL_COLUMNS), "row", n, cdf, chars, out="_part"), n, "_part")
    collapsed = placed.groupBy(*COORD, (-F.col("ts")).alias("_nts"), "_part").agg(F.max("value").alias("value"))
    out = collapsed.sortWithinPartitions(*COORD, "_nts").select(*COORD, (-F.col("_nts")).alias("ts"), "value")
    cell_writer(out).mode(mode).parquet(path)
    return path


def write_partition_runs(
    cells: DataFrame, path: str, n: int, cdf: DataFrame | None = None, chars: int = 3, mode: str = "errorifexists"
) -> list[str]:
    """``write_partitioned_cells`` in two levels: a partition above its share is cut into ordered
    runs (``keyspace.run_starts``), and each run is a file, so a hot prefix is no one task's.
    Returns the starts of the runs; the file of run i is ``part-<i>``."""
    from cellforge.operators.keyspace import assign_run, place_by_partition, run_starts

    starts = run_starts(cells, "row", n, cdf, chars)
    told = assign_run(cells.select(*CELL_COLUMNS), "row", n, starts, cdf, chars, out="_run").drop("partition")
    placed = place_by_partition(told, len(starts), "_run")
    collapsed = placed.groupBy(*COORD, (-F.col("ts")).alias("_nts"), "_run").agg(F.max("value").alias("value"))
    out = collapsed.sortWithinPartitions(*COORD, "_nts").select(*COORD, (-F.col("_nts")).alias("ts"), "value")
    cell_writer(out).mode(mode).parquet(path)
    return starts


def file_ranges(spark: SparkSession, path: str) -> DataFrame:
    """``(file, first_row, last_row, cells)`` of every written file."""
    return (
        spark.read.parquet(path)
        .withColumn("file", F.input_file_name())
        .groupBy("file")
        .agg(F.min("row").alias("first_row"), F.max("row").alias("last_row"), F.count(F.lit(1)).alias("cells"))
    )
