"""Cell tables as sources: by catalog name (a bucketed snapshot) or by path (cell files)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellforge.schema import CELL_COLUMNS


def read_cells(spark: SparkSession, location: str) -> DataFrame:
    """Cells of a table: a catalog table name, or a path of cell Parquet files."""
    if "/" not in location and spark.catalog.tableExists(location):
        return spark.table(location).select(*CELL_COLUMNS)
    return spark.read.parquet(location).select(*CELL_COLUMNS)
