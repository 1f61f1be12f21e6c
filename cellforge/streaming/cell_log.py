"""Streaming loads into an append-only cell log.

The loaders are stateless projections, so they run unchanged on a streaming
DataFrame of text lines.  Their cells are appended to a Parquet log with Spark's file
sink, which commits every micro-batch exactly once through its own metadata log and
the query checkpoint (kept in the shared folder, so a restarted driver or a lost
executor resumes where it stopped).  Readers merge versions on read (latest per
coordinate); ``compact_cell_log`` writes the merged state as a bucketed snapshot.  A
log is also a set of deltas: ``tables.read_merged(spark, snapshot, [log_path], buckets)``
serves the live table with the snapshot read unshuffled and only the streamed cells
merged in.

Reject counters on a stream are a running global aggregate (complete mode), or the
``observe_rejects`` metrics of each micro-batch (``query.lastProgress``).
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cellforge.operators.rejects import count_rejects
from cellforge.operators.tables import new_table_name, load_cell_table
from cellforge.operators.versions import latest_cells
from cellforge.schema import CELL_COLUMNS
from cellforge.session import ensure_checkpoint_dir


def read_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``line string`` from the text files arriving in ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).withColumnRenamed("value", "line")


def _checkpoint(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return checkpoint or os.path.join(ensure_checkpoint_dir(spark), "streams", name)


def start_cell_log(
    cells: DataFrame,
    log_path: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Appends a streaming cell frame to the Parquet log at ``log_path``."""
    spark = cells.sparkSession
    name = query_name or os.path.basename(log_path.rstrip("/"))
    writer = (
        cells.select(*CELL_COLUMNS)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", log_path)
        .option("checkpointLocation", _checkpoint(spark, name, checkpoint))
    )
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=available_now)
    return writer.start()


def start_reject_counts(
    parsed: DataFrame,
    reasons: Sequence[str],
    query_name: str,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Running ``(reason, n)`` counts of a parsed line stream, in an in-memory table
    named ``query_name`` (complete mode: the table always holds the totals)."""
    spark = parsed.sparkSession
    return (
        count_rejects(parsed, reasons)
        .writeStream.format("memory")
        .queryName(query_name)
        .outputMode("complete")
        .option("checkpointLocation", _checkpoint(spark, query_name, checkpoint))
        .trigger(availableNow=available_now)
        .start()
    )


def read_cell_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The table state of a cell log: latest version per coordinate."""
    return latest_cells(spark.read.parquet(log_path))


def compact_cell_log(spark: SparkSession, log_path: str, buckets: int, name: str | None = None) -> str:
    """Writes the merged state of the log as a bucketed snapshot table; returns its name."""
    return load_cell_table(spark.read.parquet(log_path), buckets, name or new_table_name("compacted"))
