"""Key-list audit: which listed keys are rows of a table.

For every listed key: ``n`` (its 1-based place in key order), ``key``, ``missed``
(1 when the table has no such row).  The check is a set operation -- the key list
joined with the table's distinct row keys -- not one lookup per key.  ``n`` is a
consecutive number computed without a single-partition window: keys are
range-partitioned and sorted, each task numbers its own rows, and a per-partition
count table (one row per partition) gives the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellforge.session import ensure_checkpoint_dir


def with_row_number(df: DataFrame, order_cols: Sequence[str], name: str = "n", partitions: int | None = None) -> DataFrame:
    """Adds a consecutive 1-based number in ``order_cols`` order.

    Range-partition + sort (with a per-row tiebreaker, so equal keys can span tasks),
    number within each task, then add the count of all earlier partitions.  The ranged
    data is checkpointed to the shared folder so the numbering pass and the counting
    pass see the same partitions, and a lost executor recomputes from the checkpoint.
    The offset table has one row per partition.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pid = F.spark_partition_id()
    # The tiebreaker lets the sampled range bounds fall inside a run of equal keys, so a
    # key that fills a third of the input is split over several tasks.
    keys = [*order_cols, "_tie"]
    # It is checkpointed first: over shuffled input a rerun task could number rows anew.
    tied = df.withColumn("_tie", F.monotonically_increasing_id()).checkpoint(eager=True)
    ranged = (
        tied.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", pid)
        .withColumn("_local", F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33))
        .checkpoint(eager=True)
    )
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_pid")
        .agg(F.count(F.lit(1)).alias("_cnt"))
        .select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    )
    return (
        ranged.join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.col("_off") + F.col("_local") + 1)
        .drop("_pid", "_local", "_off", "_tie")
    )


def lookup_audit(
    keys: DataFrame, rows: DataFrame, key_col: str = "key", row_col: str = "row", numbered: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """``(n, key, missed)`` for every listed key against the table's row keys.  Columns of
    ``keys`` to ``keep`` follow ``key``; equal keys are numbered in their order."""
    listed = keys.select(F.col(key_col).cast("string").alias("key"), *keep)
    # Only table rows that are listed matter: a semi join with the distinct keys first
    # lets Spark (or AQE at run time, by measured size) broadcast a short key list and
    # filter the table in its map tasks, so only matching rows reach the shuffle.
    wanted = listed.select(F.col("key").alias("_row")).distinct()
    # The row keys are deduplicated in the map tasks, so a long list costs a shuffle of keys.
    present = rows.select(F.col(row_col).alias("_row")).distinct().join(wanted, "_row", "left_semi")
    checked = listed.join(present, listed["key"] == present["_row"], "left").select(
        "key", *keep, F.when(F.col("_row").isNull(), 1).otherwise(0).alias("missed")
    )
    if not numbered:
        return checked
    return with_row_number(checked, ["key", *keep]).select("n", "key", *keep, "missed")


def missed_keys(keys: DataFrame, rows: DataFrame, key_col: str = "key", row_col: str = "row") -> DataFrame:
    """Listed keys that are not rows of the table."""
    return keys.join(rows.select(F.col(row_col).alias(key_col)), key_col, "left_anti")


def found_keys(keys: DataFrame, rows: DataFrame, key_col: str = "key", row_col: str = "row") -> DataFrame:
    """Listed keys that are rows of the table."""
    return keys.join(rows.select(F.col(row_col).alias(key_col)), key_col, "left_semi")


def miss_rate(audit: DataFrame) -> DataFrame:
    """``(keys, misses, miss_rate)`` of an audit."""
    return audit.agg(
        F.count(F.lit(1)).alias("keys"), F.sum("missed").alias("misses"), F.avg("missed").alias("miss_rate")
    )


def write_audit(audit: DataFrame, path: str, mode: str = "errorifexists", stamp: bool = False) -> str:
    """Tab-separated audit rows, no header.  With ``stamp`` each row also carries the
    audit time as 14-digit UTC flat text (one ``current_timestamp()`` per run), after ``n``."""
    if stamp:
        from cellforge.functions.scalars import flat_from_millis

        at = flat_from_millis(F.unix_millis(F.current_timestamp())).alias("audited_at")
        audit = audit.select("n", at, *[c for c in audit.columns if c != "n"])
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in audit.columns]
    audit.select(F.concat_ws("\t", *fields).alias("value")).write.mode(mode).text(path)
    return path
