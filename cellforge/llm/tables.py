"""Written tables in the shared folder, a global rank without one big task, and words."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of characters other than these (space, \t \n \v \f \r).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
GAP_PATTERN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ROW_BITS = 33  # monotonically_increasing_id: partition above, row within it below


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, a new one in a local session."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile

    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
    return sc.getCheckpointDir()


def stash(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to a new table in the shared folder and reads it back: the lineage is
    cut, and a lost executor costs no recomputation of what is above it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stash_path = path
    return out


def unstash(df: DataFrame) -> None:
    """Deletes a table of ``stash`` that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.stash_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ranked(df: DataFrame, keys: list, name: str) -> tuple[DataFrame, int]:
    """``df`` with ``_rank`` (0 to n-1 in the order of ``keys``), and n.

    Rows are range-partitioned on ``keys``; no task gets more than its range.  ``keys`` must
    order all but identical rows.
    """
    return numbered(df.repartitionByRange(*keys).sortWithinPartitions(*keys), name)


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` with ``_rank`` (0 to n-1 in the order of its partitions and their rows), and n.

    Rows are written with their place in their partition; only the row count of each
    partition is summed up.
    """
    placed = stash(df.withColumn("_place", F.monotonically_increasing_id()), name)
    part = F.shiftright("_place", ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # a row for each partition
    offsets = stash(counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))), f"{name}-offsets")
    total = offsets.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    rank = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # Broadcast bound: one row for each partition of the exchange above.
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets.drop("_n")), "_part")
    out = joined.withColumn("_rank", rank).drop("_part", "_place", "_before")
    out.stash_path = placed.stash_path
    return out, int(total)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def packed(df: DataFrame, name: str = "row") -> Column:
    """The whole row as one struct, to be unpacked by ``name.*``: whatever its columns are
    named, they don't meet an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words as a long; null text: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
