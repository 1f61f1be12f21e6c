"""A cell table as regions of key-sorted files under a manifest.

The key space is cut into regions by start keys.  A version of the table is a manifest: one
row for each file, with its region, first and last row key and number of cells.  Files are
never changed.  An upsert reads and rewrites only the regions that the batch touches; the next
manifest lists the new files of these and the old files of all others, and becomes the
table by one rename, which fails if another writer came first.  Readers of an older version
are not disturbed until ``vacuum``.

Each file has a blocked bloom filter of its row keys (``KEY_BITS`` bits a key, all bits of
a key in one block of 32768), built by aggregates over the written rows.  ``multi_get``
joins a key list with the manifest by region and then with the filters, and opens only files that
may hold a listed key.  ``first_rows`` reads regions from their front, to fence keys that the
manifest holds, and goes on only where rows are still missing.

On disk: ``data/<version>-<id>/region=<n>/*.parquet``, ``files/<id>`` (manifest rows),
``blooms/<id>`` (filters of one version's new files), ``versions/<number>.json``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellforge.operators.files import write_region_cells
from cellforge.operators.scan import region_of, regions_in_range, row_range
from cellforge.operators.versions import latest_cells
from cellforge.schema import CELL_COLUMNS
from cellforge.session import ensure_checkpoint_dir

KEY_BITS, BITS_SET, BLOCK_BITS = 10, 7, 32768
FENCES = [2**i for i in range(4, 31)]  # cells into a file at which its row key is kept


@dataclass(frozen=True)
class Store:
    """One version of a table; ``starts``: the start keys of regions 1 and up."""

    spark: SparkSession
    path: str
    version: int
    starts: tuple
    manifest: str

    @property
    def files(self) -> DataFrame:
        """The manifest: a row for each file of this version."""
        return self.spark.read.parquet(self.manifest)


# --- versions ---------------------------------------------------------------------


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _version_path(path: str, version: int) -> str:
    return f"{path}/versions/{version:010d}.json"


def _commit(spark: SparkSession, path: str, version: int, starts: Sequence, manifest: str) -> Store:
    """Makes ``manifest`` the table's version by one rename that never replaces a file."""
    told = {"version": version, "manifest": manifest, "starts": [s.hex() if isinstance(s, bytes) else s for s in starts]}
    told["binary"] = any(isinstance(s, bytes) for s in starts)
    jvm = spark._jvm
    draft, fs = _hadoop(spark, f"{path}/versions/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(told).encode()))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(draft, jvm.org.apache.hadoop.fs.Path(_version_path(path, version)), options)
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(e):
            raise RuntimeError(f"version {version} of {path} is there already: another writer came first") from None
        raise
    return Store(spark, path, version, tuple(starts), manifest)


def open_store(spark: SparkSession, path: str, version: int | None = None) -> Store:
    """The newest version of the table, or the one asked for."""
    if version is None:
        folder, fs = _hadoop(spark, f"{path}/versions")
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        version = max(int(n[:10]) for n in names if n.endswith(".json") and not n.startswith("."))
    told = json.loads("".join(r[0] for r in spark.read.text(_version_path(path, version), wholetext=True).collect()))
    starts = [bytes.fromhex(s) if told["binary"] else s for s in told["starts"]]
    return Store(spark, path, version, tuple(starts), told["manifest"])


# --- writing ----------------------------------------------------------------------


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("row"), blocks).cast("int")


def _bits() -> Column:
    """Places of a key's bits in its block: two hashes, stepped."""
    one, two = (F.pmod(F.xxhash64("row", F.lit(i)), F.lit(BLOCK_BITS)) for i in (1, 2))
    return F.array(*[((one + two.bitwiseOR(F.lit(1)) * i) % BLOCK_BITS).cast("int") for i in range(BITS_SET)])


def _bitmaps(sized: DataFrame) -> DataFrame:
    """``file, block, bits`` of (file, row, blocks): the bit of place p is bit p % 8 of byte p div 8.

    Bits are first combined to words of eight bytes, as numbers, whose aggregate keeps a value for
    each word and sorts nothing; a task thus holds the words of its filters, not the bits of its cells."""
    bit = sized.select("file", _block(F.col("blocks")).alias("block"), F.explode(_bits()).alias("bit"))
    mask = F.expr("shiftleft(1L, cast(56 - 8 * (bit div 8 % 8) + bit % 8 as int))")  # the word's first byte is its highest
    words = bit.groupBy("file", "block", F.expr("cast(bit div 64 as int)").alias("word")).agg(F.bit_or(mask).alias("set"))
    held = words.groupBy("file", "block").agg(F.map_from_entries(F.collect_list(F.struct("word", "set"))).alias("held"))
    places = F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1))
    texts = F.transform(places, lambda w: F.lpad(F.hex(F.coalesce(F.try_element_at("held", w), F.lit(0).cast("long"))), 16, "0"))
    return held.select("file", "block", F.unhex(F.array_join(texts, "")).alias("bits"))


def _describe(store_path: str, spark: SparkSession, data: str, version: int) -> DataFrame:
    """Manifest rows of the files in ``data``, whose bloom filters it writes."""
    stored = spark.read.parquet(data).select(
        F.col("_metadata.file_path").alias("file"), "region", "row", (F.col("_metadata.row_index") + 1).alias("at")
    )
    fence = F.when(F.col("at").isin(*FENCES), F.struct("at", "row"))
    each = stored.groupBy("file", "region").agg(
        F.min("row").alias("first_row"), F.max("row").alias("last_row"), F.count(F.lit(1)).alias("cells"),
        F.approx_count_distinct("row").alias("rows"), F.sort_array(F.collect_list(fence)).alias("fences"),  # a few keys of each file
    )
    blooms = f"{store_path}/blooms/{uuid.uuid4().hex}"
    blocks = F.greatest(F.ceil(F.col("rows") * KEY_BITS / F.lit(float(BLOCK_BITS))), F.lit(1)).cast("int")
    described = each.withColumn("blocks", blocks).withColumn("version", F.lit(version)).withColumn("blooms", F.lit(blooms))
    folder = f"{store_path}/described/{uuid.uuid4().hex}"
    described.write.parquet(folder)
    described = spark.read.schema(described.schema).parquet(folder)
    sized = stored.select("file", "row").join(F.broadcast(described.select("file", "blocks")), "file")  # a row for each file
    _bitmaps(sized).write.parquet(blooms)
    return described


def _write(store_path: str, cells: DataFrame, starts: Sequence, num_files: int, version: int) -> DataFrame:
    """Sorted files of ``cells`` by region -> their manifest rows."""
    spark = cells.sparkSession
    data = f"{store_path}/data/{version:010d}-{uuid.uuid4().hex}"
    # Materialised: the range partitioner samples its input, which here is a merge.
    write_region_cells(cells, data, list(starts), num_files, materialize=True)
    if not _there(spark, data):
        return None
    return _describe(store_path, spark, data, version)


def _there(spark: SparkSession, data: str) -> bool:
    folder, fs = _hadoop(spark, data)
    return any(s.isDirectory() for s in fs.listStatus(folder))


def create_store(cells: DataFrame, path: str, starts: Sequence, num_files: int) -> Store:
    """Version 0: the latest version of every coordinate of ``cells``, in regions."""
    ensure_checkpoint_dir(cells.sparkSession)
    return _publish(cells.sparkSession, path, 0, sorted(starts), _write(path, latest_cells(cells), sorted(starts), num_files, 0), None)


def _publish(spark: SparkSession, path: str, version: int, starts: Sequence, new: DataFrame | None, kept: DataFrame | None) -> Store:
    manifest = f"{path}/files/{uuid.uuid4().hex}"
    parts = [p for p in (kept, new) if p is not None]
    if not parts:
        raise ValueError("a store needs a cell")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rows.write.parquet(manifest)
    return _commit(spark, path, version, starts, manifest)


def upsert_store(store: Store, incoming: DataFrame, num_files: int) -> Store:
    """The next version after ``incoming``.  Only files of regions that it touches are read
    and rewritten (``num_files`` of them); the others are listed again as they are."""
    spark = store.spark
    ensure_checkpoint_dir(spark)
    batch = latest_cells(incoming.select(*CELL_COLUMNS)).checkpoint(eager=True)
    touched = [r[0] for r in batch.select(region_of("row", store.starts).alias("region")).distinct().collect()]  # regions at most
    if not touched:
        return store
    files = store.files
    old = read_files(store, files.where(F.col("region").isin(*touched)))
    merged = batch if old is None else latest_cells(old.unionByName(batch))
    new = _write(store.path, merged, store.starts, num_files, store.version + 1)
    return _publish(spark, store.path, store.version + 1, store.starts, new, files.where(~F.col("region").isin(*touched)))


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Drops all but the ``keep`` newest versions and the files that only they list; returns
    the files deleted.  Not to be run while older versions are read."""
    folder, fs = _hadoop(spark, f"{path}/versions")
    versions = sorted(int(s.getPath().getName()[:10]) for s in fs.listStatus(folder) if s.getPath().getName()[0] != ".")
    kept, gone = versions[-keep:], versions[:-keep]
    if not gone:
        return []
    listed = [open_store(spark, path, v).files.select("file") for v in gone]
    held = [open_store(spark, path, v).files.select("file") for v in kept]
    drop = listed[0]
    for more in listed[1:]:
        drop = drop.unionByName(more)
    drop = drop.distinct()
    for more in held:
        drop = drop.join(more, "file", "left_anti")
    names = sorted(r[0] for r in drop.collect())  # a name for each file of the table
    for v in gone:
        fs.delete(_hadoop(spark, _version_path(path, v))[0], False)
    for name in names:
        fs.delete(_hadoop(spark, name)[0], False)
    return names


# --- reading ----------------------------------------------------------------------


def read_files(store: Store, files: DataFrame, with_file: bool = False) -> DataFrame | None:
    """Cells of the listed files; None if there are none.  ``with_file``: also ``file``,
    ``region`` and the ``version`` that wrote it."""
    names = sorted(r[0] for r in files.select("file").collect())  # a name for each file
    if not names:
        return None
    read = store.spark.read.parquet(*names)
    if not with_file:
        return read.select(*CELL_COLUMNS)
    told = store.files.select("file", "region", "version").withColumnRenamed("file", "_file")
    named = read.select(*CELL_COLUMNS, F.col("_metadata.file_path").alias("file"))
    return named.join(told, F.col("file") == F.col("_file")).drop("_file")


def read_store(store: Store, gt=None, gte=None, lt=None, lte=None, with_file: bool = False) -> DataFrame:
    """Cells with row keys within the bounds: the manifest leaves out files by region and
    key, the bounds are pushed down to the others.  A version holds a coordinate once."""
    regions = regions_in_range(store.starts, gt, gte, lt, lte)
    files = store.files.where(F.col("region").isin(*regions))
    files = row_range(row_range(files, gt=gt, gte=gte, key_col="last_row"), lt=lt, lte=lte, key_col="first_row")
    found = read_files(store, files, with_file)
    if found is None:
        found = read_files(store, store.files, with_file).where(F.lit(False))
    return row_range(found, gt, gte, lt, lte)


def files_of_keys(store: Store, keys: DataFrame, key_col: str = "key") -> DataFrame:
    """``key, file``: the files that may hold each key, by region, key range and filter."""
    wanted = keys.select(F.col(key_col).alias("row")).where("row is not null").distinct()
    wanted = wanted.withColumn("region", region_of("row", store.starts)).withColumn("bits_of", _bits())
    files = store.files.select("file", "region", "first_row", "last_row", "blocks", "blooms")
    near = wanted.join(files, "region").where("row >= first_row and row <= last_row").withColumn("block", _block(F.col("blocks")))
    folders = [r[0] for r in files.select("blooms").distinct().collect()]  # one for each version that wrote files
    filters = store.spark.read.parquet(*folders).withColumnRenamed("file", "_file").withColumnRenamed("block", "_block")
    met = near.join(filters, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    # The bit of place p is bit p % 8 of byte p / 8.
    set_ = "forall(bits_of, p -> shiftright(cast(conv(hex(substring(bits, cast(p div 8 as int) + 1, 1)), 16, 10) as int), p % 8) % 2 = 1)"
    return met.where(set_).select(F.col("row").alias(key_col), "file")


def multi_get(store: Store, keys: DataFrame, key_col: str = "key") -> tuple[DataFrame, int]:
    """(cells of the listed keys, number of files opened for them)."""
    files = files_of_keys(store, keys, key_col).select("file").distinct().checkpoint(eager=True)
    opened = files.count()
    cells = read_files(store, files)
    if cells is None:
        return read_files(store, store.files.limit(1)).where(F.lit(False)), 0
    wanted = keys.select(F.col(key_col).alias("row")).distinct()
    return cells.join(wanted, "row", "left_semi"), opened


def _literal(key):
    return bytearray(key) if isinstance(key, (bytes, bytearray)) else key


def _bounds(store: Store, region: int) -> tuple[Column | None, Column | None]:
    """Start of a region and of the next one."""
    starts = [None, *store.starts, None]
    return tuple(None if k is None else F.lit(_literal(k)) for k in starts[region : region + 2])


def first_rows(store: Store, scan, limit: int) -> tuple[DataFrame, int]:
    """(the first ``limit`` rows of every region in key order, cells read for them).

    ``scan``: cells -> rows with a column ``row`` (say, ``scan_columns``).  A region is read up
    to a fence key; where that gave fewer rows, up to a fence further on, and at last
    whole.  Fences are pushed down, so the files' later row groups and pages are skipped."""
    files = store.files.select("file", "region", "cells", "last_row", "fences").checkpoint(eager=True)
    regions = [r[0] for r in files.select("region").distinct().collect()]
    done: DataFrame | None = None
    read, reach = 0, limit
    while regions:
        mine = files.where(F.col("region").isin(*regions))
        # Of a region's files the least fence has at least ``reach`` cells up to it.
        fence = F.try_element_at(F.filter("fences", lambda f: f["at"] >= reach), F.lit(1))["row"]
        upto = {r["region"]: r["upto"] for r in mine.groupBy("region").agg(F.min(fence).alias("upto")).collect()}
        inside = F.lit(False)
        for region in regions:  # a range of keys for each region still short
            low, high = _bounds(store, region)
            keys = [F.col("row") >= low] * (low is not None) + [F.col("row") < high] * (high is not None)
            keys += [F.col("row") <= F.lit(_literal(upto[region]))] if upto[region] is not None else []
            inside = inside | reduce(Column.__and__, keys, F.lit(True))
        cells = read_files(store, mine).where(inside).checkpoint(eager=True)
        read += cells.count()
        rows = scan(cells).withColumn("region", region_of("row", store.starts))
        ranked = rows.withColumn("_rn", F.row_number().over(Window.partitionBy("region").orderBy("row"))).where(F.col("_rn") <= limit)
        ranked = ranked.checkpoint(eager=True)
        have = {r["region"]: r["n"] for r in ranked.groupBy("region").agg(F.count(F.lit(1)).alias("n")).collect()}
        short = [r for r in regions if upto.get(r) is not None and have.get(r, 0) < limit]
        kept = ranked.where(~F.col("region").isin(*short)) if short else ranked
        done = kept if done is None else done.unionByName(kept)
        regions, reach = short, reach * 4
    return done.drop("_rn"), read
