"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) ->
DataFrame`` over the driver's whole tables (or inputs Spark derives from them)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellforge.functions.scalars import flat_to_millis, row_json
from cellforge.operators import audit, cells, files, keyspace, relations, scan, splits, store, tables, tuples, versions
from cellforge.schema import CDF_DIGITS
from cellforge.session import shared_path
from cellforge.sources import fixtures as fx
from cellforge.sources.text import key_window, mark_window, read_key_list, read_sample_counts, read_typed_tsv, write_lines

Query = Callable[[SparkSession, str], DataFrame]

SCAN_COLUMNS = "ev:click ev:view props:purchase"
REGION_STARTS = ["2", "5", "8"]
REGION_LIMIT = 5
UPSERT_CUTOFF_MS = 1705363200000  # 2024-01-16 00:00:00 UTC: earlier events are the existing table
PARTITIONS = 360
HISTOGRAM_BINS = 10
PREFIX_CHARS = 3


# --- sources ----------------------------------------------------------------------


def tsv_fields(spark, sf):
    """The follow lines split by the Java rule; field count and the first four fields."""
    split = cells.split_lines(fx.line_input(spark, sf, "follow_lines"))
    f = F.col("fields")
    return split.select("line", F.size(f).alias("n_fields"), *[F.get(f, i).alias(f"f{i}") for i in range(4)])


def typed_tsv_load(spark, sf):
    """name/number lines written as text, loaded back with a typed schema."""
    path = write_lines(fx.typed_tsv_lines(spark, sf), shared_path(spark, "typed_tsv"))
    return read_typed_tsv(spark, path, "field_1 string, field_2 int")


# --- records to cells -------------------------------------------------------------


def bulk_cells(spark, sf):
    """Generic four-field lines to cells."""
    return cells.bulk_cells(fx.line_input(spark, sf, "cell_lines"), ts=fx.LOAD_TS)


def _user_lines(spark, sf):
    return fx.line_input(spark, sf, "user_lines")


def table_cells(spark, sf):
    """User-table lines to cells (key position stored, ``-`` skipped)."""
    return cells.table_cells(
        _user_lines(spark, sf), fx.USER_NAMES, fx.USER_FAMILY, key_index=fx.USER_KEY_INDEX, ts=fx.LOAD_TS
    )


def composite_key_cells(spark, sf):
    """User-table lines with the row key custkey:nationkey."""
    return cells.composite_key_cells(
        _user_lines(spark, sf), fx.USER_NAMES, fx.USER_FAMILY, key_indexes=fx.USER_COMPOSITE_KEY, ts=fx.LOAD_TS
    )


def file_cells(spark, sf):
    """User-table lines to cells for file output (key position not stored)."""
    return cells.file_cells(
        _user_lines(spark, sf), fx.USER_NAMES, fx.USER_FAMILY, key_index=fx.USER_KEY_INDEX, ts=fx.LOAD_TS
    )


def edge_cells(spark, sf):
    """P5: follow lines as an edge list."""
    return cells.edge_cells(fx.line_input(spark, sf, "follow_lines"), family="edge", ts=fx.LOAD_TS)


def adjacency_cells(spark, sf):
    """Per order, the order key and its part keys as an adjacency line."""
    return cells.adjacency_cells(fx.adjacency_lines(spark, sf), family="adj", ts=fx.LOAD_TS)


def follow_cells(spark, sf):
    """Two cells per accepted follow line."""
    return relations.follow_cells(fx.line_input(spark, sf, "follow_lines"), ts=fx.LOAD_TS)


def follow_rejects(spark, sf):
    """A1: follow reject counters."""
    return relations.follow_rejects(fx.line_input(spark, sf, "follow_lines"))


def mention_cells(spark, sf):
    """Mention lines to reply/retweet/mention cells with JSON values."""
    return relations.mention_cells(fx.line_input(spark, sf, "atsign_lines"), ts=fx.LOAD_TS)


def mention_rejects(spark, sf):
    """A1: mention reject counters."""
    return relations.mention_rejects(fx.line_input(spark, sf, "atsign_lines"))


# --- typed rows to cells ----------------------------------------------------------


def store_row_cells(spark, sf):
    """Typed part rows to cells, ts from the stamp field (else now)."""
    rows = fx.part_rows(spark, sf)
    return tuples.store_rows(rows, "p:name p:brand p:size p:stamp", timestamp_field=4, now=fx.LOAD_TS)


def store_dynamic_cells(spark, sf):
    """P10: (row, family, qualifier, value, ts) records to cells."""
    rows = fx.part_rows(spark, sf).select(
        "key", F.lit("attr").alias("family"), F.lit("brand").alias("qualifier"), "brand",
        (F.coalesce(F.col("key"), F.lit(0)) * 1000).cast("string").alias("ts"),
    )
    return tuples.store_dynamic(rows, now=fx.LOAD_TS)


def store_bag_cells(spark, sf):
    """(key, bag) records to sorted cells; rows with a NULL are dropped."""
    rows = fx.part_rows(spark, sf).select(
        "key", F.array(F.col("key").cast("string"), "name", "brand").alias("bag")
    )
    return tuples.store_bag(rows, "key", "bag", "id,name,brand", family="bag", now=fx.LOAD_TS)


def _codec_rows(spark, sf):
    return fx.part_rows(spark, sf).select(
        "key", "name", "size", (F.col("size") - 25).alias("delta"),
        (F.col("key") * 1000003 - 5000000).alias("big"), "stamp",
    )


def encode_values(spark, sf):
    """Big-endian binary values, shown as hex."""
    rows = _codec_rows(spark, sf).drop("stamp")
    stored = tuples.store_rows(rows, "b:name b:size b:delta b:big", caster="binary", now=fx.LOAD_TS)
    return stored.select("row", "family", "qualifier", "ts", F.hex("value").alias("value_hex"))


def decode_values(spark, sf):
    """Store four columns big-endian and the stamp as text, then load them back typed:
    the stamp is read as a number, so the non-numeric ones become NULL."""
    casters = ["binary", "binary", "binary", "binary", "text"]
    stored = tuples.store_rows(
        _codec_rows(spark, sf), "b:name b:size b:delta b:big b:stamp", caster=casters, now=fx.LOAD_TS
    )
    loaded = scan.scan_typed(
        stored, "b:name b:size b:delta b:big b:stamp", ["string", "int", "int", "bigint", "bigint"], caster=casters
    )
    return loaded.withColumnRenamed("stamp", "stamp_num")


# --- versions, scans, upserts -----------------------------------------------------


def latest_cells(spark, sf):
    """A2: latest version per coordinate of the event cells."""
    return versions.latest_cells(fx.event_cells(spark, sf))


def _event_table(spark, sf):
    return fx.event_table(spark, sf)


def scan_columns(spark, sf):
    """Three named columns of the two-family event table."""
    return scan.scan_columns(_event_table(spark, sf), SCAN_COLUMNS)


def scan_family(spark, sf):
    """The whole ``ev`` family, long form."""
    return scan.scan_family(_event_table(spark, sf), "ev")


def scan_range(spark, sf):
    """The named-column scan limited to row keys in ['12', '5')."""
    return scan.scan_columns(_event_table(spark, sf), SCAN_COLUMNS, gte="12", lt="5")


def scan_bounds(spark, sf):
    """The scan limited by all four bounds at once."""
    return scan.scan_columns(_event_table(spark, sf), SCAN_COLUMNS, gt="11", gte="110", lt="7", lte="65")


def scan_empty_cells(spark, sf):
    """S3: empty cells read as "1", with a dotted qualifier, one named ``row`` and one asked
    for twice; cells of every part."""
    part = fx.table(spark, sf, "part")
    cells_ = None
    for qualifier, value in (
        ("a.b", F.when(F.col("p_partkey") % 3 == 0, F.lit("")).otherwise(F.col("p_brand"))),
        ("row", F.when(F.col("p_partkey") % 4 == 0, F.lit("")).otherwise(F.col("p_size").cast("string"))),
    ):
        cell = part.select(
            F.col("p_partkey").cast("string").alias("row"), F.lit("f").alias("family"), F.lit(qualifier).alias("qualifier"),
            F.lit(fx.LOAD_TS).cast("bigint").alias("ts"), value.alias("value"),
        )
        cells_ = cell if cells_ is None else cells_.unionByName(cell)
    found = scan.scan_columns(cells_, "f:a.b f:row f:row")
    return found.toDF("row", "dotted", "named_row", "again")


def scan_region_limit(spark, sf):
    """At most five rows per key region."""
    rows = scan.scan_columns(_event_table(spark, sf), SCAN_COLUMNS)
    rows = rows.withColumn("region", scan.region_of("row", REGION_STARTS))
    return scan.limit_per_region(rows, "region", REGION_LIMIT)


def _layout_parts(spark) -> int:
    """Files of a sorted write and buckets of a snapshot: the session's shuffle
    partition count, which a cluster sizes to its data (8 in the local tests)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def upsert_cells(spark, sf):
    """Earlier events form the base snapshot (a bucketed table); later events are
    upserted into it; the query reads the resulting snapshot."""
    ev = _event_table(spark, sf)
    buckets = _layout_parts(spark)
    base = tables.load_cell_table(ev.where(F.col("ts") < UPSERT_CUTOFF_MS), buckets)
    merged = tables.upsert_table(spark, base, ev.where(F.col("ts") >= UPSERT_CUTOFF_MS), buckets)
    return spark.table(merged)


DELTA_CUTS_MS = (1705000000000, 1706000000000)  # snapshot | delta 1 | delta 2 by event time


def merged_delta_cells(spark, sf):
    """K1 as deltas: the earliest events form a bucketed snapshot, two later slices are
    appended as deltas, and the table state is the merged read (snapshot not shuffled)."""
    ev = _event_table(spark, sf)
    lo, hi = DELTA_CUTS_MS
    buckets = _layout_parts(spark)
    base = tables.load_cell_table(ev.where(F.col("ts") < lo), buckets)
    deltas = [
        tables.append_delta(ev.where((F.col("ts") >= lo) & (F.col("ts") < hi))),
        tables.append_delta(ev.where(F.col("ts") >= hi)),
    ]
    return tables.read_merged(spark, base, deltas, buckets)


REGIONS = 8
REGION_SCAN = ("300", "700")


def scan_region_files(spark, sf):
    """Order-key cells written as region directories (region starts at the
    quantiles of the whole keys), then a key-range scan that prunes whole regions.  The counts
    are written once, for the sample and for the files."""
    counted = shared_path(spark, "key_counts")
    _key_counts(spark, sf).write.parquet(counted)
    kc = spark.read.parquet(counted)
    cells_ = kc.select(
        F.col("key").alias("row"), F.lit("k").alias("family"), F.lit("n").alias("qualifier"),
        F.lit(fx.LOAD_TS).cast("bigint").alias("ts"), F.col("cnt").cast("string").alias("value"),
    )
    starts = splits.key_starts(kc, "key", REGIONS, "cnt")
    path = files.write_region_cells(cells_, shared_path(spark, "region_cells"), starts, _layout_parts(spark))
    stored = spark.read.parquet(path)
    lo, hi = REGION_SCAN
    return scan.scan_regions(stored, starts, gte=lo, lt=hi).select("row", "family", "qualifier", "ts", "value")


def sorted_cells(spark, sf):
    path = files.write_sorted_cells(_event_table(spark, sf), shared_path(spark, "sorted_cells"), _layout_parts(spark))
    return spark.read.parquet(path)


def placed_partition_rows(spark, sf):
    """Order-key cells in files placed by the sampled CDF, read back: the rows of each
    partition's file, and those that the partitioner would have put elsewhere."""
    kc = _key_counts(spark, sf)
    cells_ = kc.select(
        F.col("key").alias("row"), F.lit("k").alias("family"), F.lit("n").alias("qualifier"),
        F.lit(fx.LOAD_TS).cast("bigint").alias("ts"), F.col("cnt").cast("string").alias("value"),
    )
    cdf = keyspace.sampled_cdf(kc, "key", "cnt", chars=PREFIX_CHARS)
    path = files.write_partitioned_cells(cells_, shared_path(spark, "placed"), PARTITIONS, cdf, PREFIX_CHARS)
    stored = spark.read.parquet(path).select("row", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int").alias("file"))
    told = keyspace.assign_partition(stored, "row", PARTITIONS, cdf=cdf, chars=PREFIX_CHARS)
    wrong = F.sum((F.col("file") != F.col("partition")).cast("long")).alias("misplaced")
    return told.groupBy(F.col("file").alias("partition")).agg(F.count(F.lit(1)).alias("n"), wrong)


def loaded_sorted_files(spark, sf):
    """K2/O4 for a loader: follow lines -> cells -> sorted files; the cells in all files,
    the neighbouring files that overlap and the rows out of order in their file."""
    path = files.write_sorted_cells(follow_cells(spark, sf), shared_path(spark, "loaded_files"), _layout_parts(spark))
    key = F.struct("row", "family", "qualifier", (-F.col("ts")).alias("nts"))
    stored = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), key.alias("key")
    )
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    per_file = stored.withColumn("breaks", (before >= F.col("key")).cast("long")).groupBy("file").agg(
        F.count(F.lit(1)).alias("cells"), F.sum("breaks").alias("breaks"), F.min("key").alias("first"), F.max("key").alias("last")
    )
    overlap = (F.lag("last").over(Window.orderBy("first")) >= F.col("first")).cast("long")  # one row for each file
    return per_file.withColumn("overlap", overlap).agg(
        F.sum("cells").alias("cells"), F.coalesce(F.sum("overlap"), F.lit(0)).alias("overlaps"),
        F.coalesce(F.sum("breaks"), F.lit(0)).alias("breaks"),
    )


def collapsed_cells(spark, sf):
    """A3: cells with true duplicates of a coordinate (row, family, qualifier, ts) in sorted
    files, kept once."""
    li = fx.table(spark, sf, "lineitem")
    dup = li.select(
        F.col("l_orderkey").cast("string").alias("row"), F.lit("l").alias("family"), F.col("l_returnflag").alias("qualifier"),
        F.lit(fx.LOAD_TS).cast("bigint").alias("ts"), F.col("l_linenumber").cast("string").alias("value"),
    )
    return spark.read.parquet(files.write_sorted_cells(dup, shared_path(spark, "collapsed"), _layout_parts(spark)))


def float_values(spark, sf):
    """Retail prices as doubles and floats, every 7th NaN, every 11th NULL, stored
    big-endian: the stored bytes, and whether they load back as the values they came from."""
    part = fx.table(spark, sf, "part")
    price = F.when(F.col("p_partkey") % 11 == 0, None).when(F.col("p_partkey") % 7 == 0, F.lit(float("nan"))).otherwise(-F.col("p_retailprice"))
    rows = part.select(F.col("p_partkey").alias("key"), price.cast("double").alias("d"), price.cast("float").alias("f"))
    stored = tuples.store_rows(rows, "v:d v:f", caster="binary", now=fx.LOAD_TS)
    back = scan.scan_typed(stored, "v:d v:f", ["double", "float"], caster="binary").toDF("row", "d_back", "f_back")
    raw = scan.scan_columns(stored, "v:d v:f").select("row", F.hex("d").alias("d_hex"), F.hex("f").alias("f_hex"))
    same = F.col("d").eqNullSafe(F.col("d_back")) & F.col("f").eqNullSafe(F.col("f_back"))
    given = rows.select(F.col("key").cast("string").alias("row"), "d", "f")
    return raw.join(back, "row").join(given, "row").select("row", "d_hex", "f_hex", same.alias("same"))


def dynamic_columns(spark, sf):
    """P10 with family and qualifier from the data; records without one are no cells."""
    part = fx.table(spark, sf, "part")
    rows = part.select(
        F.col("p_partkey").alias("key"), F.when(F.col("p_size") % 9 > 0, F.col("p_brand")).alias("family"),
        F.when(F.col("p_size") % 7 > 0, F.concat(F.lit("q."), F.col("p_size").cast("string"))).alias("qualifier"), F.col("p_name").alias("value"),
    )
    return tuples.store_dynamic(rows, now=fx.LOAD_TS)


def sampled_partition(spark, sf):
    """Partition of every order key among 360 by the sampled CDF (the join)."""
    counts = _key_counts(spark, sf)
    cdf = keyspace.sampled_cdf(counts, "key", "cnt", chars=PREFIX_CHARS)
    return keyspace.assign_partition(counts, "key", PARTITIONS, cdf=cdf, chars=PREFIX_CHARS)


AUDIT_OFFSET, AUDIT_LIMIT = 3, 40


def audit_key_file(spark, sf):
    """A key file with blank lines -> window of file order -> audit -> TSV, read back."""
    path = write_lines(fx.audit_key_lines(spark, sf).orderBy("custkey", "i"), shared_path(spark, "key_file"))
    window = key_window(read_key_list(spark, path, with_position=True), AUDIT_OFFSET, AUDIT_LIMIT, order_col="pos").drop("pos")
    out = audit.write_audit(audit.lookup_audit(window, table_cells(spark, sf)), shared_path(spark, "audit"))
    return read_typed_tsv(spark, out, "n bigint, key string, missed int").select("n", F.coalesce("key", F.lit("")).alias("key"), "missed")


def audit_key_list(spark, sf):
    """Every line of a key file with blank lines audited -> TSV, read back; its
    place in file order and whether the window of that order holds it."""
    path = write_lines(fx.audit_key_lines(spark, sf).orderBy("custkey", "i"), shared_path(spark, "key_list"))
    listed = mark_window(read_key_list(spark, path, with_position=True), AUDIT_OFFSET, AUDIT_LIMIT, order_col="pos")
    audited = audit.lookup_audit(listed, table_cells(spark, sf), keep=["place", "in_window"])
    out = audit.write_audit(audited, shared_path(spark, "audit_list"))
    back = read_typed_tsv(spark, out, "n bigint, key string, place bigint, in_window int, missed int")
    return back.withColumn("key", F.coalesce("key", F.lit("")))


# --- regions under a manifest -----------------------------------------------------------

STORE_STARTS = ["15", "2", "3", "4", "5", "6", "7", "8"]
BATCH_ROWS = ("2", "4")  # the rows of the regions that the later batch touches
READ_FACTOR = 64  # cells read for a row returned, at most


def touched_region_upsert(spark, sf):
    """K1: earlier events in a store of nine regions, the later ones of two regions' rows
    upserted: every cell, and the version that wrote its file (1: rewritten; 0: as it was)."""
    ev = _event_table(spark, sf)
    base = store.create_store(ev.where(F.col("ts") < UPSERT_CUTOFF_MS), shared_path(spark, "store"), STORE_STARTS, _layout_parts(spark))
    lo, hi = BATCH_ROWS
    later = scan.row_range(ev.where(F.col("ts") >= UPSERT_CUTOFF_MS), gte=lo, lt=hi)
    now = store.upsert_store(base, later, _layout_parts(spark))
    return store.read_store(now, with_file=True).select("row", "family", "qualifier", "ts", "value", F.col("version").alias("file_version"))


def _user_store(spark, sf):
    cells_ = table_cells(spark, sf)
    return store.create_store(cells_, shared_path(spark, "users"), splits.key_starts(cells_, "row", REGIONS), _layout_parts(spark))


def indexed_audit(spark, sf):
    """A key list checked through the store's file index; whether files were left out."""
    users, keys = _user_store(spark, sf), fx.indexed_keys(spark, sf)
    found, opened = store.multi_get(users, keys)
    skipped = F.lit(opened < users.files.count()).alias("skipped")
    return audit.lookup_audit(keys, found).select("n", "key", "missed", skipped)


def early_region_limit(spark, sf):
    """The first rows of every region, read from the regions' fronts; whether the cells read
    are bounded by regions x limit."""
    events = store.create_store(_event_table(spark, sf), shared_path(spark, "events"), REGION_STARTS, _layout_parts(spark))
    rows, read = store.first_rows(events, lambda found: scan.scan_columns(found, SCAN_COLUMNS), REGION_LIMIT)
    return rows.withColumn("bounded", F.lit(read <= (len(REGION_STARTS) + 1) * REGION_LIMIT * READ_FACTOR))


BYTE_RANGE = (r"\x80", r"\xff")


def byte_key_range(spark, sf):
    """Cells with byte row keys in regions of their quantiles; the keys within two
    escaped byte bounds."""
    cells_ = scan.byte_keys(cells.bulk_cells(fx.line_input(spark, sf, "byte_key_lines"), ts=fx.LOAD_TS))
    kept = store.create_store(cells_, shared_path(spark, "bytes"), splits.key_starts(cells_, "row", REGIONS), _layout_parts(spark))
    found = store.read_store(kept, gte=BYTE_RANGE[0], lt=BYTE_RANGE[1])
    return found.select(F.hex("row").alias("row_hex"), "family", "qualifier", "ts", "value")


RUN_CUTS_MS = (1704500000000, 1705000000000, 1705500000000, 1706000000000, 1706250000000)


def merged_run_cells(spark, sf):
    """K1/A2: the earliest events as a snapshot, later slices as sorted runs, which are
    compacted by size; the table state from a merge join."""
    ev, buckets = _event_table(spark, sf), _layout_parts(spark)
    base, runs = tables.load_cell_table(ev.where(F.col("ts") < RUN_CUTS_MS[0]), buckets), []
    for lo, hi in zip(RUN_CUTS_MS, [*RUN_CUTS_MS[1:], 1 << 62]):
        batch = ev.where((F.col("ts") >= lo) & (F.col("ts") < hi))
        runs = tables.compact_runs(spark, [*runs, tables.append_delta(batch, buckets=buckets)], buckets)
    return tables.read_merged(spark, base, runs, buckets)


def hot_region_files(spark, sf):
    """Order keys, a third of them below one prefix, in region directories; the rows of a
    key range and whether every region is below twice its share."""
    counted = shared_path(spark, "hot_counts")
    fx.line_input(spark, sf, "hot_key_counts").write.parquet(counted)
    kc = spark.read.parquet(counted)
    starts = splits.key_starts(kc, "key", REGIONS)
    path = files.write_region_cells(_count_cells(kc), shared_path(spark, "hot_regions"), starts, _layout_parts(spark))
    stored = spark.read.parquet(path)
    mass = stored.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    even = mass.agg((F.max("n") * REGIONS <= 2 * F.sum("n")).alias("balanced")).first()["balanced"]
    lo, hi = REGION_SCAN
    return scan.scan_regions(stored, starts, gte=lo, lt=hi).select("row", "family", "qualifier", "ts", "value", F.lit(even).alias("balanced"))


def _count_cells(kc):
    return kc.select(
        F.col("key").alias("row"), F.lit("k").alias("family"), F.lit("n").alias("qualifier"),
        F.lit(fx.LOAD_TS).cast("bigint").alias("ts"), F.col("cnt").cast("string").alias("value"),
    )


RUN_PARTITIONS = 36


def placed_runs(spark, sf):
    """U4: the same keys placed by partition, hot partitions cut into ordered runs of a file
    each: rows of each partition, those misplaced, and whether the largest file is below
    twice the mean."""
    kc = fx.line_input(spark, sf, "hot_key_counts")
    cdf = keyspace.sampled_cdf(_key_counts(spark, sf), "key", "cnt", chars=PREFIX_CHARS)
    path = shared_path(spark, "runs")
    starts = files.write_partition_runs(_count_cells(kc), path, RUN_PARTITIONS, cdf, PREFIX_CHARS)
    stored = spark.read.parquet(path).select("row", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int").alias("file"))
    told = keyspace.assign_run(stored, "row", RUN_PARTITIONS, starts, cdf, PREFIX_CHARS)
    files_ = told.groupBy("partition", "file").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("file") != F.col("run_id")).cast("long")).alias("wrong"))
    even = files_.agg((F.max("n") <= 2 * F.avg("n")).alias("balanced")).first()["balanced"]
    each = files_.groupBy("partition").agg(F.sum("n").alias("n"), F.sum("wrong").alias("misplaced"))
    return each.withColumn("balanced", F.lit(even))


PAGE = 50


def family_pages(spark, sf):
    """Whole families of rows of very different width, in pages with a cursor."""
    paged = scan.scan_pages(fx.line_item_cells(spark, sf), "li", PAGE)
    told = F.array_join(F.transform("bag", lambda c: F.concat_ws("=", c["qualifier"], c["value"])), ",")
    return paged.select("row", "page", F.size("bag").cast("long").alias("n"), "cursor", F.sha2(told, 256).alias("bag_sha256"))


def sorted_bag_files(spark, sf):
    """O2: the cells of each row in the order in which a file holds them."""
    path = shared_path(spark, "bags")
    store_bag_cells(spark, sf).write.parquet(path)
    stored = spark.read.parquet(path).select("row", "qualifier", F.struct("_metadata.file_path", "_metadata.row_index").alias("at"))
    held = F.transform(F.sort_array(F.collect_list(F.struct("at", "qualifier"))), lambda x: x["qualifier"])
    rows = stored.groupBy("row").agg(held.alias("held"))  # two cells a row
    return rows.select("row", F.size("held").cast("long").alias("n"), (F.col("held") == F.array_sort("held")).alias("in_order"))


def _backwards(c, dtype):
    return F.reverse(c.cast("string")).cast(dtype)


def callable_caster(spark, sf):
    """Values stored by a caster of the caller's (text backwards), seen as stored and as
    loaded back by it."""
    rows = fx.part_rows(spark, sf).select("key", "name", "size")
    stored = tuples.store_rows(rows, "b:name b:size", caster=lambda c, _: F.reverse(c.cast("string")), now=fx.LOAD_TS)
    raw = scan.scan_columns(stored, "b:name b:size").toDF("row", "raw_name", "raw_size")
    return scan.scan_typed(stored, "b:name b:size", ["string", "int"], caster=_backwards).join(raw, "row")


def sketched_cdf(spark, sf):
    """A quantile sketch saved with each of three loads, merged to a CDF, beside the exact
    one: whether it is within the sketch's error."""
    path = shared_path(spark, "sketches")
    li = fx.table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("key"), "l_returnflag")
    for flag in ("A", "N", "R"):
        keyspace.key_sketch(li.where(F.col("l_returnflag") == flag), "key", PREFIX_CHARS).write.mode("append").parquet(path)
    told = keyspace.sketch_cdf(spark.read.parquet(path), PREFIX_CHARS).withColumnRenamed("cdf", "told")
    near = F.abs(F.col("told") - F.col("cdf")) <= keyspace.SKETCH_ERROR
    return sampled_cdf(spark, sf).join(told, "prefix").select("prefix", "n", "cdf", near.alias("within"))


# --- key space ----------------------------------------------------------------------


def _key_counts(spark, sf):
    return fx.line_input(spark, sf, "key_counts")


def sampled_cdf(spark, sf):
    """Sampled CDF of the order keys over the 3-digit prefix grid."""
    return keyspace.sampled_cdf(_key_counts(spark, sf), "key", "cnt", chars=PREFIX_CHARS)


def sampled_cdf_file(spark, sf):
    """The sampled CDF from a TSV file of (key, count) samples."""
    lines = _key_counts(spark, sf).select(F.concat_ws("\t", "key", F.col("cnt").cast("string")).alias("line"))
    path = write_lines(lines, shared_path(spark, "samples"))
    return keyspace.sampled_cdf(read_sample_counts(spark, path), "key", "cnt", chars=PREFIX_CHARS)


def benford_cdf(spark, sf):
    """Benford CDF of the prefix grid, with the number of order keys per prefix; keys
    off the grid are counted in the NULL row."""
    prefix = F.substring("key", 1, PREFIX_CHARS)
    on_grid = prefix.rlike(f"^[1-9][0-9]{{{PREFIX_CHARS - 1}}}$")
    observed = _key_counts(spark, sf).groupBy(F.when(on_grid, prefix).cast("int").alias("prefix")).agg(F.count(F.lit(1)).alias("keys"))
    theory = keyspace.benford_cdf(spark, PREFIX_CHARS)
    return theory.join(observed, "prefix", "full_outer").select(
        "prefix", F.round("cdf", CDF_DIGITS).alias("cdf"), F.coalesce("keys", F.lit(0)).alias("keys")
    )


def assign_partition(spark, sf):
    """Partition of every order key among 360 by the Benford CDF."""
    return keyspace.assign_partition(_key_counts(spark, sf), "key", PARTITIONS, chars=PREFIX_CHARS)


def partition_histogram(spark, sf):
    """A4: order keys per bin (10 bins; unknown prefixes in the NULL bin)."""
    return keyspace.partition_histogram(_key_counts(spark, sf), "key", bins=HISTOGRAM_BINS, chars=PREFIX_CHARS)


# --- audit and scalar functions -----------------------------------------------------


def lookup_audit(spark, sf):
    """Every listed key checked against the user table's rows, numbered."""
    return audit.lookup_audit(fx.audit_keys(spark, sf), table_cells(spark, sf))


def row_json_q(spark, sf):
    """Name, brand and size of every part as a JSON object."""
    rows = fx.part_rows(spark, sf)
    return rows.select("key", row_json(["name", "brand", "size"], "name,brand,size").alias("json"))


def flat_ts_millis(spark, sf):
    """Order dates as flat text and back to epoch milliseconds."""
    d = fx.flat_dates(spark, sf)
    return d.select("o_orderkey", "flat", flat_to_millis("flat").alias("millis"))


QUERIES: dict[str, Query] = {
    "tsv_fields": tsv_fields,
    "typed_tsv_load": typed_tsv_load,
    "bulk_cells": bulk_cells,
    "table_cells": table_cells,
    "composite_key_cells": composite_key_cells,
    "file_cells": file_cells,
    "edge_cells": edge_cells,
    "adjacency_cells": adjacency_cells,
    "follow_cells": follow_cells,
    "follow_rejects": follow_rejects,
    "mention_cells": mention_cells,
    "mention_rejects": mention_rejects,
    "store_row_cells": store_row_cells,
    "store_dynamic_cells": store_dynamic_cells,
    "store_bag_cells": store_bag_cells,
    "encode_values": encode_values,
    "decode_values": decode_values,
    "latest_cells": latest_cells,
    "scan_columns": scan_columns,
    "scan_family": scan_family,
    "scan_range": scan_range,
    "scan_region_limit": scan_region_limit,
    "upsert_cells": upsert_cells,
    "merged_delta_cells": merged_delta_cells,
    "sorted_cells": sorted_cells,
    "scan_region_files": scan_region_files,
    "loaded_sorted_files": loaded_sorted_files,
    "collapsed_cells": collapsed_cells,
    "float_values": float_values,
    "dynamic_columns": dynamic_columns,
    "sampled_partition": sampled_partition,
    "audit_key_file": audit_key_file,
    "audit_key_list": audit_key_list,
    "placed_partition_rows": placed_partition_rows,
    "sampled_cdf_file": sampled_cdf_file,
    "scan_bounds": scan_bounds,
    "scan_empty_cells": scan_empty_cells,
    "touched_region_upsert": touched_region_upsert,
    "indexed_audit": indexed_audit,
    "early_region_limit": early_region_limit,
    "byte_key_range": byte_key_range,
    "merged_run_cells": merged_run_cells,
    "hot_region_files": hot_region_files,
    "placed_runs": placed_runs,
    "family_pages": family_pages,
    "sorted_bag_files": sorted_bag_files,
    "callable_caster": callable_caster,
    "sketched_cdf": sketched_cdf,
    "sampled_cdf": sampled_cdf,
    "benford_cdf": benford_cdf,
    "assign_partition": assign_partition,
    "partition_histogram": partition_histogram,
    "lookup_audit": lookup_audit,
    "row_json": row_json_q,
    "flat_ts_millis": flat_ts_millis,
}
