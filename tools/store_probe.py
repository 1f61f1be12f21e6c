"""Throughput probe of the region store and of sorted runs, over k shifted copies of events.

A batch for one region's rows is upserted into a store and, for comparison, into a bucketed
snapshot; keys are looked up through the file index and by a join; the first rows of all
regions are read from the front and from the whole table.  Also the encoding of doubles, by the
JVM's bit view and by a vectorised form.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from cellforge.functions.codecs import encode_value  # noqa: E402
from cellforge.operators import audit, scan, splits, store, tables  # noqa: E402
from cellforge.session import local_session, shared_path  # noqa: E402
from cellforge.sources import fixtures as fx  # noqa: E402
from tools.scale_probe import copies, timed  # noqa: E402

REGIONS, FILES, BUCKETS = 64, 64, 16


def main():
    sf = os.environ.get("PROBE_SF_DIR", "/root/testdata/sf0.1")
    k = int(os.environ.get("PROBE_COPIES", "20"))
    doubles = int(os.environ.get("PROBE_DOUBLES", "10000000"))
    spark = local_session(os.environ.get("PROBE_CPUS", "8"), app="cellforge-store-probe")
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    li = copies(fx.table(spark, sf, "lineitem"), ["l_orderkey"], k, 10**8)
    path = shared_path(spark, "probe_cells")
    li.select(
        F.col("l_orderkey").cast("string").alias("row"), F.lit("l").alias("family"), F.col("l_linenumber").cast("string").alias("qualifier"),
        F.lit(1).cast("bigint").alias("ts"), F.col("l_partkey").cast("string").alias("value"),
    ).write.parquet(path)
    cells, res = spark.read.parquet(path), {}
    res["cells"] = cells.count()
    starts, res["starts_64"] = timed(lambda: splits.key_starts(cells, "row", REGIONS))
    kept, res["create_store"] = timed(lambda: store.create_store(cells, shared_path(spark, "probe_store"), starts, FILES))
    snapshot, res["create_snapshot"] = timed(lambda: tables.load_cell_table(cells, BUCKETS))
    batch = cells.where((F.col("row") >= starts[9]) & (F.col("row") < starts[10])).withColumn("ts", F.lit(2).cast("bigint"))
    res["batch"] = batch.count()
    kept, res["upsert_one_region"] = timed(lambda: store.upsert_store(kept, batch, 2))
    _, res["upsert_snapshot"] = timed(lambda: tables.upsert_table(spark, snapshot, batch, BUCKETS))
    run, res["append_run"] = timed(lambda: tables.append_delta(batch, buckets=BUCKETS))
    _, res["read_merged_run"] = timed(lambda: noop(tables.read_merged(spark, snapshot, [run], BUCKETS)))
    keys = batch.select(F.col("row").alias("key")).distinct().limit(1000)
    (found, res["files_opened"]), res["multi_get_plan"] = timed(lambda: store.multi_get(kept, keys))
    _, res["multi_get_audit"] = timed(lambda: noop(audit.lookup_audit(keys, found, numbered=False)))
    _, res["join_audit"] = timed(lambda: noop(audit.lookup_audit(keys, store.read_store(kept), numbered=False)))
    look = lambda c: scan.scan_columns(c, "l:1 l:2")
    (rows, res["cells_read"]), took = timed(lambda: store.first_rows(kept, look, 5))
    res["first_rows"] = round(took + timed(lambda: noop(rows))[1], 3)
    whole = look(store.read_store(kept)).withColumn("region", scan.region_of("row", starts))
    _, res["limit_of_all"] = timed(lambda: noop(scan.limit_per_region(whole, "region", 5)))
    path = shared_path(spark, "probe_doubles")
    spark.range(0, doubles, 1, 8).select((F.col("id") * 1.37 - 5e6).alias("d")).write.parquet(path)

    @F.pandas_udf("binary")
    def vectorised(values):
        import pandas as pd

        return pd.Series(list(map(bytes, values.to_numpy().astype(">f8").view("V8"))))

    for name, column in (("doubles_jvm", encode_value(F.col("d"), T.DoubleType(), "binary")), ("doubles_vectorised", vectorised("d"))):
        _, res[name] = timed(lambda: noop(spark.read.parquet(path).select(column.alias("x"))))  # noqa: B023
    print(json.dumps(res | {"copies": k, "at": time.strftime("%Y-%m-%d")}))
    spark.stop()


if __name__ == "__main__":
    main()
