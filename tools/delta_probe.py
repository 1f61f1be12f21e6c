"""Delta probe: upsert 100,000 new versions into a 2,000,000-cell bucketed snapshot (20
copies of ``events``, one coordinate per event) by rewriting the snapshot vs appending a
delta, and the cost of reading the snapshot alone vs merged with the delta.  Best of 2."""

import os
import sys
import time
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from functools import reduce
from pyspark.sql import functions as F
from cellforge.session import local_session
from cellforge.sources import fixtures as fx
from cellforge.operators import tables
spark = local_session(8, conf={"spark.sql.shuffle.partitions": "16"})
ev = fx.table(spark, "/root/testdata/sf0.1", "events")
events = reduce(lambda a, b: a.unionByName(b), [ev.select((F.col("event_id") + i * 10**9).alias("event_id"), (F.col("user_id") + i * 10**9).alias("user_id"), "ts", "props") for i in range(20)])
snap_cells = events.select(F.col("user_id").cast("string").alias("row"), F.lit("ev").alias("family"), F.col("event_id").cast("string").alias("qualifier"),
    F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")).alias("ts"), F.col("props").alias("value"))
batch = snap_cells.where(F.col("qualifier").cast("bigint") % 20 == 0).select("row", "family", "qualifier", (F.col("ts") + 1).alias("ts"), F.concat("value", F.lit("'")).alias("value"))
snapshot = tables.load_cell_table(snap_cells, 16)
def best(fn, n=2):
    out = []
    for _ in range(n):
        t = time.perf_counter(); r = fn(); out.append(time.perf_counter() - t)
    return round(min(out), 2), r
t_up, _ = best(lambda: tables.upsert_table(spark, snapshot, batch, 16))
t_app, d = best(lambda: tables.append_delta(batch))
noop = lambda df: df.write.format("noop").mode("overwrite").save()
t_read_snap, _ = best(lambda: noop(spark.table(snapshot)))
t_read_merged, _ = best(lambda: noop(tables.read_merged(spark, snapshot, [d], 16)))
print("DELTA", {"upsert_table_rewrite": t_up, "append_delta": t_app, "read_snapshot": t_read_snap, "read_merged_1_delta": t_read_merged})
