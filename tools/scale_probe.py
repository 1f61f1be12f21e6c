"""Throughput probe: the main load paths over k shifted copies of the driver tables.

Copies are unions of the same table with keys shifted by a multiple of the key range,
so the data is derived from the given tables and grows with k.  Every path ends in the
``noop`` sink or a real write to the shared folder.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cellforge.operators import files, relations, scan, tables, versions  # noqa: E402
from cellforge.session import local_session, shared_path  # noqa: E402
from cellforge.sources import fixtures as fx  # noqa: E402


def copies(df, key_cols, k, step):
    return reduce(
        lambda a, b: a.unionByName(b),
        [df.select(*[(F.col(c) + i * step).alias(c) if c in key_cols else F.col(c) for c in df.columns]) for i in range(k)],
    )


def timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return out, round(time.perf_counter() - t0, 3)


def main():
    sf = os.environ.get("PROBE_SF_DIR", "/root/testdata/sf0.1")
    k = int(os.environ.get("PROBE_COPIES", "20"))
    spark = local_session(os.environ.get("PROBE_CPUS", "8"), app="cellforge-probe")
    orders = copies(fx.table(spark, sf, "orders"), ["o_orderkey", "o_custkey"], k, 10**9)
    events = copies(fx.table(spark, sf, "events"), ["event_id", "user_id"], k, 10**9)
    follow_lines = spark.sql(fx.LINE_SQL["follow_lines"], orders=orders)
    n_lines = orders.count()
    ev_cells = events.select(
        F.col("user_id").cast("string").alias("row"), F.lit("ev").alias("family"), F.col("event_type").alias("qualifier"),
        F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")).alias("ts"),
        F.col("event_id").cast("string").alias("value"),
    ).unionByName(events.select(
        F.col("user_id").cast("string").alias("row"), F.lit("props").alias("family"), F.col("event_type").alias("qualifier"),
        F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")).alias("ts"),
        F.col("props").alias("value"),
    ))
    n_cells = 2 * events.count()
    res = {}
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    _, res["follow_load"] = timed(lambda: noop(relations.follow_cells(follow_lines, ts=1)))
    _, res["follow_rejects"] = timed(lambda: relations.follow_rejects(follow_lines).collect())
    _, res["latest"] = timed(lambda: noop(versions.latest_cells(ev_cells)))
    _, res["scan_columns"] = timed(lambda: noop(scan.scan_columns(ev_cells, "ev:click ev:view props:purchase")))
    _, res["sorted_files"] = timed(lambda: files.write_sorted_cells(ev_cells, shared_path(spark, "probe_sorted"), 16))
    base, res["bucketed_load"] = timed(lambda: tables.load_cell_table(ev_cells.where("ts < 1705363200000"), 16))
    _, res["bucketed_upsert"] = timed(lambda: tables.upsert_table(spark, base, ev_cells.where("ts >= 1705363200000"), 16))
    # counters in the load's own pass vs a separate counting pass (best of 2 each)
    from pyspark.sql import Observation

    def load_with_counters():
        obs = Observation()
        noop(relations.follow_cells(follow_lines, ts=1, observation=obs))
        return obs.get

    def best(fn, n=2):
        return min(timed(fn)[1] for _ in range(n))

    res["follow_load_best"] = best(lambda: noop(relations.follow_cells(follow_lines, ts=1)))
    res["follow_load_plus_count_pass_best"] = best(
        lambda: (noop(relations.follow_cells(follow_lines, ts=1)), relations.follow_rejects(follow_lines).collect())
    )
    res["follow_load_with_observed_counters_best"] = best(load_with_counters)

    # upsert a 5% batch into a snapshot with one coordinate per event
    snap_cells = events.select(
        F.col("user_id").cast("string").alias("row"), F.lit("ev").alias("family"),
        F.col("event_id").cast("string").alias("qualifier"),
        F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")).alias("ts"),
        F.col("props").alias("value"),
    )
    batch = snap_cells.where(F.col("qualifier").cast("bigint") % 20 == 0).select(
        "row", "family", "qualifier", (F.col("ts") + 1).alias("ts"), F.concat("value", F.lit("'")).alias("value"))
    snapshot = tables.load_cell_table(snap_cells, 16)
    snapshot_path = shared_path(spark, "plain_snapshot")
    spark.table(snapshot).write.parquet(snapshot_path)
    res["snapshot_cells"] = spark.table(snapshot).count()
    res["batch_cells"] = batch.count()
    res["upsert_batch_bucketed_best"] = best(lambda: tables.upsert_table(spark, snapshot, batch, 16))
    res["upsert_batch_plain_best"] = best(
        lambda: versions.upsert_cells(spark.read.parquet(snapshot_path), batch).write.parquet(shared_path(spark, "plain"))
    )
    print(json.dumps({"copies": k, "follow_lines": n_lines, "event_cells": n_cells, "seconds": res,
                      "follow_lines_per_s": round(n_lines / res["follow_load"]),
                      "cells_per_s_latest": round(n_cells / res["latest"])}))


if __name__ == "__main__":
    main()
