"""Skew probe: one row key holds a third of all cells.  Runs the shuffle-bearing paths
and reads Spark's event log (written to a scratch folder) to report, per stage, how
many records the largest task read compared with the median task."""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cellforge.operators import audit, files, tables, versions  # noqa: E402
from cellforge.session import local_session, shared_path  # noqa: E402
from cellforge.sources import fixtures as fx  # noqa: E402


def main():
    sf = os.environ.get("PROBE_SF_DIR", "/root/testdata/sf0.1")
    k = int(os.environ.get("PROBE_COPIES", "10"))
    log_dir = tempfile.mkdtemp(prefix="cellforge-events-")
    spark = local_session(8, app="cellforge-skew", conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                                          "spark.eventLog.compress": "false",
                                                          "spark.sql.shuffle.partitions": "16"})
    ev = fx.table(spark, sf, "events")
    copies = [ev.select((F.col("event_id") + i * 10**9).alias("event_id"), "ts", "user_id", "event_type") for i in range(k)]
    events = copies[0]
    for c in copies[1:]:
        events = events.unionByName(c)
    # a third of all cells on the row "hot"; the rest spread over the users
    row = F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("user_id").cast("string"))
    cells = events.select(row.alias("row"), F.lit("ev").alias("family"),
                          F.concat(F.col("event_type"), (F.col("event_id") % 50).cast("string")).alias("qualifier"),
                          F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")).alias("ts"),
                          F.col("event_id").cast("string").alias("value"))
    jobs = {}

    def run(name, fn):
        spark.sparkContext.setJobGroup(name, name)
        fn()
        jobs[name] = True

    run("sorted_full_order", lambda: files.write_sorted_cells(cells, shared_path(spark, "skew_sorted"), 16))
    run("sorted_whole_rows", lambda: files.write_sorted_cells(cells, shared_path(spark, "skew_rows"), 16, whole_rows=True))
    run("latest", lambda: versions.latest_cells(cells).write.format("noop").mode("overwrite").save())
    holder = {}
    run("bucketed_load", lambda: holder.setdefault("base", tables.load_cell_table(cells.where("ts < 1705363200000"), 16)))
    base = holder["base"]
    run("upsert", lambda: tables.upsert_table(spark, base, cells.where("ts >= 1705363200000"), 16))
    run("row_number", lambda: audit.with_row_number(cells.select(F.col("row").alias("key")), ["key"], partitions=16)
        .write.format("noop").mode("overwrite").save())
    spark.stop()

    stage_group, reads = {}, defaultdict(list)
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in paths:
        if os.path.basename(path).startswith(("appstatus", ".")):
            continue
        for line in open(path):
            if not line.startswith("{"):
                continue
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                group = e.get("Properties", {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    stage_group[sid] = group
            elif e["Event"] == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                shuffled = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                if shuffled:
                    reads[e["Stage ID"]].append(shuffled)
    report = []
    for sid, recs in sorted(reads.items()):
        if len(recs) < 2:
            continue
        report.append({"group": stage_group.get(sid), "stage": sid, "tasks": len(recs), "max_share": round(max(recs) / sum(recs), 3),
                       "max_over_median": round(max(recs) / max(statistics.median(recs), 1), 1)})
    print(json.dumps({"hot_row_share": 1 / 3, "stages": report}))


if __name__ == "__main__":
    main()
