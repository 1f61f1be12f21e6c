"""Bloom probe: the order-line keys of ``lineitem`` in hashed order (min/max statistics cannot help) over many
small row groups; one point lookup with and without the row bloom filter.  The event log
(in a scratch folder) gives the records each lookup read."""

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from pyspark.sql import functions as F
from cellforge.session import local_session, shared_path
from cellforge.operators.files import cell_writer
log_dir = tempfile.mkdtemp(prefix="bloom-events-")
spark = local_session(4, conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false"})
from cellforge.sources import fixtures as fx  # noqa: E402

li = fx.table(spark, os.environ.get("PROBE_SF_DIR", "/root/testdata/sf0.1"), "lineitem")
key = F.format_string("%012d", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
df = (li.select(key.alias("row"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
                F.lit(1).cast("bigint").alias("ts"), F.col("l_partkey").cast("string").alias("value"))
      .orderBy(F.xxhash64("row")).coalesce(1))  # hashed order: min/max statistics cannot skip
probe_key = df.select("row").first()[0]
paths = {}
for bloom in (False, True):
    p = shared_path(spark, f"bloomskip_{bloom}")
    # Small row groups stand in for large ones; dictionaries are turned off because in a
    # 128 MB row group of distinct keys the dictionary overflows and the reader can no
    # longer skip by it -- then only min/max (useless in hashed order) or a bloom filter can.
    (cell_writer(df, bloom=bloom).option("parquet.block.size", 256 * 1024)
     .option("parquet.enable.dictionary", "false").parquet(p))
    paths[bloom] = p
for bloom in (False, True):
    spark.sparkContext.setJobGroup(f"get_{bloom}", f"get_{bloom}")
    n = spark.read.parquet(paths[bloom]).where(F.col("row") == probe_key).count()
    print("GET", bloom, n)
spark.stop()
groups, reads = {}, {}
for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
    if not os.path.isfile(path) or os.path.basename(path).startswith(("appstatus", ".")):
        continue
    for line in open(path):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            g = e.get("Properties", {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                groups[sid] = g
        elif e["Event"] == "SparkListenerTaskEnd":
            m = (e.get("Task Metrics") or {}).get("Input Metrics") or {}
            g = groups.get(e["Stage ID"])
            if g:
                reads[g] = reads.get(g, 0) + m.get("Records Read", 0)
print("READS", reads)
