"""Linearity probe: best-of-2 times of the version merge and the named-column scan over
k and 2k shifted copies of ``events`` in one process (same warm JVM, 16 partitions)."""

from __future__ import annotations

import json
import os
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cellforge.functions.scalars import ntz_to_millis  # noqa: E402
from cellforge.operators import scan, versions  # noqa: E402
from cellforge.session import local_session  # noqa: E402
from cellforge.sources import fixtures as fx  # noqa: E402


def cells(ev, k):
    copies = [ev.select((F.col("user_id") + i * 10**9).alias("user_id"), "event_type", "ts", "event_id", "props")
              for i in range(k)]
    e = reduce(lambda a, b: a.unionByName(b), copies)

    def cell(family, value):
        return F.struct(F.col("user_id").cast("string").alias("row"), F.lit(family).alias("family"),
                        F.col("event_type").alias("qualifier"), ntz_to_millis("ts").alias("ts"), value.alias("value"))

    return e.select(F.inline(F.array(cell("ev", F.col("event_id").cast("string")), cell("props", F.col("props")))))


def best(fn, n=2):
    times = []
    for _ in range(n):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return round(min(times), 2)


def main():
    sf = os.environ.get("PROBE_SF_DIR", "/root/testdata/sf0.1")
    k = int(os.environ.get("PROBE_COPIES", "20"))
    spark = local_session(8, app="cellforge-linearity", conf={"spark.sql.shuffle.partitions": "16"})
    ev = fx.table(spark, sf, "events")
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    out = {}
    for copies in (k, 2 * k):
        c = cells(ev, copies)
        out[copies] = {
            "cells": 2 * ev.count() * copies,
            "latest": best(lambda: noop(versions.latest_cells(c))),
            "scan_columns": best(lambda: noop(scan.scan_columns(c, "ev:click ev:view props:purchase"))),
        }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
