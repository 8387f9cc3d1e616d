"""Times the registered queries and prints one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) on local[BENCH_CPUS]. Tables are
timed by the better of two runs, streams, which start from fresh paths, by one.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

from adstream.plans.catalog import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))


def seconds(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("adstream-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "4g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    names = sys.argv[1:] or list(QUERIES)
    seconds(spark, "parse_clicks")
    timings = {}
    for name in names:
        streaming = name.startswith(("stream_", "medallion"))
        timings[name] = round(min(seconds(spark, name) for _ in range(1 if streaming else 2)), 3)
        print(name, timings[name], file=sys.stderr)
    scale = re.search(r"sf([\d.]+)/?$", SF_DIR)
    result = {
        "metric": "total seconds of all queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(scale.group(1)) if scale else None,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
