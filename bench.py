"""Benchmark: run every registered query on $BENCH_SF_DIR (default sf0.1) with
local[$BENCH_CPUS] and print one JSON line.

Each query is executed to completion through the ``noop`` sink (no collect to
the driver).  Landing the test data (once per application, shared by all
queries) is timed by itself as ``landing_sec``.  After one warm-up pass over all queries, each query is timed
$BENCH_REPEAT times (default 1) and its median is reported; ``value`` is the
sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from funnelspark.queries import QUERIES
    from funnelspark.session import build_session

    # local mode: the driver JVM is the whole cluster, so give it the memory.
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    names = [n for n in QUERIES if not only or n in only]

    def run(name: str) -> float:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    from funnelspark.sources import landing
    t = time.perf_counter()  # the test data are landed once, outside the queries: timed and reported beside them
    landing.event_log(spark, sf_dir)
    landing.export_dir(spark, sf_dir)
    landed = round(time.perf_counter() - t, 3)
    for n in names:  # warm-up: JIT, file listing, codegen caches
        run(n)
    times = {n: round(statistics.median(run(n) for _ in range(repeat)), 3) for n in names}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "landing_sec": landed, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
