"""Benchmark the headline queries.

Runs each registered bench query on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one JSON line.
Every query is fully executed through the ``noop`` sink (all rows
computed, nothing collected to the driver). Each query runs once to warm
up, then ``$BENCH_REPEAT`` times (default 3); the median is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quire.plans import registry  # noqa: E402
from quire.session import build_session, clear_tables, let_workers_import  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    # the bench tables are single files: deal their texts out over the cores
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="quire-bench",
                          extra={"spark.quire.textPartitions": cpus})
    let_workers_import(spark, os.path.dirname(os.path.abspath(__file__)))
    registry.load_all()
    names = names or list(registry.BENCH)
    times = {}
    for n in names:
        fn = registry.QUERIES[n]
        runs = []
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                runs.append(dt)
        times[n] = round(median(runs), 3)
        clear_tables(spark)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
