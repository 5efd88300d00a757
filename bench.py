"""Bench: run the headline queries on $BENCH_SF_DIR (default sf0.1) with
local[$BENCH_CPUS] and print one JSON line.

Each query is executed in full with the ``noop`` sink (every row is
computed, nothing is collected to the driver).  After one untimed warm-up
run, each query runs three times and the best time is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from labelweave.plans import catalog  # noqa: E402
from labelweave.session import build_session  # noqa: E402

HEADLINE = [
    "e19_collection_counts",   # flagship: classify every record, count per collection
    "c13_classify",
    "c09_batch_shape_metrics",
    "g01_index_batch",
    "g05_validation_outcome",
    "d06_run_results",
    "e10_event_summary",
    "e13_gate",
    "b11_fingerprint",
    "h04_replay_dedupe",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="labelweave-bench")
    # one untimed run warms the JVM, codegen caches and Python workers
    catalog.QUERIES[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        best = None
        for _ in range(3):
            t0 = time.time()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.time() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
