"""Benchmark: run every registered plan over the whole tables at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each plan is executed to completion with the ``noop`` sink (all rows computed, nothing
collected to the driver). Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {name: sec}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from alignfold.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", app="alignfold-bench", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    from alignfold.plans.registry import QUERIES, load_all

    load_all()
    names = only or sorted(QUERIES)
    # warm-up, not timed: JVM, codegen caches, file listing and the Python worker pool
    QUERIES["prompt_set"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(int(cpus) * 4, numPartitions=int(cpus)).mapInPandas(lambda it: it, "id long") \
        .write.format("noop").mode("overwrite").save()
    times, errors, runs = {}, {}, {}
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    for name in names:
        took = []
        try:
            while len(took) < repeats and (not took or took[0] < 3):  # the slow ones run once
                t = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                took.append(time.perf_counter() - t)
            times[name], runs[name] = round(statistics.median(took), 3), len(took)
        except Exception as e:  # report, keep benchmarking the rest
            errors[name] = repr(e)[:300]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
           "sf": float(m.group(1)) if m else sf_dir, "n_queries": len(times), "cpus": int(cpus),
           "note": "median of three runs, one run from 3 s on", "single_runs": sorted(n for n, k in runs.items() if k == 1)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
