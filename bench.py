"""Benchmark the headline queries.

Runs every catalogue entry marked ``bench`` at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]``: one warm-up and
``$BENCH_RUNS`` (default 3) timed runs each, the whole plan executed into
the ``noop`` sink. Prints ONE JSON line; ``value`` is the sum of the
per-query medians."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)
# the tasks' Python finds the package wherever the benchmark is started
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [HERE, os.environ.get("PYTHONPATH")]))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    from domus.session import build_session
    # spark.checkpoint.dir: taken from the session; only set (to a fresh
    # temporary folder) by build_session when the deployment names none
    spark = build_session(f"local[{cpus}]", "domus-bench", shuffle_partitions=int(cpus))
    from domus import plans
    timings: dict[str, float] = {}
    for name, fn in plans.bench_queries().items():
        if only and name not in only:
            continue
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            df = fn(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                samples.append(dt)
        timings[name] = round(statistics.median(samples), 3)
    total = round(sum(timings.values()), 3)
    sf = sf_dir.rsplit("sf", 1)[-1] if "sf" in sf_dir else sf_dir
    print(json.dumps({"metric": "headline_queries_total_median", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": int(cpus), "runs": runs,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
