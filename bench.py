"""Time every registered query and print one JSON line.

Each query runs once to warm up, then ``BENCH_RUNS`` times (default 3);
the median is reported. Results are forced with the ``noop`` sink, which
executes the whole plan without collecting rows to the driver.

Env: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_RUNS`` (default 3), ``BENCH_QUERIES`` (comma list).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from fleetbook.registry import QUERIES
    from fleetbook.session import ensure_checkpoint_dir, local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus), app="fleetbook-bench")
    ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="fleetbook-bench-", dir="/tmp"))

    def run(fn) -> float:
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        run(fn)
        times[name] = round(statistics.median(run(fn) for _ in range(runs)), 4)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
