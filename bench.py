"""Times the registered queries; prints one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local cores, BENCH_RUNS the runs per
query after one unmeasured run (the median counts), BENCH_QUERIES an optional list of names.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.compare import local_session  # noqa: E402
from checks.queries import REGISTERED  # noqa: E402


def seconds(build, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", "")
    chosen = names.split(",") if names else list(REGISTERED)
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in chosen:
        seconds(REGISTERED[name], spark, sf_dir)
        times[name] = round(
            statistics.median(seconds(REGISTERED[name], spark, sf_dir) for _ in range(runs)), 3
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the registered queries, warm, median run each",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
