"""Time every registered query once per run and print one JSON line.

BENCH_SF_DIR   directory of the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
BENCH_REPEAT   timed runs per query, the fastest counts (default 2)
BENCH_ONLY     comma-separated query names (default: all)
"""

from __future__ import annotations

import json
import os
import sys
import time

from matchday.session import local_session
from matchday.plans.star_queries import queries


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = local_session(cpus, "bench", int(cpus) if cpus.isdigit() else 8, **{"spark.driver.memory": "8g"})

    registered = queries()
    registered["table_counts"](spark, sf_dir).collect()  # start the session's lazy parts
    times: dict[str, float] = {}
    for name, build in registered.items():
        if only and name not in only:
            continue
        runs = []
        for _ in range(repeat):
            started = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        times[name] = round(min(runs), 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
