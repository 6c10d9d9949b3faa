"""Time every registered query; prints one JSON line.

Each query is planned and run to a sink that discards rows, ``BENCH_RUNS``
times after a warm-up on the same session; the smallest time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from tidemark.session import local_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = sys.argv[1:]
    spark = local_session(cores, memory=os.environ.get("BENCH_MEMORY", "8g"), app="bench")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("page_view_hourly")
    seconds: dict[str, float] = {}
    for name in only or QUERIES:
        seconds[name] = round(min(run(name) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "runs": runs,
                "statistic": "min",
                "cores": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
