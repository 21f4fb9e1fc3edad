"""Time the registered queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores. The warehouse build is timed on its own;
every query then runs to a sink that discards its rows, so the whole plan is executed. Progress goes to stderr.
"""

from __future__ import annotations

import json
import os
import sys
import time

from stayledger.plans.query_book import queries
from stayledger.plans.warehouse_build import warehouse_for
from stayledger.session import local_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    chosen = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]
    seconds: dict[str, float] = {}

    def timed(name, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)

    timed("warehouse_build", lambda: warehouse_for(spark, folder))
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        timed(name, lambda: query(spark, folder).write.format("noop").mode("overwrite").save())
    spark.stop()
    line = {
        "metric": "total seconds over all queries, warehouse build included",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
